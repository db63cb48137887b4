import random
import re
from collections import Counter

import duckdb
import pytest

from tierflow.llm import line_frequency as lf
from tierflow.llm import queries

FOLDER = "/root/testdata/sf0.001"


def plain_figures(text):
    """The five figures, position by position."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def plain_line(line):
    line = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    return " ".join(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[0-9]", "0", line)))


def plain_judgement(rows):
    """``(doc_id, words on common lines, base_failed, kept)`` of ``(doc_id, host, text)`` rows."""
    held = {}
    for _, host, text in rows:
        for line in (text or "").split("\n"):
            if plain_line(line):
                held.setdefault((host, plain_line(line)), set()).add(text)
    out = []
    for doc, host, text in rows:
        text = text or ""
        n, _, _, _, repeated = plain_figures(text)
        lost = sum(len(plain_line(x).split()) for x in text.split("\n") if len(held.get((host, plain_line(x)), ())) > 6)
        failed = n < 20 or 100 * repeated > 30 * n
        out.append((doc, lost, failed, not failed and n - lost >= 20 and 2 * (n - lost) >= n))
    return out


def random_text(rng):
    return "".join(rng.choice(["a", "B", "é", "#", "|", " ", " ", "\n", "\t", "\x0b", "\x1c", "　", "1", "ab cd ", "x y\n"])
                   for _ in range(rng.randint(0, 120)))


def test_figures_of_random_texts():
    rng = random.Random(1)
    for text in ["", "\n\n", "a", "a b c d e f g h " * 9, "a b c d e f g h i", *[random_text(rng) * rng.randint(1, 2) for _ in range(400)]]:
        *counts, lines = lf.figures(text.encode())
        assert tuple(counts) == plain_figures(text)
        assert sum(lines.values()) == counts[0]


def table(spark, rows, partitions=3):
    return spark.createDataFrame(
        [(d, h, t, 1, "x") for d, h, t in rows],
        "doc_id long, source string, text string, row int, kept string").repartition(partitions)


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(n))


@pytest.fixture
def corpus():
    rng = random.Random(2)
    foot = "Copyright 2019 by the owners of the site all rights reserved"
    rows = [(i, "a" if i % 3 else None, f"{words(rng, 30)}\n{foot.upper() if i % 2 else foot.replace('2019', '2024')} ") for i in range(40)]
    rows += [(100 + i, "b", f"{words(rng, 15)}\n{foot}") for i in range(9)]  # depleted
    rows += [(200 + i, "c", f"{words(rng, 30)}\n{foot}") for i in range(6)]  # at the limit
    same = words(rng, 25) + "\n" + words(rng, 25)
    rows += [(300 + i % 5, "d", same) for i in range(30)]  # copies, and repeated rows, are one document
    rows += [(None, "a", words(rng, 21)), (None, "a", None), (507, None, ""), (508, "a", words(rng, 40_000)), (509, "a", (foot + " ") * 90)]
    return rows


def test_verdicts_equal_a_plain_version(spark, corpus, rows):
    got = lf.judge(table(spark, corpus))
    assert rows(got, "doc_id", "n_lost_words", "base_failed", "kept") == sorted(plain_judgement(corpus), key=repr)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert not kept[100] and kept[200] and kept[300] and kept[1]


def test_removed_lines_are_cut_from_the_texts(spark, corpus):
    got = lf.clean(table(spark, corpus))
    assert got.columns == ["doc_id", "source", "text", "row", "kept"]
    texts = {r.doc_id: r.text for r in got.collect()}
    before = {d: t for d, _, t in corpus}
    assert texts[1] == before[1].split("\n")[0] and texts[200] == before[200] and 100 not in texts and 509 not in texts
    assert got.where("doc_id between 300 and 304").count() == 30


def test_an_expression_may_name_the_host(spark):
    rng = random.Random(3)
    rows_ = [(i, f"http://h{i % 2}.org/p{i}?q", words(rng, 30) + "\nthe same line") for i in range(10)]
    docs = spark.createDataFrame(rows_, "doc_id long, url string, text string")
    from pyspark.sql import functions as F
    assert lf.judge(docs, F.expr("parse_url(url, 'HOST')"), line_docs=4).where("n_common_lines = 1").count() == 10
    assert lf.judge(docs, F.expr("parse_url(url, 'HOST')"), line_docs=5).where("n_common_lines = 1").count() == 0


def test_empty_tables(spark):
    docs = table(spark, [(1, "a", "x")]).limit(0)
    assert lf.judge(docs).count() == 0 and lf.clean(docs).count() == 0


def test_query_equals_its_sql(spark, rows):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    found = con.execute(queries.ORACLES["op11_line_frequency"])
    names = [d[0] for d in found.description]
    assert rows(queries.QUERIES["op11_line_frequency"](spark, FOLDER).select(*names)) == sorted(found.fetchall(), key=repr)
