import random
from collections import Counter

import pytest

from tierflow.llm import decontamination as dc


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def plain_similarity(a, b, k):
    x = Counter(tuple(a[i:i + k]) for i in range(len(a) - k + 1))
    y = Counter(tuple(b[i:i + k]) for i in range(len(b) - k + 1))
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def plain(doc, items):
    """Every window of the item's size in every document."""
    d, out = [w.decode() for w in dc.words_of((doc or "").encode())], {}
    for item, text in items:
        t = [w.decode() for w in dc.words_of((text or "").encode())]
        k, n = min(5, len(t)), min(len(t), len(d))
        if not t or n < k:
            continue
        best = max((plain_similarity(d[s:s + n], t, k), -s) for s in range(len(d) - n + 1))
        if best[0] >= 0.8:
            out[item] = (-best[1], n, round(best[0], 9))
    return out


def make(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.choice([1, 3, 5, 8, 15, 40, 41, 60]))) for i in range(25)]
    docs = []
    for _ in range(80):
        body = words(rng, rng.randint(0, 120))
        for _ in range(rng.randint(0, 2)):
            passage = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(passage))
                rng.choice([lambda: passage.__setitem__(at, "edit"), lambda: passage.insert(at, "new")])()
            cut = rng.randint(0, len(body))
            body[cut:cut] = passage
        docs.append(" ".join(body))
    items = [(i, " ".join(t)) for i, t in items]
    docs += [items[9][1].upper().replace(" ", ", ") + "!", None, "", "...", items[3][1] * 1]
    return docs, items + [(98, None), (99, " .")]


@pytest.mark.parametrize("seed,block", [(1, 4 << 20), (2, 300)])
def test_against_all_windows(docs, spark, seed, block):
    texts, items = make(seed)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in dc.matches(docs(enumerate(texts), 3), bench, block_bytes=block).collect():
        got.setdefault(r.doc_id, {})[r.item_id] = (r.start_word, r.n_words, round(r.similarity, 9))
    want = {i: m for i, t in enumerate(texts) if (m := plain(t, items))}
    assert got == want


def test_tables_find_all_within_the_radius():
    items = dc.Items(((1, b"a b c d e f g"),), dc.RADIUS, 0.8)
    rng = random.Random(4)
    _, prints, tables = items.sizes[7]
    for _ in range(300):
        p = int(prints[0])
        for bit in rng.sample(range(64), dc.RADIUS):
            p ^= 1 << bit
        assert any(t[(p >> int(a)) & ((1 << int(b - a)) - 1), 0] for a, b, t in zip(items.edges, items.edges[1:], tables))


def test_clean_keeps_rows_and_columns(docs, spark):
    leak = " ".join(words(random.Random(9), 20))
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    rows = docs([(1, "x " + leak + " y"), (2, "clean text"), (2, "clean text"), (None, None), (3, "")])
    rows = rows.withColumn("matches", rows.score)
    left = dc.clean(rows, bench)
    assert left.columns == rows.columns and sorted(map(str, (r.doc_id for r in left.collect()))) == ["2", "2", "3", "None"]
    assert dc.clean(rows, bench.limit(0)).count() == 5
    assert dc.matches(rows.limit(0), bench).count() == 0
