import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierflow.llm import queries
from tierflow.llm import token_alignment as ta

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = {**{chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
LETTERS |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(LETTERS.values()))}
BYTES_A = {i: bytes(LETTERS[c] for c in t) for t, i in A.get_vocab().items() if i != 50256}
BYTES_B = {i: bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()
           for i in range(B.get_piece_size())}


def plain_tokens(text):
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if not text or b"".join(BYTES_A[i] for i in a) != whole or b"".join(BYTES_B[i] for i in b) != whole:
        return None
    return a, b


def plain(texts):
    """``(n_a, n_b, n_groups, n_links, n_best, count_sum, sha)`` of each text, from all links at once."""
    found, count = [], Counter()
    for text in texts:
        tokens = plain_tokens(text or "")
        if tokens is None:
            found.append(None)
            continue
        ends = []
        for ids, size in zip(tokens, (BYTES_A, BYTES_B)):
            ends.append(dict(zip(np.cumsum([len(size[i]) for i in ids]).tolist(), range(1, len(ids) + 1))))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(tokens[1][ends[1][c] - 1], tokens[0][ends[0][c] - 1]) for c in cuts]
        groups, at = [], (0, 0)
        for c in cuts:
            to = ends[0][c], ends[1][c]
            groups.append("|".join(",".join(map(str, t[x:y])) for t, x, y in zip(tokens, at, to)))
            at = to
        count.update(links)
        found.append((*tokens, links, ";".join(groups)))
    most = {}
    for (b, _), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (
        len(f[0]), len(f[1]), len(f[2]), len(f[2]), sum(count[x] == most[x[0]] for x in f[2]), sum(count[x] for x in f[2]),
        hashlib.sha256(f[3].encode()).hexdigest()) for f in found]


def random_text(rng):
    return "".join(rng.choice([
        "the", "ing", "a", "Z", "é", "é", "ß", "日本", "😀", "'s", "'ll", ".", ",", "(", "12", "٣", " ", " ", " ", "  ", "\n", "\n\n", "\t", "\r",
        "\r\n", "\x0b", "\x1c", "\x85", " ", "　", "​", "<s>", "<0x0A>", "<|endoftext|>", "\0", " word", " Word", "ciónmente",
    ]) for _ in range(rng.randint(0, 30)))


EDGES = [None, "", " ", "  ", "\n", "x ", " x", "x▁y", "▁", "a<|endoftext|>b", "</s> <unk>", "\n\nx", "x\n", "x \n y", "w\t", "w\t x", "w x",
         "word " * 5000, "日本語" * 3000, "x" * 30_000, "It's we'll don't\nNext line\n\nNew paragraph  two spaces"]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_units_are_cut_where_both_tokenizers_cut():
    rng = random.Random(1)
    units = ta.Units(ta.Vocabularies(public_tokenizers.path(ta.VOCABULARY_A), public_tokenizers.path(ta.VOCABULARY_B)))
    for text in [t or "" for t in EDGES] + [random_text(rng) for _ in range(4000)]:
        numbers, want = units.of(text), plain_tokens(text)
        assert (numbers is None) == (want is None), text
        if want is not None:
            groups = [g.split("|") for n in numbers for g in units.texts[n].decode().split(";")]
            for side in (0, 1):
                assert [int(x) for g in groups for x in g[side].split(",")] == want[side], text


def test_both_files_hold_the_same_first_vocabulary():
    a = ta.Vocabularies(public_tokenizers.path(ta.VOCABULARY_A), public_tokenizers.path(ta.VOCABULARY_B)).bytes_a
    assert a == BYTES_A


@pytest.mark.parametrize("limits", [{}, {"radixes": 3, "spill_links": 200, "cell_spills": 2, "unit_limit": 50, "block": 7}])
def test_equals_a_plain_version(spark, docs, limits):
    rng = random.Random(2)
    texts = EDGES + [random_text(rng) for _ in range(700)] + ["the same text"] * 300
    got = ta.align(docs(enumerate(texts), 4), with_groups=True, **limits).collect()
    want = plain(texts)
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r.doc_id], texts[r.doc_id]
        assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 or r.groups == r.groups_sha256 == ""


def test_runs_merge_in_order():
    rng = np.random.default_rng(3)
    runs, want = [], Counter()
    for _ in range(9):
        pairs = np.unique(rng.integers(0, 50, rng.integers(0, 40)))
        totals = rng.integers(1, 9, len(pairs))
        runs.append((pairs, totals))
        want.update(dict(zip(pairs.tolist(), totals.tolist())))
    assert list(ta.merged(runs)) == sorted(want.items())
    assert list(ta.merged([])) == []


def test_runs_round_trip():
    pair, doc, links = np.array([5, 5, 9 << 40]), np.array([0, 3, 1]), np.array([2, 1, 7])
    steps, totals, sizes, d, n = ta._unframed(ta.written_run(pair, doc, links), ta._RUN)
    assert np.repeat(np.cumsum(steps), sizes).tolist() == pair.tolist() and totals.tolist() == [3, 7]
    assert d.tolist() == doc.tolist() and n.tolist() == links.tolist()


def test_edge_rows(spark, docs):
    rows = docs([(None, "a b"), (4, "a b"), (4, "a b"), (5, None)], 2)
    got = sorted((str(r.doc_id), r.n_links, r.count_sum) for r in ta.align(rows).collect())
    assert got == [("4", 2, 6), ("4", 2, 6), ("5", 0, 0), ("None", 2, 6)]
    assert ta.align(docs([(1, "x")]).limit(0)).count() == 0
    broken = spark.sql("select 1L doc_id, cast(X'61FF62' as string) text union all select 2L, 'ok'")
    assert sorted((r.doc_id, r.n_a) for r in ta.align(broken).collect()) == [(1, 0), (2, 1)]


def test_whole_query_equals_a_plain_version(spark):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    want = dict(zip(table["doc_id"], plain(table["text"])))
    got = queries.QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)
