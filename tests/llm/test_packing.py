import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierflow.llm import packing as pk

TEXTS = [
    "The quick, brown fox. Ended... it's \"we'll\" don't (x) ciónó, É. ÷, ×. é É Σας ΟΔΟΣ.", "a b c\x1cd\x85e",
    "<|endoftext|> x<|startoftext|>Y <|ENDOFTEXT|>", "—. ,., .x. 12.5, 3,4 ½. ß. A.B. 'S 'ſ", None, "", " \n\t", "日本語。テスト, 😀. 😀.,",
    "word " * 9000, "Tail. " * 700,
]


TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def random_text(rng):
    return "".join(rng.choice("aZé.,'-s ß\t2٣ı́İſK​") for _ in range(rng.randint(0, 60)))


@pytest.mark.parametrize("limit", [400_000, 5])
def test_ids_of_words_are_ids_of_texts(limit):
    rng = random.Random(1)
    samples = [t or "" for t in TEXTS] + [random_text(rng) for _ in range(500)]
    words = pk.WordIds(public_tokenizers.path("word_bpe_49k.json"), limit)
    for text, ids in zip(samples, words.of([s.encode() for s in samples])):
        assert ids.tolist() == expected(text)[:-1], text


def check_pieces(rows, texts_by_row):
    """Pieces cover documents and sequences exactly; short sequences are powers of two."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(texts_by_row)
    for doc, text in texts_by_row.items():
        ids, at = expected(text), 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            cut = ids[at:at + r.length]
            assert r.ids == cut and r.ids_crc32 == zlib.crc32(np.array(cut, "<u4").tobytes())
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize("group", [4_000_000, 300])
def test_pieces_round_trip(docs, group):
    rng = random.Random(2)
    texts = TEXTS + [random_text(rng) * rng.randint(1, 20) for _ in range(60)]
    rows = pk.pack(docs(enumerate(texts), 3), group_tokens=group).collect()
    check_pieces(rows, dict(enumerate(texts)))


def test_costs_are_balanced():
    rng = random.Random(3)
    lengths = [rng.randint(1, 1500) for _ in range(3000)]
    pieces = pk.assign(lengths)
    cost = {}
    for _, _, n, s, _ in pieces:
        cost[s] = cost.get(s, 0) + pk.LINEAR * n + pk.QUADRATIC * n * n
    in_order = []
    fill = 0.0
    left = 2048
    for n in lengths:  # documents in their order, cut where a sequence ends
        while n:
            take = min(n, left)
            fill += pk.LINEAR * take + pk.QUADRATIC * take * take
            left -= take
            n -= take
            if not left:
                in_order.append(fill)
                fill, left = 0.0, 2048
    assert sum(n for _, _, n, _, _ in pieces) == sum(lengths)
    whole = [c for s, c in cost.items() if s < len(in_order)]
    assert np.std(whole) < np.std(in_order)
    assert len(pieces) < 1.5 * len(lengths)


def test_edge_rows(docs):
    rows = pk.pack(docs([(None, "a"), (4, "a b"), (4, "a b"), (5, None)], 1)).collect()
    assert sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0) == [("4", 3), ("4", 3), ("5", 1), ("None", 2)]
    assert pk.pack(docs([(1, "x")]).limit(0)).count() == 0
