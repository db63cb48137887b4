import random

import numpy as np
import pytest
import xxhash

from tierflow.llm import simhash_golay as sg


def plain_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, bits=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_decoding_is_perfect():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    fixed = words ^ sg._ERRORS[sg._remainders(words)]
    assert (sg._remainders(fixed) == 0).all()
    assert np.bitwise_count(words ^ fixed).max() <= 3
    assert len(np.unique(sg._remainders(1 << np.arange(23)))) == 23


@pytest.mark.parametrize("flips", [0, 1, 2, 3, 4])
def test_prints_within_four_bits_share_a_key(flips):
    rng = random.Random(flips)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), flips):
            b ^= 1 << bit
        keys = [set(sg.key_rows(np.array([x], dtype=np.uint64))[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]
        assert max(map(len, keys)) <= 3 * 11


def near_texts(seed=3, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "Edit"
            texts.append("\t".join(copy))
    return [*texts, None, "", "  \n", "One", "one", "a b c", "É x É " * 50]


@pytest.mark.parametrize("limit", [sg.RUN_LIMIT, 1])
def test_against_brute_force(docs, limit):
    texts = near_texts()
    ids = [7 * i + 3 for i in range(len(texts))]
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in
           sg.near_duplicates(docs(zip(ids, texts), 5), limit=limit).collect()}
    prints = [plain_print(t) for t in texts]
    assert {i: got[i][0] for i in ids} == dict(zip(ids, prints))
    assert {i: got[i][1] for i in ids} == dict(zip(ids, [ids[r] for r in plain_components(prints)]))


@pytest.mark.parametrize("limit", [sg.RUN_LIMIT, 100, 20])
def test_dense_cluster_in_all_ways(spark, limit):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 300:
        x = rng.choice([base, *prints])
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            x ^= 1 << bit
        prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = sg.links(frame, limit=limit).collect()
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 4 for r in found)
    root = {x: x for x in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in found:
        a, b = sorted((find(r.a), find(r.b)))
        root[b] = a
    groups = plain_components(prints)
    mine = [find(x) for x in signed]
    assert len(set(zip(groups, mine))) == len(set(groups)) == len(set(mine))


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("limit", [sg.RUN_LIMIT, 5])
def test_smaller_distances_lose_no_link(spark, bits, limit):
    rng = random.Random(bits)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 150:
        x = rng.choice(sorted(prints))
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << bit
        prints.add(x)
    prints = sorted(prints)
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    found = sg.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits, limit).collect()
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= bits for r in found)
    root = {x: x for x in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in found:
        a, b = sorted((find(r.a), find(r.b)))
        root[b] = a
    groups = plain_components(prints, bits)
    mine = [find(x) for x in signed]
    assert len(set(zip(groups, mine))) == len(set(groups)) == len(set(mine))


def test_a_very_long_text(docs):
    long = " ".join(f"w{i}" for i in range(200_000))
    got = sg.near_duplicates(docs([(1, long), (2, long + " end"), (3, "other")], 2)).collect()
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in got} == {
        1: (plain_print(long), 1), 2: (plain_print(long + " end"), 1), 3: (plain_print("other"), 3)}


def test_edge_rows(docs, spark):
    got = sorted(((str(r.doc_id), r.component_id) for r in sg.near_duplicates(
        docs([(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (None, "zz yy"), (9, None), (8, "")]),
        extra=["score"],
    ).collect()), key=repr)
    assert got == [("4", 4), ("4", 4), ("8", 8), ("9", 8), ("None", 4), ("None", None)]
    assert sg.near_duplicates(docs([(1, "x")]).limit(0)).count() == 0
