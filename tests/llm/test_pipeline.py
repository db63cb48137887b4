import random

import pytest
from test_decontamination import plain as plain_matches
from test_private_terms import plain_spans
from test_simhash_golay import plain_components, plain_print

import corpus_pipeline
from tierflow.llm import private_terms
from tierflow.session import scratch_dir

EN = "the house and of with there that was this from have not which their would been other about great many".split()
DE = "der und die nicht ist sich auch werden eine über straße schön haben zwischen können durch welche jetzt".split()


def table(seed=1):
    rng = random.Random(seed)
    prose = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(EN, 25)) for i in range(6)]
    rows = [(i, prose((EN, DE)[i % 2], rng.randint(20, 120)), ("en", "de")[i % 2]) for i in range(90)]
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(12)]
    rows += [(130 + i, rows[20 + i][1] + " Ende", rows[20 + i][2]) for i in range(6)]
    rows += [(150 + i, prose(EN, 30) + " " + items[i][1].upper() + " " + prose(EN, 9), "en") for i in range(4)]
    rows += [(170 + i, f"{prose(EN, 20)} a{i}.b@mail.example.org {prose(EN, 9)} 10.0.0.{i}", None) for i in range(5)]
    rows += [(190, None, "en"), (191, "", "de"), (192, "12 34 !!", "en"), (3, rows[3][1], "de"), (None, prose(DE, 40), None),
             (None, rows[5][1], None), (193, "word " * 5000, "en")]
    return [(*r, "src", None, i, "x") for i, r in enumerate(rows)], items


@pytest.fixture
def folder(spark):
    rows, items = table()
    path = scratch_dir(spark, "corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` int, lang_pred string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def key(rows):
    return sorted((str(r.doc_id), r.row) for r in rows)


def test_each_stage_against_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    left = stages["language_id"](spark, docs, folder)
    assert left.columns == columns
    got = left.collect()
    assert key(got) == key(r for r in docs.collect() if r.doc_id not in (190, 191, 192))

    once = stages["simhash_near_dedup"](spark, left, folder)
    assert once.columns == columns
    groups = plain_components([plain_print(r.text) for r in got])
    best = {}
    for r, g in zip(got, groups):
        at = (r.doc_id is None, r.doc_id or 0)
        if g not in best or at < best[g][0]:
            best[g] = (at, r)
    kept = once.collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(b[1].doc_id) for b in best.values()) and len(kept) == len(best)

    clean = stages["benchmark_decontamination"](spark, once, folder)
    assert clean.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = [r for r in kept if not plain_matches(r.text, items)]
    assert key(clean.collect()) == key(want) and len(want) < len(kept)

    private = stages["pii"](spark, clean, folder)
    assert private.columns == columns
    texts = {(r.doc_id, r.row): r.text for r in private.collect()}
    for r in want:
        spans = [(s, k, e, f"[{private_terms.KINDS[k].upper()}]") for s, k, e in plain_spans(r.text)]
        assert texts[r.doc_id, r.row] == private_terms.sanitised(r.text, spans)
    assert sum("[EMAIL]" in t and "[IP]" in t for t in texts.values()) == 5

    ids = {r.doc_id: t for (r, t) in ((r, texts[r.doc_id, r.row]) for r in want) if r.doc_id is not None}
    rows = [r for r in stages["packing"](spark, private, folder).collect()]
    named = [r for r in rows if r.doc_id is not None]
    covered = {}
    for r in rows:
        covered.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in sorted(p)) in {1 << b for b in range(12)} for p in covered.values())
    assert {r.doc_id for r in named} == set(ids)
    whole = {d: sum(r.length for r in named if r.doc_id == d) for d in ids}
    assert all(whole[r.doc_id] == r.doc_tokens for r in named)


def test_run_gives_what_the_stages_give(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    want = docs.collect()
    assert sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0) == sorted((str(r.doc_id), r.doc_tokens) for r in want if r.start == 0)


def test_empty_documents(spark, folder):
    path = scratch_dir(spark, "empty")
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").where("false").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
