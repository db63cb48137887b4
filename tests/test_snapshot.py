import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.session import scratch_dir
from tierflow.sinks import catalog
from tierflow.sinks.snapshot import Snapshot, merge_rows


def frame(spark, items, schema="k int, v string, at int"):
    return spark.createDataFrame(items, schema)


@pytest.mark.parametrize("buckets", [1, 4])
def test_merge_updates_inserts_and_keeps(spark, scratch, rows, buckets):
    table = Snapshot(spark, f"{scratch}/t", ["k"], buckets)
    table.upsert(frame(spark, [(1, "a", 1), (2, "b", 1), (3, None, 1)]))
    seen = table.upsert(frame(spark, [(2, None, 2), (4, "d", 2), (4, "e", 3), (None, "x", 2)]), latest=["at"])
    assert seen == {"rows": 2, "refused": 1}
    # a NULL in the source is a new value; the newest of two source rows is used
    assert rows(table.read()) == [(1, "a", 1), (2, None, 2), (3, None, 1), (4, "e", 3)]


def test_merge_twice_is_merge_once(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 4)
    table.overwrite(frame(spark, [(i, "old", 0) for i in range(20)]))
    source = frame(spark, [(i, "new", 1) for i in range(10, 30)])
    table.upsert(source)
    once = rows(table.read())
    table.upsert(source)
    assert rows(table.read()) == once and len(once) == 30


def test_kept_columns_survive_an_update_only(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 2)
    table.upsert(frame(spark, [(1, "a", 100), (2, "b", None)]))
    table.upsert(frame(spark, [(1, "A", 200), (2, "B", 200), (3, "C", 200)]), preserve=["at"])
    assert rows(table.read()) == [(1, "A", 100), (2, "B", None), (3, "C", 200)]


def test_columns_missing_or_new_in_the_source(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 2)
    table.overwrite(frame(spark, [(1, "a", 1), (2, "b", 2)]))
    table.upsert(spark.createDataFrame([(2, "n"), (3, "m")], "k int, extra string"))
    assert table.read().columns == ["k", "v", "at", "extra"]
    assert rows(table.read()) == [(1, "a", 1, None), (2, "b", 2, "n"), (3, None, None, "m")]


def test_keys_are_compared_in_the_type_of_the_table(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 8)
    table.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"))
    table.upsert(spark.createDataFrame([(1, "A")], "k int, v string"))
    assert rows(table.read()) == [(1, "A"), (2, "b")]


def test_only_touched_buckets_are_rewritten(spark, scratch):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 16)
    table.overwrite(frame(spark, [(i, "a", 0) for i in range(200)]))
    before = table._current()["folders"]
    table.upsert(frame(spark, [(7, "b", 1)]))
    after = table._current()["folders"]
    assert len(before) == 16
    assert sum(before[b] != after[b] for b in before) == 1
    assert table.read().count() == 200


def test_a_large_source_is_shuffled_and_gives_the_same_result(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 4)
    table.overwrite(frame(spark, [(i, "a", 0) for i in range(50)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.upsert(frame(spark, [(i, "b", 1) for i in range(25, 75)]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(table.read()) == sorted([(i, "a", 0) for i in range(25)] + [(i, "b", 1) for i in range(25, 75)], key=repr)


def test_a_failing_write_leaves_the_current_version(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 2)
    table.overwrite(frame(spark, [(1, "a", 1)]))
    broken = frame(spark, [(1, "b", 2)]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    for change in (table.overwrite, table.append, table.upsert):
        with pytest.raises(Exception, match="boom"):
            change(broken)
    assert table.version() == 1 and rows(table.read()) == [(1, "a", 1)]


def test_a_repeated_run_replaces_its_own_result(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t")
    table.append(frame(spark, [(1, "a", 1)]), run_id=1)
    table.append(frame(spark, [(2, "b", 1)]), run_id=2)
    table.append(frame(spark, [(2, "B", 1)]), run_id=2)
    assert rows(table.read()) == [(1, "a", 1), (2, "B", 1)]
    first = Snapshot(spark, f"{scratch}/first")
    for _ in range(2):
        first.append(frame(spark, [(1, "a", 1)]), run_id=1)
    assert rows(first.read()) == [(1, "a", 1)]


def test_replacement_may_read_the_table_it_replaces(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t")
    table.overwrite(frame(spark, [(1, "a", 1), (2, "b", 2)]))
    table.overwrite(table.read().filter("k = 2").drop("at"))
    assert table.read().columns == ["k", "v"] and rows(table.read()) == [(2, "b")]


def test_empty_sources(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 4)
    none = frame(spark, [])
    assert table.upsert(none)["rows"] == 0
    assert rows(table.read()) == []
    table.upsert(frame(spark, [(1, "a", 1)]))
    table.upsert(none)
    assert rows(table.read()) == [(1, "a", 1)]


def test_vacuum_keeps_what_the_last_versions_need(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 2)
    for i in range(4):
        table.upsert(frame(spark, [(i, "a", i), (100, "z", i)]))
    before = rows(table.read())
    assert table.vacuum(keep=1) > 0
    assert rows(table.read()) == before
    assert os.listdir(f"{scratch}/t/stage") == []


def test_merging_needs_keys(spark, scratch):
    with pytest.raises(ValueError):
        Snapshot(spark, f"{scratch}/t").upsert(frame(spark, [(1, "a", 1)]))
    with pytest.raises(FileNotFoundError):
        Snapshot(spark, f"{scratch}/none").read()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.dictionaries(st.integers(0, 12), st.integers(0, 9), max_size=12),
       new=st.lists(st.tuples(st.integers(0, 12), st.integers(0, 9), st.integers(0, 99)), max_size=20, unique_by=lambda r: r[2]))
def test_merge_equals_a_dictionary_update(spark, old, new):
    table = Snapshot(spark, scratch_dir(spark, "property"), ["k"], 3)
    table.overwrite(spark.createDataFrame([(k, v, -1) for k, v in old.items()], "k int, v int, at int"))
    table.upsert(spark.createDataFrame(new, "k int, v int, at int"), latest=["at"])
    want = dict(old)
    for k, v, _ in sorted(new, key=lambda r: r[2]):
        want[k] = v
    assert {r["k"]: r["v"] for r in table.read().collect()} == want


def test_merge_of_two_frames(spark, rows):
    target = frame(spark, [(1, "a", 1), (2, "b", 1)])
    source = frame(spark, [(2, "B", 2), (3, "C", 2)])
    assert rows(merge_rows(target, source, ["k"], ["at"])) == [(1, "a", 1), (2, "B", 1), (3, "C", 2)]


def test_catalog_objects(spark, scratch, rows):
    name = "t_" + os.path.basename(scratch).replace("-", "_")
    spark.range(4).selectExpr("id", "id % 2 part").write.partitionBy("part").parquet(f"{scratch}/x")
    table = catalog.create_external(spark, name, "id bigint, part bigint", f"{scratch}/x", ["part"])
    assert rows(table.filter("part = 1"), "id") == [(1,), (3,)]
    view = catalog.replace_view(table.filter("part = 0"), name + "_v")
    assert rows(view, "id") == [(0,), (2,)]
    catalog.create_schemas(spark, [name + "_s"])
    assert spark.catalog.databaseExists(name + "_s")


@pytest.mark.parametrize("before,after", [(4, 8), (8, 4), (1, 8), (8, 1)])
def test_another_number_of_buckets_loses_and_doubles_nothing(spark, scratch, rows, before, after):
    Snapshot(spark, f"{scratch}/t", ["k"], before).overwrite(frame(spark, [(i, "a", 0) for i in range(200)]))
    table = Snapshot(spark, f"{scratch}/t", ["k"], after)
    table.append(frame(spark, [(200, "a", 0)]))
    assert table._current()["buckets"] == before
    table.upsert(frame(spark, [(i, "b", 1) for i in (0, 7, 77, 199, 200, 500)]))
    assert table._current()["buckets"] == after
    got = rows(table.read(), "k", "v")
    assert got == sorted([(i, "b" if i in (0, 7, 77, 199, 200, 500) else "a") for i in [*range(201), 500]], key=repr)


def test_other_keys_than_the_recorded_ones_are_refused(spark, scratch):
    Snapshot(spark, f"{scratch}/t", ["k"], 2).overwrite(frame(spark, [(1, "a", 0)]))
    with pytest.raises(ValueError):
        Snapshot(spark, f"{scratch}/t", ["v"], 2).upsert(frame(spark, [(1, "a", 0)]))


def test_a_late_row_does_not_undo_a_newer_one(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/t", ["k"], 2)
    table.upsert(frame(spark, [(1, "new", 9), (2, "a", 5), (3, "b", None), (4, "c", 5)]))
    table.upsert(frame(spark, [(1, "late", 3), (2, "same", 5), (3, "x", None), (4, "none", None), (5, "first", None)]),
                 not_before="at")
    assert rows(table.read()) == [(1, "new", 9), (2, "same", 5), (3, "x", None), (4, "c", 5), (5, "first", None)]
