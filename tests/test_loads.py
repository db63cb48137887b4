from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.control import loads, registry, watermarks
from tierflow.control.audit import Audit, run_report, run_status, runs_newest_first
from tierflow.control.registry import TableSpec
from tierflow.control.watermarks import Watermarks
from tierflow.operators import slices
from tierflow.sinks.records import Records
from tierflow.sinks.snapshot import Snapshot

SCHEMA = "k int, at int, v string"
DAY = [datetime(2024, 1, d) for d in range(1, 10)]


class Bench:
    """One table with its bronze folder, silver table and watermark."""

    def __init__(self, spark, scratch, spec, seed="0"):
        self.spark, self.spec, self.path = spark, spec, f"{scratch}/bronze"
        self.silver = Snapshot(spark, f"{scratch}/silver", spec.keys, 2)
        self.marks = Watermarks(spark, f"{scratch}/marks")
        if spec.incremental:
            self.marks.seed([spec.table_id], DAY[0], seed)

    def land(self, run, items):
        df = self.spark.createDataFrame(items, SCHEMA)
        return loads.land_bronze(loads.new_source_rows(df, self.spec, self.marks), self.path, run, DAY[run])

    def silver_load(self, run):
        bronze = loads.read_bronze(self.spark, self.path)
        return loads.load_silver(bronze, self.silver, self.spec, self.marks, run, DAY[run])

    def run(self, run, items):
        self.land(run, items)
        return self.silver_load(run)


APPEND = TableSpec(3, "t", "APPEND", "k", "at")
MERGE = TableSpec(1, "t", "MERGE", "k", "at")
FULL = TableSpec(4, "t", "FULL", "k")


def test_slices_add_up_to_one_full_load(spark, scratch, rows):
    b = Bench(spark, scratch, APPEND)
    items = [(i, i * 3, "x") for i in range(1, 10)]
    assert b.run(1, items[:3]) == 3
    assert b.run(2, items[:7]) == 4
    assert b.run(3, items) == 2
    assert b.run(4, items) == 0
    assert rows(b.silver.read(), "k", "at") == [(i, i * 3) for i in range(1, 10)]
    assert b.marks.get(3) == "27"


def test_watermarks_are_numbers_for_number_columns(spark, scratch):
    b = Bench(spark, scratch, APPEND, seed="9")
    assert b.run(1, [(1, 8, "old"), (2, 10, "new"), (3, 100, "new")]) == 2  # as text, "10" < "9"
    assert b.marks.get(3) == "100"


def test_merge_keeps_the_first_insert_time_and_the_newest_version(spark, scratch, rows):
    b = Bench(spark, scratch, MERGE)
    b.run(1, [(1, 5, "a"), (1, 6, "b"), (2, 5, "c"), (None, 5, "no key"), (3, None, "no watermark")])
    b.run(2, [(1, 7, "B"), (4, 7, "d")])
    got = b.silver.read().select("k", "v", F.dayofmonth("insert_timestamp"), F.dayofmonth("update_timestamp"))
    assert rows(got) == [(1, "B", 2, 3), (2, "c", 2, 2), (4, "d", 3, 3)]


def test_rows_without_a_watermark_are_counted(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "k int, at int")
    assert slices.bounds(df, "at") == ("3", 1)
    assert slices.bounds(df, "at", "3") == (None, 1)


def test_rows_left_out_are_logged(spark, scratch, caplog):
    b = Bench(spark, scratch, MERGE)
    landed = spark.createDataFrame([(1, 5, "a"), (None, 5, "no key"), (3, None, "no watermark")], SCHEMA)
    loads.land_bronze(landed, b.path, 1, DAY[1])
    b.silver_load(1)
    assert "1 rows have no at" in caplog.text and "1 rows without a key" in caplog.text


def test_a_late_row_after_the_bound_waits_for_the_next_run(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 9)], "k int, at int")
    assert rows(slices.between(df, "at", "5", "7")) == [(2, 7)]
    assert slices.upper_bound(df, "at", "9") is None


def test_extracts_read_their_source_once(spark, scratch, rows):
    source = spark.createDataFrame([(1, 5), (2, 7), (3, None), (4, 9)], "k int, at int")
    source.write.parquet(f"{scratch}/source")
    marks = {"t": None}
    for number, (limit, want) in enumerate(((7, [1, 2]), (99, [4]), (99, []))):
        df = spark.read.parquet(f"{scratch}/source").coalesce(1).where(f"at is null or at <= {limit}")
        spark.sparkContext.setJobGroup(f"extract-{number}-{scratch}", "one extract")
        marks = loads.bounded_extracts(
            {"t": df}, [("t", "at", marks["t"])], lambda table, slice_: slice_.write.parquet(f"{scratch}/slice-{number}"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"extract-{number}-{scratch}")
        assert len(jobs) == 1 + bool(want)  # a look at the first row, and the write
        if want:
            assert rows(spark.read.parquet(f"{scratch}/slice-{number}"), "k") == [(k,) for k in want]
        assert marks == {"t": str(min(limit, 9))}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_both_bounds_of_a_slice_reach_the_scan(spark, scratch):
    path = f"{scratch}/pushed"
    spark.createDataFrame([(1, 5), (2, 7), (3, None)], "k int, at int").write.parquet(path)
    df = spark.read.parquet(path)

    def pushed(slice_):
        plan = slice_._jdf.queryExecution().executedPlan().toString()
        return plan.split("PushedFilters: [")[1].split("]")[0]

    assert "GreaterThan(at,5)" in pushed(slices.after(df, "at", "5"))
    assert "GreaterThanOrEqual(at,5)" in pushed(slices.after(df, "at", "5", including=True))
    both = pushed(slices.between(df, "at", "5", "7"))
    assert "GreaterThan(at,5)" in both and "LessThanOrEqual(at,7)" in both
    marks = Watermarks(spark, f"{scratch}/marks-pushed")
    marks.seed([3], DAY[0], "5")
    assert "GreaterThan(at,5)" in pushed(loads.new_source_rows(df, APPEND, marks))


def test_watermark_types(spark):
    df = spark.sql("select date '2024-01-10' d, timestamp '2024-01-10 10:00:00' t, 'b' s, 5L n")
    for column, last, newer in (("d", "2024-01-09", True), ("d", "2024-01-10", False), ("t", "2024-01-10 09:59:59", True),
                                ("s", "a", True), ("n", "10", False)):
        assert (slices.after(df, column, last).count() == 1) is newer


def test_full_load_twice_holds_the_last_one_only(spark, scratch, rows):
    b = Bench(spark, scratch, FULL)
    b.run(1, [(1, 1, "a"), (2, 1, "b")])
    b.run(2, [(1, 1, "A")])
    assert rows(b.silver.read(), "k", "v") == [(1, "A")]
    assert loads.read_bronze(spark, b.path).count() == 3


def test_a_run_that_stopped_before_its_watermark_is_repeated(spark, scratch, rows, monkeypatch):
    b = Bench(spark, scratch, APPEND)
    b.run(1, [(1, 1, "a")])
    b.land(2, [(2, 2, "b")])
    with monkeypatch.context() as patch:
        patch.setattr(Watermarks, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            b.silver_load(2)
    assert b.marks.get(3) == "1" and b.silver.read().count() == 2
    b.silver_load(2)
    assert rows(b.silver.read(), "k") == [(1,), (2,)]
    assert b.marks.get(3) == "2"


def test_the_same_run_twice_adds_only_what_is_new(spark, scratch, rows):
    b = Bench(spark, scratch, APPEND)
    b.run(1, [(1, 1, "a")])
    b.run(1, [(1, 1, "a"), (2, 2, "b")])
    assert rows(b.silver.read(), "k") == [(1,), (2,)]


def test_bad_load_types_and_missing_keys_fail_on_the_first_load(spark, scratch):
    for spec in (TableSpec(1, "t", "UPSERT", "k"), TableSpec(1, "t", "MERGE", None, "at")):
        b = Bench(spark, scratch, spec)
        b.land(1, [(1, 1, "a")])
        with pytest.raises(ValueError):
            b.silver_load(1)
        assert not b.silver.exists()


def test_bounded_extracts_move_only_tables_with_new_rows(spark):
    df = spark.createDataFrame([(1, 9), (2, 10)], "k int, at int")
    landed = {}
    got = loads.bounded_extracts({"a": df, "b": df}, [("a", "at", "9"), ("b", "at", "10")],
                                 lambda name, part: landed.update({name: part.count()}))
    assert got == {"a": "10", "b": "10"} and landed == {"a": 1}


def test_audit_rows_and_status(spark, scratch, rows):
    ticks = iter(datetime(2024, 1, 1, 0, m) for m in range(59))
    audit = Audit(spark, f"{scratch}/audit", clock=lambda: next(ticks))
    assert audit.run(5, 1, "Bronze", lambda: 10) == 10
    assert audit.run(5, 1, "Silver", lambda: 0) == 0
    with pytest.raises(RuntimeError):
        audit.run(5, 2, "Silver", lambda: (_ for _ in ()).throw(RuntimeError("it's \"broken\"")))
    audit.run(6, 99, "Gold", lambda: 1)
    table = audit.read()
    assert rows(table, "run_id", "table_id", "layer", "status", "number_of_records", "error_message") == [
        (5, 1, "Silver", "SUCCESS", 0, None), (5, 2, "Silver", "FAILED", None, "it's \"broken\""),
        (6, 99, "Gold", "SUCCESS", 1, None)]
    report = run_report(table, registry.seed_registry(spark), 5)
    assert [r["table_name"] for r in report.collect()] == ["customers", "accounts"]
    assert run_report(table, registry.seed_registry(spark), 6).first()["table_name"] is None
    assert rows(run_status(table)) == [(5, 2, 1, "FAILED"), (6, 1, 0, "SUCCESS")]
    assert [r["run_id"] for r in runs_newest_first(table).collect()] == [6, 5, 5]


def test_an_interrupted_table_fails_its_run(spark):
    df = spark.createDataFrame([(1, "SUCCESS"), (1, "INPROGRESS"), (2, "SUCCESS")], "run_id bigint, status string")
    assert {r["run_id"]: r["overall_status"] for r in run_status(df).collect()} == {1: "FAILED", 2: "SUCCESS"}


def test_registry_gives_ordered_specs(spark):
    got = registry.specs(registry.seed_registry(spark), registry.seed_parameters(spark), "SQLServer")
    assert [s.table_name for s in got] == ["customers", "accounts", "transactions", "branches"]
    assert got[3] == TableSpec(4, "branches", "FULL", "branch_code", None, "sqlserver", "banking", "branches")
    assert got[0].keys == ["customer_id"] and got[0].incremental and not got[3].incremental
    inactive = registry.seed_registry(spark).withColumn("active_flag", F.lit(False))
    assert registry.active_tables(inactive, "blob").count() == 0
    types = registry.load_types(registry.seed_registry(spark), registry.seed_parameters(spark))
    assert {r["load_type"] for r in types.collect()} == {"FULL", "APPEND", "MERGE"}
    with pytest.raises(ValueError):
        registry.active_tables(inactive, "")


def test_control_rows_of_one_source_table_are_updated(spark):
    df = spark.createDataFrame([r[:2] + (r[4],) for r in fx.HOSPITAL_WATERMARKS],
                               "source_schema string, source_table string, last_load_value string")
    got = watermarks.set_last_value(df, "dbo", "Patients", "200000")
    assert {r["source_table"]: r["last_load_value"] for r in got.collect()} == {
        "Hospitals": "9900006", "Physicians": "9999", "Patients": "200000", "Departments": "64",
        "Encounters": "2021-07-02T14:46:00"}


def test_gold_is_published_by_registered_name(spark, scratch):
    audit = Audit(spark, f"{scratch}/audit")
    builders = {"risk_customer_summary": lambda: spark.range(3)}
    assert loads.publish_gold("risk_customer_summary", builders, f"{scratch}/gold", spark, audit, 1, 11) == 3
    assert Snapshot(spark, f"{scratch}/gold/risk_customer_summary").read().count() == 3
    with pytest.raises(ValueError):
        loads.publish_gold("unknown", builders, f"{scratch}/gold", spark, audit, 1, 12)


def test_control_rows_are_replaced_by_key(spark, scratch, rows):
    table = Records(spark, f"{scratch}/r", "a int, b string, note string, at timestamp", ["a", "b"])
    assert table.read().count() == 0 and table.get(1, "x") is None
    table.put({"a": 1, "b": "x", "note": "first\nline \"quoted\"", "at": datetime(2024, 1, 1, 0, 0, 0, 123456)})
    table.put({"a": 2, "b": "x", "note": None, "at": None})
    table.put({"a": 2, "b": "x", "note": "ü", "at": None})
    assert rows(table.read()) == [(1, "x", "first\nline \"quoted\"", datetime(2024, 1, 1, 0, 0, 0, 123456)), (2, "x", "ü", None)]
    assert table.get(2, "x")["note"] == "ü"


def test_specs_from_text():
    got = registry.spec_from_text(
        "{'table_id': '1', 'table_name': 'customers', 'source_system': 'sqlserver', 'source_schema': 'banking', "
        "'source_table': 'customers', 'source_path': ''}",
        "{'load_type': 'MERGE', 'primary_key': 'customer_id', 'watermark_column': 'updated_at'}")
    assert got == TableSpec(1, "customers", "MERGE", "customer_id", "updated_at", "sqlserver", "banking", "customers")
    for metadata in ("", "{'table_name': 'x'}"):
        with pytest.raises(ValueError):
            registry.spec_from_text(metadata, "{}")


def test_old_batches_are_not_read_again(spark, scratch, rows):
    b = Bench(spark, scratch, APPEND)
    b.run(1, [(1, 1, "a")])
    b.run(2, [(1, 1, "a"), (2, 2, "b")])
    assert loads.batches(spark, b.path) == [1, 2] and b.marks.last_run(3) == 2
    recent = loads.read_bronze(spark, b.path, since=2)
    assert rows(recent, "k", "batch_id") == [(2, 2)]
    assert all("batch_id=2" in f for f in recent.inputFiles())


def test_late_equal_and_missing_watermarks_reach_silver(spark, scratch, rows, caplog):
    b = Bench(spark, scratch, MERGE)
    for run, items in ((1, [(1, 15, "a")]), (2, [(9, 15, "equal"), (2, 3, "older"), (3, None, "none"), (4, 16, "new")]),
                       (3, [(5, 2, "only late")])):
        loads.land_bronze(spark.createDataFrame(items, SCHEMA), b.path, run, DAY[run])
        b.silver_load(run)
    assert rows(b.silver.read(), "k") == [(1,), (2,), (3,), (4,), (5,)] + [(9,)]
    assert (b.marks.get(1), b.marks.last_run(1)) == ("16", 3)
    assert "1 rows have no at and 2 are not after 15" in caplog.text
    assert b.silver_load(4) == 0


def test_rows_at_the_watermark_are_extracted_again_for_a_merge(spark, scratch):
    df = spark.createDataFrame([(1, 5), (2, 6)], "k int, at int")
    for spec, n in ((MERGE, 2), (APPEND, 1)):
        b = Bench(spark, f"{scratch}/{spec.load_type}", spec, seed="5")
        assert loads.new_source_rows(df, spec, b.marks).count() == n


def test_a_failed_run_still_gives_its_report(spark, scratch):
    from tierflow.plans.banking_run import BankingRun

    def read_query(query):
        if "accounts" in query:
            raise RuntimeError("source is gone")
        return spark.sql("select 1 customer_id, 'b' branch_code, 1 txn_id, timestamp '2024-01-01' updated_at, "
                         "timestamp '2024-01-01' txn_timestamp")

    tables = registry.seed_registry(spark).filter("lower(source_system) <> 'blob'")
    run = BankingRun(spark, scratch, 1, DAY[1], read_query, {}, buckets=1)
    report = {(r["table_name"], r["status"]) for r in run.run(tables, registry.seed_parameters(spark)).collect()}
    assert ("accounts", "FAILED") in report and ("customers", "SUCCESS") in report
    assert run_status(run.audit.read()).first()["overall_status"] == "FAILED"


def test_the_hospital_run_lands_small_compressed_files(spark, scratch, rows):
    """F5 to F11: landed files are compressed, none holds more rows than asked for, and all rows come back."""
    import glob
    import gzip

    from tierflow.plans.hospital_run import CONTROL, HospitalRun
    from tierflow.sources.files import read_csv

    given = [(i, f'a "{i}"', "" if i % 3 else None) for i in range(25)] + [(3, " b,", "")] * 2 + [(None, "c", "")]
    source = spark.createDataFrame(given, "k int, v string, w string").coalesce(1)
    control = spark.createDataFrame([("dbo", "T", "T", "k", "-1")], CONTROL)
    run = HospitalRun(spark, scratch, DAY[0], file_rows=10)
    moved = run.extract({"T": source}, control)
    assert moved.first().last_load_value == "24"
    landed = f"{scratch}/landing/T/2024/01/01/00/00/T.csv"
    found = glob.glob(f"{landed.removeprefix('file:')}/part-*")
    assert all(f.endswith(".csv.gz") for f in found)
    assert sorted(gzip.open(f, "rt").read().count("\n") - 1 for f in found) == [7, 10, 10]
    assert rows(read_csv(spark, landed, "k int, v string, w string")) == sorted(
        (r for r in given if r[0] is not None), key=repr)
    assert run.extract({"T": source}, moved).first().last_load_value == "24"
    assert sorted(glob.glob(f"{landed.removeprefix('file:')}/part-*")) == sorted(found)  # no new rows: nothing is landed


def test_hospital_encounters_are_joined_once(spark, scratch, rows):
    """F5 to F11: runs extract from the joined rows as from a table, not from the join."""
    from types import SimpleNamespace

    from tierflow.catalog.whole_runs import hospital_sources

    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "x")], "k int, v string")
    right = spark.createDataFrame([(1, 5), (2, 6), (2, 6)], "k int, w int")
    sources = hospital_sources(SimpleNamespace(spark=spark, scratch=scratch, sql=lambda text: left.join(right, "k")))
    plans = {name: df._jdf.queryExecution().optimizedPlan().toString() for name, df in sources.items()}
    assert [name for name, plan in plans.items() if "Join" not in plan] == ["Encounters"]
    assert rows(sources["Encounters"]) == rows(left.join(right, "k")) == [
        (1, "a", 5), (1, "a", 5), (2, None, 6), (2, None, 6)]
    assert sources["Encounters"].dtypes == left.join(right, "k").dtypes


def test_tables_are_written_small(spark, scratch):
    """F6 to F10: keys and texts of silver and gold take less than Spark's default writes, and every type comes back."""
    import glob
    import os

    from tierflow.sinks.files import write_parquet
    from tierflow.sinks.snapshot import Snapshot

    given = spark.range(0, 60000, 1, 2).selectExpr(
        "id * 3 + id % 2 k", "cast(id * 7 as int) i", "if(id % 5 = 0, null, concat('text ', id)) v", "id / 3 d", "cast(id / 7 as float) f",
        "cast(id / 3 as decimal(9,2)) small", "cast(id / 3 as decimal(18,2)) middle", "if(id % 3 = 0, null, cast(id / 3 as decimal(38,6))) large",
        "id % 2 = 0 even", "cast(id % 30000 as smallint) s", "date_add(date '1990-01-01', cast(id % 9000 as int)) day",
        "timestamp_micros(id * 1000003) t", "cast(timestamp_micros(id * 1000003) as timestamp_ntz) n", "cast(cast(id as string) as binary) b",
        "if(id % 4 = 0, null, array(id, id + 1)) many", "named_struct('a', id, 'b', if(id % 2 = 0, null, cast(id as string))) pair",
        "map(cast(id as string), id) m")
    given.write.parquet(f"{scratch}/plain")
    plain = spark.read.parquet(f"{scratch}/plain")
    write_parquet(plain, f"{scratch}/table")
    table = Snapshot(spark, f"{scratch}/gold", ["k"], 3)
    table.overwrite(plain)

    def bytes_in(folder):
        return sum(map(os.path.getsize, glob.glob(f"{scratch.removeprefix('file:')}/{folder}/**/*.parquet", recursive=True)))

    assert bytes_in("table") < 0.7 * bytes_in("plain") and bytes_in("gold") < 0.8 * bytes_in("plain")
    want = {r["k"]: r for r in plain.collect()}
    for read in (spark.read.parquet(f"{scratch}/table"), table.read()):
        assert read.dtypes == plain.dtypes
        got = read.collect()
        assert len(got) == len(want) and all(r == want[r["k"]] for r in got)
