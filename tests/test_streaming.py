import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.streaming import ingest

SENSOR = T.StructType([
    T.StructField("device_id", T.StringType()), T.StructField("temp", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def test_misfits_are_rescued(spark):
    lines = [
        '{"device_id": "A", "temp": 21.5, "timestamp": "t"}',
        '{"device_id": "B", "temp": "hot", "timestamp": "t"}',
        '{"device_id": "C", "temp": null, "battery": 7, "pos": {"x": 1}}',
        '{"device_id": "D", "temp":',
        'plain text',
        "   ",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, _line string")
    parsed = ingest.parse_with_rescue(df, SENSOR)
    got = parsed.orderBy("i").select("device_id", "temp", "_rescued_data").collect()
    assert [tuple(r)[:2] for r in got[:3]] == [("A", 21.5), ("B", None), ("C", None)]
    assert got[0][2] is None
    assert json.loads(got[1][2]) == {"temp": "hot"}
    assert json.loads(got[2][2]) == {"battery": "7", "pos": '{"x":1}'}
    assert tuple(got[3]) == (None, None, lines[3])
    assert tuple(got[4]) == (None, None, lines[4])


def test_each_file_counts_once(spark, scratch):
    landing = f"{scratch}/landing"
    put(landing, "batch_1.json", "", '{"device_id": "A", "temp": 1.5, "timestamp": "x"}',
        '{"device_id": "B", "temp": 2.5, "timestamp": "y"}')

    def run():
        rows = ingest.json_stream(spark, landing, SENSOR, max_files=1)
        return ingest.drain(rows, f"{scratch}/bronze", f"{scratch}/checkpoint")

    assert run() == 2  # rows written; the blank line is none
    assert ingest.landed(spark, f"{scratch}/bronze").count() == 2
    assert run() == 0
    put(landing, "batch_2.json", '{"device_id": "C", "temp": 1, "timestamp": "z", "more": true}')
    put(landing, "batch_3.json", '{"device_id": "D", "temp": 4, "timestamp": "z"}')
    assert run() == 2
    out = ingest.landed(spark, f"{scratch}/bronze")
    assert out.columns == ["device_id", "temp", "timestamp", "_rescued_data", "ingested_at", "source_file"]
    assert out.count() == 4 and out.filter("ingested_at is null").count() == 0
    row = out.filter("device_id = 'C'").first()
    assert row["source_file"].endswith("/batch_2.json") and json.loads(row["_rescued_data"]) == {"more": "true"}


def test_the_schema_is_inferred_once_and_kept(spark, scratch):
    landing, location = f"{scratch}/landing", f"{scratch}/schemas"
    put(landing, "a.json", "", '{"device_id": "A", "temp": 1.5, "timestamp": "x"}')
    first = ingest.stored_schema(spark, landing, location)
    assert first.simpleString() == "struct<device_id:string,temp:double,timestamp:string>"
    put(landing, "b.json", '{"device_id": "A", "other": 1}')
    assert ingest.stored_schema(spark, landing, location) == first


def test_csv_columns_arrive_as_text(spark, scratch):
    put(f"{scratch}/landing", "a.csv", "id,score", "1,007", "2,")
    ingest.drain(ingest.csv_stream(spark, f"{scratch}/landing", ["id", "score"]), f"{scratch}/b", f"{scratch}/c")
    got = ingest.landed(spark, f"{scratch}/b")
    assert got.dtypes == [("id", "string"), ("score", "string")]
    assert sorted(tuple(r) for r in got.collect()) == [("1", "007"), ("2", None)]


def test_a_followed_stream_can_be_stopped(spark, scratch):
    put(f"{scratch}/landing", "a.json", '{"device_id": "A"}')
    query = ingest.follow(ingest.json_stream(spark, f"{scratch}/landing", SENSOR), f"{scratch}/b", f"{scratch}/c")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{scratch}/b").count() == 1


def test_many_small_batches_are_all_counted(spark, scratch):
    for i in range(120):
        put(f"{scratch}/landing", f"{i}.json", *['{"device_id": "A"}'] * (i % 3 + 1))
    rows = ingest.json_stream(spark, f"{scratch}/landing", SENSOR, max_files=1)
    assert ingest.drain(rows, f"{scratch}/b", f"{scratch}/c") == 240
    assert ingest.landed(spark, f"{scratch}/b").count() == 240


def test_a_batch_that_stopped_before_its_commit_is_replaced(spark, scratch, monkeypatch):
    put(f"{scratch}/landing", "a.json", '{"device_id": "A"}', '{"device_id": "B"}')
    sink = ingest.BatchFolders.__call__

    def stops(self, batch, number):
        sink(self, batch, number)
        raise RuntimeError("the job ends here")

    def run(day):
        rows = ingest.json_stream(spark, f"{scratch}/landing", SENSOR).withColumn("day", F.lit(day))
        return ingest.drain(rows, f"{scratch}/b", f"{scratch}/c", ["day"])

    monkeypatch.setattr(ingest.BatchFolders, "__call__", stops)
    with pytest.raises(Exception, match="the job ends here"):
        run("first")
    monkeypatch.undo()
    assert run("second") == 2 and run("third") == 0
    assert [tuple(r) for r in ingest.landed(spark, f"{scratch}/b").groupBy("day").count().collect()] == [("second", 2)]


def test_a_stream_that_starts_anew_keeps_what_was_written(spark, scratch):
    put(f"{scratch}/landing", "a.json", '{"device_id": "A"}')
    for checkpoint in ("c1", "c2"):
        assert ingest.drain(ingest.json_stream(spark, f"{scratch}/landing", SENSOR), f"{scratch}/b", f"{scratch}/{checkpoint}") == 1
    assert ingest.landed(spark, f"{scratch}/b").count() == 2


def test_the_schema_widens_with_the_batches(spark, scratch):
    def run(**options):
        return ingest.drain_json(spark, f"{scratch}/landing", f"{scratch}/b", f"{scratch}/c", f"{scratch}/s", **options)

    put(f"{scratch}/landing", "a.json", '{"device_id": "A", "temp": 1.5}')
    assert run() == 1
    put(f"{scratch}/landing", "b.json", '{"device_id": "B", "temp": "hot", "pos": {"x": 1}}', "no object", " ")
    put(f"{scratch}/landing", "c.json", '{"device_id": "C", "temp": 2.5, "battery": 7}')
    assert run(max_files=1) == 3 and run() == 0
    schema = ingest.SchemaState(spark, f"{scratch}/s").read()
    assert schema.simpleString() == "struct<device_id:string,temp:double,pos:struct<x:bigint>,battery:bigint>"
    out = ingest.landed(spark, f"{scratch}/b", schema)
    assert out.columns == ["device_id", "temp", "pos", "battery", "_rescued_data", "ingested_at", "source_file"]
    got = {r.device_id: (r.temp, r.pos and r.pos.x, r.battery, r._rescued_data) for r in out.collect()}
    assert got == {"A": (1.5, None, None, None), "B": (None, 1, None, '{"temp":"hot"}'), "C": (2.5, None, 7, None),
                   None: (None, None, None, "no object")}
    assert out.where("ingested_at is null or source_file is null").count() == 0


def test_a_stopped_batch_finds_its_own_schema(spark, scratch, monkeypatch):
    put(f"{scratch}/landing", "a.json", '{"device_id": "A", "temp": 1.5}')

    def run():
        return ingest.drain_json(spark, f"{scratch}/landing", f"{scratch}/b", f"{scratch}/c", f"{scratch}/s")

    monkeypatch.setattr(ingest, "write_counted", lambda *a: 1 / 0)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        run()
    monkeypatch.undo()
    assert run() == 1 and len(ingest.SchemaState(spark, f"{scratch}/s")._numbers()) == 1
