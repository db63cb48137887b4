import csv
import io
import json
import random

import pytest

from tierflow.sources import files, split


@pytest.fixture
def small_ranges(spark):
    name, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(name, "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set(name, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def put(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
        out.write(text)


def random_rows(rng, n):
    return [(str(i), "".join(rng.choice(['"', "\n", ",", "x", "é", "}", "{", " ", "long word " * 4]) for _ in range(rng.randint(0, 25))))
            for i in range(n)]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_line_breaks_in_quotes_over_several_tasks(spark, scratch, small_ranges, ending):
    rng = random.Random(1)
    want = {}
    for name in "abc":
        text = io.StringIO(newline="")
        rows = random_rows(rng, 120)
        writer = csv.writer(text, quoting=csv.QUOTE_ALL, escapechar="\\", doublequote=False, lineterminator=ending)
        writer.writerow(["k", "v"])
        writer.writerows(rows)
        put(f"{scratch}/csv", f"{name}.csv", text.getvalue())
        want[name] = rows
    assert spark.read.text(f"{scratch}/csv").rdd.getNumPartitions() > 30
    records = split.csv_records(spark, f"{scratch}/csv")
    got = files.read_csv(spark, f"{scratch}/csv", "k string, v string", multi_line=True)
    assert sorted(tuple(r) for r in got.collect()) == sorted(r for rows in want.values() for r in rows)
    numbers = [(r.file[-5], r.number) for r in records.collect()]
    assert len(numbers) == len(set(numbers))


def test_second_quotes_blank_lines_and_other_headers(spark, scratch, small_ranges):
    put(f"{scratch}/one", "a.csv", 'k,v\n1,"a ""quoted""\n\ntext"\n\n2,plain\n3,\n4,""\n5,\\N')
    got = files.read_csv(spark, f"{scratch}/one", "k int, v string", multi_line=True, escape='"')
    assert sorted(tuple(r) for r in got.collect()) == [(1, 'a "quoted"\n\ntext'), (2, "plain"), (3, None), (4, ""), (5, None)]
    plain = files.read_csv(spark, f"{scratch}/one", "k int, v string", multi_line=True, escape='"', header=False).count()
    assert plain == 6
    put(f"{scratch}/one", "b.csv", "v,k\nx,1\n")
    with pytest.raises(Exception, match="another header in"):
        files.read_csv(spark, f"{scratch}/one", "k int, v string", multi_line=True, escape='"').collect()


def documents(rng, n):
    return [{"id": i, "name": "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "é", "x", "\n"]) for _ in range(rng.randint(0, 20))),
             "address": {"city": rng.choice(["a}", '"b"', "c"]), "geo": {"lat": str(i)}}} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_is_read_by_several_tasks(spark, scratch, small_ranges, indent):
    rng = random.Random(2)
    first, second = documents(rng, 90), documents(rng, 1)
    put(f"{scratch}/json", "a.json", "﻿" + json.dumps(first, indent=indent, ensure_ascii=False))
    put(f"{scratch}/json", "b.json", json.dumps(second[0], indent=indent) + "\n")
    put(f"{scratch}/json", "c.json", "[]")
    assert spark.read.text(f"{scratch}/json", lineSep="}").rdd.getNumPartitions() > 20
    schema = "id int, name string, address struct<city: string, geo: struct<lat: string>>"
    got = files.read_json(spark, f"{scratch}/json", schema, multi_line=True)
    want = [(d["id"], d["name"], d["address"]["city"], d["address"]["geo"]["lat"]) for d in first + second]
    assert sorted((r.id, r.name, r.address.city, r.address.geo.lat) for r in got.collect()) == sorted(want)
    parts = split.json_elements(spark, f"{scratch}/json")
    assert sorted(r.number for r in parts.where("file like '%a.json'").collect()) == list(range(90))


def test_no_task_lands_all_of_an_array(spark, scratch):
    """F1 to F4: each task writes an array of its own, and together they are read as one table."""
    import glob

    from tierflow.catalog.social import land_array

    given = [(i % 7 or None, f'{{"\n}}é{i}') for i in range(40)]  # ids repeat and lack
    land_array(spark.createDataFrame(given, "id int, title string").repartition(5), f"{scratch}/arrays")
    land_array(spark.createDataFrame([], "id int, title string"), f"{scratch}/empty")
    found = glob.glob(f"{scratch.removeprefix('file:')}/arrays/part-*")
    arrays = [json.load(open(f, encoding="utf-8-sig")) for f in found]
    assert len(arrays) == 5 and max(map(len, arrays)) < 20
    assert sorted((str(d["id"]), d["title"]) for a in arrays for d in a) == sorted((str(i), t) for i, t in given)
    got = files.read_json(spark, f"{scratch}/arrays", "id int, title string", multi_line=True)
    assert sorted((str(r.id), r.title) for r in got.collect()) == sorted((str(i), t) for i, t in given)
    assert files.read_json(spark, f"{scratch}/empty", "id int, title string", multi_line=True).count() == 0


def test_no_task_gets_a_whole_range(spark, scratch):
    """pieces travel in chunks, so what a task reads does not grow with the range of a file."""
    from pyspark.sql import functions as F

    records = [{"id": i, "name": "}" * (i % 3) + '"{' * (i % 2), "geo": {"lat": i}} for i in range(6000)]
    put(f"{scratch}/json", "a.json", json.dumps(records))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        pieces = split._pieces(spark, f"{scratch}/json", "}", False).withColumn("range", F.lit(0)).withColumn("one", F.lit(1))
        carried = split._carried(pieces, "one", "n").withColumn("task", F.spark_partition_id())
        held = [r.held for r in carried.groupBy("task").agg(F.count("n").alias("held"), F.max("n")).collect()]
        assert sum(held) > 6000 and max(held) < 0.9 * sum(held)
        assert carried.where("chunk > 0 and n < 256").count() == 0
    finally:
        spark.conf.set(coalesce, before)
    parts = split.json_elements(spark, f"{scratch}/json")
    assert sorted(r.number for r in parts.collect()) == list(range(6000))
    got = files.read_json(spark, f"{scratch}/json", "id int, name string, geo struct<lat: int>", multi_line=True)
    assert sorted((r.id, r.name, r.geo.lat) for r in got.collect()) == [(d["id"], d["name"], d["geo"]["lat"]) for d in records]
