import os

import pytest
from pyspark.sql import functions as F

from tierflow.plans import social
from tierflow.sinks.files import insert_jdbc, write_csv, write_json_lines, write_partitioned
from tierflow.sources import files, jdbc


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as out:
        out.write(text)


def local(path):
    return path.removeprefix("file:")


def test_missing_empty_and_header_only_inputs_are_skipped(spark, scratch):
    base = local(scratch)
    put(f"{base}/empty.csv", "")
    put(f"{base}/header.csv", "a,b\n")
    put(f"{base}/full.csv", "a,b\n1,\"x, \\\"y\\\"\"\n")
    read = lambda name: files.read_csv_if_filled(spark, f"{base}/{name}", "a int, b string")
    assert read("missing.csv") is None
    assert read("empty.csv") is None
    assert read("header.csv") is None
    assert [tuple(r) for r in read("full.csv").collect()] == [(1, 'x, "y"')]


def test_landing_slot_is_recovered_from_the_file_path(spark, scratch):
    path = files.landing_path(scratch, "bank/Orders/", "2026/06/19/18/44/", "Orders")
    assert path.endswith("/bank/Orders/2026/06/19/18/44/Orders.csv")
    write_csv(spark.range(3), path)
    df = files.read_csv(spark, f"{scratch}/bank", "id bigint", recursive=True)
    assert df.select(files.slot_of_file(F.col("_metadata.file_path"))).distinct().first()[0] == "2026/06/19/18/44"
    slot = spark.sql("select timestamp '2026-06-19 18:44:31' t").select(files.landing_slot(F.col("t"))).first()[0]
    assert slot == "2026/06/19/18/44"


def test_quoted_csv_keeps_text(spark, scratch, rows):
    df = spark.createDataFrame([(1, 'a "quoted", text'), (2, "back\\slash"), (3, " padded ")], "i int, t string")
    assert write_csv(df, f"{scratch}/t.csv") == 3
    back = files.read_csv(spark, f"{scratch}/t.csv", "i int, t string")
    assert rows(back) == rows(df)


def test_json_arrays_and_json_lines_with_byte_order_mark(spark, scratch, rows):
    base = local(scratch)
    put(f"{base}/posts", '[{"userId":1,"id":1,"title":"a","body":"b\\nc"}\n,{"userId":1,"id":2,"title":"x"}]', "utf-8-sig")
    put(f"{base}/albums", '{"userId":1,"id":1,"title":"q"}\n{"userId":2,"id":2,"title":"r","more":1}\n', "utf-8-sig")
    posts = social.read_entity(spark, f"{base}/posts", social.POSTS)
    assert posts.columns == ["PostID", "UserID", "Title", "Body"]
    assert rows(posts) == [(1, 1, "a", "b\nc"), (2, 1, "x", None)]
    assert rows(social.read_entity(spark, f"{base}/albums", social.ALBUMS)) == [(1, 1, "q"), (2, 2, "r")]
    assert social.read_entity(spark, f"{base}/albums", social.ALBUMS, limit=1).count() == 1


def test_nested_users_become_flat_rows(spark, scratch):
    put(f"{local(scratch)}/users", '[{"id":1,"name":"n","username":"u","email":"e","address":{"street":"s","suite":"x",'
        '"city":"c","zipcode":"z","geo":{"lat":"-37.3159","lng":"81.1496"}},"phone":"p","website":"w",'
        '"company":{"name":"cn","catchPhrase":"cp","bs":"bs"},"unknown":{"a":1}}]')
    df = social.read_entity(spark, f"{local(scratch)}/users", social.USERS)
    row = df.first().asDict()
    assert len(row) == 15 and row["companyBs"] == "bs" and str(row["geoLat"]) == "-37.315900"
    assert dict(df.dtypes)["geoLng"] == "decimal(9,6)"


def test_entities_are_routed_by_their_nested_flag():
    assert [e.name for e in social.ENTITIES.values() if e.nested] == ["users"]
    assert len(social.ENTITIES) == 6


def test_database_slices_are_pushed_with_typed_bounds():
    assert jdbc.slice_query("dbo.t") == "(SELECT * FROM dbo.t) src"
    assert jdbc.slice_query("dbo.t", "Hospital ID", 9900006, 9900010) == (
        '(SELECT * FROM dbo.t WHERE "Hospital ID" > 9900006 AND "Hospital ID" <= 9900010) src')
    assert jdbc.slice_query("t", "ts", "2021-07-02T14:46:00") == "(SELECT * FROM t WHERE \"ts\" > '2021-07-02T14:46:00') src"
    assert jdbc.slice_query("t", "c", "o'x").endswith("> 'o''x') src")
    assert jdbc.max_query("t", "c") == '(SELECT MAX("c") AS upper_bound FROM t) src'


class _Reader:
    def jdbc(self, *args, **kwargs):
        return args, kwargs


class _Session:
    read = _Reader()


def test_database_read_is_split_over_ranges():
    args, kwargs = jdbc.read_slice(_Session(), "jdbc:x", "(q) src", {"user": "u"})
    assert args == ("jdbc:x", "(q) src") and kwargs == {"properties": {"user": "u"}}
    _, kwargs = jdbc.read_slice(_Session(), "jdbc:x", "(q) src", {}, jdbc.SplitBy("id", "0", "100", 8))
    assert kwargs["column"] == "id" and kwargs["numPartitions"] == 8


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_ranges_deal_a_skewed_key_evenly(spark, parts):
    """Edges and conditions as a database would see them: each row in one range, the hot key in one, NULL in the last."""
    keys = [7] * 300 + [*range(100, 400)] + [10**6] + [None] * 5
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k bigint")
    df.createOrReplaceTempView("skewed")
    edges = [r.edge for r in spark.sql(
        "SELECT * FROM " + jdbc.edges_query("(SELECT * FROM skewed)", "k", parts, quote="`")).collect()]
    found = [[r.i for r in df.where(p).collect()] for p in jdbc.range_predicates(edges, "k", quote="`")]
    assert sorted(i for part in found for i in part) == list(range(len(keys)))
    assert all(keys[i] is not None for part in found[:-1] for i in part)
    if parts > 1:  # equal ranges between the smallest and the largest key would put all but one row into the first
        assert max(len([i for i in part if keys[i] != 7]) for part in found) <= 2 * 606 / parts
        assert max(map(len, found)) <= 300 + 606 / parts


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_edges_by_an_aggregate_sort_no_keys(spark, parts):
    """F12 to F14: the same shares without a window, which would take all keys to one task."""
    keys = [7] * 300 + [*range(100, 400)] + [10**6] + [None] * 5
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k bigint")
    df.createOrReplaceTempView("skewed_too")
    found = {}
    for quantile in (None, "approx_percentile({key}, {share}D, 10000)"):
        edges = spark.sql("SELECT * FROM " + jdbc.edges_query("(SELECT * FROM skewed_too) src", "k", parts, "`", quantile))
        found[quantile] = sorted(edges.collect())
        assert ("Window" in edges._jdf.queryExecution().executedPlan().toString()) == (quantile is None)
        ranges = jdbc.range_predicates([r.edge for r in found[quantile]], "k", quote="`")
        dealt = [[r.i for r in df.where(p).collect()] for p in ranges]
        assert sorted(i for part in dealt for i in part) == list(range(len(keys)))
        assert max(map(len, dealt)) <= 300 + 606 / parts
    plain, shares = found.values()
    assert [r.part for r in plain] == [r.part for r in shares] == list(range(1, parts + 1)) and plain[-1] == shares[-1]


def test_range_predicates_of_few_edges():
    assert jdbc.range_predicates([], "k") == ["1 = 1"] == jdbc.range_predicates([5, 5], "k")
    assert jdbc.range_predicates(["b", "a'"], "k") == ["\"k\" <= 'a" + "'" * 3, "(\"k\" > 'a" + "'" * 3 + " OR \"k\" IS NULL)"]
    args, kwargs = jdbc.read_ranges(_Session(), "jdbc:x", "(q) src", ["1 = 1"], {"user": "u"})
    assert args == ("jdbc:x", "(q) src") and kwargs == {"predicates": ["1 = 1"], "properties": {"user": "u"}}


def test_formats_globs_and_paths(spark, scratch, rows):
    for month in (1, 2):
        spark.range(month).write.parquet(f"{scratch}/trips_2026-0{month}.parquet")
    write_json_lines(spark.range(2), f"{scratch}/j")
    assert files.read_parquet(spark, f"{scratch}/trips_2026-*.parquet").count() == 3
    assert files.load(spark, "json", f"{scratch}/j", "id bigint").count() == 2
    assert files.query_path(spark, "parquet", f"{scratch}/trips_2026-02.parquet", "id > 0", 10).count() == 1


def test_partitioned_write_and_pruned_read(spark, scratch):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("m"))
    assert write_partitioned(df, f"{scratch}/p", ["m"]) == 100
    back = spark.read.parquet(f"{scratch}/p").filter("m = 1")
    assert back.count() == 33
    assert "PartitionFilters: [isnotnull(m" in back._jdf.queryExecution().executedPlan().toString()


def test_database_sink_only_inserts():
    calls = []

    class Frame:
        class write:  # noqa: N801
            @staticmethod
            def jdbc(url, table, mode, properties):
                calls.append((url, table, mode, properties))

    insert_jdbc(Frame, "jdbc:x", "dbo.users", {"user": "u"})
    assert calls == [("jdbc:x", "dbo.users", "append", {"user": "u"})]


def test_csv_columns_are_taken_by_name(spark, scratch, rows):
    spark.createDataFrame([("1", "x", "m"), ("2", "y", None)], "b string, a string, c string").write.csv(f"{scratch}/c", header=True)
    with pytest.raises(ValueError, match="c"):
        files.read_csv(spark, f"{scratch}/c", "a string, b int")
    got = files.read_csv(spark, f"{scratch}/c", "a string, b int, d string", rescue="rest")
    assert rows(got) == [("x", 1, None, '{"c":"m"}'), ("y", 2, None, None)]
    assert got.columns == ["a", "b", "d", "rest"]
    with pytest.raises(ValueError, match="d"):
        files.read_csv(spark, f"{scratch}/c", "a string, b int, c string, d string")


def test_a_file_with_another_header_is_an_error(spark, scratch):
    for name, header in (("1", "a,b"), ("2", "b,a")):
        spark.createDataFrame([(header,), ("1,2",)], "value string").coalesce(1).write.mode("append").text(f"{scratch}/m")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, f"{scratch}/m", "a string, b string").collect()


def test_line_breaks_empty_and_missing_texts_survive_csv(spark, scratch, rows):
    from tierflow.sinks.files import write_csv
    items = [(1, "a\nb"), (2, ""), (3, None), (4, 'q"u,o\\te\r\n'), (5, " x "), (6, "\\N?")]
    for quote_all in (True, False):
        write_csv(spark.createDataFrame(items, "k int, v string"), f"{scratch}/{quote_all}", quote_all=quote_all)
        got = files.read_csv(spark, f"{scratch}/{quote_all}", "k int, v string", multi_line=True)
        assert rows(got) == sorted(items, key=repr)
