"""File formats, guards and catalog objects."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.catalog.registry import Tables, query
from tierflow.sinks import catalog
from tierflow.sinks.files import write_csv, write_json_lines, write_parquet, write_partitioned
from tierflow.sinks.snapshot import Snapshot
from tierflow.sources.files import (
    landing_path, landing_slot, load, query_path, read_csv, read_csv_if_filled, read_json, read_parquet, slot_of_file, text_schema,
)
from tierflow.streaming import ingest

SLOT = "2026/06/19/18/44"
_ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders"
_ORDERS_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


def _orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("dated_csv_roundtrip", f"select *, '{SLOT}' slot from ({_ORDERS_SQL}) o")
def dated_csv_roundtrip(t: Tables):
    path = landing_path(t.scratch, "landing/Orders", SLOT + "/", "Orders")
    write_csv(_orders(t), path)
    return read_csv(t.spark, path, _ORDERS_DDL).withColumn("slot", slot_of_file(F.col("_metadata.file_path")))


@query("quoted_text_roundtrip", """
    select doc_id, case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then '' else lang end lang, text body
    from documents""")
def quoted_text_roundtrip(t: Tables):
    """Whole texts with quotes, commas and line breaks through quoted CSV; empty texts and missing ones."""
    path = f"{t.scratch}/texts.csv"
    lang = F.when(F.col("doc_id") % 5 == 1, "").when(F.col("doc_id") % 5 > 1, F.col("lang")).alias("lang")
    write_csv(t.documents.select("doc_id", lang, F.col("text").alias("body")), path)
    return read_csv(t.spark, path, "doc_id bigint, lang string, body string", multi_line=True)


@query("csv_reordered_columns", "select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as double) o_totalprice from orders")
def csv_reordered_columns(t: Tables):
    """Columns are taken by name, whatever their order in the files."""
    path = f"{t.scratch}/reordered.csv"
    write_csv(t.orders.select("o_totalprice", "o_orderstatus", "o_orderkey", "o_custkey"), path)
    return read_csv(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")


@query("preview_rows", """
    select 'json' preview, least(100, count(*)) as rows from events union all select 'path', least(7, count(*)) from events""")
def preview_rows(t: Tables):
    """Previews of a landed folder: declared JSON with a limit, and SQL over its path."""
    path = f"{t.scratch}/events"
    write_json_lines(t.events.select("event_id", "event_type"), path)
    previews = {"json": read_json(t.spark, path, "event_id bigint, event_type string", limit=100),
                "path": query_path(t.spark, "json", path, "event_id is not null", 7)}
    counts = [df.agg(F.lit(name).alias("preview"), F.count(F.lit(1)).alias("rows")) for name, df in previews.items()]
    return counts[0].union(counts[1])


@query("landing_slots", """
    select strftime(o_orderdate, '%Y/%m/%d/%H/%M') slot, count(*) orders from orders where o_orderdate is not null group by 1""")
def landing_slots(t: Tables):
    """The folder of each order's time."""
    return t.orders.groupBy(landing_slot(F.col("o_orderdate")).alias("slot")).agg(F.count(F.lit(1)).alias("orders")).where("slot is not null")


@query("stream_followed", "select event_id, event_type, true as dated from events")
def stream_followed(t: Tables):
    """A continuous stream over two arrivals, stopped by its caller when nothing is left to read."""
    landing, bronze = f"{t.scratch}/landing", f"{t.scratch}/bronze"
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    even = F.col("event_id") % 2 == 0
    write_json_lines(t.events.select("event_id", "event_type").filter(even), landing)
    running = ingest.follow(ingest.json_stream(t.spark, landing, schema), bronze, f"{t.scratch}/checkpoint")
    running.processAllAvailable()
    write_json_lines(t.events.select("event_id", "event_type").filter(~even), landing, mode="append")
    running.processAllAvailable()
    running.stop()
    return ingest.landed(t.spark, bronze).select("event_id", "event_type", F.col("ingested_at").isNotNull().alias("dated"))


@query("stream_csv_rescue", """
    select cast(event_id as varchar) event_id, event_type, cast(null as varchar) channel,
           case when user_id is null then null else '{"user_id":"' || user_id || '"}' end _rescued_data
    from events""")
def stream_csv_rescue(t: Tables):
    """A stream of files whose columns come in another order, one missing and one more than asked for."""
    landing, bronze = f"{t.scratch}/csv", f"{t.scratch}/csv_bronze"
    write_csv(t.events.select("user_id", "event_type", "event_id"), landing)
    rows = ingest.csv_stream(t.spark, landing, ["event_id", "event_type", "channel"], rescue=True)
    ingest.drain(rows, bronze, f"{t.scratch}/csv_checkpoint")
    return ingest.landed(t.spark, bronze)


@query("empty_input_guard", f"{_ORDERS_SQL}")
def empty_input_guard(t: Tables):
    """A missing and a header-only input leave the table as it was."""
    table = Snapshot(t.spark, f"{t.scratch}/orders")
    schema = text_schema(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    write_csv(_orders(t), f"{t.scratch}/full.csv")
    write_csv(_orders(t).filter(F.col("o_orderkey").isNull()), f"{t.scratch}/header.csv")
    for name in ("full.csv", "missing.csv", "header.csv"):
        rows = read_csv_if_filled(t.spark, f"{t.scratch}/{name}", schema)
        if rows is not None:
            table.overwrite(rows)
    return table.read().selectExpr(
        "cast(o_orderkey as bigint) o_orderkey", "cast(o_custkey as bigint) o_custkey", "o_orderstatus",
        "cast(o_totalprice as double) o_totalprice")


@query("query_by_path", "select l_orderkey, l_quantity from lineitem where l_quantity > 40")
def query_by_path(t: Tables):
    return query_path(t.spark, "parquet", f"{t.folder}/lineitem.parquet", "l_quantity > 40").select(
        "l_orderkey", "l_quantity")


@query("parquet_glob", "select event_id, user_id from events")
def parquet_glob(t: Tables):
    return read_parquet(t.spark, f"{t.folder}/event*.parquet").select("event_id", "user_id")


@query("load_by_format", "select r_regionkey::bigint r_regionkey, n_name from region join nation on r_regionkey = n_regionkey")
def load_by_format(t: Tables):
    regions = load(t.spark, "parquet", f"{t.folder}/region.parquet")
    nations = load(t.spark, "parquet", f"{t.folder}/nation.parquet")
    return regions.join(nations, F.col("r_regionkey") == F.col("n_regionkey")).select("r_regionkey", "n_name")


@query("external_table", f"{_ORDERS_SQL} where o_orderstatus = 'F'")
def external_table(t: Tables):
    """A partitioned table over existing files; the filter on the partition column prunes folders."""
    path = f"{t.scratch}/orders"
    write_partitioned(_orders(t), path, ["o_orderstatus"])
    name = f"orders_{uuid.uuid4().hex}"
    table = catalog.create_external(t.spark, name, _ORDERS_DDL, path, ["o_orderstatus"])
    return table.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("replaced_view", "select o_orderstatus, count(*) orders from orders group by 1")
def replaced_view(t: Tables):
    name = f"view_{uuid.uuid4().hex}"
    catalog.replace_view(_orders(t).limit(0), name)
    return catalog.replace_view(_orders(t), name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query("named_tables", """
    select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P'
    union all select o_orderkey, o_orderstatus from orders where o_orderstatus = 'P'
    union all select l_orderkey, l_linestatus from lineitem""")
def named_tables(t: Tables):
    """Create if absent (twice), replace, append, and scan by name."""
    name = f"orders_{uuid.uuid4().hex}"
    keyed = t.orders.select("o_orderkey", "o_orderstatus")
    catalog.create_if_absent(keyed.limit(0), name, f"{t.scratch}/named")
    catalog.create_if_absent(keyed, name, f"{t.scratch}/named")
    catalog.replace_table(keyed, name, f"{t.scratch}/replaced")
    catalog.append_table(t.lineitem.selectExpr("l_orderkey o_orderkey", "l_linestatus o_orderstatus"), name)
    return t.spark.table(name)


@query("overwritten_merged_schema", """
    select c_custkey, cast(null as double) c_acctbal, c_name from customer""")
def overwritten_merged_schema(t: Tables):
    """An overwrite that keeps a column the new rows do not have."""
    table = Snapshot(t.spark, f"{t.scratch}/customers")
    table.overwrite(t.customer.select("c_custkey", "c_acctbal"))
    table.overwrite(t.customer.select("c_custkey", "c_name"), merge_schema=True)
    return table.read()


@query("append_new_columns", """
    select o_orderkey, o_custkey, cast(null as varchar) o_orderstatus from orders
    union all select o_orderkey, o_custkey, o_orderstatus from orders""")
def append_new_columns(t: Tables):
    """Rows appended with one more column: older rows show NULL in it."""
    table = Snapshot(t.spark, f"{t.scratch}/orders", ["o_orderkey"], 4)
    table.append(t.orders.select("o_orderkey", "o_custkey"))
    table.append(t.orders.select("o_orderstatus", "o_custkey", "o_orderkey"))
    return table.read()


@query("replaced_schema", "select c_custkey, c_name from customer")
def replaced_schema(t: Tables):
    """A replacement that reads the table it replaces, with other columns."""
    table = Snapshot(t.spark, f"{t.scratch}/customers")
    table.overwrite(t.customer)
    table.overwrite(table.read().select("c_custkey", "c_name"))
    return table.read()


@query("written_row_counts", """
    select (select count(*) from orders) orders, (select count(*) from lineitem) lines,
           (select count(*) from events) events""")
def written_row_counts(t: Tables):
    """Row counts measured by the writes themselves."""
    counts = [write_parquet(df, f"{t.scratch}/{i}") for i, df in enumerate((t.orders, t.lineitem, t.events))]
    return t.spark.createDataFrame([counts], "orders bigint, lines bigint, events bigint")
