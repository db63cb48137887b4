"""Merges, incremental loads, watermarks and file streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.catalog.registry import Tables, query
from tierflow.control import loads
from tierflow.control.registry import TableSpec
from tierflow.control.watermarks import Watermarks
from tierflow.operators.dedup import keep_latest
from tierflow.sinks.files import write_csv
from tierflow.sinks.snapshot import Snapshot, merge_rows
from tierflow.sources.files import read_csv, slot_of_file, text_schema
from tierflow.streaming import ingest

# --- merges -------------------------------------------------------------------------------
# Target: every customer. Source: every order, several per customer; urgent orders belong to
# customers the target does not know.

_TARGET = """
    select c_custkey customer_id, c_acctbal balance, c_mktsegment status, c_name name,
           timestamp '2000-01-01 00:00:00' insert_timestamp, timestamp '2000-01-01 00:00:00' update_timestamp
    from {customer}"""
_SOURCE = """
    select case when o_orderpriority = '1-URGENT' then o_custkey + 500000000 else o_custkey end customer_id,
           o_totalprice balance, o_orderstatus status, o_orderkey order_id, o_orderdate changed,
           timestamp '2024-01-01 00:00:00' insert_timestamp, timestamp '2024-01-01 00:00:00' update_timestamp
    from {orders}"""
_LATEST_SQL = """
    select * from (select *, row_number() over (partition by customer_id order by changed desc, order_id desc) rn
                   from (select case when o_orderpriority = '1-URGENT' then o_custkey + 500000000
                                else o_custkey end customer_id, o_totalprice balance, o_orderstatus status,
                                o_orderkey order_id, o_orderdate changed from orders) o) ranked where rn = 1"""


def _target(t: Tables, buckets: int = 8) -> Snapshot:
    table = Snapshot(t.spark, f"{t.scratch}/merged", ["customer_id"], buckets)
    table.overwrite(t.sql(_TARGET))
    return table


def _source(t: Tables) -> DataFrame:
    return t.sql(_SOURCE)


@query("upsert_update_insert", f"""
    select coalesce(s.customer_id, c.c_custkey) customer_id, coalesce(s.balance, c.c_acctbal) balance,
           coalesce(s.status, c.c_mktsegment) status, c.c_name as name, s.order_id
    from customer c full join ({_LATEST_SQL}) s on c.c_custkey = s.customer_id""")
def upsert_update_insert(t: Tables):
    table = _target(t)
    table.upsert(_source(t), latest=["changed", "order_id"], tie_break=[])
    return table.read().select("customer_id", "balance", "status", "name", "order_id")


@query("upsert_idempotent", f"""
    select coalesce(s.customer_id, c.c_custkey) customer_id, coalesce(s.balance, c.c_acctbal) balance,
           coalesce(s.status, c.c_mktsegment) status
    from customer c full join ({_LATEST_SQL}) s on c.c_custkey = s.customer_id""")
def upsert_idempotent(t: Tables):
    table = _target(t)
    for _ in range(2):
        table.upsert(_source(t), run_id=7, latest=["changed", "order_id"], tie_break=[])
    return table.read().select("customer_id", "balance", "status")


@query("upsert_preserve_insert_ts", f"""
    select coalesce(s.customer_id, c.c_custkey) customer_id,
           case when c.c_custkey is null then '2024-01-01 00:00:00' else '2000-01-01 00:00:00' end insert_timestamp,
           case when s.customer_id is null then '2000-01-01 00:00:00' else '2024-01-01 00:00:00' end update_timestamp
    from customer c full join ({_LATEST_SQL}) s on c.c_custkey = s.customer_id""")
def upsert_preserve_insert_ts(t: Tables):
    table = _target(t)
    table.upsert(_source(t), preserve=["insert_timestamp"], latest=["changed", "order_id"], tie_break=[])
    return table.read().select("customer_id", "insert_timestamp", "update_timestamp")


@query("upsert_frames", f"""
    select coalesce(s.customer_id, c.c_custkey) customer_id, coalesce(s.balance, c.c_acctbal) balance, c.c_name as name
    from customer c full join ({_LATEST_SQL}) s on c.c_custkey = s.customer_id""")
def upsert_frames(t: Tables):
    """The merge as one DataFrame, without a stored table."""
    source = keep_latest(_source(t), ["customer_id"], ["changed", "order_id"], tie_break=[])
    return merge_rows(t.sql(_TARGET), source, ["customer_id"]).select("customer_id", "balance", "name")


# --- loads --------------------------------------------------------------------------------
# Three runs, each seeing the source as it was at that time; the last one sees all of it.

_UNTIL = ["1997-01-01", "1999-01-01", "9999-12-31"]


def _orders_at(t: Tables, until: str) -> DataFrame:
    return t.sql("""select o_orderkey account_id, o_custkey customer_id, o_totalprice balance,
                    o_orderstatus status, o_orderdate updated_at from {orders}""").filter(
        F.col("updated_at") <= F.lit(until).cast("timestamp_ntz"))


def _run_loads(t: Tables, spec: TableSpec, snapshots: list[DataFrame], buckets: int = 8):
    """Each state of the source through bronze into silver, one run per state."""
    silver = Snapshot(t.spark, f"{t.scratch}/silver", spec.keys, buckets)
    marks = Watermarks(t.spark, f"{t.scratch}/watermarks")
    if spec.incremental:
        marks.seed([spec.table_id], datetime(2024, 1, 1))
    bronze_path = f"{t.scratch}/bronze"
    for run, state in enumerate(snapshots, start=1):
        now = datetime(2024, 1, run)
        loads.land_bronze(loads.new_source_rows(state, spec, marks), bronze_path, run, now)
        bronze = loads.read_bronze(t.spark, bronze_path, T.StructType(state.schema.fields + [
            T.StructField("insert_timestamp", T.TimestampType())]))
        loads.load_silver(bronze, silver, spec, marks, run, now)
    return silver, marks


_RUN_OF = """case when {0} <= timestamp '1997-01-01 00:00:00' then '2024-01-01'
                  when {0} <= timestamp '1999-01-01 00:00:00' then '2024-01-02' else '2024-01-03' end"""


@query("load_append", f"""
    select o_orderkey account_id, o_custkey customer_id, o_totalprice balance, o_orderstatus status,
           {_RUN_OF.format('o_orderdate')} loaded
    from orders""")
def load_append(t: Tables):
    spec = TableSpec(3, "orders", "APPEND", "account_id", "updated_at")
    silver, _ = _run_loads(t, spec, [_orders_at(t, u) for u in _UNTIL], buckets=1)
    return silver.read().select("account_id", "customer_id", "balance", "status",
                                F.to_date("insert_timestamp").alias("loaded"))


@query("load_merge", f"""
    select r.customer_id, r.account_id, r.balance, r.status, b.first_loaded, b.last_loaded
    from (select *, row_number() over (partition by customer_id order by updated_at desc, account_id) rn
          from (select o_custkey customer_id, o_orderkey account_id, o_totalprice balance, o_orderstatus status,
                       o_orderdate updated_at from orders) o) r
    join (select o_custkey customer_id, {_RUN_OF.format('min(o_orderdate)')} first_loaded,
                 {_RUN_OF.format('max(o_orderdate)')} last_loaded from orders group by 1) b
      on r.customer_id = b.customer_id
    where r.rn = 1""")
def load_merge(t: Tables):
    spec = TableSpec(2, "orders", "MERGE", "customer_id", "updated_at")
    silver, _ = _run_loads(t, spec, [_orders_at(t, u) for u in _UNTIL])
    return silver.read().select(
        "customer_id", "account_id", "balance", "status",
        F.to_date("insert_timestamp").alias("first_loaded"), F.to_date("update_timestamp").alias("last_loaded"))


@query("load_full", """
    select c_custkey customer_id, c_acctbal + 1 balance, '2024-01-02' loaded from customer""")
def load_full(t: Tables):
    """The second full load replaces the first, though bronze holds both."""
    spec = TableSpec(4, "customers", "FULL", "customer_id")
    first = t.sql("select c_custkey customer_id, c_acctbal balance from {customer}")
    second = t.sql("select c_custkey customer_id, c_acctbal + 1 balance from {customer}")
    silver, _ = _run_loads(t, spec, [first, second])
    return silver.read().select("customer_id", "balance", F.to_date("insert_timestamp").alias("loaded"))


@query("load_late_rows", """
    select o_orderkey account_id, case when o_orderkey % 7 = 0 then null else cast(o_orderdate as date) end updated_at,
           case when o_orderkey % 3 = 1 then '2024-01-02' else '2024-01-01' end loaded
    from orders""")
def load_late_rows(t: Tables):
    """The second batch holds rows before, at and after the watermark, and rows without one."""
    orders = t.sql("""select o_orderkey account_id, o_custkey customer_id,
                      case when o_orderkey % 7 = 0 then null else cast(o_orderdate as date) end updated_at from {orders}""")
    spec = TableSpec(3, "orders", "MERGE", "account_id", "updated_at")
    silver = Snapshot(t.spark, f"{t.scratch}/silver", spec.keys, 4)
    marks = Watermarks(t.spark, f"{t.scratch}/watermarks")
    marks.seed([spec.table_id], datetime(2024, 1, 1))
    for run, part in ((1, "account_id % 3 <> 1"), (2, "account_id % 3 = 1")):
        loads.land_bronze(orders.filter(part), f"{t.scratch}/bronze", run, datetime(2024, 1, run))
        bronze = loads.read_bronze(t.spark, f"{t.scratch}/bronze", since=marks.last_run(spec.table_id))
        loads.load_silver(bronze, silver, spec, marks, run, datetime(2024, 1, run))
    return silver.read().select("account_id", "updated_at", F.to_date("insert_timestamp").alias("loaded"))


@query("upsert_rebucketed", f"""
    select coalesce(s.customer_id, c.c_custkey) customer_id, coalesce(s.balance, c.c_acctbal) balance
    from customer c full join ({_LATEST_SQL}) s on c.c_custkey = s.customer_id""")
def upsert_rebucketed(t: Tables):
    """A table opened with other numbers of buckets between merges."""
    _target(t, buckets=4)
    for buckets in (8, 1, 4):
        table = Snapshot(t.spark, f"{t.scratch}/merged", ["customer_id"], buckets)
        table.upsert(_source(t), latest=["changed", "order_id"], tie_break=[])
    return table.read().select("customer_id", "balance")


@query("watermark_after_load", """
    select 3 table_id, cast(max(o_orderdate) as varchar) last_watermark_value, 3 last_run_id from orders""")
def watermark_after_load(t: Tables):
    spec = TableSpec(3, "orders", "APPEND", "account_id", "updated_at")
    _, marks = _run_loads(t, spec, [_orders_at(t, u) for u in _UNTIL], buckets=1)
    return marks.read().select("table_id", "last_watermark_value", "last_run_id")


@query("load_slices", """
    select o_orderkey, o_custkey, o_totalprice, '2026/06/19/18/' ||
           case when o_orderdate <= timestamp '1998-01-01 00:00:00' then '41' else '42' end slot
    from orders""")
def load_slices(t: Tables):
    """Bounded extracts to dated quoted CSV: two rounds over a growing source make one full load."""
    last: str | None = "1900-01-01 00:00:00"
    for slot, until in (("2026/06/19/18/41", "1998-01-01"), ("2026/06/19/18/42", "9999-12-31")):
        source = t.orders.filter(F.col("o_orderdate") <= F.lit(until).cast("timestamp_ntz"))

        def land(table: str, rows: DataFrame, slot: str = slot) -> None:
            write_csv(rows.select("o_orderkey", "o_custkey", "o_totalprice"),
                      f"{t.scratch}/landing/Orders/{slot}/{table}.csv")

        last = loads.bounded_extracts({"Orders": source}, [("Orders", "o_orderdate", last)], land)["Orders"]
    landed = read_csv(t.spark, f"{t.scratch}/landing/Orders",
                      "o_orderkey bigint, o_custkey bigint, o_totalprice double", recursive=True)
    return landed.withColumn("slot", slot_of_file(F.col("_metadata.file_path")))


# --- streams ------------------------------------------------------------------------------

_SENSOR = T.StructType([
    T.StructField("device_id", T.StringType()), T.StructField("temp", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])
_EVENT = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


@query("stream_ingest_once", "select event_id, event_type, value, null::varchar _rescued_data from events")
def stream_ingest_once(t: Tables):
    """Two arrivals and three runs: each event once."""
    landing, target, checkpoint = (f"{t.scratch}/{n}" for n in ("landing", "bronze", "checkpoint"))
    events = t.events.select("event_id", "event_type", "value")
    for arrived in (F.col("event_type").isin("error", "view"), ~F.col("event_type").isin("error", "view"), None):
        if arrived is not None:
            events.filter(arrived).write.mode("append").json(landing)
        rows = ingest.json_stream(t.spark, landing, _EVENT, lineage=False)
        ingest.drain(rows, target, checkpoint)
    return ingest.landed(t.spark, target)



def _sensor_line():
    """An event as a sensor document that fits, misfits, has more fields or is cut off."""
    device = F.concat(F.lit('{"device_id":"DEV_'), "event_id", F.lit('","temp":'))
    kind = F.col("event_type")
    return (
        F.when(kind == "error", F.concat(device, F.lit('"n/a","timestamp":"t"}')))
        .when(kind == "click", F.concat(device, F.lit('21.5,"timestamp":"t","battery":'), "user_id", F.lit("}")))
        .when(kind == "signup", device)
        .when(kind == "purchase", F.concat(device, "value", F.lit(',"pos":{"x":'), "user_id", F.lit("}}")))
        .otherwise(F.concat(device, F.lit('null,"timestamp":"t"}')))
    )


@query("stream_rescue", """
    select case when event_type <> 'signup' then 'DEV_' || event_id end device_id,
           case event_type when 'click' then 21.5 when 'purchase' then value end temp,
           case when event_type in ('error', 'click', 'view') then 't' end as "timestamp",
           case event_type when 'error' then '{"temp":"n/a"}'
             when 'click' then '{"battery":"' || user_id || '"}'
             when 'signup' then '{"device_id":"DEV_' || event_id || '","temp":'
             when 'purchase' then '{"pos":"{\\"x\\":' || user_id || '}"}' end _rescued_data
    from events""")
def stream_rescue(t: Tables):
    """Extra, mistyped and nested values and broken lines are kept beside the typed columns."""
    landing = f"{t.scratch}/landing"
    t.events.select(_sensor_line().alias("value")).write.text(landing)
    rows = ingest.json_stream(t.spark, landing, _SENSOR, lineage=False)
    ingest.drain(rows, f"{t.scratch}/bronze", f"{t.scratch}/checkpoint")
    return ingest.landed(t.spark, f"{t.scratch}/bronze")


@query("stream_sensor_widening", """
    select case when event_type <> 'signup' then 'DEV_' || event_id end device_id,
           case when event_type in ('click', 'purchase') then value + 0.5 end "temp",
           case when event_type <> 'signup' then 't' end "timestamp", case event_type when 'click' then user_id end battery,
           case event_type when 'error' then '{"temp":"n/a"}' when 'signup' then '{"device_id":"DEV_' || event_id || '","temp":' end
             _rescued_data,
           case when event_type in ('view', 'purchase') then 1 else 2 end arrival, true dated
    from events""")
def stream_sensor_widening(t: Tables):
    """The sensor stream as a whole: its first arrival tells the schema, the second brings a further field, a value
    of another type and lines that are cut off, the third nothing."""
    landing, bronze, kept = (f"{t.scratch}/{n}" for n in ("landing", "bronze", "schema"))
    kind = F.col("event_type")
    device = F.concat(F.lit('{"device_id":"DEV_'), "event_id", F.lit('","temp":'))
    line = (
        F.when(kind == "error", F.concat(device, F.lit('"n/a","timestamp":"t"}')))
        .when(kind == "view", F.concat(device, F.lit('null,"timestamp":"t"}')))
        .when(kind == "purchase", F.concat(device, F.col("value") + 0.5, F.lit(',"timestamp":"t"}')))
        .when(kind == "click", F.concat(device, F.col("value") + 0.5, F.lit(',"timestamp":"t","battery":'), "user_id", F.lit("}")))
        .otherwise(device)
    )
    for arrival, chosen in ((1, kind.isin("view", "purchase")), (2, ~kind.isin("view", "purchase")), (3, None)):
        if chosen is not None:
            t.events.filter(chosen).select(line.alias("value")).write.text(f"{landing}/arrival_{arrival}")
        ingest.drain_json(t.spark, f"{landing}/*", bronze, f"{t.scratch}/checkpoint", kept)
    rows = ingest.landed(t.spark, bronze, ingest.SchemaState(t.spark, kept).read())
    return rows.withColumns({
        "arrival": F.regexp_extract("source_file", r"/arrival_(\d)/", 1).cast("int"), "dated": F.col("ingested_at").isNotNull(),
    }).drop("source_file", "ingested_at")


@query("stream_csv_strings", """
    select cast(event_id as varchar) event_id, event_type, cast(user_id as varchar) user_id from events""")
def stream_csv_strings(t: Tables):
    landing = f"{t.scratch}/landing"
    write_csv(t.events.select("event_id", "event_type", "user_id"), landing, quote_all=False)
    rows = ingest.csv_stream(t.spark, landing, ["event_id", "event_type", "user_id"])
    ingest.drain(rows, f"{t.scratch}/bronze", f"{t.scratch}/checkpoint")
    return ingest.landed(t.spark, f"{t.scratch}/bronze")


@query("stream_to_silver", """
    select event_id, event_type, user_id, value
    from events qualify row_number() over (partition by user_id order by event_id desc) = 1""")
def stream_to_silver(t: Tables):
    """Text columns from a CSV stream are typed before the watermark compares them, then merged."""
    landing, bronze = f"{t.scratch}/landing", f"{t.scratch}/bronze"
    columns = ["event_id", "event_type", "user_id", "value"]
    write_csv(t.events.select(*columns), landing, quote_all=False)
    ingest.drain(ingest.csv_stream(t.spark, landing, columns), bronze, f"{t.scratch}/checkpoint")
    typed = t.spark.read.schema(text_schema(columns)).parquet(bronze).selectExpr(
        "cast(event_id as bigint) event_id", "event_type", "cast(user_id as bigint) user_id",
        "cast(value as double) value")
    silver = Snapshot(t.spark, f"{t.scratch}/silver", ["user_id"], 8)
    marks = Watermarks(t.spark, f"{t.scratch}/watermarks")
    marks.seed([6], datetime(2024, 1, 1), "-1")
    loads.load_silver(typed, silver, TableSpec(6, "logs", "MERGE", "user_id", "event_id"), marks, 1,
                      datetime(2024, 1, 1))
    return silver.read().select(*columns)
