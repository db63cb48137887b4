"""Cleansing operators on whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.catalog.registry import Tables, query
from tierflow.functions import columns as fn
from tierflow.operators.cleanse import Rule, apply_rules, fill, require, unreadable
from tierflow.operators.dedup import keep_latest
from tierflow.operators.slices import between


@query("dedup_latest_row", """
    select l_orderkey, cast(l_linenumber as bigint) l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_returnflag, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') l_shipdate
    from (select *, row_number() over (
            partition by l_orderkey, l_linenumber
            order by l_shipdate desc nulls last, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                     l_discount, l_tax, l_returnflag, l_linestatus) rn from lineitem) ranked
    where rn = 1""")
def dedup_latest_row(t: Tables):
    return keep_latest(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate")


@query("dedup_hot_key", """
    select l_returnflag, l_orderkey, cast(l_linenumber as bigint) l_linenumber, l_partkey, l_extendedprice
    from (select *, row_number() over (
            partition by l_returnflag
            order by l_shipdate desc nulls last, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                     l_extendedprice, l_discount, l_tax, l_linestatus) rn from lineitem) ranked
    where rn = 1""")
def dedup_hot_key(t: Tables):
    """Three keys hold all rows."""
    return keep_latest(t.lineitem, ["l_returnflag"], ["l_shipdate"]).select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


_WITH_CREDIT = """
    select c.customer_id, c.last_name, c.branch_code, r.credit_score, r.risk_grade, r.external_overdue_amount
    from {customers} c left join {credit_bureau_reports} r on c.customer_id = r.customer_id"""
_WITH_CREDIT_SQL = _WITH_CREDIT.replace("{", "").replace("}", "")


@query("drop_null_keys", f"""
    select customer_id, last_name, branch_code, cast(credit_score as bigint) credit_score, risk_grade,
           cast(external_overdue_amount as double) external_overdue_amount
    from ({_WITH_CREDIT_SQL}) j where last_name is not null and credit_score is not null""")
def drop_null_keys(t: Tables):
    return require(t.sql(_WITH_CREDIT), ["last_name", "credit_score"])


@query("fill_defaults", f"""
    select customer_id, coalesce(last_name, 'UNKNOWN') last_name, branch_code,
           cast(coalesce(credit_score, 0) as bigint) credit_score, coalesce(risk_grade, 'UNKNOWN') risk_grade,
           cast(coalesce(external_overdue_amount, 0) as double) external_overdue_amount
    from ({_WITH_CREDIT_SQL}) j""")
def fill_defaults(t: Tables):
    return fill(t.sql(_WITH_CREDIT), {"last_name": "UNKNOWN", "credit_score": 0, "risk_grade": "UNKNOWN",
                                      "external_overdue_amount": "0.00"})


# Orders as untidy text: padded, lower case, two date formats, an unreadable amount.
_UNTIDY = """
    select concat(' ', o_orderkey, ' ') key_text, concat('  ', lower(o_orderstatus), ' ') status_text,
           case when o_orderstatus = 'P' then date_format(o_orderdate, 'M/d/yyyy')
                when o_orderpriority = '5-LOW' then 'not a date'
                else date_format(o_orderdate, 'yyyy-MM-dd') end date_text,
           case when o_orderpriority = '1-URGENT' then 'n/a' else cast(o_totalprice as string) end price_text
    from {orders}"""
_UNTIDY_RULES = [
    Rule("order_key", "bigint", trim=True, source="key_text"),
    Rule("status", "string", trim=True, upper=True, source="status_text"),
    Rule("order_date", "date", formats=("M/d/yyyy", "yyyy-MM-dd"), source="date_text"),
    Rule("price", "decimal(18,2)", source="price_text"),
    Rule("status", "string", source="key_text"),
]


@query("schema_cast_rules", """
    select o_orderkey order_key, upper(o_orderstatus) status,
           case when o_orderstatus = 'P' or o_orderpriority <> '5-LOW'
                then cast(cast(o_orderdate as date) as varchar) end order_date,
           case when o_orderpriority <> '1-URGENT' then o_totalprice end price
    from orders""")
def schema_cast_rules(t: Tables):
    return apply_rules(t.sql(_UNTIDY), _UNTIDY_RULES)


@query("unreadable_values", """
    select ' ' || o_orderkey || ' ' key_text,
           case when o_orderpriority = '1-URGENT' then 'price' else 'order_date' end lost
    from orders
    where o_orderpriority = '1-URGENT' or (o_orderpriority = '5-LOW' and o_orderstatus <> 'P')""")
def unreadable_values(t: Tables):
    return unreadable(t.sql(_UNTIDY), _UNTIDY_RULES[:4]).select(
        "key_text", F.array_join("_unreadable", ",").alias("lost"))


@query("messy_timestamp_parse", """
    select o_orderkey, case when o_orderpriority = '5-LOW' then null
             else strftime(o_orderdate + (o_orderkey % 1440) * interval '1' minute, '%Y-%m-%d %H:%M:%S')
           end discharged,
           cast(o_orderdate + (o_orderkey % 1440) * interval '1' minute + interval '123456' microsecond as varchar) admitted
    from orders""")
def messy_timestamp_parse(t: Tables):
    raw = t.sql("""
        select o_orderkey,
               case when o_orderpriority = '5-LOW' then 'pending'
                    else replace(date_format(ts, 'MMM d yyyy h:mma'), ' ', '   ') end discharge_text,
               concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '.1234567') admission_text
        from (select o_orderkey, o_orderpriority,
                     o_orderdate + (o_orderkey % 1440) * interval '1' minute ts from {orders})""")
    return raw.select(
        "o_orderkey",
        fn.parse_timestamp(F.col("discharge_text"), fx.DISCHARGE_FORMAT).alias("discharged"),
        fn.parse_timestamp(F.col("admission_text"), fx.ADMISSION_FORMAT).alias("admitted"),
    )


@query("truncated_timestamp_parse", """
    select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') admitted from orders""")
def truncated_timestamp_parse(t: Tables):
    """Only the first 19 characters of a padded text are read."""
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(".12"))
    return t.orders.select("o_orderkey", fn.truncated_timestamp(text).alias("admitted"))


@query("messy_birth_dates", """
    select c_custkey, case when c_mktsegment = 'BUILDING' then '1900-01-01'
             else cast(date '1930-01-01' + cast(c_custkey % 30000 as int) as varchar) end born
    from customer""")
def messy_birth_dates(t: Tables):
    raw = t.sql("""
        select c_custkey, case when c_mktsegment = 'BUILDING' then '1980-07-04 0:00'
                 else concat('  ', date_format(date '1930-01-01' + cast(c_custkey % 30000 as int), 'M/d/yyyy'),
                             ' 0:00') end dob
        from {customer}""")
    return raw.select("c_custkey", fn.birth_date(F.col("dob")).alias("born"))


@query("distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("bounded_slice", """
    select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') o_orderdate from orders
    where o_orderdate > timestamp '1997-01-01 00:00:00' and o_orderdate <= timestamp '1999-06-30 00:00:00'""")
def bounded_slice(t: Tables):
    return between(t.orders, "o_orderdate", "1997-01-01 00:00:00", "1999-06-30").select("o_orderkey", "o_orderdate")


@query("value_segments", """
    select o_orderkey, case when o_totalprice >= 500000 then 'HIGH_VALUE' when o_totalprice >= 100000
           then 'MEDIUM_VALUE' else 'LOW_VALUE' end segment from orders""")
def value_segments(t: Tables):
    return t.orders.select("o_orderkey", fn.value_segment(fn.money(F.col("o_totalprice"))).alias("segment"))
