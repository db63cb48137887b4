"""Whole runs from source tables to gold, over the complete test tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.catalog.registry import ORACLES, Tables, query
from tierflow.catalog.star import dimension
from tierflow.catalog.hospital import RAW as HOSPITAL_RAW
from tierflow import fixed_values as fx
from tierflow.control import loads, registry
from tierflow.control.audit import run_report, run_status
from tierflow.operators.cleanse import Rule
from tierflow.plans import hospital, star
from tierflow.plans.banking_run import BankingRun
from tierflow.plans.hospital_run import CONTROL, HospitalRun
from tierflow.sinks.files import write_csv, write_parquet
from tierflow.sinks.snapshot import Snapshot
from tierflow.sources.files import landing_path, read_csv, text_schema

# --- banking: two runs, the second one after the sources have grown -------------------------

FILE_RULES = {
    "credit_bureau_reports": (
        Rule("customer_id", "bigint"), Rule("bureau_pull_date", "timestamp_ntz"), Rule("report_id", "bigint"),
        Rule("credit_score", "int"), Rule("risk_grade", "string"), Rule("external_active_loans", "int"),
        Rule("external_overdue_amount", "decimal(18,2)"),
    ),
    "payment_gateway_logs": (
        Rule("txn_id", "bigint"), Rule("gateway_name", "string"), Rule("device_type", "string"),
        Rule("gateway_status", "string"), Rule("processing_time_ms", "int"),
        Rule("processed_timestamp", "timestamp_ntz"),
    ),
}
_DATABASE = {
    "customers": "select *, timestamp_ntz '2001-01-01 00:00:00' updated_at from {customers}",
    "accounts": "select *, opened_ts updated_at from {accounts}",
    "transactions": "select * from {transactions}",
    "branches": "select * from {branches}",
}
_FILES = {
    "credit_bureau_reports": "select * from {credit_bureau_reports}",
    "payment_gateway_logs": """
        select l.txn_id, l.gateway_name, l.device_type, l.gateway_status, l.processing_time_ms,
               e.ts processed_timestamp from {payment_gateway_logs} l join {events} e on l.txn_id = e.event_id""",
}
_GROWS_BY = {"accounts": "updated_at", "transactions": "txn_timestamp"}
# What arrives first does not follow the watermark: the second delivery holds older rows too.
_FIRST_FILES = {"credit_bureau_reports": "report_id % 3 <> 1", "payment_gateway_logs": "txn_id % 2 = 0"}


def banking_run(t: Tables, unreachable: str | None = None) -> BankingRun:
    """The database is played by views; the pushed subquery runs on them as it would there. A table that is
    ``unreachable`` fails in the second run."""
    spark, root = t.spark, t.scratch
    tables = registry.seed_registry(spark, f"{root}/landing")
    run = None
    for run_id, until in ((1, "1999-01-01"), (2, "9999-12-31")):
        views = {}
        for name, text in _DATABASE.items():
            df = t.sql(text)
            if name in _GROWS_BY:
                df = df.filter(f"{_GROWS_BY[name]} <= timestamp_ntz '{until} 00:00:00'")
            views[name] = df
        for name, text in _FILES.items():
            arrived = _FIRST_FILES[name] if run_id == 1 else f"not ({_FIRST_FILES[name]})"
            t.sql(text).filter(arrived).write.mode("append").csv(f"{root}/landing/{name}", header=True)

        def read_query(subquery: str, views=views, run_id=run_id):
            source = subquery.split(" FROM banking.")[1].split(" ")[0].rstrip(")")
            if run_id == 2 and source == unreachable:
                raise ConnectionError(f"no answer from {source}")
            return spark.sql(f"SELECT * FROM {subquery.replace('banking.' + source, '{source}')}",
                             source=views[source])

        def read_ranges(subquery: str, predicates: list[str], read_query=read_query):
            return reduce(DataFrame.union, [read_query(subquery).where(p) for p in predicates])

        run = BankingRun(spark, root, run_id, datetime(2024, 1, run_id), read_query, FILE_RULES, quote="`", buckets=4,
                         split_by={"transactions": "txn_id"}, connections=4, read_ranges=read_ranges,
                         quantile="approx_percentile({key}, {share}D, 10000)")
        run.run(tables, registry.seed_parameters(spark))
    return run



@query("run_banking_customer_360", "select * from x_customer_360")
def run_banking_customer_360(t: Tables):
    return banking_run(t).gold("customer_360")


@query("run_banking_status", """
    select run_id, 11 total_tables, 0 failed_tables, 'SUCCESS' overall_status
    from (values (1), (2)) runs(run_id) where (select count(*) from events) > 0""")
def run_banking_status(t: Tables):
    return run_status(banking_run(t).audit.read())


@query("run_banking_failed", """
    select run_id, if(run_id = 1, 11, 6) total_tables, if(run_id = 1, 0, 1) failed_tables,
           if(run_id = 1, 'SUCCESS', 'FAILED') overall_status, case run_id when 2 then 'branches: no answer from branches' end failure,
           (select count(*) from nation) gold_branches
    from (values (1), (2)) runs(run_id)""")
def run_banking_failed(t: Tables):
    """A source that does not answer: the other tables load, gold stays that of the run before, the run counts as failed."""
    run = banking_run(t, unreachable="branches")
    audit = run.audit.read()
    failed = run_report(audit, registry.seed_registry(t.spark, t.scratch)).where("status = 'FAILED'").select(
        "run_id", F.concat_ws(": ", "table_name", "error_message").alias("failure"))
    branches = run.gold("branch_performance").count()
    return run_status(audit).join(failed, "run_id", "left").withColumn("gold_branches", F.lit(branches))


# --- hospital: bounded extract, dated CSV, silver, gold, insight ----------------------------

@query("run_hospital_longest_stay", """
    select e.patient_id, p.patient_name, e.actual_stay_days
    from (select *, row_number() over (partition by encounter_id order by admission_datetime desc nulls last,
            patient_id, provider_id, discharge_datetime asc nulls last) rn from x_encounters_summary) e
    join patients p on e.patient_id = p.patient_id and p.ethnicity <> 'MACHINERY'
    where rn = 1
    order by e.actual_stay_days desc nulls last, e.patient_id limit 1""")
def run_hospital_longest_stay(t: Tables):
    slot, now = "2026/06/19/18/44", datetime(2026, 6, 19, 18, 50)
    sources = {name: t.sql(HOSPITAL_RAW[name]) for name in ("encounters", "patients")}
    controls = [("encounters", "Patient Admission Datetime", "1900-01-01"), ("patients", "Patient Name", "")]
    loads.bounded_extracts(sources, controls, lambda name, rows: write_csv(rows, landing_path(
        t.scratch, hospital.SILVER[name].folder, slot, hospital.SILVER[name].folder)))
    silver = f"{t.scratch}/silver"
    for name in sources:
        hospital.silver_job(t.spark, hospital.SILVER[name], t.scratch, slot, silver, now)
    encounters, patients = (t.spark.read.parquet(f"{silver}/{name}") for name in sources)
    return hospital.longest_stay(hospital.encounters_summary(encounters), patients)


# Two runs over a growing source: what lies after the cut arrives for the second one.
_CUTS = {"Hospitals": "`Hospital ID` <= {half}", "Physicians": "`Provider ID` <= {half}", "Patients": "`Master Patient ID` < '5'",
         "Departments": "`Department ID` <= {half}", "Encounters": "`Patient Admission Datetime` < '1996-01-02'"}
_CONTROL = [("dbo", "Hospitals", "Hospital ID", "-1"), ("dbo", "Physicians", "Provider ID", "-1"), ("dbo", "Patients", "Master Patient ID", ""),
            ("dbo", "Departments", "Department ID", "-1"), ("dbo", "Encounters", "Patient Admission Datetime", "1900-01-01")]


def hospital_sources(t: Tables) -> dict[str, DataFrame]:
    """The source tables. Encounters are a join, written once as the table a database has: each run extracts from it
    again, after a look for new rows."""
    sources = {name: t.sql(HOSPITAL_RAW[name.lower()]) for name in _CUTS}
    joined, path = sources["Encounters"], f"{t.scratch}/sources/Encounters"
    write_parquet(joined, path)
    return sources | {"Encounters": t.spark.read.schema(joined.schema).parquet(path)}


def hospital_run(t: Tables) -> tuple[HospitalRun, DataFrame]:
    half = t.supplier.agg(F.floor(F.max("s_suppkey") / 2)).first()[0]
    sources = hospital_sources(t)
    control = t.spark.createDataFrame([(s, name, name, column, last) for s, name, column, last in _CONTROL], CONTROL)
    for now, grown in ((datetime(2026, 6, 19, 18, 50), False), (datetime(2026, 6, 20, 18, 50), True)):
        seen = sources if grown else {n: df.filter(_CUTS[n].format(half=half)) for n, df in sources.items()}
        run = HospitalRun(t.spark, t.scratch, now, buckets=4)
        control = run.run(seen, control)
    return run, control


def _published(t: Tables, name: str, *columns: str) -> DataFrame:
    run, _ = hospital_run(t)
    return run.gold(name).read().select(*columns, F.to_date("gold_processed_at").alias("published"))


_HALF = "(select floor(max(s_suppkey) / 2) from supplier)"
_DAY = "case when {0} then '2026-06-19' else '2026-06-20' end"


@query("run_hospital_watermarks", """
    select 'Hospitals' source_table, cast(max(s_suppkey) as varchar) last_load_value from supplier
    union all select 'Physicians', cast(max(s_suppkey) as varchar) from supplier
    union all select 'Patients', max(case when c_mktsegment = 'MACHINERY' then 'X' || c_custkey else cast(c_custkey as varchar) end) from customer
    union all select 'Departments', cast(max(p_partkey) as varchar) from part
    union all select 'Encounters', max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) || '.1234567' from lineitem join orders on l_orderkey = o_orderkey""")
def run_hospital_watermarks(t: Tables):
    return hospital_run(t)[1].select("source_table", "last_load_value")


@query("run_hospital_gold_hospitals", f"""
    select s_suppkey hospital_id, count(*) over (partition by s_nationkey, s_suppkey <= {_HALF}) zipcode_hospitals_total,
           {_DAY.format("s_suppkey <= " + _HALF)} published from supplier""")
def run_hospital_gold_hospitals(t: Tables):
    return _published(t, "hospitals_directory", "hospital_id", "zipcode_hospitals_total")


@query("run_hospital_gold_departments", f"""
    select p_partkey department_id, cast(p_size as bigint) hospital_id, true is_active_clinical_unit,
           {_DAY.format("p_partkey <= " + _HALF)} published from part""")
def run_hospital_gold_departments(t: Tables):
    return _published(t, "departments_directory", "department_id", "hospital_id", "is_active_clinical_unit")


@query("run_hospital_gold_patients", f"""
    select patient_id, case when date_of_birth <> '1900-01-01' then 2026 - cast(date_of_birth[1:4] as int) end current_age,
           {_DAY.format("cast(patient_id as varchar) < '5'")} published
    from ({ORACLES["silver_patients"]}) p""")
def run_hospital_gold_patients(t: Tables):
    return _published(t, "patients_demographics", "patient_id", "current_age")


@query("run_hospital_gold_physicians", f"""
    select s_suppkey provider_id, count(encounter_id) provider_encounters_total, {_DAY.format("s_suppkey <= " + _HALF)} published
    from supplier left join ({ORACLES["silver_encounters"]}) e
      on provider_id = s_suppkey and (admission_datetime < '1996-01-02') = (s_suppkey <= {_HALF})
    group by s_suppkey""")
def run_hospital_gold_physicians(t: Tables):
    return _published(t, "physicians_directory", "provider_id", "provider_encounters_total")


@query("run_hospital_gold_encounters", f"""
    select encounter_id, patient_id, provider_id, '2026-06-20' published
    from ({ORACLES["silver_encounters"]}) e where admission_datetime >= '1996-01-02'""")
def run_hospital_gold_encounters(t: Tables):
    return _published(t, "encounters_summary", "encounter_id", "patient_id", "provider_id")


_IDS = "count(distinct l_orderkey * 100 + l_linenumber)"


@query("run_hospital_refused", f"""
    select 'departments' table_name, 2 runs, count(*) rows_read, 0 no_key, 0 unreadable_key, 0 repeated,
           count(*) written, true adds_up from part
    union all select 'hospitals', 2, count(*), 0, 0, 0, count(*), true from supplier
    union all select 'physicians', 2, count(*), 0, 0, 0, count(*), true from supplier
    union all select 'patients', 2, count(*), 0, count(*) filter (c_mktsegment = 'MACHINERY'), 0,
                     count(*) filter (c_mktsegment <> 'MACHINERY'), true from customer
    union all select 'encounters', 2, count(*), 0, 0, count(*) - {_IDS}, {_IDS}, true from lineitem join orders on l_orderkey = o_orderkey""")
def run_hospital_refused(t: Tables):
    """What both runs read is what they wrote, refused by reason, or had as repeated keys."""
    run, _ = hospital_run(t)
    sums = [F.sum(c).alias("rows_read" if c == "read" else c) for c in ("read", "no_key", "unreadable_key", "repeated", "written")]
    return run.outcomes.read().groupBy("table_name").agg(F.count(F.lit(1)).alias("runs"), *sums).withColumn(
        "adds_up", F.col("rows_read") == F.col("no_key") + F.col("unreadable_key") + F.col("repeated") + F.col("written"))


_SEEDED = {  # rows as the published start values find them: some before, some after
    "Hospitals": "select 9900000 + s_suppkey `Hospital ID`, s_name name from {supplier}",
    "Physicians": "select 9991 + s_suppkey `Provider ID`, s_name name from {supplier}",
    "Patients": "select 107300 + c_custkey `Master Patient ID`, c_name name from {customer}",
    "Departments": "select p_partkey DepartmentKey, p_name name from {part}",
    "Encounters": "select o_orderdate + interval '24' year `Patient Admission Datetime`, o_orderkey name from {orders}",
}


@query("run_hospital_seeded", """
    select 'Hospitals' source_table, count(*) landed, cast(max(9900000 + s_suppkey) as varchar) last_load_value
      from supplier where 9900000 + s_suppkey > 9900006
    union all select 'Physicians', count(*), cast(max(9991 + s_suppkey) as varchar) from supplier where 9991 + s_suppkey > 9999
    union all select 'Patients', count(*), cast(max(107300 + c_custkey) as varchar) from customer where 107300 + c_custkey > 107386
    union all select 'Departments', count(*), cast(max(p_partkey) as varchar) from part where p_partkey > 64
    union all select 'Encounters', count(*), strftime(max(o_orderdate + interval 24 year), '%Y-%m-%d %H:%M:%S') from orders
      where o_orderdate + interval 24 year > timestamp '2021-07-02 14:46:00'""")
def run_hospital_seeded(t: Tables):
    """The extract of the control rows with their published start values, and where it leaves them."""
    sources = {name: t.sql(sql) for name, sql in _SEEDED.items()}
    control = t.spark.createDataFrame(
        [(schema, table, folder, column, last) for schema, table, folder, column, last in fx.HOSPITAL_WATERMARKS], CONTROL)
    run = HospitalRun(t.spark, t.scratch, datetime(2026, 6, 19, 18, 50))
    moved = run.extract(sources, control)
    landed = None
    for name, df in sources.items():
        rows = read_csv(t.spark, f"{t.scratch}/landing/{name}", text_schema(df.columns), recursive=True)
        counted = rows.agg(F.lit(name).alias("source_table"), F.count(F.lit(1)).alias("landed"))
        landed = counted if landed is None else landed.union(counted)
    return landed.join(moved.select("source_table", "last_load_value"), "source_table")


# --- star: dimensions and fact from CSV to the published fact -------------------------------

@query("run_star_fact", """
    select f.date_key, case when f.branch_key in (select s_suppkey from supplier) then f.branch_key else -1 end
             ::bigint branch_key,
           case when f.product_key in (select p_partkey from part) then f.product_key else -1 end::bigint product_key,
           case when f.customer_key in (select c_custkey from customer where c_mktsegment <> 'FURNITURE')
                then f.customer_key else -1 end customer_key,
           case when f.account_key in (select o_orderkey from orders where o_orderpriority <> '5-LOW')
                then f.account_key else -1 end account_key,
           cast(opening_balance as double) opening_balance, cast(debit_amount as double) debit_amount,
           cast(credit_amount as double) credit_amount, cast(closing_balance as double) closing_balance,
           cast(transaction_count as bigint) transaction_count
    from x_staged_fact f""")
def run_star_fact(t: Tables):
    names = {"customer_key": "dim_customer", "account_key": "dim_account", "branch_key": "dim_branch",
             "product_key": "dim_product"}
    dimensions = {key: dimension(t, name) for key, name in names.items()}
    write_csv(t.balance_rows, f"{t.scratch}/fact.csv")
    raw = read_csv(t.spark, f"{t.scratch}/fact.csv", text_schema([r.target for r in star.FACT_RULES]))
    staging = Snapshot(t.spark, f"{t.scratch}/stg_balance")
    staging.overwrite(star.staged_fact(raw))
    fact = Snapshot(t.spark, f"{t.scratch}/gold_balance")
    fact.overwrite(star.gold_fact(staging.read(), dimensions))
    return fact.read()
