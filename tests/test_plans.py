import decimal
from datetime import date, datetime

from pyspark.sql import functions as F

from tierflow.plans import banking, hospital, reports, star, trips
from tierflow.sinks.files import write_csv
from tierflow.sinks.snapshot import Snapshot
from tierflow.sources.files import landing_path

D = decimal.Decimal


def bank(spark):
    customers = spark.createDataFrame(
        [(1, "A", "One", "b1"), (2, "B", None, "b1"), (3, "C", "Three", None)],
        "customer_id int, first_name string, last_name string, branch_code string")
    accounts = spark.createDataFrame(
        [(10, 1, D("500000.00")), (11, 1, D("1.00")), (12, 2, D("100000.00")), (13, 9, D("5.00"))],
        "account_id int, customer_id int, balance decimal(18,2)")
    transactions = spark.createDataFrame(
        [(100, 10, D("1.50"), datetime(2024, 1, 1, 5)), (101, 10, D("2.50"), datetime(2024, 1, 1, 23)),
         (102, 77, D("9.00"), datetime(2024, 1, 2))],
        "txn_id int, account_id int, amount decimal(18,2), txn_timestamp timestamp")
    branches = spark.createDataFrame([("b1", "First"), ("b2", "Empty")], "branch_code string, branch_name string")
    reports_ = spark.createDataFrame(
        [(1, date(2024, 1, 1), 1, 700, "LOW", 1, D("0.00")), (1, date(2024, 2, 1), 2, 600, "HIGH", 2, D("3.00")),
         (1, date(2024, 2, 1), 3, 610, "HIGH", 2, D("4.00"))],
        "customer_id int, bureau_pull_date date, report_id int, credit_score int, risk_grade string, "
        "external_active_loans int, external_overdue_amount decimal(18,2)")
    return customers, accounts, transactions, branches, reports_


def test_customer_360(spark):
    customers, accounts, transactions, branches, credit = bank(spark)
    got = {r["customer_id"]: r for r in banking.customer_360(customers, accounts, transactions, branches, credit).collect()}
    assert len(got) == 3
    assert got[1]["customer_name"] == "A One" and got[2]["customer_name"] is None
    assert (got[1]["total_accounts"], got[1]["total_balance"], got[1]["total_transactions"]) == (2, D("500001.00"), 2)
    assert got[1]["total_transaction_amount"] == D("4.00") and got[1]["credit_score"] == 610
    assert [got[i]["customer_segment"] for i in (1, 2, 3)] == ["HIGH_VALUE", "MEDIUM_VALUE", "LOW_VALUE"]
    assert (got[2]["total_transactions"], got[3]["total_accounts"], got[3]["branch_name"]) == (0, 0, None)


def test_branch_sums_stay_null_without_activity(spark):
    customers, accounts, transactions, branches, _ = bank(spark)
    got = {r["branch_code"]: r for r in banking.branch_performance(branches, customers, accounts, transactions).collect()}
    assert (got["b1"]["total_customers"], got["b1"]["total_accounts"], got["b1"]["total_deposits"]) == (2, 3, D("600001.00"))
    assert (got["b2"]["total_customers"], got["b2"]["total_accounts"], got["b2"]["total_deposits"]) == (0, None, None)


def test_daily_kpis_have_no_join(spark):
    customers, accounts, transactions, _, credit = bank(spark)
    df = banking.daily_bank_kpi(transactions, customers, accounts, credit)
    rows = sorted(df.collect())
    assert [(r["txn_date"], r["total_transactions"]) for r in rows] == [(date(2024, 1, 1), 2), (date(2024, 1, 2), 1)]
    assert (rows[0]["total_customers"], rows[0]["total_accounts"], rows[0]["high_risk_customers"]) == (3, 4, 2)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_dashboard_top_and_filters(spark):
    customers, accounts, transactions, branches, credit = bank(spark)
    gold = banking.customer_360(customers, accounts, transactions, branches, credit)
    assert [r["total_balance"] for r in reports.top_customers(gold, 2).collect()] == [D("500001.00"), D("100000.00")]
    assert tuple(reports.total_kpis(gold).first()) == (3, D("600001.00"), 2, 1)
    assert tuple(reports.rows_matching(gold, "risk_grade", "HIGH").first()) == (1, 3)


def test_silver_jobs_skip_missing_input_and_keep_their_target(spark, scratch, rows):
    table, slot, now = hospital.DEPARTMENTS, "2026/06/19/18/44/", datetime(2026, 6, 19)
    path = landing_path(scratch, "Departments", slot, "Departments")
    raw = spark.createDataFrame([("1", "ER", "7", "x"), ("1", "ER", "7", "w"), ("1", "ER", "8", "x"), (None, "n", "7", "x")],
                                [*table.header])
    assert hospital.silver_job(spark, table, scratch, slot, f"{scratch}/silver", now) is None
    write_csv(raw, path)
    assert hospital.silver_job(spark, table, scratch, slot, f"{scratch}/silver", now) == 2
    write_csv(raw.limit(0), path)
    assert hospital.silver_job(spark, table, scratch, slot, f"{scratch}/silver", now) is None
    out = spark.read.parquet(f"{scratch}/silver/departments")
    assert rows(out.drop("silver_processed_at")) == [(1, "ER", 7, "w"), (1, "ER", 8, "x")]
    assert out.select("silver_processed_at").distinct().first()[0] == now


def test_providers_without_encounters_count_zero(spark, rows):
    physicians = spark.createDataFrame([(1, "x"), (2, "y")], "provider_id int, full_name string")
    encounters = spark.createDataFrame([(5, 1), (6, 1)], "encounter_id int, provider_id int")
    assert rows(hospital.physicians_directory(physicians, encounters)) == [(1, "x", 2), (2, "y", 0)]


def test_staged_fact_and_orphans(spark, rows):
    cols = "date_key string, account_key string, customer_key string, branch_key string, product_key string, " \
           "opening_balance string, debit_amount string, credit_amount string, closing_balance string, transaction_count string"
    good = ("20260101", "1", "1", "1", "1", "85200.5", "17700.46", "3797.49", "71297.53", "0")
    raw = spark.createDataFrame([
        good, good, ("20260101", "2", "9", "1", "1", "1", "0", "0", "1", "3"),
        ("20260101", "3", "1", "1", "1", "1", "0", "0", "1.01", "3"),
        ("20260101", None, "1", "1", "1", "1", "0", "0", "1", "3")], cols)
    staged = star.staged_fact(raw)
    assert staged.count() == 2 and "is_balance_valid" in staged.columns
    dims = {k: spark.createDataFrame([(1,), (2,)] if k == "account_key" else [(1,)], f"{k} bigint")
            for k in ("customer_key", "account_key", "branch_key", "product_key")}
    assert rows(star.gold_fact(staged, dims), "account_key", "customer_key") == [(1, 1), (2, -1)]


def test_dimensions_are_merged_again(spark, scratch, rows):
    table = Snapshot(spark, f"{scratch}/dim_branch", ["branch_key"])
    raw = spark.createDataFrame(
        [("1", " BR1 ", None, "c", "s", "x", "r", "4/1/2010", "Urban"), ("2", None, "n", "c", "s", "x", "r", "2010-04-01", "t")],
        "branch_key string, branch_code string, branch_name string, city string, state string, country string, "
        "region string, open_date string, branch_type string")
    star.load_dimension(raw, "dim_branch", table)
    star.load_dimension(raw.withColumn("city", F.lit("moved")), "dim_branch", table)
    assert rows(table.read(), "branch_key", "branch_code", "branch_name", "city", "open_date") == [
        (1, "BR1", "UNKNOWN BRANCH", "moved", date(2010, 4, 1))]


def test_rolling_window_opens_only_recent_folders(spark, scratch):
    days = spark.range(0, 400).select(
        (F.lit("2025-01-01").cast("timestamp") + F.make_interval(days=F.col("id").cast("int"))).alias("tpep_pickup_datetime"))
    table = trips.load_trips(spark, days, f"{scratch}/trips")
    assert trips.newest_month(spark, f"{scratch}/trips") == 202602 and trips.newest_month(spark, f"{scratch}/none") is None
    window = trips.rolling_window(table, newest=202602)
    got = window.agg(F.count("*"), F.min("tpep_pickup_datetime"), F.max("cutoff_date")).first()
    assert tuple(got) == (63, datetime(2025, 12, 4), datetime(2025, 12, 4))  # newest is 2026-02-04
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_year" in plan
    files = window.select(F.input_file_name()).distinct().collect()
    assert all("pickup_month=12" in f[0] or "pickup_year=2026" in f[0] for f in files)
    # every scan, those of the subqueries included, is filtered by partition
    whole = window._jdf.queryExecution().executedPlan().toString()
    assert whole.count("FileScan parquet") == whole.count("PartitionFilters: [isnotnull(pickup_year") + whole.count("PartitionFilters: [(((pickup_year")
    assert {r[0] for r in window.select("pickup_month_name").distinct().collect()} == {"December", "January", "February"}


def test_yearly_trip_load_and_landing_files(spark, scratch):
    df = spark.sql("select timestamp '2025-12-31 23:59:59' tpep_pickup_datetime, 1 x union all "
                   "select timestamp '2026-01-01 00:00:00', 2")
    table = trips.load_trips(spark, df, f"{scratch}/t", 2026)
    assert [(r["x"], r["pickup_year"], r["pickup_month"]) for r in table.collect()] == [(2, 2026, 1)]
    assert trips.month_files("/landing/", "yellow", 2026, [1, 2]) == [
        "/landing/yellow_tripdata_2026-01.parquet", "/landing/yellow_tripdata_2026-02.parquet"]
