"""One key holds a third of all rows: joins split it, groupings shrink it before the shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from tierflow.operators.lookup import keep_or_default, with_group_count
from tierflow.plans import banking, hospital, star
from tierflow.session import scratch_dir

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",  # a split needs several map outputs
}


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, rows=60000):
    return spark.range(rows).repartition(8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("bigint").alias("key"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_fact_key_is_split(spark, small_limits):
    fact = hot(spark)
    dim = spark.range(500).repartition(4).withColumnRenamed("id", "key")
    df = keep_or_default(fact, {"key": dim}, F.lit(-1), sent_keys=0)
    hot_dim = dim.where("key <> 7")  # the hot key is unknown
    for known, out in ((dim, df), (hot_dim, keep_or_default(fact, {"key": hot_dim}, F.lit(-1), sent_keys=0))):
        assert out.count() == 60000
        assert out.filter("key = -1").count() == fact.join(known, "key", "left_anti").count()
    assert "skew=true" in final_plan(df)


def test_facts_stay_where_they_are_read(spark, small_limits):
    """Four dimensions and no automatic broadcast: rows of the fact pass no exchange."""
    fact = hot(spark).select("id", *[(F.col("key") + i).alias(f"k{i}") for i in range(4)])
    dims = {f"k{i}": spark.range(10, 500).repartition(4).withColumnRenamed("id", f"k{i}") for i in range(4)}
    path = scratch_dir(spark, "narrow")
    fact.write.parquet(path)
    df = keep_or_default(spark.read.parquet(path), dims, F.lit(-1))
    plan = final_plan(df)
    assert plan.count("BroadcastExchange") and not re.search(r"\bExchange (hash|range|RoundRobin|Single)", plan)
    for k in dims:
        assert df.filter(f"{k} = -1").count() == spark.read.parquet(path).filter(f"{k} < 10 or {k} >= 500").count()


def test_a_hot_group_count_is_split(spark, small_limits):
    df = with_group_count(hot(spark), "key", "n")
    assert "skew=true" in final_plan(df)
    assert df.filter("key = 7").select("n").distinct().first()[0] == hot(spark).filter("key = 7").count()


def test_a_hot_transaction_key_is_split(spark, small_limits):
    logs = hot(spark).select(
        F.col("key").alias("txn_id"), F.lit("g").alias("gateway_name"), F.lit("d").alias("device_type"),
        F.lit("SUCCESS").alias("gateway_status"), F.lit(1).alias("processing_time_ms"))
    transactions = spark.range(1000).repartition(4).select(
        F.col("id").alias("txn_id"), F.lit("2024-01-01").cast("timestamp").alias("txn_timestamp"))
    df = banking.transaction_channel_summary(transactions, logs)
    assert "skew=true" in final_plan(df)
    assert df.first()["successful_transactions"] == 60000


def test_hot_accounts_and_providers_are_summed_before_the_shuffle(spark, small_limits):
    rows = hot(spark)
    transactions = rows.select(F.col("id").alias("txn_id"), F.col("key").alias("account_id"),
                               F.lit(1).cast("decimal(18,2)").alias("amount"))
    accounts = spark.range(1000).select(F.col("id").alias("account_id"), (F.col("id") % 2).alias("customer_id"),
                                        F.lit(1).cast("decimal(18,2)").alias("balance"))
    got = {r["customer_id"]: r["total_transactions"] for r in banking.customer_activity(accounts, transactions).collect()}
    assert sum(got.values()) == 60000
    physicians = spark.range(1000).select(F.col("id").alias("provider_id"), F.lit("x").alias("full_name"))
    encounters = rows.select(F.col("id").alias("encounter_id"), F.col("key").alias("provider_id"))
    plan = hospital.physicians_directory(physicians, encounters)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count(")


def test_hot_dimension_keys_of_accounts_are_split(spark, small_limits):
    fact = hot(spark).select("key", F.col("id").alias("account_key"))
    dim = spark.range(1000).repartition(4).select(F.col("id").alias("key"), (F.col("id") % 5).alias("city"))
    df = star.accounts_per(fact, "key", dim, ["city"])
    assert "skew=true" in final_plan(df)
    assert sum(r["accounts"] for r in df.collect()) == 60000
