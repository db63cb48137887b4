"""Dashboard queries on the banking gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import fixed_values as fx


def total_kpis(customer_360: DataFrame) -> DataFrame:
    """All headline figures in one pass."""
    return customer_360.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("total_balance").alias("total_deposits"),
        F.sum("total_transactions").alias("total_transactions"),
        F.count_if(F.col("risk_grade") == fx.HIGH_RISK_GRADE).alias("high_risk_customers"),
    )


def customers_by(customer_360: DataFrame, attribute: str) -> DataFrame:
    return customer_360.groupBy(attribute).agg(F.count(F.lit(1)).alias("customers"))


def top_customers(customer_360: DataFrame, count: int = fx.TOP_CUSTOMERS) -> DataFrame:
    """Largest balances; the lower customer id wins a tie."""
    return (
        customer_360.orderBy(F.desc_nulls_last("total_balance"), "customer_id")
        .limit(count)
        .select("customer_name", "branch_name", "total_balance")
    )


def branches_by(branch_performance: DataFrame, figure: str) -> DataFrame:
    return branch_performance.select("branch_name", figure).orderBy(F.desc_nulls_last(figure), "branch_name")


def gateway_outcomes(channel_summary: DataFrame, gateway: str | None = None) -> DataFrame:
    """Successes and failures per gateway, or of one selected gateway."""
    chosen = channel_summary if gateway is None else channel_summary.filter(F.col("gateway_name") == gateway)
    return chosen.groupBy("gateway_name").agg(
        F.sum("successful_transactions").alias("successful_transactions"),
        F.sum("failed_transactions").alias("failed_transactions"),
    )


def device_totals(channel_summary: DataFrame) -> DataFrame:
    return channel_summary.groupBy("device_type").agg(F.sum("total_transactions").alias("total_transactions"))


def field_totals(data: DataFrame, field: str, figure: str) -> DataFrame:
    """Sum of a figure by a field, as a chart aggregates the rows of its data set again."""
    return data.groupBy(field).agg(F.sum(figure).alias(figure))


def rows_matching(data: DataFrame, field: str, value: str) -> DataFrame:
    """Number of rows that match a filter choice, next to all rows."""
    return data.agg(
        F.count_if(F.col(field) == value).alias("matching"), F.count(F.lit(1)).alias("total")
    )
