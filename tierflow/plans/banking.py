"""Gold tables of the banking tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.functions.columns import count_if, value_segment
from tierflow.operators.dedup import keep_latest


def customer_activity(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Accounts, balances, transactions and amounts per customer.

    Transactions are summed per account before the join, so the join sees each account once
    however many transactions it has, and accounts are read and shuffled once for all four
    figures. Transactions of unknown accounts do not count. The transaction figures are NULL for a
    customer without any.
    """
    per_account = transactions.groupBy("account_id").agg(
        F.count("txn_id").alias("_txns"), F.sum("amount").alias("_amount")
    )
    return (
        accounts.join(per_account, "account_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("account_id").alias("total_accounts"),
            F.sum("balance").alias("total_balance"),
            F.sum("_txns").alias("total_transactions"),
            F.sum("_amount").alias("total_transaction_amount"),
        )
    )


def latest_credit(reports: DataFrame) -> DataFrame:
    """Newest bureau report per customer; the higher report id wins a tie."""
    return keep_latest(
        reports.select("customer_id", "bureau_pull_date", "report_id", "credit_score", "risk_grade",
                       "external_active_loans", "external_overdue_amount"),
        ["customer_id"], latest=["bureau_pull_date", "report_id"], tie_break=[],
    ).drop("bureau_pull_date", "report_id")


def customer_360(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, branches: DataFrame, reports: DataFrame
) -> DataFrame:
    """One row per customer. All three customer-keyed joins share one partitioning."""
    activity = customer_activity(accounts, transactions)
    zero = F.lit(0)
    return (
        customers.join(activity, "customer_id", "left")
        .join(latest_credit(reports), "customer_id", "left")
        .join(branches.select("branch_code", "branch_name"), "branch_code", "left")
        .select(
            "customer_id",
            F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
            "branch_name",
            F.coalesce("total_accounts", zero).alias("total_accounts"),
            F.coalesce("total_balance", zero).alias("total_balance"),
            F.coalesce("total_transactions", zero).alias("total_transactions"),
            F.coalesce("total_transaction_amount", zero).alias("total_transaction_amount"),
            "credit_score",
            "risk_grade",
            "external_active_loans",
            "external_overdue_amount",
            value_segment(F.col("total_balance")).alias("customer_segment"),
        )
    )


def branch_performance(
    branches: DataFrame, customers: DataFrame, accounts: DataFrame, transactions: DataFrame
) -> DataFrame:
    """One row per branch; sums stay NULL for a branch without customers or without activity.

    Customers are rolled up to branch codes before branch names are joined, so only one row per
    branch takes part in the last join.
    """
    activity = customer_activity(accounts, transactions)
    per_code = (
        customers.select("customer_id", "branch_code")
        .join(activity, "customer_id", "left")
        .groupBy("branch_code")
        .agg(
            F.count_distinct("customer_id").alias("total_customers"),
            F.sum("total_accounts").alias("total_accounts"),
            F.sum("total_balance").alias("total_deposits"),
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("total_transaction_amount").alias("total_transaction_amount"),
        )
    )
    return (
        branches.join(per_code, "branch_code", "left")
        .groupBy("branch_code", "branch_name")
        .agg(
            F.coalesce(F.max("total_customers"), F.lit(0)).alias("total_customers"),
            *[F.sum(c).alias(c) for c in
              ("total_accounts", "total_deposits", "total_transactions", "total_transaction_amount")],
        )
    )


def daily_bank_kpi(
    transactions: DataFrame, customers: DataFrame, accounts: DataFrame, reports: DataFrame
) -> DataFrame:
    """Transactions per day next to bank-wide figures, which are scalar subqueries: no join."""
    bank = (
        customers.agg(F.struct(F.count_distinct("customer_id").alias("total_customers"))).scalar(),
        accounts.agg(F.struct(
            F.count("account_id").alias("total_accounts"), F.sum("balance").alias("total_balance")
        )).scalar(),
        reports.agg(F.struct(
            F.avg("credit_score").alias("avg_credit_score"),
            count_if(F.col("risk_grade") == fx.HIGH_RISK_GRADE).alias("high_risk_customers"),
        )).scalar(),
    )
    daily = transactions.groupBy(F.to_date("txn_timestamp").alias("txn_date")).agg(
        F.count("txn_id").alias("total_transactions"), F.sum("amount").alias("total_transaction_amount")
    )
    return daily.select("*", *[b.alias(f"_{i}") for i, b in enumerate(bank)]).select(
        "txn_date", "_0.total_customers", "_1.total_accounts", "_1.total_balance",
        "total_transactions", "total_transaction_amount", "_2.avg_credit_score", "_2.high_risk_customers",
    )


def risk_customer_summary(reports: DataFrame) -> DataFrame:
    return reports.groupBy("risk_grade").agg(
        F.count("customer_id").alias("total_customers"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.sum("external_active_loans").alias("total_external_loans"),
        F.sum("external_overdue_amount").alias("total_overdue_amount"),
    )


def transaction_channel_summary(transactions: DataFrame, gateway_logs: DataFrame) -> DataFrame:
    """Outcome and speed per day, gateway and device of transactions that have a gateway log."""
    status = F.col("gateway_status")
    return (
        transactions.select("txn_id", F.to_date("txn_timestamp").alias("txn_date"))
        .join(gateway_logs, "txn_id")
        .groupBy("txn_date", "gateway_name", "device_type")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            count_if(status == fx.GATEWAY_SUCCESS).alias("successful_transactions"),
            count_if(status == fx.GATEWAY_FAILED).alias("failed_transactions"),
            F.avg("processing_time_ms").alias("avg_processing_time_ms"),
        )
    )
