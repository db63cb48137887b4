"""Star schema of the financial tier: cleaned dimensions, a checked fact, orphan keys, measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.operators.cleanse import EXACT, EntityRules, Rule, apply_rules, check_balance, clean_entity, keep_valid
from tierflow.operators.dedup import keep_latest
from tierflow.operators.lookup import keep_or_default
from tierflow.sinks.snapshot import Snapshot

ISO = ("yyyy-MM-dd",)
US_OR_ISO = ("M/d/yyyy", "yyyy-MM-dd")


def _key(name: str) -> Rule:
    return Rule(name, "int")


def _word(name: str, upper: bool = False) -> Rule:
    return Rule(name, "string", trim=True, upper=upper)


# Columns, types, formats, required columns and defaults of the four dimensions.
DIMENSIONS: dict[str, EntityRules] = {
    "dim_customer": EntityRules(
        key="customer_key",
        rules=(
            _key("customer_key"), _word("customer_id"), _word("full_name"), _word("gender"),
            Rule("date_of_birth", "date", formats=ISO), _word("city"), _word("state"),
            _word("customer_segment"), _word("kyc_status", upper=True),
            Rule("onboard_date", "date", formats=ISO),
        ),
        required=("customer_id", "full_name"),
        defaults={"kyc_status": "UNKNOWN", "customer_segment": "UNKNOWN"},
    ),
    "dim_product": EntityRules(
        key="product_key",
        rules=(
            _key("product_key"), _word("product_code"), _word("product_name"), _word("product_category"),
            Rule("interest_rate_percent", "decimal(5,2)"), Rule("fee_percent", "decimal(5,2)"),
            _word("is_active"),
        ),
        required=("product_key", "product_code"),
        defaults={"product_name": "UNKNOWN PRODUCT", "product_category": "STANDARD",
                  "interest_rate_percent": "0.00", "fee_percent": "0.00", "is_active": "U"},
    ),
    "dim_branch": EntityRules(
        key="branch_key",
        rules=(
            _key("branch_key"), _word("branch_code"), _word("branch_name"), _word("city"), _word("state"),
            _word("country"), _word("region"), Rule("open_date", "date", formats=US_OR_ISO),
            _word("branch_type"),
        ),
        required=("branch_key", "branch_code"),
        defaults={"branch_name": "UNKNOWN BRANCH", "city": "UNKNOWN", "state": "UNKNOWN",
                  "country": "UNKNOWN", "region": "UNKNOWN", "branch_type": "STANDARD"},
    ),
    "dim_account": EntityRules(
        key="account_key",
        rules=(
            _key("account_key"), _word("account_number"), _key("customer_key"), _key("branch_key"),
            _key("product_key"), Rule("account_open_date", "date", formats=ISO), _word("account_status"),
            _word("currency"), Rule("current_balance", "decimal(9,2)"),
        ),
        required=("account_number", "customer_key", "branch_key", "product_key"),
        defaults={"account_status": "UNKNOWN", "currency": "INR", "current_balance": "0.00"},
    ),
}

FACT_RULES = tuple(
    [Rule(k, "bigint") for k in fx.FACT_KEYS]
    + [Rule(a, EXACT) for a in fx.FACT_AMOUNTS]
    + [Rule("transaction_count", "bigint")]
)


def load_dimension(raw: DataFrame, name: str, table: Snapshot, run_id: object = None) -> dict:
    """Clean one dimension and merge it into its table."""
    return table.upsert(clean_entity(raw, DIMENSIONS[name]), run_id)


def staged_fact(raw: DataFrame) -> DataFrame:
    """Typed daily balances: keys present, balance adds up, one row per key. Keeps the check flag.

    Amounts are compared as given and take their two places afterwards.
    """
    flag = "is_balance_valid"
    valid = keep_valid(check_balance(apply_rules(raw, FACT_RULES), flag), fx.FACT_KEYS, flag)
    shaped = valid.withColumns({a: F.col(a).try_cast("decimal(18,2)") for a in fx.FACT_AMOUNTS})
    return keep_latest(shaped, fx.FACT_KEYS)


def gold_fact(staged: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Balances whose unknown dimension keys became the orphan key."""
    known = keep_or_default(staged, dimensions, F.lit(fx.ORPHAN_KEY))
    return known.select(
        "date_key", "branch_key", "product_key", "customer_key", "account_key", *fx.FACT_AMOUNTS,
        "transaction_count",
    )


# --- reports ------------------------------------------------------------------------------

def accounts_per(fact: DataFrame, key: str, dimension: DataFrame, attributes: list[str]) -> DataFrame:
    """Distinct accounts in the fact per attribute of one dimension.

    (key, account) pairs are made distinct first, with map-side aggregation, so the join with the
    dimension sees each pair once.
    """
    pairs = fact.select(key, "account_key").distinct()
    return (
        pairs.join(dimension.select(key, *attributes), key, "left")
        .groupBy(*attributes)
        .agg(F.count_distinct("account_key").alias("accounts"))
    )


def customers_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment").agg(F.count_distinct("customer_key").alias("customers"))


def measures(fact: DataFrame, accounts: DataFrame) -> DataFrame:
    """Distinct account numbers and their current balances, over accounts that occur in the fact."""
    used = accounts.join(fact.select("account_key").distinct(), "account_key", "left_semi")
    return used.agg(
        F.count_distinct("account_number").alias("distinct_accounts"),
        F.sum("current_balance").alias("total_balance"),
    )


def top_balances_by_gender(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts and the highest account balance per gender."""
    per_customer = accounts.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("_accounts"), F.max("current_balance").alias("_top")
    )
    return (
        customers.select("customer_key", "gender").join(per_customer, "customer_key", "left")
        .groupBy("gender")
        .agg(F.coalesce(F.sum("_accounts"), F.lit(0)).alias("accounts"), F.max("_top").alias("top_balance"))
    )
