"""Star dimensions from untidy CSV, the checked fact, orphan keys and the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog.registry import Tables, query
from tierflow.operators.cleanse import clean_entity, rejected
from tierflow.plans import star
from tierflow.sinks.files import write_csv
from tierflow.sinks.snapshot import Snapshot
from tierflow.sources.files import read_csv, text_schema

# Untidy text of each dimension. Customers come twice, with a differing state.
RAW = {
    "dim_customer": """
        select c_custkey customer_key, concat('  CUST', c_custkey, ' ') customer_id,
               case when c_mktsegment = 'FURNITURE' then null else concat(' ', c_name) end full_name,
               case when c_nationkey < 12 then ' F' else 'M ' end gender,
               date_format(date '1950-01-01' + cast(c_custkey % 20000 as int), 'yyyy-MM-dd') date_of_birth,
               n_name city, state, case when c_mktsegment = 'BUILDING' then null else c_mktsegment end
                 customer_segment,
               case when c_nationkey = 5 then null else ' verified ' end kyc_status, 'soon' onboard_date
        from {customer} join {nation} on c_nationkey = n_nationkey
             join (select r_regionkey, explode(array(r_name, 'ZZZ')) state from {region}) on n_regionkey = r_regionkey""",
    "dim_product": """
        select p_partkey product_key, concat('P', p_partkey, ' ') product_code,
               case when p_size > 45 then null else p_name end product_name, concat(' ', p_type) product_category,
               cast(p_size / 10 as string) interest_rate_percent,
               case when p_brand = 'Brand#1' then null else '0.25' end fee_percent,
               case when p_size < 5 then null else 'Y' end is_active
        from {part}""",
    "dim_branch": """
        select s_suppkey branch_key, concat('BR', s_suppkey) branch_code, concat(s_name, '  ') branch_name,
               n_name city, case when s_nationkey = 2 then null else n_name end state,
               cast(null as string) country, 'South' region,
               case when s_nationkey % 2 = 0 then date_format(date '2010-03-04' + cast(s_suppkey as int), 'M/d/yyyy')
                    else date_format(date '2010-03-04' + cast(s_suppkey as int), 'yyyy-MM-dd') end open_date,
               case when s_acctbal < 0 then null else 'Urban' end branch_type
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "dim_account": """
        select o_orderkey account_key, concat('AC', o_orderkey) account_number, o_custkey customer_key,
               case when o_orderpriority = '5-LOW' then null else cast(o_custkey % 25 as string) end branch_key,
               o_custkey % 200 product_key, date_format(o_orderdate, 'yyyy-MM-dd') account_open_date,
               case when o_orderstatus = 'O' then null else o_orderstatus end account_status,
               case when o_orderstatus = 'F' then null else 'USD' end currency,
               case when o_orderpriority = '1-URGENT' then null else cast(o_totalprice as string) end current_balance
        from {orders}""",
}
BUCKETS = {"dim_customer": 8, "dim_product": 8, "dim_branch": 1, "dim_account": 8}


def dimension(t: Tables, name: str):
    """Land as CSV, read as text, clean, merge, read the table."""
    entity = star.DIMENSIONS[name]
    path = f"{t.scratch}/{name}.csv"
    write_csv(t.sql(RAW[name]), path, quote_all=False)
    raw = read_csv(t.spark, path, text_schema([r.target for r in entity.rules]))
    table = Snapshot(t.spark, f"{t.scratch}/{name}", [entity.key], BUCKETS[name])
    star.load_dimension(raw, name, table)
    return table.read()


@query("star_dim_customer", """
    select c_custkey customer_key, 'CUST' || c_custkey customer_id, c_name full_name,
           case when c_nationkey < 12 then 'F' else 'M' end gender,
           cast(date '1950-01-01' + cast(c_custkey % 20000 as int) as varchar) date_of_birth, n_name city,
           r_name state, case when c_mktsegment = 'BUILDING' then 'UNKNOWN' else c_mktsegment end customer_segment,
           case when c_nationkey = 5 then 'UNKNOWN' else 'VERIFIED' end kyc_status,
           cast(null as varchar) onboard_date
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    where c_mktsegment <> 'FURNITURE'""")
def star_dim_customer(t: Tables):
    return dimension(t, "dim_customer")


@query("star_dim_product", """
    select p_partkey product_key, 'P' || p_partkey product_code,
           case when p_size > 45 then 'UNKNOWN PRODUCT' else p_name end product_name, p_type product_category,
           cast(cast(p_size / 10 as decimal(5,2)) as double) interest_rate_percent,
           case when p_brand = 'Brand#1' then 0.0 else 0.25 end::double fee_percent,
           case when p_size < 5 then 'U' else 'Y' end is_active
    from part""")
def star_dim_product(t: Tables):
    return dimension(t, "dim_product")


@query("star_dim_branch", """
    select s_suppkey branch_key, 'BR' || s_suppkey branch_code, s_name branch_name, n_name city,
           case when s_nationkey = 2 then 'UNKNOWN' else n_name end state, 'UNKNOWN' country, 'South' region,
           cast(date '2010-03-04' + cast(s_suppkey as int) as varchar) open_date,
           case when s_acctbal < 0 then 'STANDARD' else 'Urban' end branch_type
    from supplier join nation on s_nationkey = n_nationkey""")
def star_dim_branch(t: Tables):
    return dimension(t, "dim_branch")


@query("star_dim_account", """
    select o_orderkey account_key, 'AC' || o_orderkey account_number, o_custkey customer_key,
           o_custkey % 25 branch_key, o_custkey % 200 product_key,
           cast(cast(o_orderdate as date) as varchar) account_open_date,
           case when o_orderstatus = 'O' then 'UNKNOWN' else o_orderstatus end account_status,
           case when o_orderstatus = 'F' then 'INR' else 'USD' end currency,
           case when o_orderpriority = '1-URGENT' then 0.0 else o_totalprice end::double current_balance
    from orders where o_orderpriority <> '5-LOW'""")
def star_dim_account(t: Tables):
    return dimension(t, "dim_account")


_ODD_ACCOUNTS = """
    select cast(o_orderkey as string) account_key, concat('AC', o_orderkey) account_number, cast(o_custkey as string) customer_key,
           case when o_orderpriority = '5-LOW' then null else '7' end branch_key, '3' product_key,
           '2024-01-05' account_open_date, 'O' account_status, 'USD' currency,
           case when o_orderkey % 5 = 0 then '12000000.00' when o_orderkey % 5 = 1 then 'abc'
                when o_orderkey % 5 = 2 then '  ' else '17.25' end current_balance
    from {orders}"""


@query("star_dim_account_odd", """
    select o_orderkey account_key, case o_orderkey % 5 when 0 then null when 1 then null when 2 then 0.0 else 17.25 end::double current_balance
    from orders where o_orderpriority <> '5-LOW'""")
def star_dim_account_odd(t: Tables):
    """Balances that do not fit or cannot be read stay NULL; blank ones get the default."""
    return clean_entity(t.sql(_ODD_ACCOUNTS), star.DIMENSIONS["dim_account"]).select("account_key", "current_balance")


@query("rejected_rows", """
    select 'current_balance' column_name, 'unreadable' reason, count(*) "rows" from orders where o_orderkey % 5 in (0, 1)
    union all
    select 'branch_key', 'missing', count(*) from orders where o_orderpriority = '5-LOW'""")
def rejected_rows(t: Tables):
    return rejected(t.sql(_ODD_ACCOUNTS), star.DIMENSIONS["dim_account"]).withColumnRenamed("column", "column_name")


# --- fact ---------------------------------------------------------------------------------

_AMOUNTS = """cast(opening_balance as double) opening_balance, cast(debit_amount as double) debit_amount,
           cast(credit_amount as double) credit_amount, cast(closing_balance as double) closing_balance,
           cast(transaction_count as bigint) transaction_count"""
_KEYS = "date_key, account_key, customer_key, cast(branch_key as bigint) branch_key, cast(product_key as bigint) product_key"


def staged(t: Tables):
    return star.staged_fact(t.balance_rows)


def gold(t: Tables):
    return star.gold_fact(staged(t), {
        "customer_key": t.customer.withColumnRenamed("c_custkey", "customer_key"),
        "account_key": t.orders.withColumnRenamed("o_orderkey", "account_key"),
        "branch_key": t.nation.withColumnRenamed("n_nationkey", "branch_key"),
        "product_key": t.part.withColumnRenamed("p_partkey", "product_key"),
    })


@query("balance_third_decimal", f"select {_KEYS}, {_AMOUNTS}, true is_balance_valid from x_staged_fact where account_key % 3 <> 0")
def balance_third_decimal(t: Tables):
    """A difference beyond the second place is one."""
    off = F.when(F.col("account_key") % 3 == 0, F.lit("0.004")).otherwise(F.lit("0")).cast("decimal(10,3)")
    return star.staged_fact(t.balance_rows.withColumn("closing_balance", F.col("closing_balance") + off))


@query("balance_check", f"select {_KEYS}, {_AMOUNTS}, true is_balance_valid from x_staged_fact")
def balance_check(t: Tables):
    return staged(t)


@query("balance_flags", """
    select closing_balance = opening_balance + credit_amount - debit_amount is_balance_valid, count(*) n
    from balance_rows group by 1""")
def balance_flags(t: Tables):
    return star.check_balance(t.balance_rows).groupBy("is_balance_valid").agg(F.count(F.lit(1)).alias("n"))


@query("orphan_keys", f"select {_KEYS}, {_AMOUNTS} from x_gold_fact")
def orphan_keys(t: Tables):
    return gold(t)


# --- reports ------------------------------------------------------------------------------

def customers(t: Tables):
    return t.sql("""select c_custkey customer_key, c_mktsegment customer_segment, cast(c_nationkey as string) gender,
                    case when c_acctbal < 0 then 'PENDING' else 'VERIFIED' end kyc_status from {customer}""")


@query("star_accounts_by_branch", """
    select n_name branch_name, cast(n_regionkey as bigint) region, count(distinct account_key) accounts
    from x_gold_fact left join nation on branch_key = n_nationkey group by 1, 2""")
def star_accounts_by_branch(t: Tables):
    branches = t.sql("select n_nationkey branch_key, n_name branch_name, n_regionkey region from {nation}")
    return star.accounts_per(gold(t), "branch_key", branches, ["branch_name", "region"])


@query("star_accounts_by_category", """
    select p_type product_category, count(distinct account_key) accounts
    from x_gold_fact left join part on product_key = p_partkey group by 1""")
def star_accounts_by_category(t: Tables):
    products = t.sql("select p_partkey product_key, p_type product_category from {part}")
    return star.accounts_per(gold(t), "product_key", products, ["product_category"])


@query("star_accounts_by_kyc", """
    select kyc_status, count(distinct account_key) accounts
    from x_gold_fact left join (select c_custkey, case when c_acctbal < 0 then 'PENDING' else 'VERIFIED' end
      kyc_status from customer) c on customer_key = c_custkey group by 1""")
def star_accounts_by_kyc(t: Tables):
    return star.accounts_per(gold(t), "customer_key", customers(t), ["kyc_status"])


@query("star_accounts_by_gender", """
    select cast(c_nationkey as varchar) gender, count(distinct account_key) accounts
    from x_gold_fact left join customer on customer_key = c_custkey group by 1""")
def star_accounts_by_gender(t: Tables):
    return star.accounts_per(gold(t), "customer_key", customers(t), ["gender"])


@query("star_customers_by_segment", """
    select c_mktsegment customer_segment, count(distinct c_custkey) customers from customer group by 1""")
def star_customers_by_segment(t: Tables):
    return star.customers_by_segment(customers(t))


@query("star_top_balances_by_gender", """
    select cast(c_nationkey as varchar) gender, count(o_orderkey) accounts, max(o_totalprice) top_balance
    from customer left join orders on c_custkey = o_custkey group by 1""")
def star_top_balances_by_gender(t: Tables):
    accounts = t.sql("""select o_custkey customer_key, cast(o_totalprice as decimal(18,2)) current_balance
                        from {orders}""")
    return star.top_balances_by_gender(customers(t), accounts)


@query("star_measures", """
    select count(distinct 'AC' || o_orderkey) distinct_accounts,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) total_balance
    from orders where o_orderkey in (select account_key from x_gold_fact)""")
def star_measures(t: Tables):
    accounts = t.sql("""select o_orderkey account_key, concat('AC', o_orderkey) account_number,
                        cast(o_totalprice as decimal(18,2)) current_balance from {orders}""")
    return star.measures(gold(t), accounts)
