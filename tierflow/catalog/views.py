"""The test tables seen as the tables the jobs work on.

``VIEWS`` are read by both engines. They keep every row of their base tables; derived columns add
the empty groups, orphans, NULLs and repeated keys the base tables lack. ``EXPECTED`` states gold
tables in plain SQL for the engine that checks the results.
"""

from __future__ import annotations

# Declared, so that opening a table reads no file footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
BASE_TABLES = tuple(SCHEMAS)

VIEWS = {
    # --- banking
    "branches": """
        select cast(n_nationkey as string) branch_code, n_name branch_name, r_name region
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "customers": """
        select c_custkey customer_id, substr(c_name, 1, 8) first_name,
               case when c_mktsegment = 'MACHINERY' then null else substr(c_name, 10) end last_name,
               case when c_nationkey = 24 then null else cast(c_nationkey as string) end branch_code,
               c_mktsegment market, cast(c_acctbal as decimal(18,2)) acctbal
        from {customer}""",
    "accounts": """
        select o_orderkey account_id,
               case when o_custkey % 7 = 0 then o_custkey + 1 else o_custkey end customer_id,
               o_orderpriority account_type, cast(o_totalprice as decimal(18,2)) balance,
               o_orderstatus status, o_orderdate opened_ts
        from {orders}""",
    "transactions": """
        select l_orderkey * 100 + l_linenumber txn_id, l_orderkey account_id,
               cast(l_extendedprice as decimal(18,2)) amount, l_shipdate txn_timestamp,
               l_returnflag channel
        from {lineitem}""",
    "credit_bureau_reports": """
        select user_id customer_id, ts bureau_pull_date, event_id report_id,
               cast(300 + (event_id * 37) % 551 as int) credit_score,
               case event_type when 'error' then 'HIGH' when 'view' then 'MEDIUM' else 'LOW' end risk_grade,
               cast(event_id % 5 as int) external_active_loans,
               cast(value as decimal(18,2)) external_overdue_amount
        from {events}""",
    "payment_gateway_logs": """
        select event_id txn_id, event_type gateway_name,
               case user_id % 3 when 0 then 'MOBILE' when 1 then 'WEB' else 'POS' end device_type,
               case when event_type = 'error' then 'FAILED' when event_type = 'click' then 'PENDING'
                    else 'SUCCESS' end gateway_status,
               cast(round(value * 100) as int) processing_time_ms
        from {events}""",
    "gw_transactions": "select o_orderkey txn_id, o_orderdate txn_timestamp from {orders}",
    # --- hospital
    "encounters": """
        select l_orderkey * 100 + l_linenumber encounter_id, o_custkey patient_id, l_suppkey provider_id,
               o_orderdate admission_datetime,
               case when l_returnflag = 'R' then null
                    else l_shipdate + l_linenumber * interval '5' hour end discharge_datetime,
               l_partkey department_id
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "patients": """
        select c_custkey patient_id, c_name patient_name,
               case when c_nationkey = 3 then date '1900-01-01'
                    else date '1930-01-01' + cast(c_custkey * 23 % 33000 as int) end date_of_birth,
               c_mktsegment ethnicity
        from {customer}""",
    "hospitals": """
        select s_suppkey hospital_id, s_name hospital_name, n_name city,
               case when s_nationkey = 7 then null else cast(s_nationkey as string) end zip_code
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "physicians": """
        select s_suppkey * 2 provider_id, 'Dr' first_name, s_name last_name, 'Dr ' || s_name full_name
        from {supplier}""",
    "departments": """
        select p_partkey department_id, p_name department_name, p_size hospital_id,
               p_type specialty_description
        from {part}""",
    # --- star
    "balance_rows": """
        select year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) date_key,
               l_orderkey account_key,
               case when o_orderpriority = '5-LOW' then o_custkey + 900000000 else o_custkey end customer_key,
               case when l_linenumber = 7 then null else l_linenumber end branch_key,
               case when l_linenumber = 6 then 800000000 else l_linenumber * 3 end product_key,
               cast(l_extendedprice as decimal(18,2)) opening_balance,
               cast(l_quantity as decimal(18,2)) debit_amount,
               cast(l_quantity * 2 as decimal(18,2)) credit_amount,
               cast(l_extendedprice as decimal(18,2)) + cast(l_quantity as decimal(18,2))
                 + case when l_returnflag = 'R' then cast(0.01 as decimal(18,2))
                        else cast(0 as decimal(18,2)) end closing_balance,
               cast(l_quantity as int) transaction_count
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    # --- trips
    "trips": """
        select l_linenumber % 2 + 1 VendorID,
               l_shipdate + l_linenumber * interval '3' hour tpep_pickup_datetime,
               l_shipdate + l_linenumber * interval '3' hour + cast(l_quantity as int) * interval '1' minute
                 tpep_dropoff_datetime,
               cast(l_linenumber as bigint) passenger_count, l_quantity / 2 trip_distance,
               l_suppkey PULocationID, l_partkey % 263 DOLocationID, l_extendedprice fare_amount,
               l_extendedprice + l_quantity total_amount
        from {lineitem}""",
    # --- control
    "run_events": """
        select cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as bigint) run_id,
               cast(user_id % 13 + 1 as int) table_id, event_id, ts start_time,
               case event_type when 'error' then 'FAILED' when 'view' then 'INPROGRESS' else 'SUCCESS' end status,
               event_id * 3 number_of_records
        from {events}""",
    "registry_rows": """
        select cast(s_suppkey as int) table_id, s_name table_name,
               case s_nationkey % 2 when 0 then 'SqlServer' else 'blob' end source_system,
               s_acctbal > 0 active_flag, s_nationkey load_order
        from {supplier}""",
    "parameter_rows": """
        select cast(p_partkey as int) table_id, 'load_type' parameter_name, p_type parameter_value from {part}
        union all
        select cast(p_partkey as int) table_id, 'primary_key' parameter_name, p_brand parameter_value from {part}
        union all
        select cast(p_partkey as int) table_id, 'watermark_column' parameter_name, p_name parameter_value
        from {part}""",
}

EXPECTED = {
    "x_account_agg": """
        select customer_id, count(account_id) total_accounts, sum(balance) total_balance
        from accounts group by customer_id""",
    "x_txn_agg": """
        select a.customer_id, count(t.txn_id) total_transactions, sum(t.amount) total_transaction_amount
        from transactions t join accounts a on t.account_id = a.account_id group by a.customer_id""",
    "x_customer_360": """
        select c.customer_id, c.first_name || ' ' || c.last_name customer_name, b.branch_name,
               cast(coalesce(a.total_accounts, 0) as bigint) total_accounts,
               cast(coalesce(a.total_balance, 0) as double) total_balance,
               cast(coalesce(t.total_transactions, 0) as bigint) total_transactions,
               cast(coalesce(t.total_transaction_amount, 0) as double) total_transaction_amount,
               cast(r.credit_score as bigint) credit_score, r.risk_grade,
               cast(r.external_active_loans as bigint) external_active_loans,
               cast(r.external_overdue_amount as double) external_overdue_amount,
               case when a.total_balance >= 500000 then 'HIGH_VALUE'
                    when a.total_balance >= 100000 then 'MEDIUM_VALUE' else 'LOW_VALUE' end customer_segment
        from customers c
        left join x_account_agg a on c.customer_id = a.customer_id
        left join x_txn_agg t on c.customer_id = t.customer_id
        left join branches b on c.branch_code = b.branch_code
        left join (select * from (select *, row_number() over (
                     partition by customer_id order by bureau_pull_date desc, report_id desc) rn
                   from credit_bureau_reports) ranked where rn = 1) r on c.customer_id = r.customer_id""",
    "x_branch_performance": """
        select b.branch_code, b.branch_name, count(distinct c.customer_id) total_customers,
               cast(sum(a.total_accounts) as bigint) total_accounts,
               cast(sum(a.total_balance) as double) total_deposits,
               cast(sum(t.total_transactions) as bigint) total_transactions,
               cast(sum(t.total_transaction_amount) as double) total_transaction_amount
        from branches b
        left join customers c on b.branch_code = c.branch_code
        left join x_account_agg a on c.customer_id = a.customer_id
        left join x_txn_agg t on c.customer_id = t.customer_id
        group by b.branch_code, b.branch_name""",
    "x_channel_summary": """
        select cast(cast(t.txn_timestamp as date) as varchar) txn_date, g.gateway_name, g.device_type,
               count(*) total_transactions,
               cast(sum(case when g.gateway_status = 'SUCCESS' then 1 else 0 end) as bigint) successful_transactions,
               cast(sum(case when g.gateway_status = 'FAILED' then 1 else 0 end) as bigint) failed_transactions,
               avg(g.processing_time_ms) avg_processing_time_ms
        from gw_transactions t join payment_gateway_logs g on t.txn_id = g.txn_id
        group by all""",
    "x_encounters_summary": """
        select *, cast(case when stay = 0 then 1 else stay end as bigint) actual_stay_days from (
          select *, date_diff('day', cast(admission_datetime as date), cast(discharge_datetime as date)) stay
          from encounters) e""",
    "x_physicians_directory": """
        select distinct p.provider_id, p.full_name, count(e.encounter_id) over (partition by p.provider_id)
               provider_encounters_total
        from physicians p left join encounters e on p.provider_id = e.provider_id""",
    "x_staged_fact": """
        select * from (select *, row_number() over (
                 partition by date_key, account_key, customer_key, branch_key, product_key
                 order by opening_balance, debit_amount, credit_amount, closing_balance, transaction_count) rn
          from balance_rows
          where date_key is not null and account_key is not null and customer_key is not null
            and branch_key is not null and product_key is not null
            and closing_balance = opening_balance + credit_amount - debit_amount) ranked
        where rn = 1""",
    "x_gold_fact": """
        select f.date_key,
               case when f.branch_key in (select n_nationkey from nation) then f.branch_key else -1 end branch_key,
               case when f.product_key in (select p_partkey from part) then f.product_key else -1 end product_key,
               case when f.customer_key in (select c_custkey from customer) then f.customer_key else -1 end customer_key,
               case when f.account_key in (select o_orderkey from orders) then f.account_key else -1 end account_key,
               opening_balance, debit_amount, credit_amount, closing_balance, transaction_count
        from x_staged_fact f""",
    "x_latest_runs": """
        select * from (select *, row_number() over (
                 partition by run_id, table_id order by start_time desc, event_id desc) rn
          from run_events) ranked where rn = 1""",
}
