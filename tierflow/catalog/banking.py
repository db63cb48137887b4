"""Banking gold tables, dashboard figures, registry and audit reports."""

from __future__ import annotations

from tierflow.catalog.registry import Tables, query
from tierflow.control import audit, registry
from tierflow.operators.dedup import keep_latest
from tierflow.plans import banking, reports


def customer_360(t: Tables):
    return banking.customer_360(t.customers, t.accounts, t.transactions, t.branches, t.credit_bureau_reports)


def branch_performance(t: Tables):
    return banking.branch_performance(t.branches, t.customers, t.accounts, t.transactions)


def channel_summary(t: Tables):
    return banking.transaction_channel_summary(t.gw_transactions, t.payment_gateway_logs)


query("customer_360", "select * from x_customer_360")(customer_360)
query("branch_performance", "select * from x_branch_performance")(branch_performance)
query("transaction_channel_summary", "select * from x_channel_summary")(channel_summary)


@query("daily_bank_kpi", """
    select cast(d.txn_date as varchar) txn_date,
           (select count(distinct customer_id) from customers) total_customers,
           (select count(account_id) from accounts) total_accounts,
           (select cast(sum(balance) as double) from accounts) total_balance,
           d.total_transactions, cast(d.total_transaction_amount as double) total_transaction_amount,
           (select avg(credit_score) from credit_bureau_reports) avg_credit_score,
           (select cast(sum(case when risk_grade = 'HIGH' then 1 else 0 end) as bigint)
              from credit_bureau_reports) high_risk_customers
    from (select cast(txn_timestamp as date) txn_date, count(txn_id) total_transactions,
                 sum(amount) total_transaction_amount
          from transactions group by 1) d""")
def daily_bank_kpi(t: Tables):
    return banking.daily_bank_kpi(t.transactions, t.customers, t.accounts, t.credit_bureau_reports)


@query("risk_customer_summary", """
    select risk_grade, count(customer_id) total_customers, avg(credit_score) avg_credit_score,
           cast(sum(external_active_loans) as bigint) total_external_loans,
           cast(sum(external_overdue_amount) as double) total_overdue_amount
    from credit_bureau_reports group by risk_grade""")
def risk_customer_summary(t: Tables):
    return banking.risk_customer_summary(t.credit_bureau_reports)


# --- dashboard ----------------------------------------------------------------------------

@query("dash_total_kpis", """
    select count(distinct customer_id) total_customers,
           cast(sum(cast(total_balance as decimal(18,2))) as double) total_deposits,
           cast(sum(total_transactions) as bigint) total_transactions,
           cast(sum(case when risk_grade = 'HIGH' then 1 else 0 end) as bigint) high_risk_customers
    from x_customer_360""")
def dash_total_kpis(t: Tables):
    return reports.total_kpis(customer_360(t))


@query("dash_segments", "select customer_segment, count(*) customers from x_customer_360 group by 1")
def dash_segments(t: Tables):
    return reports.customers_by(customer_360(t), "customer_segment")


@query("dash_risk", "select risk_grade, count(*) customers from x_customer_360 group by 1")
def dash_risk(t: Tables):
    return reports.customers_by(customer_360(t), "risk_grade")


@query("dash_top_customers", """
    select customer_name, branch_name, total_balance from x_customer_360
    order by total_balance desc, customer_id limit 10""")
def dash_top_customers(t: Tables):
    return reports.top_customers(customer_360(t))


@query("dash_branch_deposits", "select branch_name, total_deposits from x_branch_performance")
def dash_branch_deposits(t: Tables):
    return reports.branches_by(branch_performance(t), "total_deposits")


@query("dash_branch_customers", "select branch_name, total_customers from x_branch_performance")
def dash_branch_customers(t: Tables):
    return reports.branches_by(branch_performance(t), "total_customers")


@query("dash_branch_amounts", "select branch_name, total_transaction_amount from x_branch_performance")
def dash_branch_amounts(t: Tables):
    return reports.branches_by(branch_performance(t), "total_transaction_amount")


@query("dash_gateway", """
    select gateway_name, cast(sum(successful_transactions) as bigint) successful_transactions,
           cast(sum(failed_transactions) as bigint) failed_transactions
    from x_channel_summary group by 1""")
def dash_gateway(t: Tables):
    return reports.gateway_outcomes(channel_summary(t))


@query("dash_gateway_selected", """
    select gateway_name, cast(sum(successful_transactions) as bigint) successful_transactions,
           cast(sum(failed_transactions) as bigint) failed_transactions
    from x_channel_summary where gateway_name = 'error' group by 1""")
def dash_gateway_selected(t: Tables):
    return reports.gateway_outcomes(channel_summary(t), "error")


@query("dash_device", """
    select device_type, cast(sum(total_transactions) as bigint) total_transactions
    from x_channel_summary group by 1""")
def dash_device(t: Tables):
    return reports.device_totals(channel_summary(t))


@query("dash_field_totals", """
    select device_type, cast(sum(failed_transactions) as bigint) failed_transactions
    from x_channel_summary group by 1""")
def dash_field_totals(t: Tables):
    return reports.field_totals(channel_summary(t), "device_type", "failed_transactions")


@query("dash_filter_matches", """
    select cast(sum(case when gateway_name = 'click' then 1 else 0 end) as bigint) matching, count(*) total
    from x_channel_summary""")
def dash_filter_matches(t: Tables):
    return reports.rows_matching(channel_summary(t), "gateway_name", "click")


# --- control tables -----------------------------------------------------------------------

def latest_runs(t: Tables):
    """One row per run and table, the newest event of the pair."""
    runs = keep_latest(t.run_events, ["run_id", "table_id"], ["start_time", "event_id"], tie_break=[])
    return runs.selectExpr(
        "run_id", "table_id", "'Silver' layer", "start_time", "start_time + interval 5 minutes end_time",
        "status", "number_of_records", "if(status = 'FAILED', 'failed ''here''', null) error_message",
    )


_SEED = ", ".join(f"({r[0]}, '{r[1]}')" for r in registry.fx.REGISTRY_ROWS)


@query("audit_report", f"""
    select r.run_id, cast(r.table_id as bigint) table_id, n.table_name, 'Silver' layer,
           cast(r.start_time as varchar) start_time,
           cast(r.start_time + interval '5' minute as varchar) end_time, r.status,
           r.number_of_records,
           case when r.status = 'FAILED' then 'failed ''here''' end error_message
    from x_latest_runs r left join (values {_SEED}) n(table_id, table_name) on r.table_id = n.table_id""")
def audit_report(t: Tables):
    return audit.run_report(latest_runs(t), registry.seed_registry(t.spark))


@query("audit_overall", """
    select run_id, count(*) total_tables,
           cast(sum(case when status <> 'SUCCESS' then 1 else 0 end) as bigint) failed_tables,
           case when sum(case when status <> 'SUCCESS' then 1 else 0 end) > 0 then 'FAILED'
                else 'SUCCESS' end overall_status
    from x_latest_runs group by run_id""")
def audit_overall(t: Tables):
    return audit.run_status(latest_runs(t))


@query("audit_newest_first", """
    select run_id, cast(table_id as bigint) table_id, status,
           cast(start_time as varchar) start_time from x_latest_runs""")
def audit_newest_first(t: Tables):
    return audit.runs_newest_first(latest_runs(t)).select("run_id", "table_id", "status", "start_time")


@query("registry_order", """
    select cast(table_id as bigint) table_id, table_name, cast(load_order as bigint) load_order
    from registry_rows where active_flag and lower(source_system) = 'sqlserver'""")
def registry_order(t: Tables):
    return registry.active_tables(t.registry_rows, "sqlserver").select("table_id", "table_name", "load_order")


@query("params_pivot", """
    select cast(table_id as bigint) table_id,
           max(case when parameter_name = 'load_type' then parameter_value end) load_type,
           max(case when parameter_name = 'primary_key' then parameter_value end) primary_key,
           max(case when parameter_name = 'watermark_column' then parameter_value end) watermark_column
    from parameter_rows group by table_id""")
def params_pivot(t: Tables):
    return registry.parameters_wide(t.parameter_rows)


@query("load_type_by_table", """
    select r.table_name, p.parameter_value load_type
    from registry_rows r join parameter_rows p on r.table_id = p.table_id
    where p.parameter_name = 'load_type'""")
def load_type_by_table(t: Tables):
    return registry.load_types(t.registry_rows, t.parameter_rows)
