"""Fixed values that results depend on: thresholds, rates, sentinels, formats, column mappings
and the seed rows of the control tables."""

from __future__ import annotations

# --- banking gold -------------------------------------------------------------------------
HIGH_VALUE_FROM = 500000
MEDIUM_VALUE_FROM = 100000
HIGH_VALUE, MEDIUM_VALUE, LOW_VALUE = "HIGH_VALUE", "MEDIUM_VALUE", "LOW_VALUE"
HIGH_RISK_GRADE = "HIGH"
GATEWAY_SUCCESS, GATEWAY_FAILED = "SUCCESS", "FAILED"
TOP_CUSTOMERS = 10

# --- hospital -----------------------------------------------------------------------------
CHARGE_PER_DAY = 1200.0
COST_PER_DAY = 750.0
COST_PER_STAY = 500.0
UNKNOWN_BIRTH_DATE = "1900-01-01"
ADULT_FROM, GERIATRIC_FROM = 18, 65
PEDIATRIC, ADULT, GERIATRIC, UNKNOWN_AGE = "Pediatric", "Adult", "Geriatric", "Unknown"
ADMISSION_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSS"
DISCHARGE_FORMAT = "MMM d yyyy h:mma"
BIRTH_DATE_FORMAT = "M/d/yyyy"

# --- star schema --------------------------------------------------------------------------
ORPHAN_KEY = -1
FACT_KEYS = ["date_key", "account_key", "customer_key", "branch_key", "product_key"]
FACT_AMOUNTS = ["opening_balance", "debit_amount", "credit_amount", "closing_balance"]

# --- trips --------------------------------------------------------------------------------
ROLLING_MONTHS = 2
TOP_ZONES = 5

# --- control tables -----------------------------------------------------------------------
FIRST_WATERMARK = "1900-01-01 00:00:00"
IN_PROGRESS, SUCCESS, FAILED = "INPROGRESS", "SUCCESS", "FAILED"
FULL, APPEND, MERGE = "FULL", "APPEND", "MERGE"

# table_id, table_name, source_system, source_schema, source_table, target_layer, load_order
REGISTRY_ROWS = [
    (1, "customers", "sqlserver", "banking", "customers", "silver", 1),
    (2, "accounts", "sqlserver", "banking", "accounts", "silver", 2),
    (3, "transactions", "sqlserver", "banking", "transactions", "silver", 3),
    (4, "branches", "sqlserver", "banking", "branches", "silver", 4),
    (5, "credit_bureau_reports", "blob", None, None, "silver", 5),
    (6, "payment_gateway_logs", "blob", None, None, "silver", 6),
    (7, "customer_360", "silver", None, None, "gold", 1),
    (8, "branch_performance", "silver", None, None, "gold", 2),
    (9, "transaction_channel_summary", "silver", None, None, "gold", 3),
    (10, "daily_bank_kpi", "silver", None, None, "gold", 4),
    (11, "risk_customer_summary", "silver", None, None, "gold", 1),
]

# table_id, parameter_name, parameter_value
PARAMETER_ROWS = [
    (1, "load_type", "MERGE"),
    (1, "primary_key", "customer_id"),
    (1, "watermark_column", "updated_at"),
    (2, "load_type", "MERGE"),
    (2, "primary_key", "account_id"),
    (2, "watermark_column", "updated_at"),
    (3, "load_type", "APPEND"),
    (3, "primary_key", "txn_id"),
    (3, "watermark_column", "txn_timestamp"),
    (4, "load_type", "FULL"),
    (4, "primary_key", "branch_code"),
    (5, "load_type", "MERGE"),
    (5, "primary_key", "customer_id"),
    (5, "watermark_column", "bureau_pull_date"),
    (6, "load_type", "APPEND"),
    (6, "primary_key", "txn_id"),
    (6, "watermark_column", "processed_timestamp"),
]

# table_id of the tables that start from FIRST_WATERMARK
WATERMARKED_TABLES = [1, 2, 3, 5, 6]

# source_schema, source_table, folder_name, watermark_column, last_load_value
HOSPITAL_WATERMARKS = [
    ("dbo", "Hospitals", "landing/Hospitals", "Hospital ID", "9900006"),
    ("dbo", "Physicians", "landing/Physicians", "Provider ID", "9999"),
    ("dbo", "Patients", "landing/Patients", "Master Patient ID", "107386"),
    ("dbo", "Departments", "landing/Departments", "DepartmentKey", "64"),
    ("dbo", "Encounters", "landing/Encounters", "Patient Admission Datetime", "2021-07-02T14:46:00"),
]
