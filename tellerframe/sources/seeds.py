"""Small reference data shipped with the code."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tellerframe.schemas import LINEAGE_EDGE, MERCHANT_CATEGORIES
from tellerframe.sources.raw import read_raw_csv

# ---- fixed values: merchant category, its group, whether spending is essential
CATEGORY_SEED = [
    ("Grocery", "Food & Beverage", True),
    ("Restaurant", "Food & Beverage", False),
    ("Gas", "Transportation", True),
    ("Utilities", "Home & Bills", True),
    ("Entertainment", "Leisure", False),
    ("Travel", "Transportation", False),
    ("Healthcare", "Health", True),
    ("Retail", "Shopping", False),
    ("ATM", "Banking", True),
    ("Salary", "Income", True),
    ("Transfer", "Banking", True),
    ("Unclassified", "Other", False),
]

# ---- fixed values: column lineage of the standard model
LINEAGE_SEED = [
    ("CORE_BANKING.customers_raw", "customer_id", "staging.stg_customers", "customer_id", "Direct copy", "extractor"),
    ("CORE_BANKING.customers_raw", "first_name", "staging.stg_customers", "first_name", "SHA-256 mask in non-prod", "transformer.pii_masking"),
    ("CORE_BANKING.customers_raw", "last_name", "staging.stg_customers", "last_name", "SHA-256 mask in non-prod", "transformer.pii_masking"),
    ("CORE_BANKING.customers_raw", "email", "staging.stg_customers", "email", "SHA-256 mask in non-prod", "transformer.pii_masking"),
    ("CORE_BANKING.customers_raw", "date_of_birth", "staging.stg_customers", "date_of_birth", "Cast to DATE", "transformer"),
    ("CORE_BANKING.customers_raw", "date_of_birth", "staging.stg_customers", "age_years", "Derived: (today - DOB).days / 365.25", "transformer.derive"),
    ("CORE_BANKING.customers_raw", "join_date", "staging.stg_customers", "tenure_years", "Derived: (today - join_date).days / 365.25", "transformer.derive"),
    ("CORE_BANKING.customers_raw", "date_of_birth", "staging.stg_customers", "age_band", "Derived: pd.cut on age_years", "transformer.derive"),
    ("staging.stg_customers", "customer_id", "marts.dim_customer", "customer_id", "Direct copy with surrogate key added", "dbt.dim_customer"),
    ("staging.stg_customers", "customer_segment", "marts.dim_customer", "customer_segment", "Direct copy", "dbt.dim_customer"),
    ("staging.stg_customers", "age_band", "marts.dim_customer", "age_band", "Direct copy", "dbt.dim_customer"),
    ("marts.dim_customer", "customer_sk", "marts.fact_transactions", "customer_sk", "FK join on account_id → customer_id", "dbt.fact_transactions"),
    ("CORE_BANKING.accounts_raw", "account_id", "staging.stg_accounts", "account_id", "Direct copy", "extractor"),
    ("CORE_BANKING.accounts_raw", "current_balance", "staging.stg_accounts", "current_balance", "Cast to NUMERIC(18,2)", "transformer"),
    ("CORE_BANKING.accounts_raw", "current_balance", "staging.stg_accounts", "balance_tier", "Derived: pd.cut on balance", "transformer.derive"),
    ("CORE_BANKING.accounts_raw", "last_activity_date", "staging.stg_accounts", "days_since_activity", "Derived: (today - last_activity).days", "transformer.derive"),
    ("CORE_BANKING.accounts_raw", "last_activity_date", "staging.stg_accounts", "is_dormant", "Derived: days_since_activity > 730", "transformer.derive"),
    ("CORE_BANKING.accounts_raw", "current_balance", "staging.stg_accounts", "is_overdraft", "Derived: balance < 0", "transformer.derive"),
    ("staging.stg_accounts", "account_id", "marts.dim_account", "account_id", "Direct copy with surrogate key", "dbt.dim_account"),
    ("staging.stg_accounts", "balance_tier", "marts.dim_account", "balance_tier", "Direct copy", "dbt.dim_account"),
    ("staging.stg_accounts", "is_dormant", "marts.dim_account", "is_dormant", "Direct copy", "dbt.dim_account"),
    ("marts.dim_account", "account_sk", "marts.fact_transactions", "account_sk", "FK join on transaction.account_id", "dbt.fact_transactions"),
    ("TPS.transactions_raw", "transaction_id", "staging.stg_transactions", "transaction_id", "Direct copy after dedup", "transformer.dedup"),
    ("TPS.transactions_raw", "amount", "staging.stg_transactions", "amount", "Direct copy (original currency)", "transformer"),
    ("TPS.transactions_raw", "amount", "staging.stg_transactions", "amount_cad", "Derived: USD×1.36 if USD else amount", "transformer.currency_normalize"),
    ("TPS.transactions_raw", "amount", "staging.stg_transactions", "signed_amount_cad", "Derived: negate if Debit/ATM/BillPay", "transformer.derive"),
    ("TPS.transactions_raw", "amount", "staging.stg_transactions", "is_large_transaction", "Derived: amount_cad >= 10000", "transformer.derive"),
    ("TPS.transactions_raw", "transaction_date", "staging.stg_transactions", "txn_year", "Derived: date.year", "transformer.derive"),
    ("TPS.transactions_raw", "transaction_date", "staging.stg_transactions", "txn_quarter", "Derived: date.quarter", "transformer.derive"),
    ("staging.stg_transactions", "transaction_id", "marts.fact_transactions", "transaction_id", "Direct copy with surrogate key", "dbt.fact_transactions"),
    ("staging.stg_transactions", "amount_cad", "marts.fact_transactions", "amount_cad", "Direct copy", "dbt.fact_transactions"),
    ("staging.stg_transactions", "amount_cad", "metrics.kpi_daily_summary", "total_volume_cad", "Aggregated: SUM(amount_cad) per date", "dbt.kpi_daily"),
    ("staging.stg_transactions", "transaction_id", "metrics.kpi_daily_summary", "transaction_count", "Aggregated: COUNT(*) per date", "dbt.kpi_daily"),
    ("CREDIT_RISK.credit_data_raw", "loan_id", "staging.stg_credit", "loan_id", "Direct copy", "extractor"),
    ("CREDIT_RISK.credit_data_raw", "credit_score", "staging.stg_credit", "credit_score_band", "Derived: pd.cut on credit_score", "transformer.derive"),
    ("CREDIT_RISK.credit_data_raw", "days_past_due", "staging.stg_credit", "is_delinquent", "Derived: days_past_due > 0", "transformer.derive"),
    ("CREDIT_RISK.credit_data_raw", "days_past_due", "staging.stg_credit", "delinquency_bucket", "Derived: pd.cut on days_past_due", "transformer.derive"),
    ("CREDIT_RISK.credit_data_raw", "outstanding_balance", "staging.stg_credit", "ltv_ratio", "Derived: outstanding / original_amount", "transformer.derive"),
]


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table of literals.  Handed over as Arrow it becomes a local
    relation, whose size Catalyst knows and which it broadcasts without a hint."""
    columns = dict(zip(schema.names, map(list, zip(*rows))))
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema)), schema)


def merchant_categories(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The category seed, from a CSV when a path is given; twelve rows."""
    if path:
        return read_raw_csv(spark, path, MERCHANT_CATEGORIES)
    return literal_table(spark, CATEGORY_SEED, MERCHANT_CATEGORIES)


def lineage_edges(spark: SparkSession) -> DataFrame:
    """The registry of column lineage, one row per edge."""
    return literal_table(spark, LINEAGE_SEED, LINEAGE_EDGE)
