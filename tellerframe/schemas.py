"""Declared schemas of the feeds; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


STRING, BOOLEAN, DATE = T.StringType(), T.BooleanType(), T.DateType()
INT, LONG = T.IntegerType(), T.LongType()
MONEY, RATE = T.DecimalType(18, 2), T.DecimalType(6, 4)


def fields(names: str, kind: T.DataType = STRING) -> list[T.StructField]:
    """Fields of one type, names separated by blanks."""
    return [T.StructField(name, kind) for name in names.split()]


# Dates arrive as ISO text and are typed in staging, so that a bad one becomes
# null there instead of failing the read.
SOURCE_COLUMNS = ("_source_system", "_extract_ts")
_SOURCE = fields(" ".join(SOURCE_COLUMNS))

RAW_CUSTOMERS = T.StructType(
    [
        *fields("customer_id first_name last_name email phone date_of_birth province postal_code customer_segment kyc_status join_date"),
        *fields("is_active", BOOLEAN),
        *_SOURCE,
    ]
)
RAW_ACCOUNTS = T.StructType(
    [
        *fields("account_id customer_id account_type account_status currency"),
        *fields("current_balance available_balance", MONEY),
        *fields("interest_rate", RATE),
        *fields("open_date last_activity_date branch_id"),
        *_SOURCE,
    ]
)
RAW_TRANSACTIONS = T.StructType(
    [
        *fields("transaction_id account_id transaction_type channel"),
        *fields("amount", MONEY),
        *fields("currency merchant_category transaction_date transaction_time status description"),
        *_SOURCE,
    ]
)
RAW_CREDIT = T.StructType(
    [
        *fields("loan_id customer_id loan_type"),
        *fields("original_amount outstanding_balance", MONEY),
        *fields("interest_rate", RATE),
        *fields("term_months", INT),
        *fields("origination_date maturity_date"),
        *fields("credit_score", INT),
        *fields("risk_rating"),
        *fields("days_past_due", INT),
        *fields("loan_status collateral_type"),
        *_SOURCE,
    ]
)
MERCHANT_CATEGORIES = T.StructType([*fields("merchant_category category_group"), *fields("is_essential", BOOLEAN)])
LINEAGE_EDGE = T.StructType(
    fields("source_dataset source_column target_dataset target_column transformation_rule pipeline_step")
)

RAW_FEEDS = {
    "customers_raw": RAW_CUSTOMERS,
    "accounts_raw": RAW_ACCOUNTS,
    "transactions_raw": RAW_TRANSACTIONS,
    "credit_data_raw": RAW_CREDIT,
}
