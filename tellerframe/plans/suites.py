"""The quality rules of the banking model, as lists of checks."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerframe.config import Rules
from tellerframe.functions.banding import AGE_BANDS, BALANCE_TIERS
from tellerframe.operators import score
from tellerframe.operators.checks import (
    Check,
    allowed,
    exists,
    fresh,
    in_range,
    mean_between,
    median_between,
    not_null,
    references,
    row_count,
    run_checks,
    unique,
)
from tellerframe.operators.profile import profile

# ---- fixed values ----------------------------------------------------------
TRANSACTION_STATUS = ("Completed", "Pending", "Failed", "Reversed")
TRANSACTION_TYPES = ("Debit", "Credit", "Transfer", "Bill Payment", "ATM Withdrawal")
CURRENCIES = ("CAD", "USD")
ACCOUNT_TYPES = ("Chequing", "Savings", "TFSA", "RRSP", "GIC")
ACCOUNT_STATUS = ("Active", "Dormant", "Closed", "Frozen")
KYC_STATUS = ("Verified", "Pending", "Expired", "Unknown")
SEGMENTS = ("Mass Market", "Affluent", "Private Banking", "Small Business")


def transaction_checks(accounts: DataFrame, rules: Rules) -> list[Check]:
    """Rules of the transaction feed; ids, accounts and amounts quarantine."""
    return [
        not_null("transaction_id"),
        not_null("account_id"),
        not_null("amount"),
        not_null("transaction_date"),
        unique("transaction_id"),
        in_range("amount", 0, rules.amount_ceiling),
        references("account_id", accounts),
        allowed("status", TRANSACTION_STATUS),
        allowed("transaction_type", TRANSACTION_TYPES),
        fresh("transaction_date", rules.freshness_days, rules.as_of),
    ]


def account_checks(customers: DataFrame) -> list[Check]:
    """Rules of the account feed; it is only judged, never split."""
    return [
        not_null("account_id"),
        not_null("customer_id"),
        not_null("account_type"),
        not_null("open_date"),
        unique("account_id"),
        references("customer_id", customers),
        allowed("account_type", ACCOUNT_TYPES),
        in_range("interest_rate", 0, 25),
    ]


def customer_checks() -> list[Check]:
    return [
        not_null("customer_id"),
        not_null("date_of_birth"),
        unique("customer_id"),
        allowed("kyc_status", KYC_STATUS),
        allowed("customer_segment", SEGMENTS),
    ]


def credit_checks(customers: DataFrame) -> list[Check]:
    return [
        not_null("loan_id"),
        unique("loan_id"),
        references("customer_id", customers),
        in_range("credit_score", 300, 900),
        in_range("original_amount", 0),
    ]


def transaction_expectations(
    mean_bounds: tuple[int, int] = (50, 5_000), median_bounds: tuple[int, int] = (10, 1_000)
) -> list[Check]:
    """The expectation suite of the transaction feed."""
    return [
        *[not_null(c) for c in ("transaction_id", "account_id", "amount", "transaction_date", "status")],
        unique("transaction_id", every_copy=True),
        allowed("status", TRANSACTION_STATUS),
        allowed("transaction_type", TRANSACTION_TYPES),
        allowed("currency", CURRENCIES),
        in_range("amount", 0, 500_000, mostly=Decimal("0.999")),
        *[exists(c) for c in ("transaction_id", "account_id", "amount")],
        row_count(1, 10_000_000),
        mean_between("amount", *mean_bounds),
        median_between("amount", *median_bounds),
    ]


def account_expectations() -> list[Check]:
    return [
        not_null("account_id"),
        not_null("customer_id"),
        unique("account_id", every_copy=True),
        allowed("account_type", ACCOUNT_TYPES),
        allowed("account_status", ACCOUNT_STATUS),
        in_range("interest_rate", 0, 25),
    ]


def model_checks(tables: dict[str, DataFrame]) -> dict[str, list[Check]]:
    """Tests of the raw feeds and models, by table name.

    Hand the tables over as written tables: every uniqueness and reference
    test scans its column on its own.
    """
    return {
        "customers_raw": [not_null("customer_id"), unique("customer_id"), allowed("kyc_status", KYC_STATUS)],
        "accounts_raw": [
            not_null("account_id"), unique("account_id"), not_null("customer_id"), references("customer_id", tables["customers_raw"]),
        ],
        "transactions_raw": [not_null("transaction_id"), unique("transaction_id"), not_null("amount"), in_range("amount", 0, 500_000)],
        "credit_data_raw": [not_null("loan_id"), unique("loan_id")],
        "stg_customers": [
            not_null("customer_id"), unique("customer_id"), not_null("kyc_status"), allowed("kyc_status", KYC_STATUS),
            allowed("customer_segment", SEGMENTS), allowed("age_band", AGE_BANDS.labels),
        ],
        "stg_accounts": [
            not_null("account_id"), unique("account_id"), not_null("customer_id"), references("customer_id", tables["stg_customers"]),
            not_null("is_dormant"), not_null("balance_tier"), allowed("balance_tier", BALANCE_TIERS.labels),
        ],
        "stg_transactions": [
            not_null("transaction_id"), unique("transaction_id"), not_null("amount_cad"), not_null("is_large_transaction"),
            allowed("status", TRANSACTION_STATUS),
        ],
        "dim_customer": [
            not_null("customer_sk"), unique("version_sk"), not_null("customer_id"), not_null("is_current"), not_null("effective_from"),
        ],
        "dim_account": [
            not_null("account_sk"), unique("version_sk"), not_null("account_id"), not_null("customer_sk"),
            references("customer_sk", tables["dim_customer"]),
        ],
        "fact_transactions": [
            not_null("transaction_id"), unique("transaction_id"), not_null("account_sk"), references("account_sk", tables["dim_account"]),
            not_null("customer_sk"), references("customer_sk", tables["dim_customer"]),
            not_null("date_sk"), references("date_sk", tables["dim_date"]), not_null("amount_cad"),
        ],
        "kpi_daily_summary": [not_null("summary_date"), unique("summary_date"), in_range("failure_rate_pct", 0, 100)],
    }


def checked(datasets: dict[str, tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """Check results of several datasets in one table, with ``dataset``."""
    results = None
    for name, (df, checks) in datasets.items():
        part = run_checks(df, checks).select(F.lit(name).alias("dataset"), "*")
        results = part if results is None else results.unionByName(part)
    return results


def quality_report(
    dataset: str, df: DataFrame, checks: DataFrame, rules: Rules, quarantined: DataFrame | None = None, approximate: bool = False
) -> DataFrame:
    """One nested row: score, action, all check results and column profiles.

    The lists are as long as the suite and the schema.
    """
    figures = profile(df, approximate)
    profiles = figures.agg(
        F.max("total_count").alias("total_rows"), F.sort_array(F.collect_list(F.struct(*figures.columns))).alias("column_profiles")
    )
    held_back = quarantined.agg(F.count(F.lit(1))).scalar() if quarantined is not None else F.lit(0)
    summary = checks.agg(
        score.score_column().alias("overall_score"),
        F.count_if((F.col("action") == "HALT") & ~F.col("passed")).alias("_halted"),
        F.sort_array(F.collect_list(F.struct(*checks.columns))).alias("checks"),
    )
    report = summary.withColumns({name: profiles.select(name).scalar() for name in ("total_rows", "column_profiles")})
    return report.select(
        F.lit(dataset).alias("dataset_name"),
        F.lit(rules.run_at).alias("run_timestamp"),
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        "overall_score",
        "checks",
        "column_profiles",
        held_back.cast("long").alias("quarantined_rows"),
        score.pipeline_action(F.col("overall_score"), F.col("_halted") > 0, rules).alias("pipeline_action"),
    )
