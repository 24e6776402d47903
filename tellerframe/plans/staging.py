"""Raw feeds to typed, cleaned staging rows.

Each function is one projection over its raw frame; only transactions and
loans need a shuffle, for deduplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerframe.config import Rules
from tellerframe.functions.banding import (
    AGE_BANDS,
    BALANCE_TIERS,
    CREDIT_SCORE_BANDS,
    DELINQUENCY_BUCKETS,
    Bands,
    bucketize,
)
from tellerframe.functions.dates import (
    calendar_age,
    days_since,
    months_between,
    parse_date,
    transaction_calendar,
    years_between,
)
from tellerframe.functions.masking import mask_columns
from tellerframe.functions.money import add_cad, is_large, signed
from tellerframe.functions.ratios import ratio
from tellerframe.operators.dedup import dedup_first, dedup_latest, dedup_sparse
from tellerframe.schemas import SOURCE_COLUMNS

_INTERNAL = (*SOURCE_COLUMNS, "_ingest_order")


def _finish(df: DataFrame, rules: Rules) -> DataFrame:
    """Stamp the run and drop what only the source system needs."""
    return df.withColumns(
        {"_transformed_at": F.lit(rules.run_at).try_cast("timestamp"), "_pipeline_version": F.lit(rules.version)}
    ).drop(*_INTERNAL)


def stage_customers(raw: DataFrame, rules: Rules) -> DataFrame:
    """The newest extract of each customer: dates, age, tenure, band, KYC default,
    province code; personal fields masked outside production."""
    single = dedup_latest(raw.filter(F.col("customer_id").isNotNull()), ["customer_id"], "_extract_ts")
    typed = single.withColumns(
        {
            "join_date": parse_date(F.col("join_date")),
            "date_of_birth": parse_date(F.col("date_of_birth")),
            "kyc_status": F.coalesce("kyc_status", F.lit("Unknown")),
            "province_code": F.upper(F.trim("province")),
        }
    )
    derived = typed.withColumns(
        {
            "age_years": calendar_age(F.col("date_of_birth"), rules.as_of),
            "tenure_years": years_between(days_since(F.col("join_date"), rules.as_of)),
        }
    ).withColumn("age_band", bucketize(F.col("age_years"), AGE_BANDS))
    return _finish(mask_columns(derived, environment=rules.environment), rules)


def stage_accounts(raw: DataFrame, rules: Rules, tiers: Bands = BALANCE_TIERS) -> DataFrame:
    """The newest extract of each account: ages, dormancy, tier, overdraft; a
    missing available balance is the current one."""
    balance = F.col("current_balance")
    known = raw.filter(F.col("account_id").isNotNull() & F.col("customer_id").isNotNull())
    typed = dedup_latest(known, ["account_id"], "_extract_ts").withColumns(
        {
            "open_date": parse_date(F.col("open_date")),
            "last_activity_date": parse_date(F.col("last_activity_date")),
            "available_balance": F.coalesce("available_balance", balance),
        }
    )
    derived = typed.withColumns(
        {
            "account_age_days": days_since(F.col("open_date"), rules.as_of),
            "days_since_activity": days_since(F.col("last_activity_date"), rules.as_of),
            "is_overdraft": balance < 0,
            "balance_tier": bucketize(balance, tiers),
        }
    ).withColumn(
        "is_dormant",
        F.coalesce(
            (F.col("account_status") == "Active") & (F.col("days_since_activity") > rules.dormancy_days), F.lit(False)
        ),
    )
    return _finish(derived, rules)


def stage_transactions(
    raw: DataFrame, rules: Rules, keep: str = "latest", keep_version: bool = False, sparse: bool = False
) -> DataFrame:
    """One row per id, CAD and signed amounts, size flag, calendar parts.

    ``keep="latest"`` takes the newest extract of an id, ``"first"`` the row
    read first.  ``sparse`` chooses the deduplication for stored feeds in which
    few ids repeat; it runs a narrow job at once.  Rows without id are dropped before the deduplication, which
    spares it the shuffle of one big null group; rows whose surviving version
    has no account or amount are dropped after it.
    """
    identified = raw.filter(F.col("transaction_id").isNotNull())
    if keep == "first":
        single = dedup_first(identified, ["transaction_id"])
    else:
        dedup = dedup_sparse if sparse else dedup_latest
        single = dedup(identified, ["transaction_id"], "_extract_ts")
    typed = single.filter(F.col("account_id").isNotNull() & F.col("amount").isNotNull()).withColumn(
        "transaction_date", parse_date(F.col("transaction_date"))
    )
    in_cad = add_cad(typed, "amount", "currency", rules)
    derived = in_cad.withColumns(
        {
            "signed_amount_cad": signed(F.col("amount_cad"), F.col("transaction_type")),
            "is_large_transaction": is_large(F.col("amount_cad"), rules),
            "merchant_category_clean": F.coalesce("merchant_category", F.lit("Unclassified")),
            **transaction_calendar(F.col("transaction_date")),
        }
    )
    if keep_version:
        derived = derived.withColumn("extract_ts", F.col("_extract_ts"))
    return _finish(derived, rules)


def stage_credit(raw: DataFrame, rules: Rules, sparse: bool = False) -> DataFrame:
    """Loan age, months to maturity, loan-to-value, score band, delinquency."""
    dedup = dedup_sparse if sparse else dedup_latest
    single = dedup(raw.filter(F.col("loan_id").isNotNull()), ["loan_id"], "_extract_ts")
    typed = single.withColumns(
        {"origination_date": parse_date(F.col("origination_date")), "maturity_date": parse_date(F.col("maturity_date"))}
    )
    overdue = F.col("days_past_due")
    derived = typed.withColumns(
        {
            "loan_age_months": months_between(days_since(F.col("origination_date"), rules.as_of)),
            "months_to_maturity": months_between(-days_since(F.col("maturity_date"), rules.as_of)),
            "ltv_ratio": ratio(F.col("outstanding_balance"), F.col("original_amount"), 4).cast("decimal(18,4)"),
            "credit_score_band": bucketize(F.col("credit_score"), CREDIT_SCORE_BANDS),
            "is_delinquent": F.coalesce(overdue > 0, F.lit(False)),
            "delinquency_bucket": bucketize(overdue, DELINQUENCY_BUCKETS),
        }
    )
    return _finish(derived, rules)
