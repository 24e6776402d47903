"""Star schema: date, customer, account and merchant dimensions, one fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerframe.config import Rules
from tellerframe.functions.dates import calendar_attributes
from tellerframe.operators.history import load_history, merge_history, start_history

# ---- fixed values ----------------------------------------------------------
FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2030, 12, 30)

FACT_CLUSTER = ("account_sk", "customer_sk")
CUSTOMER_TRACKED = ("customer_segment", "kyc_status", "province", "age_band", "is_active")
ACCOUNT_TRACKED = (
    "account_type", "account_status", "currency", "balance_tier", "branch_id", "is_dormant", "is_overdraft", "open_date",
)


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day of a fixed span."""
    days = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")
    return spark.range(1).select(days).select(*[e.alias(n) for n, e in calendar_attributes(F.col("day")).items()])


def dim_merchant(categories: DataFrame, rules: Rules) -> DataFrame:
    """Numbered categories.  The window has one partition on purpose: the seed
    is a hand-kept list of a dozen rows."""
    return categories.select(
        F.row_number().over(Window.orderBy("merchant_category")).alias("merchant_sk"),
        "merchant_category",
        "category_group",
        "is_essential",
        F.lit(rules.run_at).try_cast("timestamp").alias("_loaded_at"),
    )


def customer_attributes(staged: DataFrame) -> DataFrame:
    """What the customer dimension holds; no personal field among it."""
    return staged.select(
        "customer_id", "customer_segment", "kyc_status", F.col("province_code").alias("province"), "age_band", "tenure_years", "is_active"
    )


def account_attributes(staged: DataFrame, customers: DataFrame, as_of: date | None = None) -> DataFrame:
    """Account columns with the key of their customer, if it is known; on ``as_of``, if given, else now."""
    known = customers.filter("is_current" if as_of is None else F.col("effective_from") <= F.lit(as_of)).select("customer_id", "customer_sk")
    return staged.join(known if as_of is None else known.distinct(), "customer_id", "left").select(
        "account_id", "customer_sk", "account_type", "account_status", "currency", "balance_tier", "branch_id",
        "is_dormant", "is_overdraft", "open_date",
    )


def dim_customer(staged: DataFrame, rules: Rules, previous: DataFrame | None = None, log: str | None = None) -> DataFrame:
    """Customer versions after this load; without ``previous`` the first load.  With the path of a log of loads,
    loads may come in any order and again."""
    return _dimension(customer_attributes(staged), "customer_id", "customer_sk", CUSTOMER_TRACKED, rules, previous, log)


def dim_account(
    staged: DataFrame, customers: DataFrame, rules: Rules, previous: DataFrame | None = None, log: str | None = None
) -> DataFrame:
    """Account versions after this load; a load out of order follows that of its day's customers."""
    attributes = account_attributes(staged, customers, rules.as_of if log else None)
    return _dimension(attributes, "account_id", "account_sk", ("customer_sk", *ACCOUNT_TRACKED), rules, previous, log)


def _dimension(
    attributes: DataFrame, key: str, sk: str, tracked: tuple[str, ...], rules: Rules, previous: DataFrame | None, log: str | None
) -> DataFrame:
    if log:
        return load_history(previous, attributes, key, sk, tracked, rules.as_of, log)
    if previous is None:
        return start_history(attributes, key, sk, rules.as_of)
    return merge_history(previous, attributes, key, sk, tracked, rules.as_of)


def fact_transactions(
    transactions: DataFrame, accounts: DataFrame, dates: DataFrame, merchants: DataFrame, rules: Rules
) -> DataFrame:
    """One row per transaction with a known account.

    The account join is the one shuffle; accounts are unique, so a hot account
    skews only the transaction side, which adaptive execution splits.  Dates
    and merchants carry no hint: Catalyst knows their size, from literals or
    from files, and broadcasts them while they are small.
    """
    current = accounts.filter("is_current").select("account_id", "account_sk", "customer_sk")
    days = dates.select("date_sk", F.col("full_date").alias("transaction_date"))
    categories = merchants.select("merchant_sk", F.col("merchant_category").alias("merchant_category_clean"))
    return (
        transactions.filter(F.col("transaction_id").isNotNull() & F.col("amount_cad").isNotNull())
        .join(current, "account_id")
        .join(days, "transaction_date", "left")
        .join(categories, "merchant_category_clean", "left")
        .select(
            "transaction_id", "account_sk", "customer_sk", "date_sk", "merchant_sk", "transaction_type", "channel", "status",
            "amount_cad", "signed_amount_cad", "is_large_transaction", "is_weekend", "transaction_date",
            F.lit(rules.run_at).try_cast("timestamp").alias("_loaded_at"),
        )
    )
