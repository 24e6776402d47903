"""Aggregates behind the dashboard views; display order is a rank column."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerframe.functions.banding import (
    AGE_BANDS,
    BALANCE_TIERS,
    CREDIT_SCORE_BANDS,
    DELINQUENCY_BUCKETS,
    RISK_RATINGS,
    label_rank,
)
from tellerframe.functions.ratios import share_true


def _count() -> Column:
    return F.count(F.lit(1)).alias("n")


def _ranked(counts: DataFrame, label: str, labels: Sequence[str], *then: str) -> DataFrame:
    return counts.withColumn("sort_rank", label_rank(F.col(label), labels)).orderBy("sort_rank", label, *then)


def filter_transactions(
    transactions: DataFrame,
    dates: tuple[date, ...] = (),
    channels: Sequence[str] | None = None,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """The dashboard's filter.  As long as only one end of the date range is
    chosen nothing is filtered.  Plain predicates, pushed into the scan."""
    if len(dates) != 2:
        return transactions
    chosen = transactions.filter(F.col("transaction_date").between(*dates))
    if channels is not None:
        chosen = chosen.filter(F.col("channel").isin(*channels))
    if types is not None:
        chosen = chosen.filter(F.col("transaction_type").isin(*types))
    return chosen


def filter_bounds(transactions: DataFrame) -> DataFrame:
    """First and last transaction day."""
    return transactions.agg(F.min("transaction_date").alias("min_date"), F.max("transaction_date").alias("max_date"))


def filter_options(transactions: DataFrame) -> DataFrame:
    """The distinct channels and types on offer, sorted; one pass."""
    offered = F.array(
        F.struct(F.lit("channel").alias("filter"), F.col("channel").alias("option")),
        F.struct(F.lit("transaction_type").alias("filter"), F.col("transaction_type").alias("option")),
    )
    return (
        transactions.groupBy("channel", "transaction_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode(offered).alias("o"))
        .select("o.*")
        .filter("option is not null")
        .distinct()
        .orderBy("filter", "option")
    )


def kpi_cards(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """The headline figures, one row."""
    flow = transactions.agg(
        F.sum("amount_cad").alias("total_volume_cad"),
        F.count(F.lit(1)).alias("transaction_count"),
        share_true(F.col("status") == "Failed", 1).alias("failure_rate_pct"),
        F.count_if("is_large_transaction").alias("large_transactions"),
    )
    active = accounts.agg(F.count_if(F.col("account_status") == "Active")).scalar()
    dormant = accounts.agg(share_true(F.col("is_dormant"), 1)).scalar()
    return flow.withColumns({"active_accounts": active, "dormancy_rate_pct": dormant})


def daily_trend(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("transaction_date").isNotNull())
        .groupBy("transaction_date")
        .agg(F.sum("amount_cad").alias("volume"), F.count("transaction_id").alias("n"))
        .orderBy("transaction_date")
    )


def volume_by_channel(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("channel").isNotNull()).groupBy("channel").agg(F.sum("amount_cad").alias("volume"))


def top_merchants(transactions: DataFrame, k: int = 8) -> DataFrame:
    """The categories with the highest spend."""
    spend = transactions.groupBy(F.col("merchant_category_clean").alias("merchant_category")).agg(
        F.sum("amount_cad").alias("spend")
    )
    return spend.orderBy(F.desc_nulls_last("spend"), "merchant_category").limit(k)


def accounts_by_type(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("account_type").isNotNull()).groupBy("account_type").agg(_count())


def accounts_by_tier(accounts: DataFrame) -> DataFrame:
    counts = accounts.filter(F.col("balance_tier").isNotNull()).groupBy("balance_tier").agg(_count())
    return _ranked(counts, "balance_tier", BALANCE_TIERS.labels)


def deposits_by_province(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Balances by the owner's province; summed per customer before the join."""
    held = accounts.groupBy("customer_id").agg(F.sum("current_balance").alias("held"))
    owners = customers.select("customer_id", F.col("province_code").alias("province"))
    return (
        held.join(owners, "customer_id")
        .groupBy("province")
        .agg(F.sum("held").alias("deposits"))
        .orderBy(F.desc_nulls_first("deposits"), "province")
    )


def customers_by_segment(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("customer_segment").isNotNull()).groupBy("customer_segment").agg(_count())


def customers_by_age_and_segment(customers: DataFrame) -> DataFrame:
    known = customers.filter(F.col("age_band").isNotNull() & F.col("customer_segment").isNotNull())
    counts = known.groupBy("age_band", "customer_segment").agg(_count())
    return _ranked(counts, "age_band", AGE_BANDS.labels, "customer_segment")


def exposure_by_rating(credit: DataFrame) -> DataFrame:
    rated = credit.filter(F.col("risk_rating").isNotNull()).groupBy("risk_rating")
    exposure = rated.agg(F.count("loan_id").alias("loans"), F.sum("outstanding_balance").alias("outstanding"))
    return _ranked(exposure, "risk_rating", RISK_RATINGS)


def loans_by_delinquency(credit: DataFrame) -> DataFrame:
    counts = credit.filter(F.col("delinquency_bucket").isNotNull()).groupBy("delinquency_bucket").agg(_count())
    return _ranked(counts, "delinquency_bucket", DELINQUENCY_BUCKETS.labels)


def loans_by_score_band(credit: DataFrame) -> DataFrame:
    counts = credit.filter(F.col("credit_score_band").isNotNull()).groupBy("credit_score_band").agg(_count())
    return _ranked(counts, "credit_score_band", CREDIT_SCORE_BANDS.labels)
