"""The analyst reports over the star schema.

Distinct counts of customers and accounts are turned into plain counts by
aggregating to one row per customer (and account) first: partial aggregation
absorbs hot keys, and the dimension joins see one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerframe.functions.dates import DAYS_PER_YEAR
from tellerframe.functions.ratios import mean, percent, ratio, share_true


def daily_summary(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Per day: count, volume, average, active accounts, large count, failures."""
    days = dates.select("date_sk", "full_date", "day_of_week")
    amount = F.col("amount_cad")
    return (
        fact.join(days, "date_sk")
        .groupBy("full_date", "day_of_week")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.round(F.sum(amount), 2).alias("total_volume_cad"),
            mean(amount, 2).alias("avg_amount_cad"),
            F.count_distinct("account_sk").alias("active_accounts"),
            F.count_if("is_large_transaction").alias("fintrac_reportable_count"),
            share_true(F.col("status") == "Failed").alias("failure_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("full_date"))
    )


_GROUP = ("customer_segment", "age_band", "province")


def segment_analysis(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, transactions and spend per segment, age band and province."""
    per_customer = fact.groupBy("customer_sk").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cad").alias("spend"), F.count("amount_cad").alias("priced"))
    current = customers.filter("is_current").select("customer_sk", *_GROUP)
    spend = F.sum("spend")
    return (
        per_customer.join(current, "customer_sk")
        .groupBy(*_GROUP)
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("n").alias("total_transactions"),
            F.round(spend, 2).alias("total_spend_cad"),
            ratio(spend, F.sum("priced"), 2).alias("avg_transaction_cad"),
            ratio(spend, F.count(F.lit(1)), 2).alias("avg_spend_per_customer"),
        )
        .orderBy(F.desc_nulls_first("total_spend_cad"))
    )


def dormancy_report(accounts: DataFrame) -> DataFrame:
    """Active accounts by type and tier with their dormancy rate."""
    return (
        accounts.filter(F.col("account_status") == "Active")
        .groupBy("account_type", "balance_tier")
        .agg(
            F.count(F.lit(1)).alias("total_accounts"),
            F.count_if("is_dormant").alias("dormant_accounts"),
            share_true(F.col("is_dormant")).alias("dormancy_rate_pct"),
            mean(F.col("days_since_activity"), 0).alias("avg_days_inactive"),
        )
        .orderBy(F.desc_nulls_first("dormancy_rate_pct"))
    )


def channel_performance(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Channel by month with the change to the channel's previous month.

    The window runs over the aggregate, one row per channel and month.
    """
    days = dates.select("date_sk", "year", "month_number", "month_name")
    monthly = (
        fact.join(days, "date_sk")
        .groupBy("year", "month_number", "month_name", "channel")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.round(F.sum("amount_cad"), 2).alias("volume_cad"),
            mean(F.col("amount_cad"), 2).alias("avg_amount"),
        )
    )
    previous = F.lag("transaction_count").over(Window.partitionBy("channel").orderBy("year", "month_number"))
    return monthly.withColumn(
        "txn_count_mom_pct", percent(F.col("transaction_count") - previous, previous)
    ).orderBy("year", "month_number", F.desc_nulls_first("volume_cad"))


def large_transaction_register(fact: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Completed large transactions with account and customer, greatest first."""
    wanted = fact.filter(F.col("is_large_transaction") & (F.col("status") == "Completed"))
    account = accounts.filter("is_current").select("account_sk", "account_id", "account_type", "currency")
    customer = customers.filter("is_current").select("customer_sk", "customer_id", "customer_segment", "kyc_status", "province")
    return (
        wanted.join(account, "account_sk")
        .join(customer, "customer_sk")
        .select(
            "transaction_id", "transaction_date", "transaction_type", "channel", "amount_cad",
            "account_id", "account_type", "currency", "customer_id", "customer_segment", "kyc_status", "province",
        )
        .orderBy(F.desc_nulls_first("amount_cad"))
    )


def credit_portfolio(credit: DataFrame) -> DataFrame:
    """Loans by rating, type, score band and delinquency bucket."""
    return (
        credit.groupBy("risk_rating", "loan_type", "credit_score_band", "delinquency_bucket")
        .agg(
            F.count(F.lit(1)).alias("loan_count"),
            F.round(F.sum("original_amount"), 2).alias("total_original_cad"),
            F.round(F.sum("outstanding_balance"), 2).alias("total_outstanding_cad"),
            mean(F.col("ltv_ratio"), 4).alias("avg_ltv"),
            mean(F.col("credit_score"), 0).alias("avg_credit_score"),
            F.count_if("is_delinquent").alias("delinquent_count"),
            share_true(F.col("is_delinquent")).alias("delinquency_rate_pct"),
        )
        .orderBy("risk_rating", F.desc_nulls_first("delinquency_rate_pct"))
    )


def lifetime_value(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Average lifetime volume, activity and products per customer group."""
    per_account = (
        fact.filter(F.col("status") == "Completed")
        .groupBy("customer_sk", "account_sk")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount_cad").alias("volume"),
            F.min("transaction_date").alias("first_day"),
            F.max("transaction_date").alias("last_day"),
        )
    )
    per_customer = per_account.groupBy("customer_sk").agg(
        F.sum("n").alias("n"),
        F.round(F.sum("volume"), 2).alias("volume"),
        F.count("account_sk").alias("accounts"),
        F.datediff(F.max("last_day"), F.min("first_day")).alias("active_days"),
    )
    current = customers.filter("is_current").select("customer_sk", *_GROUP)
    return (
        per_customer.join(current, "customer_sk")
        .groupBy(*_GROUP)
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            mean(F.col("volume"), 2).alias("avg_lifetime_value_cad"),
            mean(F.col("n"), 0).alias("avg_txn_count"),
            mean(F.col("accounts"), 1).alias("avg_products_held"),
            ratio(F.sum("active_days"), F.count("active_days") * F.lit(DAYS_PER_YEAR), 1).alias("avg_active_years"),
        )
        .orderBy(F.desc_nulls_first("avg_lifetime_value_cad"))
    )
