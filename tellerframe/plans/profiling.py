"""The data-profiling figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerframe.functions.ratios import mean, percent, share_true
from tellerframe.operators.histogram import clipped_histogram
from tellerframe.operators.median import exact_median
from tellerframe.operators.profile import null_shares


def null_percentages(datasets: dict[str, DataFrame]) -> DataFrame:
    """Null percent of every business column of every dataset."""
    report = None
    for name, df in datasets.items():
        part = null_shares(df, name)
        report = part if report is None else report.unionByName(part)
    return report


def median_by_type(transactions: DataFrame) -> DataFrame:
    """Exact median amount per transaction type."""
    typed = transactions.filter(F.col("transaction_type").isNotNull())
    return exact_median(typed, "amount_cad", ["transaction_type"]).select(
        "transaction_type", F.col("median").alias("median_amount_cad")
    )


def amount_histogram(transactions: DataFrame, cap: int = 5_000, bins: int = 60) -> DataFrame:
    return clipped_histogram(transactions, "amount_cad", cap, bins)


def large_amount_histogram(transactions: DataFrame, cap: int = 100_000, bins: int = 30) -> DataFrame:
    return clipped_histogram(transactions.filter("is_large_transaction"), "amount_cad", cap, bins)


def inactivity_histogram(accounts: DataFrame, cap: int = 1_500, bins: int = 50) -> DataFrame:
    return clipped_histogram(accounts, "days_since_activity", cap, bins, scale=0)


def dormancy_by_type(accounts: DataFrame) -> DataFrame:
    """Dormancy rate per account type beside the mean of the group rates."""
    rates = (
        accounts.filter(F.col("account_type").isNotNull())
        .groupBy("account_type")
        .agg(share_true(F.col("is_dormant"), 6).alias("rate"))
    )
    overall = rates.agg(mean(F.col("rate").cast("decimal(18,4)"), 2)).scalar()
    return rates.select("account_type", F.round("rate", 2).alias("dormancy_rate_pct")).withColumn("mean_rate_pct", overall)


def portfolio_summary(transactions: DataFrame, accounts: DataFrame, credit: DataFrame) -> DataFrame:
    """Totals, means and rates of the three portfolios as (dataset, figure, value)."""

    def long(df: DataFrame, name: str, figures: dict) -> DataFrame:
        totals = df.agg(*[expression.alias(figure) for figure, expression in figures.items()])
        rows = [
            F.struct(F.lit(name).alias("dataset"), F.lit(f).alias("figure"), F.col(f).cast("decimal(28,4)").alias("value"))
            for f in figures
        ]
        return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    rows = F.count(F.lit(1))
    balance = F.col("current_balance")
    return (
        long(
            transactions,
            "transactions",
            {
                "records": rows,
                "total_volume_cad": F.sum("amount_cad"),
                "avg_transaction_cad": mean(F.col("amount_cad"), 2),
                "large_transactions": F.count_if("is_large_transaction"),
                "failure_rate_pct": share_true(F.col("status") == "Failed", 1),
            },
        )
        .unionByName(
            long(
                accounts,
                "accounts",
                {
                    "records": rows,
                    "dormancy_rate_pct": share_true(F.col("is_dormant"), 1),
                    "overdraft_rate_pct": percent(F.count_if("is_overdraft"), rows, 1),
                    "total_deposits_cad": F.sum(F.when(balance > 0, balance)),
                },
            )
        )
        .unionByName(
            long(
                credit,
                "credit",
                {
                    "records": rows,
                    "delinquency_rate_pct": share_true(F.col("is_delinquent"), 1),
                    "total_exposure_cad": F.sum("outstanding_balance"),
                    "avg_ltv": mean(F.col("ltv_ratio"), 4),
                },
            )
        )
    )
