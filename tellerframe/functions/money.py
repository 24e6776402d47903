"""Currency, sign and size of amounts, all in DECIMAL(18,2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerframe.config import Rules

MONEY = "decimal(18,2)"
# ---- fixed values ----------------------------------------------------------
OUTGOING_TYPES = ("Debit", "ATM Withdrawal", "Bill Payment")


def to_cad(amount: Column, currency: Column, rules: Rules) -> Column:
    """Amount in CAD, half-up to the cent; currencies without a rate pass through."""
    rate = F.lit(None)
    for code, value in rules.fx_to_cad.items():
        rate = F.when(currency == code, F.lit(value)).otherwise(rate)
    return F.coalesce(F.round(amount * rate, 2).cast(MONEY), amount.cast(MONEY))


def add_cad(df: DataFrame, amount: str, currency: str, rules: Rules) -> DataFrame:
    """``<amount>_cad`` beside the original column."""
    return df.withColumn(f"{amount}_cad", to_cad(F.col(amount), F.col(currency), rules))


def add_cad_from_rates(df: DataFrame, amount: str, currency: str, rates: DataFrame) -> DataFrame:
    """The same with a rate table (currency, rate_to_cad) instead of constants.

    The rate table holds one row per currency; Catalyst broadcasts it by its
    file size.
    """
    joined = df.join(rates.select(F.col("currency").alias(currency), "rate_to_cad"), currency, "left")
    in_cad = F.round(F.col(amount) * F.col("rate_to_cad"), 2).cast(MONEY)
    return joined.withColumn(f"{amount}_cad", F.coalesce(in_cad, F.col(amount).cast(MONEY))).drop("rate_to_cad")


def signed(amount: Column, transaction_type: Column) -> Column:
    """Outgoing types are negative cash flow."""
    return F.when(transaction_type.isin(*OUTGOING_TYPES), -amount).otherwise(amount).cast(MONEY)


def is_large(amount_cad: Column, rules: Rules) -> Column:
    """Reportable size, judged on the rounded CAD amount."""
    return F.coalesce(amount_cad >= F.lit(rules.large_amount), F.lit(False))
