"""Surrogate and business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the key parts: no sequence, hence no shuffle and no coordination."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_KEY_TOKEN)) for p in parts]))


def zero_pad(number: Column, width: int) -> Column:
    """Left-pad with zeros; longer numbers are kept whole (a plain lpad would cut them)."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def business_id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), zero_pad(number, width))
