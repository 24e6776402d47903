"""Deterministic masking of personal fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
MASK_PREFIX = "MASKED_"
MASK_LENGTH = 12
MASK_MAIL_DOMAIN = "@masked.internal"
PII_COLUMNS = ("first_name", "last_name", "email", "phone", "postal_code")


def _stamp(digest: Column) -> Column:
    return F.concat(F.lit(MASK_PREFIX), F.upper(F.substring(digest, 1, MASK_LENGTH)))


def mask(value: Column) -> Column:
    """SHA-256 mask: equal inputs give equal masks (joins survive), null gives null."""
    return _stamp(F.sha2(value.cast("string"), 256))


def mask_columns(df: DataFrame, columns: Sequence[str] = PII_COLUMNS, environment: str = "dev") -> DataFrame:
    """Mask the listed columns that exist; production keeps its input unchanged."""
    if environment == "prod":
        return df
    return df.withColumns({name: mask(F.col(name)) for name in columns if name in df.columns})


def mask_names_md5(first: Column, last: Column, customer_id: Column, email: Column) -> dict[str, Column]:
    """The MD5 variant: names salted with a neighbour field, mail kept mail-shaped."""
    return {
        "first_name": _stamp(F.md5(F.concat(first, last))),
        "last_name": _stamp(F.md5(F.concat(last, customer_id))),
        "email": F.concat(_stamp(F.md5(email)), F.lit(MASK_MAIL_DOMAIN)),
    }
