from __future__ import annotations

import hashlib
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tellerframe.functions.banding import (
    AGE_BANDS,
    BALANCE_TIERS,
    CREDIT_SCORE_BANDS,
    DELINQUENCY_BUCKETS,
    Bands,
    bucketize,
    label_rank,
)
from tellerframe.functions.dates import calendar_age, months_between, parse_date, years_between
from tellerframe.functions.keys import business_id, surrogate_key
from tellerframe.functions.masking import mask, mask_columns
from tellerframe.functions.money import add_cad, is_large
from tellerframe.functions.ratios import mean, percent, ratio


def banded(spark, values, bands):
    df = spark.createDataFrame([(i, Decimal(str(v)) if v is not None else None) for i, v in enumerate(values)], "i int, v decimal(18,2)")
    return [r[0] for r in df.orderBy("i").select(bucketize(F.col("v"), bands)).collect()]


@pytest.mark.parametrize(
    ("bands", "cases"),
    [
        (BALANCE_TIERS, {-0.01: "Negative", 0: "Under $1K", 999.99: "Under $1K", 1000: "$1K-$10K", 100000: "Over $100K", None: None}),
        (BALANCE_TIERS.right_closed(), {0: "Negative", 0.01: "Under $1K", 1000: "Under $1K", 1000.01: "$1K-$10K"}),
        (AGE_BANDS, {18: "18-25", 25: "18-25", 26: "26-35", 50: "36-50", 65: "51-65", 66: "65+", None: None}),
        (
            CREDIT_SCORE_BANDS,
            {0: None, 1: "Poor (<580)", 579: "Poor (<580)", 580: "Fair (580-669)", 780: "Very Good (740-799)", 900: "Excellent (800+)", 901: None},
        ),
        (
            DELINQUENCY_BUCKETS,
            {-1: None, 0: "Current", 1: "1-30 DPD", 30: "1-30 DPD", 31: "31-60 DPD", 180: "91-180 DPD", 181: "180+ DPD", None: None},
        ),
    ],
)
def test_band_edges(spark, bands, cases):
    assert banded(spark, list(cases), bands) == list(cases.values())


def test_bands_reject_nonsense():
    with pytest.raises(ValueError):
        Bands(("a",), (1, 2))
    with pytest.raises(ValueError):
        Bands(("a", "b"), (2, 1))
    with pytest.raises(ValueError):
        Bands(("a",), (1,), closed="middle")


def test_label_rank_puts_unknown_last(spark):
    df = spark.createDataFrame([("b",), ("a",), ("x",), (None,)], "v string").withColumn("r", label_rank(F.col("v"), ("a", "b")))
    assert {r.v: r.r for r in df.collect()} == {"a": 0, "b": 1, "x": 2, None: 2}


def test_mask_is_deterministic_and_null_safe(spark):
    df = spark.createDataFrame([("John",), ("John",), (None,)], "v string").select(mask(F.col("v")).alias("m"))
    expected = "MASKED_" + hashlib.sha256(b"John").hexdigest()[:12].upper()
    assert [r.m for r in df.collect()] == [expected, expected, None]


def test_masking_skips_absent_columns_and_production(spark):
    df = spark.createDataFrame([("John", "x")], "first_name string, other string")
    masked = mask_columns(df, ["first_name", "nothing"]).first()
    assert masked.first_name.startswith("MASKED_") and masked.other == "x"
    assert mask_columns(df, ["first_name"], "prod").first().first_name == "John"


def test_currency(spark, rules):
    df = spark.createDataFrame(
        [("USD", Decimal("9000")), ("CAD", Decimal("9000")), ("USD", Decimal("7352.94")), ("USD", None), (None, Decimal("5"))],
        "currency string, amount decimal(18,2)",
    )
    out = add_cad(df, "amount", "currency", rules).withColumn("large", is_large(F.col("amount_cad"), rules)).collect()
    assert [r.amount_cad for r in out] == [Decimal("12240.00"), Decimal("9000.00"), Decimal("10000.00"), None, Decimal("5.00")]
    assert [r.large for r in out] == [True, False, True, False, False]
    assert out[0].amount == Decimal("9000.00")


@pytest.mark.parametrize(
    ("born", "as_of", "age"),
    [
        ("2004-02-29", date(2025, 2, 28), 20),
        ("2004-02-29", date(2025, 3, 1), 21),
        ("2000-06-30", date(2024, 6, 30), 24),
        ("2000-07-01", date(2024, 6, 30), 23),
        ("unknown", date(2024, 6, 30), None),
    ],
)
def test_calendar_age(spark, born, as_of, age):
    df = spark.createDataFrame([(born,)], "b string").select(calendar_age(parse_date(F.col("b")), as_of))
    assert df.first()[0] == age


def test_spans_round_half_up(spark):
    df = spark.createDataFrame([(0,), (365,), (-100,), (3653,)], "d int")
    assert [r[0] for r in df.select(years_between(F.col("d"))).collect()] == [Decimal("0.0"), Decimal("1.0"), Decimal("-0.3"), Decimal("10.0")]
    assert [r[0] for r in df.select(months_between(F.col("d"))).collect()] == [0, 12, -3, 120]


def test_ids_are_padded_and_never_cut(spark):
    df = spark.createDataFrame([(7,), (123456789012,)], "n long").select(business_id("TXN", F.col("n"), 10).alias("id"))
    assert [r.id for r in df.collect()] == ["TXN0000000007", "TXN123456789012"]


def test_surrogate_key_of_one_column_is_its_md5(spark):
    df = spark.createDataFrame([("CUST1",), (None,)], "k string").select(surrogate_key(F.col("k")).alias("sk")).collect()
    assert df[0].sk == hashlib.md5(b"CUST1").hexdigest()
    assert df[1].sk is not None and df[1].sk != df[0].sk


@settings(max_examples=25, deadline=None)
@given(st.integers(-(10**15), 10**15), st.integers(0, 10**9))
def test_ratio_is_exact_half_up(spark, numerator, denominator):
    from decimal import ROUND_HALF_UP

    df = spark.createDataFrame([(numerator, denominator)], "a long, b long")
    got = df.select(ratio(F.col("a"), F.col("b"), 2), percent(F.col("b"), F.col("b"))).first()
    if denominator == 0:
        assert got[0] is None and got[1] is None
    else:
        exact = Decimal(numerator) / Decimal(denominator)
        assert got[0] == exact.quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[1] == 100


def test_mean_ignores_nulls(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),), (None,)], "v decimal(18,2)")
    assert df.agg(mean(F.col("v"), 2)).first()[0] == Decimal("0.02")
