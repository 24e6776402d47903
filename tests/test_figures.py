"""Exact medians and histograms against brute force on awkward data."""

from __future__ import annotations

import statistics
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tellerframe.operators.histogram import clipped_histogram
from tellerframe.operators.median import exact_median

CENTS = st.integers(-(10**17), 10**17)


def frame(spark, pairs):
    return spark.createDataFrame([(g, None if c is None else Decimal(c).scaleb(-2)) for g, c in pairs], "g string, v decimal(20,2)")


def expected(pairs):
    groups = {}
    for g, c in pairs:
        if c is not None:
            groups.setdefault(g, []).append(Decimal(c).scaleb(-2))
    return {g: (statistics.median(v), len(v)) for g, v in groups.items()}


def test_median_of_skewed_groups(spark):
    pairs = [("hot", 500)] * 400 + [("hot", n) for n in range(700)] + [("b", -99999999_00), ("b", 7), (None, 3), (None, 4), ("c", None)]
    got = {r.g: (r.median, r.n) for r in exact_median(frame(spark, pairs), "v", ["g"]).collect()}
    assert got == expected(pairs)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), CENTS, st.integers(-5, 5))), min_size=1, max_size=40))
def test_median_of_anything(spark, pairs):
    got = {r.g: (r.median, r.n) for r in exact_median(frame(spark, pairs), "v", ["g"]).collect()}
    assert got == expected(pairs)


def test_median_of_whole_table_and_of_nothing(spark):
    df = frame(spark, [("a", 100), ("a", 300)])
    assert exact_median(df, "v").first().median == 2
    assert exact_median(df.limit(0), "v", ["g"]).isEmpty()


def test_median_keeps_the_decimals_of_its_type(spark):
    df = spark.createDataFrame([(Decimal("0.0049"),), (Decimal("0.0040"),)], "v decimal(6,4)")
    assert exact_median(df, "v").first().median == Decimal("0.00445")
    assert exact_median(spark.createDataFrame([(1,), (4,)], "v int"), "v").first().median == Decimal("2.5")
    with pytest.raises(TypeError):
        exact_median(df.select(df.v.cast("double").alias("v")), "v")


def test_histogram_counts_everything_once(spark):
    values = [0, 1, 2, 2, 5, 9, 10, 11, 5000, None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r.bin: (float(r.lower_edge), r.n) for r in clipped_histogram(df, "v", cap=10, bins=5, scale=0).collect()}
    assert got == {0: (0.0, 2), 1: (2.0, 2), 2: (4.0, 1), 3: (6.0, 0), 4: (8.0, 4)}


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(7,), (7,)], "v int")
    assert [r.n for r in clipped_histogram(df, "v", cap=100, bins=4, scale=0).orderBy("bin").collect()] == [0, 0, 2, 0]
