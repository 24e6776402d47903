"""Profiles merged from stored days against the data's own figures."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tellerframe.operators import sketches
from tellerframe.sources.storage import fresh_path

DAYS = [date(2024, 1, d) for d in range(1, 11)]


@pytest.fixture(scope="module")
def data(spark):
    """Ten days; amounts of the last two are higher and half of their names are missing."""
    late = F.col("id") % 10 >= 8
    return spark.range(40_000).select(
        F.date_add(F.lit(DAYS[0]), (F.col("id") % 10).cast("int")).alias("day"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100 + F.when(late, 900).otherwise(0)).cast("decimal(18,2)").alias("amount"),
        F.when(~late | (F.col("id") % 20 < 10), F.concat(F.lit("n"), F.pmod(F.xxhash64("id"), F.lit(3_000)))).alias("name"),
        F.lit(None).cast("double").alias("nothing"),
    )


@pytest.fixture(scope="module")
def stored(spark, data):
    path = fresh_path(spark, "day-profiles")
    for day in [*DAYS, DAYS[3]]:  # one day twice
        sketches.store_day(data.filter(F.col("day") == F.lit(day)).drop("day"), "payments", day, path)
    return spark.read.parquet(path)


def by_column(df):
    return {r.column_name: r for r in df.collect()}


def test_range_of_days(stored, data):
    first, last = DAYS[2], DAYS[6]
    found = by_column(sketches.summarised(sketches.merged(stored, first, last)))
    own = data.filter(F.col("day").between(F.lit(first), F.lit(last)))
    exact = own.agg(
        F.count("*").alias("n"), F.min("amount").alias("least"), F.max("amount").alias("most"),
        F.round(F.sum("amount") / F.count("amount"), 4).alias("mean"),
        F.count_distinct("name").alias("names"), F.percentile("amount", 0.5).alias("median"),
    ).first()
    amount = found["amount"]
    assert (amount.total_count, amount.null_count, amount.min_value, amount.max_value) == (exact.n, 0, exact.least, exact.most)
    assert amount.mean_value == Decimal(exact.mean).quantize(Decimal("0.0001"))
    assert abs(found["name"].unique_count - exact.names) <= 0.05 * exact.names
    below = own.filter(F.col("amount") <= amount.median).count() / exact.n
    assert abs(below - 0.5) < 0.03
    assert found["nothing"].null_count == exact.n and found["nothing"].unique_count == 0 and found["nothing"].median is None


def test_all_days_are_those_of_one_scan(stored, data):
    once = by_column(sketches.merged(sketches.sketch_days(data.drop("day"), "payments", F.lit(DAYS[0]))))
    merged = by_column(sketches.merged(stored))
    for name, row in once.items():
        for figure in ("dtype", "total_count", "null_count", "number_count", "min_value", "max_value", "sum_value"):
            assert merged[name][figure] == row[figure]


def test_drift(stored):
    early, middle, late = (sketches.merged(stored, *span) for span in ((DAYS[0], DAYS[3]), (DAYS[4], DAYS[7]), (DAYS[8], DAYS[9])))
    assert not any(r.drifted for r in sketches.drift(early, middle).collect())
    found = by_column(sketches.drift(early, late))
    assert found["amount"].drifted and found["amount"].distance > 0.8 and 850 < found["amount"].mean_shift < 950
    assert found["name"].drifted and found["name"].distance is None and found["name"].null_share_change == 0.5
    assert not found["nothing"].drifted


def test_column_of_one_side(spark, data):
    one, two = (sketches.merged(sketches.sketch_days(df, "d", F.lit(DAYS[0]))) for df in (data.select("amount"), data.select("name")))
    found = by_column(sketches.drift(one, two))
    assert (found["amount"].other_count, found["name"].base_count) == (0, 0) and found["amount"].distance is None


def test_values_that_are_no_numbers(spark):
    odd = spark.sql("select explode(array(double('nan'), double('inf'), -0.0d, 0.0d, 1.5d, null)) as v")
    row = sketches.summarised(sketches.merged(sketches.sketch_days(odd, "d", F.lit(DAYS[0])))).first()
    assert (row.total_count, row.null_count, row.unique_count) == (6, 1, 4)
    assert (row.min_value, row.max_value) == (0, Decimal("1.5"))


def test_empty(spark):
    assert sketches.merged(sketches.sketch_days(spark.createDataFrame([], "v int"), "d", F.lit(DAYS[0]))).filter("total_count > 0").isEmpty()
