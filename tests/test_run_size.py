"""What runs leave on disk and how often they write and read: the figures that grow with the tables."""

from __future__ import annotations

import time
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tellerframe.functions.dates import DAYS_PER_MONTH, months_between
from tellerframe.functions.ratios import ratio
from tellerframe.operators import checks as c
from tellerframe.operators import profile as p
from tellerframe.plans import daily
from tellerframe.registry import queries
from tellerframe.registry.bank import Bank
from tellerframe.sources import storage
from tellerframe.sources.storage import fresh_path


def _tables(spark, folder):
    """Star-schema tables of a few rows: every customer has orders, order 414 a second and later copy."""
    start = datetime(2000, 1, 1)
    orders = [(k, k % 10, "O", 1000.0 + k, start + timedelta(days=k % 90), "1-URGENT") for k in [*range(40), 414]]
    lines = [(k, k % 7, k % 3, n, 5.0, 100.0 + k, 0.0, 0.0, "N", "O", start) for k in range(20) for n in (1, 1, 2)]
    customers = [(k, f"Customer {k}", 0, 10.0 * k, "BUILDING" if k % 2 else "AUTOMOBILE") for k in range(10)]
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    write(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", "orders")
    write(
        lines,
        """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,
           l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp""",
        "lineitem",
    )
    write(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", "customer")
    write([(0, "CANADA", 1)], "n_nationkey int, n_name string, n_regionkey int", "nation")
    return folder


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark):
    before = _shuffle_files(spark)
    with storage.shuffles_removed(spark):
        kept = storage.materialize(spark.range(1000).repartition(5, "id"), "shuffled")
        for _ in range(50):
            if not _shuffle_files(spark) - before:
                break
            time.sleep(0.2)
        assert not _shuffle_files(spark) - before
        assert kept.groupBy("id").count().count() == 1000
    assert spark.conf.get(storage._SHUFFLE_CLEANUP, "false") == "false"


def test_two_days_write_once_and_keep_their_tables_only(spark, monkeypatch):
    """On the first day transactions, facts and counts of months go to their tables alone; at the end nothing but the run's tables is left."""
    folder = _tables(spark, fresh_path(spark, "tables"))
    written, materialize = [], daily.materialize
    monkeypatch.setattr(daily, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    with storage.working(spark):
        own = storage._WORKING.get()
        layout = queries._run_repeated_days(Bank(spark, folder))
        location, files = storage._hadoop(spark, own)
        assert [s.getPath().toString().endswith(layout.root) for s in files.listStatus(location)] == [True]
        first = written[: written.index("arrived")]
        assert "fact-batch" not in first and "day-holders" in first and "customer-months" not in written
        read = lambda layer, name: spark.read.parquet(layout.table(layer, name))
        fact, kpi = read("marts", "fact_transactions"), read("metrics", "kpi_daily_summary")
        assert read("staging", "stg_transactions").count() == fact.select("transaction_id").distinct().count() == fact.count() == 39
        assert [r.amount_cad for r in fact.filter("amount_cad > 1400").collect()] == [Decimal("1415.00")]
        assert kpi.agg(F.sum("transaction_count")).first()[0] == 39
        months = read("metrics", "kpi_customer_segment").groupBy("customer_segment").agg(F.sum("total_transactions").alias("n"))
        current = read("marts", "dim_customer").filter("is_current").select("customer_sk", "customer_segment")
        expected = fact.join(current, "customer_sk").groupBy("customer_segment").count()
        assert {tuple(r) for r in months.collect()} == {tuple(r) for r in expected.collect()}


def test_samples_are_sought_among_few_cells(spark):
    """Rows come largest value first, so the first rows bound little; all samples are those of a full search."""
    n = 3 * p.HEAD
    rows = spark.range(n, numPartitions=1).select(
        F.format_string("%06d", n - F.col("id")).alias("falling"), F.format_string("%06d", F.col("id")).alias("rising"),
        (F.col("id") % 3).cast("string").alias("few"), F.lit(None).cast("string").alias("none"), F.when(F.col("id") > n - 8, F.col("id")).alias("late"),
    )
    rows = storage.materialize(rows, "profiled")
    found = {r.column_name: r.sample_values for r in p.profile(rows).collect()}
    values = {name: sorted({str(r[0]) for r in rows.select(name).distinct().collect() if r[0] is not None})[: p.SAMPLES] for name in rows.columns}
    assert found == values
    cells = p._cells(rows.select("rising")).filter("_v is not null").distinct()
    assert p._candidates(cells, rows.select("rising")).count() <= p.HEAD


def test_offenders_are_read_from_the_counts_of_the_results(spark):
    """The rows and the reference are read once for uniqueness, references and the orphans named."""
    rows = storage.materialize(spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "x"), (None, "y")], "id int, ref string"), "rows")
    reference = storage.materialize(spark.createDataFrame([("a",), ("b",), (None,)], "ref string"), "reference")
    suite = [c.unique("id"), c.references("ref", reference)]
    named = c.with_samples(c.run_checks(rows, suite), rows, suite)
    result = {r.check_name: (r.failed_count, r.details) for r in named.collect()}
    assert result == {"unique_id": (1, "1 duplicate rows detected"), "referential_integrity_ref": (2, "Orphan keys: x, y")}
    plan = named._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 2


def test_whole_months_equal_the_decimal_quotient(spark):
    days = spark.range(-40_000, 40_000).select(F.col("id").cast("int").alias("d"))
    other = ratio(F.col("d"), F.lit(DAYS_PER_MONTH), 0).cast("int")
    assert days.filter(~months_between(F.col("d")).eqNullSafe(other)).isEmpty()
    assert spark.sql("select cast(null as int) as d").select(months_between(F.col("d"))).first()[0] is None
