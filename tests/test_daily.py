from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tellerframe.plans import daily, governance
from tellerframe.registry.bank import RULES, Bank
from tellerframe.schemas import RAW_ACCOUNTS
from tellerframe.sinks import tables
from tellerframe.sources.storage import fresh_path, materialize, working

TABLES = "/root/testdata/sf0.001"


def test_two_days(spark):
    """A second day with one changed customer keeps history and doubles nothing."""
    bank, root = Bank(spark, TABLES), fresh_path(spark, "days")
    first = {r.dataset: r.row_count for r in daily.run_day(spark, bank.feeds, root, RULES).collect()}
    changed = F.when(F.col("customer_id") == "CUST0000007", "Affluent").otherwise(F.col("customer_segment"))
    feeds = {**bank.feeds, "customers_raw": bank.raw_customers.withColumn("customer_segment", changed)}
    next_day = replace(RULES, as_of=date(2026, 8, 3))
    second = {r.dataset: r.row_count for r in daily.run_day(spark, feeds, root, next_day).collect()}
    assert second["fact_transactions"] == first["fact_transactions"]
    assert second["kpi_daily_summary"] == first["kpi_daily_summary"]
    customers = spark.read.parquet(f"{root}/marts/dim_customer")
    versions = customers.filter("customer_id = 'CUST0000007'").orderBy("effective_from").collect()
    assert [(v.is_current, v.effective_to) for v in versions] == [(False, date(2026, 8, 3)), (True, None)]
    assert customers.filter("is_current").count() == first["dim_customer"]
    assert spark.read.json(f"{root}/quality_reports").count() == 8
    tested = spark.read.parquet(f"{root}/governance/model_tests")
    assert tested.select("run_date").distinct().count() == 2 and tested.filter("dataset = 'fact_transactions' and not passed and check_name like 'unique%'").isEmpty()
    assert spark.read.parquet(f"{root}/governance/data_catalog").count() == 4


def test_newest_extract_and_late_rows(spark):
    """The newest of repeated ids wins; late rows and moved days are in the fact; a repeated day doubles nothing."""
    bank, root = Bank(spark, TABLES), fresh_path(spark, "days")
    transactions = materialize(bank.raw_transactions, "transactions")
    old = transactions.filter("transaction_date is not null and amount is not null and account_id is not null").orderBy("transaction_date").first()
    feeds = {**bank.feeds, "transactions_raw": transactions.filter(F.col("transaction_id") != old.transaction_id)}
    daily.run_day(spark, feeds, root, RULES)
    fact = lambda: spark.read.parquet(f"{root}/marts/fact_transactions")
    repeated = transactions.groupBy("transaction_id").agg(F.count("*").alias("n"), F.max("_extract_ts").alias("newest")).filter("n > 1")
    stored = spark.read.parquet(f"{root}/staging/stg_transactions").join(repeated, "transaction_id").select("extract_ts", "newest").collect()
    assert stored and all(r.extract_ts == r.newest for r in stored)

    other = fact().filter(F.col("transaction_id") != old.transaction_id).orderBy("transaction_id").first()
    moved = transactions.filter(F.col("transaction_id") == other.transaction_id).withColumns(
        {"transaction_date": F.lit("2031-05-05"), "_extract_ts": F.lit("2026-08-04T00:00:00")}
    )
    late = transactions.filter(F.col("transaction_id") == old.transaction_id).unionByName(moved)
    rest = transactions.filter(F.col("transaction_id") > "TXN0000000500").limit(200)
    next_day = replace(RULES, as_of=date(2026, 8, 5))
    counts = []
    for _ in range(2):
        daily.run_day(spark, {**bank.feeds, "transactions_raw": materialize(late.unionByName(rest), "late")}, root, next_day)
        kpis = spark.read.parquet(f"{root}/metrics/kpi_daily_summary")
        counts.append((fact().count(), kpis.agg(F.sum("transaction_count")).first()[0], spark.read.option("header", True).csv(f"{root}/quarantine").count()))
    assert fact().filter(F.col("transaction_id") == old.transaction_id).count() == 1
    assert [r.transaction_date for r in fact().filter(F.col("transaction_id") == other.transaction_id).collect()] == [date(2031, 5, 5)]
    assert fact().filter("date_sk is null and transaction_date is not null").count() == 0
    assert counts[0] == counts[1] and counts[0][0] == counts[0][1]


def test_repeated_customers_do_not_multiply_facts(spark):
    from tellerframe.plans import staging

    bank = Bank(spark, TABLES)
    raw = bank.raw_customers
    bank.raw_customers = raw.unionByName(raw.withColumns({"_extract_ts": F.lit("2026-08-09"), "customer_segment": F.lit("Affluent")}))
    bank.raw_accounts = bank.raw_accounts.unionByName(bank.raw_accounts)
    assert bank.fact.count() == bank.fact.select("transaction_id").distinct().count() > 0
    assert {r[0] for r in staging.stage_customers(bank.raw_customers, RULES).select("customer_segment").distinct().collect()} == {"Affluent"}


def test_drifted_feed_halts(spark):
    bank, root = Bank(spark, TABLES), fresh_path(spark, "days")
    with pytest.raises(daily.SchemaDrift, match="accounts_raw"):
        daily.run_day(spark, {**bank.feeds, "accounts_raw": bank.raw_accounts.drop("branch_id")}, root, RULES)
    assert daily.read_optional(spark, f"{root}/staging/stg_accounts") is None


def test_gate_halts(spark):
    bank, root = Bank(spark, TABLES), fresh_path(spark, "days")
    broken = {**bank.feeds, "transactions_raw": bank.raw_transactions.withColumn("account_id", F.lit(None).cast("string"))
              .withColumn("amount", F.lit(None).cast("decimal(18,2)")).withColumn("transaction_id", F.lit(None).cast("string"))
              .withColumn("transaction_date", F.lit(None).cast("string"))}
    with pytest.raises(daily.QualityHalt):
        daily.run_day(spark, broken, root, RULES)
    assert daily.read_optional(spark, f"{root}/staging/stg_transactions") is None


def test_schema_drift(spark):
    df = spark.createDataFrame([], RAW_ACCOUNTS)
    assert not governance.has_drifted(df, RAW_ACCOUNTS)
    drifted = df.drop("branch_id").withColumn("interest_rate", F.lit("x")).withColumn("extra", F.lit(1))
    assert governance.has_drifted(drifted, RAW_ACCOUNTS)
    found = {r.column_name: r.status for r in governance.schema_drift(drifted, RAW_ACCOUNTS).collect() if r.status != "ok"}
    assert found == {"branch_id": "missing", "interest_rate": "type", "extra": "extra"}


def test_retention_edges(spark):
    df = spark.createDataFrame([(date(2017, 6, 30),), (date(2017, 6, 29),), (None,)], "day date")
    kept, expired = governance.split_by_retention(df, "day", "transactions", date(2024, 6, 30))
    assert kept.count() == 2 and [r.day for r in expired.collect()] == [date(2017, 6, 29)]


def test_archive(spark):
    path = fresh_path(spark, "archive")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2001, 1, 1))], "id int, day date")
    for _ in range(2):
        assert governance.archive_expired(df, "day", "transactions", date(2024, 6, 30), path, ["id"]).count() == 1
    assert spark.read.parquet(f"{path}/transactions").count() == 1


def test_whole_months_are_archived_once(spark):
    path, archive = fresh_path(spark, "table"), fresh_path(spark, "archive")
    rows = [("a", date(2017, 5, 31)), ("b", date(2017, 6, 1)), ("c", date(2017, 6, 30)), ("d", None), ("e", date(2016, 1, 1))]
    tables.write_by_month(spark.createDataFrame(rows, "id string, day date"), path, "day", ())
    run = lambda: governance.archive_months(spark, path, archive, "transactions", date(2024, 6, 30), ["id"])
    ids = lambda folder: sorted(r.id for r in spark.read.parquet(folder).collect())
    assert run() == [201601, 201705] and run() == []
    assert (ids(path), ids(archive)) == (["b", "c", "d"], ["a", "e"])
    # a month that is in the archive already: an archived row again, and a late one
    again = spark.createDataFrame([("a", date(2017, 5, 31)), ("f", date(2017, 5, 2))], "id string, day date")
    tables.write_by_month(again, path, "day", ())
    assert run() == [201705]
    assert (ids(path), ids(archive)) == (["b", "c", "d"], ["a", "e", "f"])
    assert governance.archive_months(spark, fresh_path(spark, "none"), archive, "transactions", date(2024, 6, 30), ["id"]) == []


def test_failed_model_tests_stop(spark):
    row = lambda dataset, dimension, passed: (dataset, "c", dimension, passed)
    make = lambda *rows: spark.createDataFrame(rows, "dataset string, check_name string, dimension string, passed boolean")
    sound = [row("fact_transactions", "Uniqueness", True), row("transactions_raw", "Uniqueness", False), row("dim_account", "Completeness", False)]
    daily.stop_on_failures(make(*sound), daily.BLOCKING)
    with pytest.raises(daily.ModelTestFailure, match="dim_account.c"):
        daily.stop_on_failures(make(*sound), ("Completeness",))
    with pytest.raises(daily.ModelTestFailure, match="fact_transactions.c"):
        daily.stop_on_failures(make(row("fact_transactions", "Uniqueness", False)), daily.BLOCKING)


def test_run_of_landed_files(spark):
    """Corrupt rows are kept as text by run day; the run goes on with the others, and archives what is past retention."""
    bank, folder, root = Bank(spark, TABLES), fresh_path(spark, "landing"), fresh_path(spark, "days")
    for name, df in bank.feeds.items():
        df = df.drop("_ingest_order")
        if name == "transactions_raw":
            df = df.withColumn("amount", F.when(F.col("transaction_id").endswith("77"), "n/a").otherwise(F.col("amount").cast("string")))
        tables.write_landing_csv(df, f"{folder}/{name}.csv")
    broken = bank.raw_transactions.filter(F.col("transaction_id").endswith("77")).count()
    late = replace(RULES, as_of=date(2031, 1, 15))
    daily.run_landed(spark, folder, root, late)
    text = spark.read.parquet(f"{root}/quarantine_text")
    assert broken and text.filter("dataset = 'transactions_raw' and run_date = '2031-01-15'").count() == broken
    fact, archived = (spark.read.parquet(f"{root}/{layer}/fact_transactions") for layer in ("marts", "archive"))
    assert archived.count() > 0 and archived.filter("transaction_date >= '2024-01-01'").isEmpty()
    assert fact.filter("transaction_date < '2024-01-01'").isEmpty()
    ids = fact.select("transaction_id").unionByName(archived.select("transaction_id"))
    kpis = spark.read.parquet(f"{root}/metrics/kpi_daily_summary").agg(F.sum("transaction_count")).first()[0]
    assert ids.count() == ids.distinct().count()
    # days that were past retention when they arrived have no KPI rows
    assert kpis == fact.count()


def test_month_gap_compares_with_the_previous_row(spark):
    from decimal import Decimal

    from tellerframe.plans import marts, reports

    days = [date(2024, 1, 5)] * 2 + [date(2024, 3, 5)] * 3
    fact = spark.createDataFrame([(int(d.strftime("%Y%m%d")), "ATM", Decimal("1")) for d in days], "date_sk int, channel string, amount_cad decimal(18,2)")
    growth = [r.txn_count_mom_pct for r in reports.channel_performance(fact, marts.dim_date(spark)).collect()]
    assert growth == [None, Decimal("50.00")]


def test_stored_reports_hold_exact_profiles(spark):
    bank, root = Bank(spark, TABLES), fresh_path(spark, "reports")
    feeds = {name: materialize(df, name) for name, df in bank.feeds.items()}
    with working(spark):
        daily.validate(feeds, daily.Layout(root), RULES)
    df = feeds["customers_raw"]
    expected = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    report = spark.read.json(f"{root}/quality_reports").filter("dataset_name = 'customers_raw'").first()
    assert {p.column_name: p.unique_count for p in report.column_profiles} == expected
