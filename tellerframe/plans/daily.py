"""One day from raw feeds to KPI tables, as functions over one folder of tables.

Every stage ends in a written table and the next one reads it, so plans stay
short and a failed stage is repeated without its predecessors.  The clean
transactions of the quality stage are what staging reads.  What arrived, not
its date, decides what is loaded: the arrived ids and the days they had or have
drive the fact and the KPI tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerframe.config import Rules
from tellerframe.operators import score, uniques
from tellerframe.operators.checks import run_checks, with_samples
from tellerframe.operators.quarantine import quarantine
from tellerframe.operators.upsert import matching
from tellerframe.plans import governance, kpi, marts, staging, suites
from tellerframe.schemas import RAW_FEEDS
from tellerframe.sinks import exports, tables
from tellerframe.sources import seeds
from tellerframe.sources.raw import inventory, land_feed, read_optional
from tellerframe.sources.storage import materialize, path_exists, rename_path, shuffles_removed, working


class QualityHalt(RuntimeError):
    """The quality gate stopped the run."""


class ModelTestFailure(RuntimeError):
    """A test of a written model failed that must not."""


class SchemaDrift(RuntimeError):
    """A feed lacks a declared column or has it with another type."""


def check_schemas(feeds: dict[str, DataFrame]) -> None:
    """Stop before anything is read from a feed that does not fit its schema."""
    drifted = [name for name, df in feeds.items() if governance.has_drifted(df, RAW_FEEDS[name])]
    if drifted:
        raise SchemaDrift(f"feeds with another schema than declared: {', '.join(drifted)}")


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables."""

    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"


def _stored(spark: SparkSession, layout: Layout, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(layout.table(layer, name))


def validate(feeds: dict[str, DataFrame], layout: Layout, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(clean transactions, scores); writes quarantine and reports."""
    transactions, accounts, customers = feeds["transactions_raw"], feeds["accounts_raw"], feeds["customers_raw"]
    rulesets = {
        "transactions_raw": (transactions, suites.transaction_checks(accounts, rules)),
        "accounts_raw": (accounts, suites.account_checks(customers)),
        "customers_raw": (customers, suites.customer_checks()),
        "credit_data_raw": (feeds["credit_data_raw"], suites.credit_checks(customers)),
    }
    clean, quarantined = quarantine(transactions, rulesets["transactions_raw"][1])
    exports.write_quarantine(quarantined, f"{layout.root}/quarantine", "transactions_raw", rules.as_of.isoformat())
    results = None
    for name, (df, checks) in rulesets.items():
        outcome = materialize(with_samples(run_checks(df, checks), df, checks), "checks")
        held_back = quarantined if name == "transactions_raw" else None
        report = suites.quality_report(name, clean if held_back is not None else df, outcome, rules, held_back)
        exports.write_report(report, f"{layout.root}/quality_reports", name, rules.as_of.isoformat())
        named = outcome.withColumn("dataset", F.lit(name))
        results = named if results is None else results.unionByName(named)
    return clean, score.dataset_scores(results, rules)


def stage(feeds: dict[str, DataFrame], clean: DataFrame, layout: Layout, rules: Rules) -> DataFrame:
    """Write the staging tables; returns the transactions that arrived, staged
    and stored.  Transactions go by month, and only months they touch are
    rewritten."""
    root = f"{layout.root}/staging"
    tables.load_all(
        {
            "stg_customers": staging.stage_customers(feeds["customers_raw"], rules),
            "stg_accounts": staging.stage_accounts(feeds["accounts_raw"], rules),
            "stg_credit": staging.stage_credit(feeds["credit_data_raw"], rules),
        },
        root,
    )
    staged = tables.with_month(staging.stage_transactions(clean, rules, keep_version=True, sparse=True), "transaction_date")
    path = layout.table("staging", "stg_transactions")
    load = partial(tables.load_table, path=path, mode="upsert", pk=["transaction_id"], partition=tables.MONTH, cluster=("account_id",))
    known = read_optional(clean.sparkSession, path, merge_schema=True)
    if known is None and load(staged):
        # a first load is what the table holds: it is not written apart
        return clean.sparkSession.read.schema(staged.schema).parquet(path)
    batch = materialize(staged, "arrived")
    if known is not None:
        # an older extract that arrives after a newer one changes nothing
        stored = matching(known, batch, ["transaction_id"], "left_semi").select(F.col("transaction_id").alias("_id"), F.col("extract_ts").alias("_stored"))
        newer = F.col("_stored").isNull() | (F.col("extract_ts") >= F.col("_stored"))
        batch = materialize(batch.join(stored, F.col("transaction_id") == F.col("_id"), "left").filter(newer).drop("_id", "_stored"), "arrived")
        load(batch)
    return batch


def _replace(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a table that ``df`` may itself be read from."""
    tables.replace_table(df, path)
    return df.sparkSession.read.parquet(path)


def build_marts(spark: SparkSession, arrived: DataFrame, layout: Layout, rules: Rules) -> DataFrame:
    """Dimensions with history, then the fact's rows of the arrived
    transactions, whatever their day.  Returns the days on which the fact had or
    has rows of them."""
    customers_path, accounts_path = layout.table("marts", "dim_customer"), layout.table("marts", "dim_account")
    staged_customers, staged_accounts = (_stored(spark, layout, "staging", n) for n in ("stg_customers", "stg_accounts"))
    logs = (layout.table("history", "customer_loads"), layout.table("history", "account_loads"))
    customers = _replace(marts.dim_customer(staged_customers, rules, read_optional(spark, customers_path), logs[0]), customers_path)
    accounts = _replace(marts.dim_account(staged_accounts, customers, rules, read_optional(spark, accounts_path), logs[1]), accounts_path)
    first, last = _span(arrived)
    known_dates = read_optional(spark, layout.table("marts", "dim_date"))
    if known_dates is not None:
        span = known_dates.agg(F.min("full_date"), F.max("full_date")).first()
        first, last = min(first, span[0]), max(last, span[1])
    dates = _replace(marts.dim_date(spark, first, last), layout.table("marts", "dim_date"))
    merchants = _replace(marts.dim_merchant(seeds.merchant_categories(spark), rules), layout.table("marts", "dim_merchant"))
    fact_path = layout.table("marts", "fact_transactions")
    fact = tables.with_month(marts.fact_transactions(arrived.drop(tables.MONTH), accounts, dates, merchants, rules), "transaction_date")
    load = partial(tables.load_table, path=fact_path, mode="upsert", pk=["transaction_id"], partition=tables.MONTH, cluster=marts.FACT_CLUSTER)
    known = read_optional(spark, fact_path)
    if known is None:
        written = spark.read.schema(fact.schema).parquet(fact_path) if load(fact) else fact.limit(0)
        return materialize(written.select("transaction_date").distinct(), "touched-days")
    batch = materialize(fact, "fact-batch")
    had = matching(known, arrived, ["transaction_id"], "left_semi").select("transaction_date")
    days = materialize(batch.select("transaction_date").unionByName(had).distinct(), "touched-days")
    load(batch, keys=arrived)
    return days


def _span(arrived: DataFrame) -> tuple[date, date]:
    """The calendar's fixed span, made wider where transactions lie outside."""
    low, high = arrived.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    return min(marts.FIRST_DAY, low or marts.FIRST_DAY), max(marts.LAST_DAY, high or marts.LAST_DAY)


def build_kpis(spark: SparkSession, days: DataFrame, layout: Layout, rules: Rules) -> None:
    """Recompute the days and whole months that changed, and move the months of customers whose segment
    changed; a day or month without rows any more goes."""
    fact = _stored(spark, layout, "marts", "fact_transactions")
    months = {row[0] for row in tables.with_month(days, "transaction_date").select(tables.MONTH).distinct().collect()}
    # as many as the calendar has months; a literal list prunes partitions
    touched = fact.filter(tables.among(tables.MONTH, months))
    changed = matching(touched, days, ["transaction_date"], "left_semi")
    summary_days = days.select(F.col("transaction_date").alias("summary_date"))

    holders = materialize(kpi.daily_holders(changed, *_numbers(spark, layout)), "day-holders")
    _exchange(holders, summary_days, layout.table("metrics", "daily_holders"))
    _exchange(kpi.daily_kpi(changed, rules, holders), summary_days, layout.table("metrics", "kpi_daily_summary"))
    _build_segments(spark, fact, months, layout, rules)


def _numbers(spark: SparkSession, layout: Layout) -> list[DataFrame]:
    """Numbers of all accounts and customers, new ones included."""
    found = []
    for name, key in (("account", "account_sk"), ("customer", "customer_sk")):
        path = layout.table("metrics", f"{name}_numbers")
        found.append(_replace(uniques.numbered(_stored(spark, layout, "marts", f"dim_{name}"), key, read_optional(spark, path)), path))
    return found


def _build_segments(spark: SparkSession, fact: DataFrame, months: set, layout: Layout, rules: Rules) -> None:
    """The segment KPI, equal to one computed from the whole fact.

    Kept are the transactions of each customer and month, by month, and beside the flow of each segment the
    segments it was counted with.  Touched months are counted again; in all others only customers whose segment is another
    than then are moved.  Flow and segments are put in place together, so that a broken-off run moves none twice.
    Balances are of the run day in every month's row.
    """
    counts_path, state = layout.table("metrics", "customer_months"), layout.table("metrics", "segment_state")
    first = not path_exists(spark, state) or not path_exists(spark, counts_path)
    source = fact if first else fact.filter(tables.among(tables.MONTH, months))
    counted = tables.with_month(kpi.customer_months(source), "summary_date")
    tables.overwrite_partitions(counted, counts_path, tables.MONTH, ("customer_sk",))
    # the fact goes by the same months
    for month in months - {row[0] for row in source.select(tables.MONTH).distinct().collect()}:
        tables.drop_partition(spark, counts_path, tables.MONTH, month)
    counts = spark.read.schema(counted.schema).parquet(counts_path)
    counts = counts if first else counts.filter(tables.among(tables.MONTH, months))

    customers = _stored(spark, layout, "marts", "dim_customer")
    segments = kpi.current_segments(customers)
    flow = kpi.segment_flow(counts.drop(tables.MONTH), segments)
    if not first:
        untouched = ~F.coalesce(tables.among(tables.MONTH, months), F.lit(False))
        kept = tables.with_month(spark.read.parquet(f"{state}/flow"), "summary_date").filter(untouched).drop(tables.MONTH)
        moved = materialize(kpi.moved_customers(spark.read.parquet(f"{state}/segments"), segments), "moved-customers")
        others = spark.read.parquet(counts_path).filter(untouched).drop(tables.MONTH)
        flow = flow.unionByName(kpi.carried_flow(kept, others, moved))
    beside = f"{state}.new-{uuid.uuid4().hex}"
    flow.write.parquet(f"{beside}/flow")
    segments.write.parquet(f"{beside}/segments")
    rename_path(spark, beside, state)
    staged_accounts = _stored(spark, layout, "staging", "stg_accounts")
    result = kpi.segment_kpi_of(spark.read.parquet(f"{state}/flow"), customers, staged_accounts, rules)
    tables.replace_table(result, layout.table("metrics", "kpi_customer_segment"))


def _exchange(rows: DataFrame, days: DataFrame, path: str) -> None:
    """Put ``rows`` in place of everything the small table holds for ``days``."""
    known = read_optional(rows.sparkSession, path)
    kept = rows if known is None else matching(known, days, ["summary_date"], "left_anti").unionByName(rows)
    tables.replace_table(kept, path)


def test_models(spark: SparkSession, feeds: dict[str, DataFrame], layout: Layout, rules: Rules) -> DataFrame:
    """Run the tests of feeds and models on the written tables; the results of
    a run day replace those of an earlier run of that day."""
    written = {**feeds, **{n: _stored(spark, layout, layer, n) for layer, names in LAYERS.items() for n in names}}
    tests = suites.model_checks(written)
    results = suites.checked({name: (written[name], checks) for name, checks in tests.items()})
    path = f"{layout.table('governance', 'model_tests')}/run_date={rules.as_of.isoformat()}"
    results.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stop_on_failures(results: DataFrame, blocking: Sequence[str]) -> None:
    """Raise if a test of one of the models, not of the feeds, failed in a ``blocking`` dimension."""
    models = [name for names in LAYERS.values() for name in names]
    failed = results.filter(~F.col("passed") & F.col("dataset").isin(models) & F.col("dimension").isin(*blocking))
    # at most as many as there are tests
    names = [f"{r.dataset}.{r.check_name}" for r in failed.select("dataset", "check_name").orderBy("dataset", "check_name").collect()]
    if names:
        raise ModelTestFailure(f"failed: {', '.join(names)}")


def archive(spark: SparkSession, layout: Layout, rules: Rules) -> None:
    """Months of transactions past their retention go to the archive; what the KPI tables hold for them stays."""
    for layer, name in (("staging", "stg_transactions"), ("marts", "fact_transactions")):
        target = layout.table("archive", name)
        governance.archive_months(spark, layout.table(layer, name), target, "transactions", rules.as_of, ["transaction_id"])


def govern(spark: SparkSession, feeds: dict[str, DataFrame], layout: Layout, rules: Rules) -> None:
    edges = seeds.lineage_edges(spark)
    exports.write_lineage_json(edges, f"{layout.root}/governance/lineage_json", rules.run_at)
    exports.write_lineage_markdown(edges, f"{layout.root}/governance/lineage_markdown")
    catalog_path = layout.table("governance", "data_catalog")
    entries = governance.catalog_entries(feeds, layout.root, rules)
    _replace(governance.register(read_optional(spark, catalog_path), entries), catalog_path)


BLOCKING = ("Uniqueness",)

LAYERS = {
    "staging": ("stg_customers", "stg_accounts", "stg_transactions", "stg_credit"),
    "marts": ("dim_date", "dim_customer", "dim_account", "dim_merchant", "fact_transactions"),
    "metrics": ("kpi_daily_summary", "kpi_customer_segment"),
}


def run_day(
    spark: SparkSession, feeds: dict[str, DataFrame], root: str, rules: Rules, blocking: Sequence[str] = BLOCKING
) -> DataFrame:
    """All stages; returns the inventory of the tables written.

    ``feeds`` are landed tables: most stages read them more than once.  Failed tests of models stop the run, after their
    results are written, if their dimension is ``blocking``: repeated keys by default, as orphans and
    nulls of a feed are kept on purpose.  Nothing is archived or registered then.
    """
    layout = Layout(root)
    check_schemas(feeds)
    with working(spark), shuffles_removed(spark):
        clean, scores = validate(feeds, layout, rules)
        if not score.may_proceed(scores, ["transactions_raw", "accounts_raw"], rules):
            raise QualityHalt(f"quality below {rules.halt_below_score}")
        arrived = stage(feeds, clean, layout, rules)
        days = build_marts(spark, arrived, layout, rules)
        # of older months the fact holds late rows only: their KPI rows stay as they are
        first = governance.first_kept_month("transactions", rules.as_of)
        inside = F.year("transaction_date") * 100 + F.month("transaction_date") >= first
        days = days.filter(F.coalesce(inside, F.lit(True)))
        build_kpis(spark, days, layout, rules)
        stop_on_failures(test_models(spark, feeds, layout, rules), blocking)
        archive(spark, layout, rules)
        govern(spark, feeds, layout, rules)
    return inventory({name: _stored(spark, layout, layer, name) for layer, names in LAYERS.items() for name in names})


def run_landed(spark: SparkSession, folder: str, root: str, rules: Rules, blocking: Sequence[str] = BLOCKING) -> DataFrame:
    """:func:`run_day` on a folder of CSV feeds.  Rows that do not fit their schema are set aside as text, by feed and run
    day, below ``quarantine_text``; a repeated run day replaces its own."""
    feeds = {}
    with working(spark), shuffles_removed(spark):
        for name in RAW_FEEDS:
            feeds[name], corrupt = land_feed(spark, folder, name)
            day = f"run_date={rules.as_of.isoformat()}"
            corrupt.write.mode("overwrite").parquet(f"{root}/quarantine_text/dataset={name}/{day}")
        return run_day(spark, feeds, root, rules, blocking)
