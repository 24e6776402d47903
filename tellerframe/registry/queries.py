"""One entry per operator; each callable takes (spark, folder of test tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerframe.functions.banding import BALANCE_TIERS
from tellerframe.functions.masking import mask_names_md5
from tellerframe.functions.money import add_cad_from_rates
from tellerframe.operators import checks as check_engine
from tellerframe.operators import lineage, score, sketches, uniques
from tellerframe.operators.history import as_of_fill, as_of_join
from tellerframe.operators.profile import profile
from tellerframe.operators.quarantine import flag_rows, split
from tellerframe.operators.upsert import high_water_mark, newer_than, upsert
from tellerframe.plans import daily, dashboard, governance, kpi, marts, profiling, reports, staging, suites
from tellerframe.registry.bank import RULES, Bank, rules_at
from tellerframe.schemas import RAW_ACCOUNTS, RAW_TRANSACTIONS, fields
from tellerframe.sinks import exports, tables
from tellerframe.sources import sample_feed
from tellerframe.sources.raw import CORRUPT, inventory, land_csv, optional_inventory, read_optional, read_raw_csv, register_raw, with_file_order
from tellerframe.sources.seeds import literal_table
from tellerframe.sources.storage import fresh_path, materialize, path_exists, shuffles_removed, working
from tellerframe.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types every engine shows alike: decimals as double, days and times as
    text, short integers as int, lists as text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ";")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(build: Callable[[Bank], DataFrame]) -> Callable[[Bank], DataFrame]:
    """Register ``build`` under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: plain(build(Bank(spark, sf_dir)))
    return build


# ---- staging ---------------------------------------------------------------


@query
def stg_customers(bank: Bank) -> DataFrame:
    return bank.customers


@query
def stg_customers_prod(bank: Bank) -> DataFrame:
    """Production keeps the personal fields readable."""
    from dataclasses import replace

    return staging.stage_customers(bank.raw_customers, replace(bank.rules, environment="prod"))


@query
def mask_md5(bank: Bank) -> DataFrame:
    masks = mask_names_md5(*[F.col(c) for c in ("first_name", "last_name", "customer_id", "email")])
    return bank.raw_customers.select("customer_id", *[e.alias(n) for n, e in masks.items()])


@query
def stg_accounts(bank: Bank) -> DataFrame:
    return bank.accounts


@query
def tier_right_closed(bank: Bank) -> DataFrame:
    """Balance tiers with edges in the lower band."""
    staged = staging.stage_accounts(bank.raw_accounts, bank.rules, BALANCE_TIERS.right_closed())
    return staged.select("account_id", "balance_tier")


@query
def stg_transactions(bank: Bank) -> DataFrame:
    return bank.transactions


@query
def stg_transactions_first(bank: Bank) -> DataFrame:
    """The row read first wins instead of the newest."""
    return staging.stage_transactions(bank.raw_transactions, bank.rules, keep="first")


@query
def stg_first_files(bank: Bank) -> DataFrame:
    """The row read first wins, in a landing folder of files of unlike size that many tasks read out of order."""
    path = fresh_path(bank.spark, "landing-files")
    rows = bank.raw_transactions.orderBy("_ingest_order").drop("_ingest_order")
    rows.write.parquet(path)
    return staging.stage_transactions(with_file_order(bank.spark.read.parquet(path)), bank.rules, keep="first")


@query
def stg_transactions_sparse(bank: Bank) -> DataFrame:
    """Deduplicated through the few repeated ids of the landed feed."""
    return staging.stage_transactions(materialize(bank.raw_transactions, "landing"), bank.rules, sparse=True)


@query
def stg_credit(bank: Bank) -> DataFrame:
    return bank.credit


@query
def fx_rate_table(bank: Bank) -> DataFrame:
    """Conversion by a rate table instead of one constant."""
    schema = T.StructType([*fields("currency"), *fields("rate_to_cad", T.DecimalType(10, 4))])
    rates = literal_table(bank.spark, [("USD", Decimal("1.36"))], schema)
    priced = add_cad_from_rates(bank.raw_transactions, "amount", "currency", rates)
    return priced.groupBy("currency").agg(F.count("amount_cad").alias("n"), F.sum("amount_cad").alias("total_cad"))


# ---- star schema -----------------------------------------------------------


@query
def dim_date(bank: Bank) -> DataFrame:
    """Every calendar day with the number of transactions on it."""
    used = bank.raw_transactions.groupBy(F.col("transaction_date").try_cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return bank.dates.join(used, "full_date", "left").withColumn("transactions", F.coalesce("n", F.lit(0))).drop("n")


@query
def dim_merchant(bank: Bank) -> DataFrame:
    """Every category with the number of transactions in it."""
    used = bank.transactions.groupBy(F.col("merchant_category_clean").alias("merchant_category")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        bank.merchants.join(used, "merchant_category", "left")
        .withColumn("transactions", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


@query
def dim_customer(bank: Bank) -> DataFrame:
    return bank.dim_customer


@query
def dim_account(bank: Bank) -> DataFrame:
    return bank.dim_account


@query
def fact_transactions(bank: Bank) -> DataFrame:
    return bank.fact


# ---- analyst reports -------------------------------------------------------


@query
def q1_daily_summary(bank: Bank) -> DataFrame:
    return reports.daily_summary(bank.fact, bank.dates)


@query
def q2_segment_analysis(bank: Bank) -> DataFrame:
    return reports.segment_analysis(bank.fact, bank.dim_customer)


@query
def q3_dormancy(bank: Bank) -> DataFrame:
    return reports.dormancy_report(bank.accounts)


@query
def q4_channel_mom(bank: Bank) -> DataFrame:
    return reports.channel_performance(bank.fact, bank.dates)


@query
def q5_large_register(bank: Bank) -> DataFrame:
    return reports.large_transaction_register(bank.fact, bank.dim_account, bank.dim_customer)


@query
def q6_credit_portfolio(bank: Bank) -> DataFrame:
    return reports.credit_portfolio(bank.credit)


@query
def q7_lifetime_value(bank: Bank) -> DataFrame:
    return reports.lifetime_value(bank.fact, bank.dim_customer)


# ---- KPI tables and declared metrics ---------------------------------------


@query
def kpi_daily_summary(bank: Bank) -> DataFrame:
    """All days in one pass over a fact that is not stored; the daily run keeps bitmaps instead."""
    return kpi.daily_kpi(bank.fact, bank.rules)


@query
def kpi_period_uniques(bank: Bank) -> DataFrame:
    """Accounts and customers of every week and month, from the stored days alone."""
    fact = materialize(bank.fact.select("transaction_date", "account_sk", "customer_sk"), "holders-fact")
    numbers = (materialize(uniques.numbered(fact, key), "numbers") for key in ("account_sk", "customer_sk"))
    holders = materialize(kpi.daily_holders(fact, *numbers), "day-holders")
    week, month = (
        kpi.unique_holders(holders, F.trunc("summary_date", unit)).withColumn("period", F.lit(unit)) for unit in ("week", "month")
    )
    return week.unionByName(month)


@query
def kpi_daily_staged(bank: Bank) -> DataFrame:
    return kpi.daily_kpi_from_staging(bank.transactions)


@query
def kpi_customer_segment(bank: Bank) -> DataFrame:
    return kpi.segment_kpi(bank.fact, bank.dim_customer, bank.accounts, bank.rules)


@query
def aum(bank: Bank) -> DataFrame:
    return kpi.assets_under_management(bank.accounts, bank.rules)


@query
def dormancy_30_60_90(bank: Bank) -> DataFrame:
    return kpi.inactivity_report(bank.accounts)


@query
def nii(bank: Bank) -> DataFrame:
    return kpi.net_interest_income(bank.accounts, bank.credit, bank.rules)


# ---- dashboard -------------------------------------------------------------


@query
def dash_kpi_cards(bank: Bank) -> DataFrame:
    return dashboard.kpi_cards(bank.transactions, bank.accounts)


@query
def dash_filtered_cards(bank: Bank) -> DataFrame:
    """The cards after the user narrowed dates, channels and types."""
    chosen = dashboard.filter_transactions(
        bank.transactions, (date(2022, 1, 1), date(2024, 12, 31)), ["Online", "Mobile"], ["Debit", "Credit", "Transfer"]
    )
    return dashboard.kpi_cards(chosen, bank.accounts)


@query
def dash_trend(bank: Bank) -> DataFrame:
    return dashboard.daily_trend(bank.transactions)


@query
def dash_channel(bank: Bank) -> DataFrame:
    return dashboard.volume_by_channel(bank.transactions)


@query
def dash_top_merchants(bank: Bank) -> DataFrame:
    return dashboard.top_merchants(bank.transactions)


@query
def dash_account_type(bank: Bank) -> DataFrame:
    return dashboard.accounts_by_type(bank.accounts)


@query
def dash_tier(bank: Bank) -> DataFrame:
    return dashboard.accounts_by_tier(bank.accounts)


@query
def dash_province(bank: Bank) -> DataFrame:
    return dashboard.deposits_by_province(bank.accounts, bank.customers)


@query
def dash_segment(bank: Bank) -> DataFrame:
    return dashboard.customers_by_segment(bank.customers)


@query
def dash_age_segment(bank: Bank) -> DataFrame:
    return dashboard.customers_by_age_and_segment(bank.customers)


@query
def dash_risk(bank: Bank) -> DataFrame:
    return dashboard.exposure_by_rating(bank.credit)


@query
def dash_delinquency(bank: Bank) -> DataFrame:
    return dashboard.loans_by_delinquency(bank.credit)


@query
def dash_score_band(bank: Bank) -> DataFrame:
    return dashboard.loans_by_score_band(bank.credit)


# ---- profiling -------------------------------------------------------------


@query
def prof_null_pct(bank: Bank) -> DataFrame:
    return profiling.null_percentages(bank.feeds)


@query
def prof_median(bank: Bank) -> DataFrame:
    return profiling.median_by_type(bank.transactions)


@query
def prof_hist_amount(bank: Bank) -> DataFrame:
    return profiling.amount_histogram(bank.transactions, cap=300_000)


@query
def prof_hist_large(bank: Bank) -> DataFrame:
    return profiling.large_amount_histogram(bank.transactions, cap=600_000)


@query
def prof_hist_inactivity(bank: Bank) -> DataFrame:
    return profiling.inactivity_histogram(bank.accounts)


@query
def prof_dormancy(bank: Bank) -> DataFrame:
    return profiling.dormancy_by_type(bank.accounts)


@query
def prof_summary(bank: Bank) -> DataFrame:
    return profiling.portfolio_summary(bank.transactions, bank.accounts, bank.credit)


@query
def prof_bounds(bank: Bank) -> DataFrame:
    return dashboard.filter_bounds(bank.transactions)


@query
def prof_options(bank: Bank) -> DataFrame:
    return dashboard.filter_options(bank.transactions)


# ---- quality ---------------------------------------------------------------


def _transaction_checks(bank: Bank) -> list[check_engine.Check]:
    return suites.transaction_checks(bank.raw_accounts, bank.rules)


def _feed_checks(bank: Bank) -> DataFrame:
    return suites.checked(
        {
            "transactions_raw": (bank.raw_transactions, _transaction_checks(bank)),
            "accounts_raw": (bank.raw_accounts, suites.account_checks(bank.raw_customers)),
            "customers_raw": (bank.raw_customers, suites.customer_checks()),
            "credit_data_raw": (bank.raw_credit, suites.credit_checks(bank.raw_customers)),
        }
    )


@query
def dq_profile(bank: Bank) -> DataFrame:
    """Deviations to one decimal: the sums behind them are floating-point."""
    figures = profile(bank.raw_transactions.drop("_source_system", "_ingest_order"))
    return figures.withColumns({c: F.round(c, 1) for c in ("std_value", "mean_value")})


@query
def dq_checks(bank: Bank) -> DataFrame:
    checks = _transaction_checks(bank)
    results = check_engine.run_checks(bank.raw_transactions, checks)
    return check_engine.with_samples(results, bank.raw_transactions, checks)


@query
def dq_account_checks(bank: Bank) -> DataFrame:
    return check_engine.run_checks(bank.raw_accounts, suites.account_checks(bank.raw_customers))


@query
def dq_quarantine(bank: Bank) -> DataFrame:
    return split(flag_rows(bank.raw_transactions, _transaction_checks(bank)))[1]


@query
def dq_clean(bank: Bank) -> DataFrame:
    return split(flag_rows(bank.raw_transactions, _transaction_checks(bank)))[0]


@query
def dq_score(bank: Bank) -> DataFrame:
    return score.dataset_scores(_feed_checks(bank), bank.rules)


@query
def dq_gate(bank: Bank) -> DataFrame:
    scores = score.dataset_scores(_feed_checks(bank), bank.rules)
    return score.gate(scores, ["transactions_raw", "accounts_raw"], bank.rules)


@query
def dq_scorecard(bank: Bank) -> DataFrame:
    return score.scorecard(materialize(_feed_checks(bank), "checks"), bank.rules)


@query
def dq_by_dimension(bank: Bank) -> DataFrame:
    return score.by_dimension(_feed_checks(bank))


@query
def dq_totals(bank: Bank) -> DataFrame:
    return score.failed_share(_feed_checks(bank))


@query
def dq_failures(bank: Bank) -> DataFrame:
    return score.first_failures(_feed_checks(bank)).select("dataset", "check_index", "check_name", "failed_count", "failed_pct")


@query
def dq_report(bank: Bank) -> DataFrame:
    """The nested report of the transaction feed, its lists counted."""
    raw, checks = bank.raw_transactions, _transaction_checks(bank)
    clean, quarantined = split(materialize(flag_rows(raw, checks), "flagged"))
    results = materialize(check_engine.run_checks(raw, checks), "checks")
    report = suites.quality_report("transactions_raw", clean, results, bank.rules, quarantined)
    return report.select(
        "dataset_name", "run_timestamp", "total_rows", "total_columns", "overall_score", "quarantined_rows", "pipeline_action",
        F.size("checks").alias("checks"),
        F.size(F.filter("checks", lambda c: ~c["passed"])).alias("failed_checks"),
        F.size("column_profiles").alias("profiles"),
    )


@query
def dq_schema_drift(bank: Bank) -> DataFrame:
    return governance.schema_drift(bank.raw_accounts, RAW_ACCOUNTS)


@query
def dq_row_counts(bank: Bank) -> DataFrame:
    return inventory(bank.feeds)


# ---- expectation suites and model tests ------------------------------------


@query
def ge_transactions(bank: Bank) -> DataFrame:
    return check_engine.run_checks(bank.raw_transactions, suites.transaction_expectations())


@query
def ge_accounts(bank: Bank) -> DataFrame:
    return check_engine.run_checks(bank.raw_accounts, suites.account_expectations())


@query
def ge_checkpoint(bank: Bank) -> DataFrame:
    """The summary of a checkpoint that expects a dataset that is not there."""
    suites_of = {
        "transactions": (bank.raw_transactions, suites.transaction_expectations()),
        "accounts": (bank.raw_accounts, suites.account_expectations()),
    }
    return score.suite_results(suites.checked(suites_of), ["transactions", "accounts", "customers"])


@query
def ge_summary(bank: Bank) -> DataFrame:
    return score.suite_results(
        suites.checked(
            {
                "transactions": (bank.raw_transactions, suites.transaction_expectations()),
                "accounts": (bank.raw_accounts, suites.account_expectations()),
            }
        )
    )


@query
def model_tests(bank: Bank) -> DataFrame:
    """All tests of feeds and models, over written tables."""
    written = {name: materialize(df, name) for name, df in bank.feeds.items()}
    bank.raw_customers, bank.raw_accounts = written["customers_raw"], written["accounts_raw"]
    bank.raw_transactions = written["transactions_raw"]
    for name, attribute in [
        ("stg_customers", "customers"), ("stg_accounts", "accounts"), ("stg_transactions", "transactions"),
        ("dim_date", "dates"), ("dim_customer", "dim_customer"), ("dim_account", "dim_account"), ("fact_transactions", "fact"),
    ]:
        table = written[name] = materialize(getattr(bank, attribute), name)
        setattr(bank, attribute, table)
    written["kpi_daily_summary"] = kpi.daily_kpi(bank.fact, bank.rules)
    tests = suites.model_checks(written)
    results = suites.checked({name: (written[name], checks) for name, checks in tests.items()})
    return results.select("dataset", "check_index", "check_name", "passed", "failed_count", "failed_pct")


# ---- profiles of stored days -----------------------------------------------

# ours: a figure of each kind
SKETCHED = ("account_id", "channel", "status", "merchant_category", "amount_cad", "signed_amount_cad", "txn_year", "txn_month")
# ours: two ranges of stored months
BASE_MONTHS, OTHER_MONTHS = (date(2020, 1, 1), date(2021, 12, 31)), (date(2022, 1, 1), date(2023, 12, 31))


def _stored_months(bank: Bank, transactions: DataFrame) -> DataFrame:
    month = F.trunc("transaction_date", "month")
    rows = sketches.sketch_days(transactions.select(*SKETCHED, "transaction_date"), "transactions", month)
    return materialize(rows.filter(F.col("column_name") != "transaction_date"), "month-profiles")


@query
def prof_range(bank: Bank) -> DataFrame:
    """Profile of two years merged from stored months; whether estimates lie within 5% of the data's own figures."""
    transactions = materialize(bank.transactions.select(*SKETCHED, "transaction_date"), "transactions")
    found = sketches.summarised(sketches.merged(_stored_months(bank, transactions), *BASE_MONTHS))
    first, last = (F.lit(d) for d in BASE_MONTHS)
    exact = profile(transactions.filter(F.col("transaction_date").between(first, last)).select(*SKETCHED))
    exact = exact.select("column_name", F.col("unique_count").alias("_distinct"))
    close = F.abs(F.col("unique_count") - F.col("_distinct")) * 20 <= F.greatest("_distinct", F.lit(20))
    return found.join(exact, "column_name").select(
        "column_name", "total_count", "null_count", "min_value", "max_value", "mean_value", close.alias("unique_close")
    )


@query
def prof_drift(bank: Bank) -> DataFrame:
    """Which columns differ between two ranges of stored months."""
    transactions = materialize(bank.transactions.select(*SKETCHED, "transaction_date"), "transactions")
    months = _stored_months(bank, transactions)
    found = sketches.drift(sketches.merged(months, *BASE_MONTHS), sketches.merged(months, *OTHER_MONTHS))
    return found.select("column_name", "base_count", "other_count", "mean_shift", "drifted")


# ---- history ---------------------------------------------------------------

# ours: three load days, so that customers join, age and go dormant between them
LOAD_DAYS = (date(2020, 1, 1), date(2023, 1, 1), date(2026, 1, 1))


def _histories(bank: Bank) -> tuple[DataFrame, DataFrame]:
    """Customer and account dimension after the three loads."""
    customers = accounts = None
    for day in LOAD_DAYS:
        rules = rules_at(day)
        known_customers = bank.raw_customers.filter(F.col("join_date") <= day.isoformat())
        known_accounts = bank.raw_accounts.filter(F.col("open_date") <= day.isoformat())
        customers = materialize(
            marts.dim_customer(staging.stage_customers(known_customers, rules), rules, customers), "dim-customer"
        )
        accounts = marts.dim_account(staging.stage_accounts(known_accounts, rules), customers, rules, accounts)
    return customers, accounts


@query
def scd2_customer(bank: Bank) -> DataFrame:
    return _histories(bank)[0]


@query
def scd2_account(bank: Bank) -> DataFrame:
    return _histories(bank)[1]


# ours: the middle load comes first, the oldest after the newest, and one again
ANY_ORDER = (LOAD_DAYS[1], LOAD_DAYS[2], LOAD_DAYS[0], LOAD_DAYS[1])


def _any_order(bank: Bank) -> tuple[DataFrame, DataFrame]:
    """Customer and account dimension after loads out of order."""
    customers = accounts = None
    logs = [fresh_path(bank.spark, name) for name in ("customer-loads", "account-loads")]
    for day in ANY_ORDER:
        rules = rules_at(day)
        known_customers = bank.raw_customers.filter(F.col("join_date") <= day.isoformat())
        known_accounts = bank.raw_accounts.filter(F.col("open_date") <= day.isoformat())
        customers = materialize(marts.dim_customer(staging.stage_customers(known_customers, rules), rules, customers, logs[0]), "dim-customer")
        accounts = materialize(marts.dim_account(staging.stage_accounts(known_accounts, rules), customers, rules, accounts, logs[1]), "dim-account")
    return customers, accounts


@query
def scd2_any_order(bank: Bank) -> DataFrame:
    """Customer versions after loads out of order: those of the loads in order."""
    return _any_order(bank)[0]


@query
def scd2_account_any_order(bank: Bank) -> DataFrame:
    return _any_order(bank)[1]


@query
def pit_any_order(bank: Bank) -> DataFrame:
    """Volume by the segment valid on the transaction day, after a backdated load."""
    return _point_in_time(bank, _any_order(bank)[0])


def _after_history(bank: Bank) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts loaded with the first dimensions; customers and accounts after the third load."""
    customers = accounts = fact = None
    for day in LOAD_DAYS:
        rules = rules_at(day)
        customers = materialize(marts.dim_customer(staging.stage_customers(bank.raw_customers, rules), rules, customers), "dim-customer")
        accounts = materialize(marts.dim_account(staging.stage_accounts(bank.raw_accounts, rules), customers, rules, accounts), "dim-account")
        if fact is None:
            fact = materialize(marts.fact_transactions(bank.transactions, accounts, bank.dates, bank.merchants, rules), "fact")
    return fact, customers, accounts


@query
def q2_after_history(bank: Bank) -> DataFrame:
    fact, customers, _ = _after_history(bank)
    return reports.segment_analysis(fact, customers)


@query
def q5_after_history(bank: Bank) -> DataFrame:
    fact, customers, accounts = _after_history(bank)
    return reports.large_transaction_register(fact, accounts, customers)


@query
def q7_after_history(bank: Bank) -> DataFrame:
    fact, customers, _ = _after_history(bank)
    return reports.lifetime_value(fact, customers)


@query
def kpi_segment_after_history(bank: Bank) -> DataFrame:
    fact, customers, _ = _after_history(bank)
    return kpi.segment_kpi(fact, customers, bank.accounts, bank.rules)


@query
def pit_segment(bank: Bank) -> DataFrame:
    """Volume by the segment and age band valid on the transaction day."""
    customers = None
    for day in LOAD_DAYS:
        rules = rules_at(day)
        known = bank.raw_customers.filter(F.col("join_date") <= day.isoformat())
        customers = marts.dim_customer(staging.stage_customers(known, rules), rules, customers)
    return _point_in_time(bank, customers)


def _point_in_time(bank: Bank, customers: DataFrame) -> DataFrame:
    owners = bank.accounts.select("account_id", "customer_id")
    owned = bank.transactions.join(owners, "account_id")
    dated = as_of_join(owned, customers, "customer_id", "transaction_date", ["customer_segment", "age_band"])
    return dated.groupBy("customer_segment", "age_band", "txn_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cad").alias("volume_cad")
    )


@query
def pit_segment_filled(bank: Bank) -> DataFrame:
    """As ``pit_segment``, by versions carried forward on one timeline."""
    owned = bank.transactions.join(bank.accounts.select("account_id", "customer_id"), "account_id")
    dated = as_of_fill(owned, _histories(bank)[0], "customer_id", "transaction_date", ["customer_segment", "age_band"])
    return dated.groupBy("customer_segment", "age_band", "txn_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cad").alias("volume_cad")
    )


@query
def pit_last_activity(bank: Bank) -> DataFrame:
    """Every transaction beside its account's last active day before, as many versions an account as it has days."""
    transactions = materialize(bank.transactions.select("account_id", "transaction_date", "txn_year", "amount_cad"), "transactions")
    active = transactions.dropna(subset=["transaction_date"]).groupBy("account_id", "transaction_date").agg(F.sum("amount_cad").alias("day_volume"))
    versions = active.select("account_id", F.date_add("transaction_date", 1).alias("effective_from"), F.lit(None).cast("date").alias("effective_to"), "day_volume")
    dated = as_of_fill(transactions, versions, "account_id", "transaction_date", ["day_volume"])
    return dated.groupBy("txn_year").agg(
        F.count(F.lit(1)).alias("n"), F.count("day_volume").alias("n_before"), F.sum("day_volume").alias("volume_before")
    )


# ---- incremental loads -----------------------------------------------------


def _first_extract(bank: Bank) -> DataFrame:
    return bank.raw_transactions.filter(F.col("_extract_ts") == sample_feed.FIRST_EXTRACT)


@query
def upsert_staging(bank: Bank) -> DataFrame:
    """The second extract merged into the table of the first."""
    target = staging.stage_transactions(_first_extract(bank), bank.rules)
    later = bank.raw_transactions.filter(F.col("_extract_ts") > sample_feed.FIRST_EXTRACT)
    return upsert(target, staging.stage_transactions(later, bank.rules), ["transaction_id"])


def _loaded_twice(bank: Bank, first: DataFrame, second: DataFrame) -> DataFrame:
    """The fact after a first load and one of what arrived later, twice."""
    path = fresh_path(bank.spark, "fact")
    tables.write_by_month(bank.fact_of(staging.stage_transactions(first, bank.rules)), path, "transaction_date", marts.FACT_CLUSTER)
    batch = tables.with_month(bank.fact_of(staging.stage_transactions(second, bank.rules)), "transaction_date")
    arrived = materialize(second.select("transaction_id").distinct(), "arrived")
    for _ in range(2):
        tables.load_table(batch, path, "upsert", ["transaction_id"], tables.MONTH, marts.FACT_CLUSTER, keys=arrived)
    return bank.spark.read.parquet(path)


@query
def incremental_fact(bank: Bank) -> DataFrame:
    """A first load, then what arrived from the newest loaded extract on, upserted
    into month partitions."""
    first = _first_extract(bank)
    mark = high_water_mark(first, "_extract_ts")
    return _loaded_twice(bank, first, newer_than(bank.raw_transactions, "_extract_ts", mark))


# ours: transactions of every seventh account arrive last, whatever their day
def _late() -> Column:
    return F.pmod(F.substring("account_id", -6, 6).try_cast("int"), F.lit(7)) == 0


@query
def incremental_late(bank: Bank) -> DataFrame:
    """Rows of all years, one of them far in the future, that arrive after newer days were loaded."""
    late = F.coalesce(_late(), F.lit(False))
    future = F.when(F.col("transaction_id") == "TXN0000000007", F.lit("2029-12-31")).otherwise(F.col("transaction_date"))
    raw = bank.raw_transactions.withColumn("transaction_date", future)
    return _loaded_twice(bank, raw.filter(~late), raw.filter(late))


@query
def incremental_correction(bank: Bank) -> DataFrame:
    """The first load has every transaction of the late accounts 400 days before its day and with another
    amount; the corrections move them to another month."""
    late = F.coalesce(_late(), F.lit(False))
    earlier = F.date_format(F.date_sub(F.col("transaction_date").try_cast("date"), 400), "yyyy-MM-dd")
    wrong = bank.raw_transactions.withColumns(
        {
            "transaction_date": F.when(late, earlier).otherwise(F.col("transaction_date")),
            "amount": F.when(late, F.lit(1).cast("decimal(18,2)")).otherwise(F.col("amount")),
        }
    )
    return _loaded_twice(bank, wrong, bank.raw_transactions.filter(late))


# ---- lineage ---------------------------------------------------------------


def _edges(bank: Bank) -> DataFrame:
    return sample_feed.lineage_from_tables(bank.spark, bank.sf_dir)


def _registry(bank: Bank) -> DataFrame:
    """The edges as a stored registry: a walk reads them once per level."""
    return materialize(_edges(bank), "lineage-registry")


@query
def lineage_ancestors(bank: Bank) -> DataFrame:
    """Everything that feeds one region."""
    return lineage.ancestors(_registry(bank), "region", "1")


@query
def lineage_descendants(bank: Bank) -> DataFrame:
    """Everything one customer feeds."""
    return lineage.descendants(_registry(bank), "customer", "7")


@query
def lineage_trace(bank: Bank) -> DataFrame:
    return lineage.trace(_registry(bank), "nation", "3")


@query
def lineage_closure(bank: Bank) -> DataFrame:
    return lineage.closure(_registry(bank)).select(
        "root_dataset", "root_column", "hop", "source_dataset", "source_column", "target_dataset", "target_column"
    )


@query
def lineage_json(bank: Bank) -> DataFrame:
    return lineage.as_json(_edges(bank))


@query
def lineage_markdown(bank: Bank) -> DataFrame:
    return lineage.as_markdown(_edges(bank))


@query
def lineage_checks(bank: Bank) -> DataFrame:
    """Edge counts per step, and how many of them are faulty."""
    edges = _edges(bank)
    faulty = lineage.registry_problems(edges).groupBy("pipeline_step").agg(F.count(F.lit(1)).alias("problems"))
    counts = edges.groupBy("pipeline_step").agg(F.count(F.lit(1)).alias("edges"))
    return counts.join(faulty, "pipeline_step", "left").withColumn("problems", F.coalesce("problems", F.lit(0)))


# ---- catalog and retention -------------------------------------------------


@query
def catalog(bank: Bank) -> DataFrame:
    """Two registrations of the feeds; the second replaces the first."""
    stale = governance.catalog_entries({"accounts_raw": bank.raw_accounts}, "/landing/old", bank.rules)
    entries = governance.catalog_entries(bank.feeds, "/landing", bank.rules)
    return governance.register(stale, entries)


@query
def retention(bank: Bank) -> DataFrame:
    return governance.retention_report(
        {"transactions": (bank.transactions, "transaction_date"), "credit": (bank.credit, "origination_date")}, date(2030, 6, 30)
    )


@query
def retention_rows(bank: Bank) -> DataFrame:
    """Months of staged transactions past their retention moved to the archive, twice: rows kept and archived."""
    spark, day = bank.spark, date(2031, 6, 30)
    path, archive = fresh_path(spark, "retained"), fresh_path(spark, "archive")
    tables.write_by_month(bank.transactions, path, "transaction_date", ("account_id",))
    expired = governance.first_kept_month("transactions", day)
    late = materialize(spark.read.parquet(path).filter(F.col(tables.MONTH) < expired), "late")
    governance.archive_months(spark, path, archive, "transactions", day, ["transaction_id"])
    # the same rows arrive once more and are archived once more
    tables.load_table(late, path, "upsert", ["transaction_id"], tables.MONTH)
    governance.archive_months(spark, path, archive, "transactions", day, ["transaction_id"])
    places = {"kept": read_optional(spark, path), "archived": read_optional(spark, archive)}
    found = [df.groupBy(tables.MONTH).agg(F.lit(place).alias("place"), F.count(F.lit(1)).alias("n")) for place, df in places.items() if df is not None]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


# ---- sources and sinks -----------------------------------------------------


@query
def io_csv(bank: Bank) -> DataFrame:
    """Landing CSV written and read back under the declared schema."""
    path = fresh_path(bank.spark, "landing")
    tables.write_landing_csv(bank.raw_transactions.drop("_ingest_order"), path)
    return read_raw_csv(bank.spark, path, RAW_TRANSACTIONS)


@query
def io_corrupt_rows(bank: Bank) -> DataFrame:
    """A landing file in which every tenth amount is no number: rows kept and rows set aside, by status."""
    path = fresh_path(bank.spark, "landing")
    broken = F.when(F.col("transaction_id").endswith("7"), "n/a").otherwise(F.col("amount").cast("string"))
    tables.write_landing_csv(bank.raw_transactions.drop("_ingest_order").withColumn("amount", broken), path)
    good, corrupt = land_csv(bank.spark, path, RAW_TRANSACTIONS)
    kept = good.agg(F.lit("kept").alias("status"), F.count(F.lit(1)).alias("n"))
    return kept.unionByName(corrupt.agg(F.lit("corrupt").alias("status"), F.count_if(F.col(CORRUPT).contains("n/a")).alias("n")))


@query
def io_parquet(bank: Bank) -> DataFrame:
    path = fresh_path(bank.spark, "staged")
    tables.write_staged(bank.accounts, path)
    return bank.spark.read.parquet(path)


@query
def io_named_source(bank: Bank) -> DataFrame:
    """Raw feeds by name, from SQL."""
    register_raw(bank.feeds)
    return bank.spark.sql("SELECT account_status, count(*) AS n FROM accounts_raw GROUP BY account_status")


@query
def io_partitioned(bank: Bank) -> DataFrame:
    """The fact by month; written twice, a month is replaced, not doubled."""
    path = fresh_path(bank.spark, "fact")
    fact = materialize(bank.fact, "fact-source")
    for _ in range(2):
        tables.write_by_month(fact, path, "transaction_date", marts.FACT_CLUSTER)
    stored = bank.spark.read.parquet(path)
    return stored.groupBy(tables.MONTH).agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cad").alias("volume_cad"))


@query
def io_evolve(bank: Bank) -> DataFrame:
    """A column added by a later load; earlier rows hold nulls."""
    path = fresh_path(bank.spark, "evolving")
    tables.write_staged(bank.accounts.drop("balance_tier"), path)
    merged = tables.append_evolving(bank.accounts, path)
    return merged.groupBy("balance_tier").agg(F.count(F.lit(1)).alias("n"))


@query
def io_load_modes(bank: Bank) -> DataFrame:
    """Replace twice, append twice, upsert twice: rows stored by each."""
    accounts = materialize(bank.accounts.select("account_id", "balance_tier"), "accounts")
    stored = None
    for mode in ("replace", "append", "upsert"):
        path = fresh_path(bank.spark, mode)
        given = [tables.load_table(accounts, path, mode, ["account_id"]) for _ in range(2)]
        row = bank.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored_rows"))
        row = row.select(F.lit(mode).alias("mode"), F.lit(sum(given)).cast("long").alias("given_rows"), "stored_rows")
        stored = row if stored is None else stored.unionByName(row)
    return stored


@query
def io_load_all(bank: Bank) -> DataFrame:
    """All staged datasets by their own mode, twice; one that is absent is reported as skipped."""
    root = fresh_path(bank.spark, "staging")
    given = {"stg_customers": bank.customers, "stg_accounts": bank.accounts, "stg_transactions": bank.transactions, "stg_credit": bank.credit}
    for _ in range(2):
        tables.load_all(given, root)
    names = [*(load.dataset for load in tables.STANDARD_LOADS), "stg_absent"]
    return optional_inventory(bank.spark, {name: f"{root}/{name}" for name in names})


@query
def io_quarantine(bank: Bank) -> DataFrame:
    """Quarantined rows written by dataset and run date, read back by reason."""
    path = fresh_path(bank.spark, "quarantine")
    rows = split(flag_rows(bank.raw_transactions, _transaction_checks(bank)))[1]
    if not exports.write_quarantine(rows, path, "transactions_raw", bank.rules.as_of.isoformat()):
        return bank.spark.createDataFrame([], "dataset string, run_date string, reasons string, n long")
    stored = bank.spark.read.option("header", True).csv(path)
    return stored.groupBy("dataset", F.col("run_date").cast("string").alias("run_date"), "reasons").agg(F.count(F.lit(1)).alias("n"))


@query
def io_report(bank: Bank) -> DataFrame:
    """A nested quality report written as JSON and read back, one row per check."""
    path = fresh_path(bank.spark, "reports")
    raw, checks = bank.raw_accounts, suites.account_checks(bank.raw_customers)
    results = materialize(check_engine.run_checks(raw, checks), "checks")
    report = suites.quality_report("accounts_raw", raw, results, bank.rules)
    exports.write_report(report, path, "accounts_raw", bank.rules.as_of.isoformat())
    stored = bank.spark.read.schema(report.schema).json(path)
    return stored.select("dataset_name", "overall_score", F.explode("checks").alias("c")).select(
        "dataset_name", "overall_score", "c.check_name", "c.passed", "c.failed_count"
    )


# ---- streaming -------------------------------------------------------------


@query
def stream_ingest(bank: Bank) -> DataFrame:
    """Two arrivals in a landing folder, each merged by its own stream run."""
    landing, path, checkpoint = (fresh_path(bank.spark, p) for p in ("arrivals", "stream-table", "stream-state"))
    first = F.col("_extract_ts") == sample_feed.FIRST_EXTRACT
    for arrival in (first, ~first):
        bank.raw_transactions.filter(arrival).write.mode("append").parquet(landing)
        stream = ingest.read_landing(bank.spark, landing, bank.raw_transactions.schema)
        ingest.ingest(stream, path, checkpoint, bank.rules).awaitTermination()
    return bank.spark.read.parquet(path).drop(tables.MONTH, "extract_ts")


@query
def stream_dedup(bank: Bank) -> DataFrame:
    """Ids seen by a stream that drops copies within a day of event time."""
    landing, path, checkpoint = (fresh_path(bank.spark, p) for p in ("arrivals", "stream-ids", "stream-state"))
    bank.raw_transactions.write.parquet(landing)
    raw = ingest.read_landing(bank.spark, landing, bank.raw_transactions.schema)
    timed = raw.select("transaction_id", "transaction_type", F.col("transaction_date").try_cast("timestamp").alias("event_time"))
    ingest.append_stream(ingest.dedup_stream(timed, "transaction_id", "event_time", "1 day"), path, checkpoint).awaitTermination()
    stored = read_optional(bank.spark, path)
    return stored.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("transaction_id").alias("ids"))


@query
def stream_dedup_late(bank: Bank) -> DataFrame:
    """Two arrivals through a dedup that keeps what is later than 180 days: where the rows of each went."""
    landing, path, checkpoint = (fresh_path(bank.spark, p) for p in ("arrivals", "stream-split", "stream-state"))
    first = F.col("_extract_ts") == sample_feed.FIRST_EXTRACT
    for arrival in (first, ~first):
        bank.raw_transactions.filter(arrival).write.mode("append").parquet(landing)
        raw = ingest.read_landing(bank.spark, landing, bank.raw_transactions.schema)
        timed = raw.select("transaction_id", F.col("transaction_date").try_cast("timestamp").alias("event_time"))
        ingest.dedup_keeping_late(timed, "transaction_id", "event_time", "180 days", path, checkpoint).awaitTermination()
    stored = bank.spark.read.parquet(f"{path}/counts")
    return stored.select(F.col("batch_id").cast("int"), "rows_in", "kept", "duplicates", "late")


# ---- all stages ------------------------------------------------------------


def _two_days(bank: Bank) -> str:
    """Two run days up to the fact: the first extract, then the later one with customers changed."""
    layout = daily.Layout(fresh_path(bank.spark, "run"))
    with working(bank.spark), shuffles_removed(bank.spark):
        landed, days = _landed_days(bank)
        for day, arrived in days:
            rules = rules_at(day)
            # what a day writes on its way goes with the day
            with working(bank.spark):
                feeds = {**landed, **arrived}
                clean, _ = daily.validate(feeds, layout, rules)
                daily.build_marts(bank.spark, daily.stage(feeds, clean, layout, rules), layout, rules)
    return layout.root


def _landed_days(bank: Bank) -> tuple[dict[str, DataFrame], list[tuple[date, dict[str, DataFrame]]]]:
    """The landed feeds, and what is their own on two run days: transactions of the first extract beside customers of other
    segments, then the later transactions and the customers as they are."""
    landed = {name: materialize(df, name) for name, df in bank.feeds.items()}
    transactions, customers = landed["transactions_raw"], landed["customers_raw"]
    first = F.col("_extract_ts") == sample_feed.FIRST_EXTRACT
    changed = F.when(F.col("customer_segment") == "Mass Market", "Affluent").otherwise("Mass Market")
    # the first day is nearly all of the landed rows and read from there
    before = {"transactions_raw": transactions.filter(first), "customers_raw": customers.withColumn("customer_segment", changed)}
    last = {"transactions_raw": materialize(transactions.filter(~first), "day"), "customers_raw": customers}
    return landed, [(date(2026, 8, 1), before), (bank.rules.as_of, last)]


_RUNS: dict[tuple[str, str], daily.Layout] = {}


def _repeated_days(bank: Bank) -> daily.Layout:
    """Once for each application and folder: three queries look at the tables of one run."""
    key = (bank.spark.sparkContext.applicationId, bank.sf_dir)
    if key not in _RUNS or not path_exists(bank.spark, _RUNS[key].root):
        _RUNS[key] = _run_repeated_days(bank)
    return _RUNS[key]


def _run_repeated_days(bank: Bank) -> daily.Layout:
    """Two run days up to the KPI tables, the second one twice."""
    layout = daily.Layout(fresh_path(bank.spark, "run"))
    with working(bank.spark), shuffles_removed(bank.spark):
        landed, days = _landed_days(bank)
        for day, arrived in (*days, days[-1]):
            rules = rules_at(day)
            # what a day writes on its way goes with the day
            with working(bank.spark):
                feeds = {**landed, **arrived}
                rows = split(flag_rows(feeds["transactions_raw"], suites.transaction_checks(landed["accounts_raw"], rules)))[0]
                staged = daily.stage(feeds, rows, layout, rules)
                daily.build_kpis(bank.spark, daily.build_marts(bank.spark, staged, layout, rules), layout, rules)
    return layout


@query
def run_two_days_stg(bank: Bank) -> DataFrame:
    """Staged transactions after two run days, the second one repeated."""
    return bank.spark.read.parquet(_repeated_days(bank).table("staging", "stg_transactions")).drop("extract_ts", tables.MONTH)


@query
def run_two_days_kpi(bank: Bank) -> DataFrame:
    """The daily KPI after two run days, the second one repeated."""
    return bank.spark.read.parquet(_repeated_days(bank).table("metrics", "kpi_daily_summary"))


@query
def kpi_segment_maintained(bank: Bank) -> DataFrame:
    """The segment KPI kept over two run days, on the second of which customers change their segment: that of a full rebuild."""
    return bank.spark.read.parquet(_repeated_days(bank).table("metrics", "kpi_customer_segment"))


@query
def daily_run(bank: Bank) -> DataFrame:
    """Landed feeds to KPI tables in one go; the rows of every table written."""
    root = fresh_path(bank.spark, "run")
    with working(bank.spark), shuffles_removed(bank.spark):
        landed = {name: materialize(df, name) for name, df in bank.feeds.items()}
        return daily.run_day(bank.spark, landed, root, bank.rules).select("dataset", "row_count")


@query
def daily_run_fact(bank: Bank) -> DataFrame:
    """The fact after two run days."""
    return bank.spark.read.parquet(f"{_two_days(bank)}/marts/fact_transactions").drop("_loaded_at", tables.MONTH)


__all__ = ["QUERIES", "RULES"]
