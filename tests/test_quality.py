from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tellerframe.operators import checks as c
from tellerframe.operators import score
from tellerframe.operators.profile import null_shares, profile
from tellerframe.operators.quarantine import flag_rows, quarantine
from tellerframe.plans import suites

FEED = "transaction_id string, account_id string, transaction_type string, amount decimal(18,2), currency string, transaction_date string, status string, _ingest_order long"


def feed(spark, data):
    typed = [(*r[:3], None if r[3] is None else Decimal(str(r[3])), *r[4:], i) for i, r in enumerate(data)]
    return spark.createDataFrame(typed, FEED)


@pytest.fixture
def clean(spark):
    return feed(
        spark,
        [
            ("TXN0000000001", "ACC00000001", "Debit", 150.00, "CAD", "2024-01-15", "Completed"),
            ("TXN0000000002", "ACC00000002", "Credit", 2500.00, "CAD", "2024-02-20", "Completed"),
            ("TXN0000000003", "ACC00000001", "Transfer", 75.50, "USD", "2024-03-10", "Pending"),
        ],
    )


@pytest.fixture
def dirty(spark):
    return feed(
        spark,
        [
            ("TXN001", "ACC001", "Debit", 100, "CAD", "2024-01-01", "Completed"),
            ("TXN001", "ACC001", "Debit", 100, "CAD", "2024-01-01", "Completed"),
            ("TXN002", "ACC002", "Credit", None, "CAD", "2024-01-02", "Completed"),
            (None, "ACC003", "Debit", 50, "CAD", "2024-01-03", "Failed"),
            ("TXN003", "INVALID", "Debit", -999999, "CAD", "2024-01-04", "INVALID_STATUS"),
        ],
    )


def accounts(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "account_id string")


def run(df, *checks):
    return {r.check_name: r for r in c.run_checks(df, checks).collect()}


def one(df, check):
    return c.run_checks(df, [check]).first()


class TestChecks:
    def test_clean_feed_passes(self, spark, clean, rules):
        results = run(clean, *suites.transaction_checks(accounts(spark, "ACC00000001", "ACC00000002"), rules))
        assert len(results) == 10
        assert all(r.passed and r.failed_count == 0 for r in results.values())

    def test_dirty_feed(self, spark, dirty, rules):
        results = run(dirty, *suites.transaction_checks(accounts(spark, "ACC001", "ACC002", "ACC003"), rules))
        failed = {name: (r.failed_count, float(r.failed_pct)) for name, r in results.items() if not r.passed}
        assert failed == {
            "not_null_transaction_id": (1, 20.0),
            "not_null_amount": (1, 20.0),
            "unique_transaction_id": (1, 20.0),
            "range_amount": (1, 20.0),
            "referential_integrity_account_id": (1, 20.0),
            "allowed_values_status": (1, 20.0),
        }
        assert results["not_null_amount"].dimension == "Completeness"
        assert results["unique_transaction_id"].dimension == "Uniqueness"
        assert results["referential_integrity_account_id"].dimension == "Referential Integrity"
        assert results["range_amount"].action == "FLAG"

    def test_results_follow_the_declared_schema(self, clean, rules):
        assert c.run_checks(clean, [c.not_null("amount"), c.unique("amount")]).schema.simpleString() == c.RESULT.simpleString()

    @pytest.mark.parametrize(
        ("values", "low", "high", "failed"),
        [([10, 20, -5, 0], 0, None, 1), ([10, 20, 600000], None, 500000, 1), ([10, None, 20], 0, 100, 0), ([0, 100], 0, 100, 0)],
    )
    def test_range_bounds(self, spark, values, low, high, failed):
        df = spark.createDataFrame([(v,) for v in values], "amount int")
        assert one(df, c.in_range("amount", low, high)).failed_count == failed

    def test_missing_columns(self, clean, spark):
        assert run(clean, c.not_null("nope"), c.unique("nope"), c.allowed("nope", ["a"]), c.references("nope", clean, "account_id")) == {}
        with pytest.raises(ValueError):
            c.run_checks(clean, [c.in_range("nope", 0)])
        assert not one(clean, c.exists("nope")).passed and one(clean, c.exists("amount")).passed

    def test_nulls_repeat_but_pass_references_and_value_sets(self, spark):
        df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
        results = run(df, c.unique("k"), c.references("k", accounts(spark, "a"), "account_id"), c.allowed("k", ["a"]))
        assert {n: r.failed_count for n, r in results.items()} == {"unique_k": 1, "referential_integrity_k": 0, "allowed_values_k": 0}
        assert one(df, c.unique("k", every_copy=True)).failed_count == 0

    def test_every_copy_counts_all_rows_of_a_repeated_value(self, spark):
        df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
        assert one(df, c.unique("k", every_copy=True)).failed_count == 2

    def test_null_keys_in_the_reference_do_not_hide_orphans(self, spark):
        df = spark.createDataFrame([("a",), ("b",)], "k string")
        known = spark.createDataFrame([("a",), (None,)], "account_id string")
        assert one(df, c.references("k", known, "account_id")).failed_count == 1

    def test_freshness(self, spark):
        df = spark.createDataFrame([("2024-01-01",), ("2020-01-01",), (None,), ("bad",)], "d string")
        result = one(df, c.fresh("d", 730, date(2024, 6, 30)))
        assert (result.failed_count, result.details) == (1, "Oldest record: 2020-01-01")
        nothing = spark.createDataFrame([("bad",)], "d string")
        assert one(nothing, c.fresh("d", 730, date(2024, 6, 30))).details == "No valid dates"

    def test_mostly(self, spark):
        df = spark.range(1000).select(F.when(F.col("id") == 0, -1).otherwise(1).alias("v"))
        assert one(df, c.in_range("v", 0, mostly=Decimal("0.999"))).passed
        assert not one(df, c.in_range("v", 0, mostly=Decimal("0.9999"))).passed

    def test_figures_of_the_whole_table(self, spark):
        df = spark.createDataFrame([(Decimal(v),) for v in (10, 20, 90)], "v decimal(18,2)")
        results = run(df, c.mean_between("v", 40, 40), c.median_between("v", 20, 20), c.row_count(1, 3))
        assert all(r.passed for r in results.values())
        assert not one(df, c.row_count(4, 9)).passed
        empty = df.limit(0)
        assert not one(empty, c.median_between("v", 0, 99)).passed and not one(empty, c.mean_between("v", 0, 99)).passed

    def test_empty_feed_fails_nothing(self, spark, clean, rules):
        results = run(clean.limit(0), *suites.transaction_checks(accounts(spark), rules))
        assert len(results) == 10
        assert all(r.passed and r.failed_pct == 0 for r in results.values())

    def test_samples_are_named(self, spark, dirty):
        checks = [c.allowed("status", suites.TRANSACTION_STATUS), c.references("account_id", accounts(spark, "ACC001"))]
        results = c.with_samples(c.run_checks(dirty, checks), dirty, checks).orderBy("check_index").collect()
        assert [r.details for r in results] == ["Invalid values: INVALID_STATUS", "Orphan keys: ACC002, ACC003, INVALID"]


class TestQuarantine:
    def test_dirty_rows_and_reasons(self, spark, dirty, rules, rows):
        checks = suites.transaction_checks(accounts(spark, "ACC001", "ACC002", "ACC003"), rules)
        clean, bad = quarantine(dirty, checks)
        assert rows(clean, "_ingest_order") == [(0,)]
        assert "reasons" not in clean.columns
        reasons = {r["_ingest_order"]: r.reasons for r in bad.collect()}
        assert reasons == {
            1: ["unique_transaction_id"],
            2: ["not_null_amount"],
            3: ["not_null_transaction_id"],
            4: ["referential_integrity_account_id"],
        }

    def test_clean_rows_stay(self, spark, clean, rules):
        flagged = flag_rows(clean, suites.transaction_checks(accounts(spark, "ACC00000001", "ACC00000002"), rules))
        assert flagged.filter(F.size("reasons") > 0).isEmpty() and flagged.count() == 3

    def test_flags_never_quarantine(self, spark, clean, rules):
        flagged = flag_rows(clean, [c.in_range("amount", 0, 1), c.fresh("transaction_date", 1, rules.as_of)])
        assert flagged.filter(F.size("reasons") > 0).isEmpty()

    def test_hot_id_keeps_one_row(self, spark):
        df = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("_ingest_order")
        )
        flagged = flag_rows(df, [c.unique("k")])
        assert flagged.filter(F.size("reasons") > 0).count() == 999
        assert flagged.filter((F.col("k") == "hot") & (F.size("reasons") == 0)).first()["_ingest_order"] == 0


class TestScore:
    def checks(self, spark, *results):
        schema = "dataset string, check_index int, dimension string, passed boolean, failed_pct decimal(5,2), action string"
        return spark.createDataFrame([("d", i, dim, p, Decimal(str(f)), a) for i, (dim, p, f, a) in enumerate(results)], schema)

    def test_no_checks_score_full(self, spark):
        assert score.quality_score(self.checks(spark)).first()[0] == 100

    def test_weights(self, spark):
        one_failed = lambda action: score.quality_score(
            self.checks(spark, ("Validity", False, 60, action), ("Validity", True, 0, "FLAG"))
        ).first()[0]
        assert [float(one_failed(a)) for a in ("QUARANTINE", "HALT", "FLAG", "WARN", "OTHER")] == [55.0, 50.0, 70.0, 80.0, 70.0]

    def test_actions(self, spark, rules):
        outcome = lambda *r: score.dataset_scores(self.checks(spark, *r), rules).first().pipeline_action
        assert outcome(("Validity", True, 0, "FLAG")) == "PROCEED"
        assert outcome(("Validity", False, 50, "FLAG")) == "WARN"
        assert outcome(("Schema", False, 1, "HALT"), ("Validity", True, 0, "FLAG")) == "HALT"

    def test_gate(self, spark, rules):
        scores = score.dataset_scores(self.checks(spark, ("Validity", False, 50, "FLAG")), rules)
        assert not score.may_proceed(scores, ["d"], rules)
        good = score.dataset_scores(self.checks(spark, ("Validity", True, 0, "FLAG")), rules)
        assert score.may_proceed(good, ["d"], rules)
        assert not score.may_proceed(good, ["d", "missing"], rules)

    def test_dimension_pivot_fills_zero(self, spark, rows):
        checks = self.checks(spark, ("Validity", False, 50, "FLAG"), ("Uniqueness", True, 0, "FLAG"))
        assert rows(score.by_dimension(checks)) == [("Uniqueness", 1, 0), ("Validity", 0, 1)]

    def test_account_suite(self, spark):
        df = spark.createDataFrame(
            [("ACC1", "C1", "Savings", Decimal("1"), "2020-01-01"), ("ACC1", "C9", "Gold", Decimal("30"), None)],
            "account_id string, customer_id string, account_type string, interest_rate decimal(6,4), open_date string",
        )
        customers = spark.createDataFrame([("C1",)], "customer_id string")
        failed = {n for n, r in run(df, *suites.account_checks(customers)).items() if not r.passed}
        assert failed == {
            "not_null_open_date", "unique_account_id", "referential_integrity_customer_id", "allowed_values_account_type", "range_interest_rate",
        }


class TestProfile:
    def test_figures(self, spark):
        df = spark.createDataFrame([(100.0, "x"), (200.0, "y"), (300.0, None)], "a double, b string")
        figures = {r.column_name: r for r in profile(df).collect()}
        a, b = figures["a"], figures["b"]
        assert (a.min_value, a.max_value, a.mean_value, a.std_value) == (100.0, 300.0, 200.0, 100.0)
        assert (b.null_count, float(b.null_pct), b.unique_count, b.min_value) == (1, 33.33, 2, None)
        assert b.sample_values == ["x", "y"] and len(a.sample_values) == 3

    def test_approximate_distinct_is_close(self, spark):
        df = spark.range(10_000).select((F.col("id") % 500).alias("v"))
        assert abs(profile(df, approximate=True).first().unique_count - 500) < 50

    def test_empty(self, spark):
        df = spark.createDataFrame([], "a int")
        row = profile(df).first()
        assert (row.total_count, row.unique_count, row.null_pct) == (0, 0, 0)

    def test_null_shares_leave_out_metadata(self, spark, rows):
        df = spark.createDataFrame([(1, None, 1), (None, None, 1)], "a int, b int, _x int")
        assert [(r.column_name, float(r.null_pct)) for r in null_shares(df, "d").collect()] == [("b", 100.0), ("a", 50.0)]


def test_report_is_nested(spark, dirty, rules):
    checks = suites.transaction_checks(accounts(spark, "ACC001", "ACC002", "ACC003"), rules)
    clean, bad = quarantine(dirty, checks)
    report = suites.quality_report("transactions_raw", clean, c.run_checks(dirty, checks), rules, bad).first()
    assert (report.total_rows, report.quarantined_rows, len(report.checks), len(report.column_profiles)) == (1, 4, 10, 8)
    assert [r.check_index for r in report.checks] == list(range(10))
    # 4 of 7 quarantining checks and 2 flags fail with 20 percent each
    assert float(report.overall_score) == round(100 - 100 * (4 * 3 + 2 * 1) * 0.2 / (6 * 3 + 3 * 1 + 0.5), 1)


def test_key_checks_read_the_table_once(spark):
    """However many keys and references: one scan of the table, one of each reference, one exchange of keys."""
    from tellerframe.operators.checks import references, run_checks, unique
    from tellerframe.sources.storage import materialize

    df = materialize(spark.range(50).selectExpr("id % 40 AS a", "id AS b", "id % 7 AS c", "cast(id % 3 AS int) AS d"), "checked")
    known = materialize(spark.range(5).selectExpr("id AS k"), "known")
    rules = [unique("a"), unique("b"), references("c", known, "k"), references("d", known, "k")]
    results = run_checks(df, rules)
    assert [r.failed_count for r in results.orderBy("check_index").collect()] == [10, 0, 14, 0]
    plan = results._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("FileScan parquet") == 3
    assert [r.failed_count for r in run_checks(df.limit(0), rules).collect()] == [0] * 4
