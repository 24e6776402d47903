from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tellerframe.functions.banding import BALANCE_TIERS
from tellerframe.plans import staging
from tellerframe.schemas import RAW_ACCOUNTS, RAW_CREDIT, RAW_CUSTOMERS, RAW_TRANSACTIONS

STAMP = ("SRC", "2024-01-01T00:00:00")


def money(v):
    return None if v is None else Decimal(str(v))


def transactions(spark, *data):
    """(id, account, type, amount, currency, category, day, extract)"""
    full = [
        (i, a, t, "Online", money(m), cur, cat, day, "10:00:00", "Completed", "text", "TPS", ts) for i, a, t, m, cur, cat, day, ts in data
    ]
    return spark.createDataFrame(full, RAW_TRANSACTIONS)


def sample(spark):
    return transactions(
        spark,
        ("TXN1", "ACC1", "Debit", 150, "CAD", "Grocery", "2024-01-15", "t1"),
        ("TXN2", "ACC2", "Credit", 9000, "USD", None, "2024-01-20", "t1"),
        ("TXN1", "ACC1", "Debit", 150, "CAD", "Grocery", "2024-01-15", "t1"),
    )


class TestTransactions:
    def test_sample(self, spark, rules):
        staged = {r.transaction_id: r for r in staging.stage_transactions(sample(spark), rules).collect()}
        assert set(staged) == {"TXN1", "TXN2"}
        first, second = staged["TXN1"], staged["TXN2"]
        assert (first.signed_amount_cad, first.is_large_transaction) == (Decimal("-150.00"), False)
        assert (second.amount_cad, second.amount, second.is_large_transaction) == (Decimal("12240.00"), Decimal("9000.00"), True)
        assert (second.merchant_category, second.merchant_category_clean) == (None, "Unclassified")
        assert (first.txn_year, first.txn_quarter, first.txn_week, first.txn_day_of_week) == (2024, 1, 3, "Monday")
        assert (first.is_weekend, second.is_weekend) == (False, True)
        assert "_extract_ts" not in first and first["_pipeline_version"] == "1.0.0"

    def test_newest_extract_wins_then_is_filtered(self, spark, rules, rows):
        raw = transactions(
            spark,
            ("A", "ACC1", "Debit", 1, "CAD", None, "2024-01-01", "t1"),
            ("A", "ACC1", "Debit", 2, "CAD", None, "2024-01-01", "t2"),
            ("B", "ACC1", "Debit", 1, "CAD", None, "2024-01-01", "t1"),
            ("B", "ACC1", "Debit", None, "CAD", None, "2024-01-01", "t2"),
            (None, "ACC1", "Debit", 1, "CAD", None, "2024-01-01", "t1"),
            ("C", None, "Debit", 1, "CAD", None, "2024-01-01", "t1"),
        )
        assert rows(staging.stage_transactions(raw, rules), "transaction_id", "amount") == [("A", Decimal("2.00"))]

    def test_first_read_wins_on_request(self, spark, rules, rows):
        raw = sample(spark).withColumn("_ingest_order", F.when(F.col("transaction_id") == "TXN1", 2).otherwise(1).cast("long"))
        extra = transactions(spark, ("TXN1", "ACC9", "Credit", 7, "CAD", None, "2024-01-01", "t9")).withColumn("_ingest_order", F.lit(0).cast("long"))
        staged = staging.stage_transactions(raw.unionByName(extra), rules, keep="first")
        assert rows(staged, "transaction_id", "account_id") == [("TXN1", "ACC9"), ("TXN2", "ACC2")]

    def test_tied_extracts_give_the_same_row_however_partitioned(self, spark, rules, rows):
        raw = transactions(spark, *[("A", f"ACC{n}", "Debit", n, "CAD", None, "2024-01-01", "t1") for n in range(20)])
        picks = {tuple(rows(staging.stage_transactions(raw.repartition(n), rules), "account_id")) for n in (1, 3, 7)}
        assert len(picks) == 1

    def test_sparse_dedup_gives_the_same_rows(self, spark, rules, rows):
        from tellerframe.operators.dedup import dedup_latest, dedup_sparse

        data = [("hot", f"ACC{n}", "Debit", n, "CAD", None, "2024-01-01", f"t{n % 7}") for n in range(50)]
        data += [(f"S{n}", "ACC1", "Debit", n, "CAD", None, "2024-01-01", "t1") for n in range(50)] + [(None, "A", "Debit", 1, "CAD", None, "x", "t1")] * 3
        raw = transactions(spark, *data)
        expected = rows(dedup_latest(raw, ["transaction_id"], "_extract_ts"))
        assert len(expected) == 52
        assert rows(dedup_sparse(raw, ["transaction_id"], "_extract_ts")) == expected

    def test_bad_date_becomes_null(self, spark, rules):
        raw = transactions(spark, ("A", "ACC1", "Debit", 1, "CAD", None, "not a date", "t1"))
        row = staging.stage_transactions(raw, rules).first()
        assert row.transaction_date is None and row.txn_year is None

    def test_dedup_limits_rows_before_the_shuffle(self, spark, rules):
        plan = staging.stage_transactions(sample(spark), rules)._jdf.queryExecution().executedPlan().toString()
        assert "Partial" in plan and plan.index("Partial") > plan.index("Exchange hashpartitioning")


class TestAccounts:
    def raw(self, spark, *data):
        """(id, balance, available, status, last activity)"""
        full = [(i, "C1", "Savings", st, "CAD", money(b), money(a), Decimal("1"), "2020-01-01", act, "BR1", *STAMP) for i, b, a, st, act in data]
        return spark.createDataFrame(full, RAW_ACCOUNTS)

    def test_flags_and_imputation(self, spark, rules):
        raw = self.raw(
            spark,
            ("A", 5000, 4900, "Active", "2024-06-01"),
            ("B", -200, None, "Active", "2021-01-01"),
            ("C", None, None, "Closed", "2021-01-01"),
            ("D", 0, 0, "Active", None),
        )
        a, b, c, d = staging.stage_accounts(raw, rules).orderBy("account_id").collect()
        assert (a.is_overdraft, a.is_dormant, a.balance_tier, a.days_since_activity) == (False, False, "$1K-$10K", 29)
        assert (b.is_overdraft, b.is_dormant, b.balance_tier, b.available_balance) == (True, True, "Negative", Decimal("-200.00"))
        assert (c.is_dormant, c.balance_tier) == (False, None)
        assert (d.is_dormant, d.days_since_activity, d.balance_tier) == (False, None, "Under $1K")

    def test_dormancy_needs_more_than_the_limit(self, spark, rules):
        limit = date.fromordinal(rules.as_of.toordinal() - 730).isoformat()
        beyond = date.fromordinal(rules.as_of.toordinal() - 731).isoformat()
        staged = staging.stage_accounts(self.raw(spark, ("A", 1, 1, "Active", limit), ("B", 1, 1, "Active", beyond)), rules)
        assert [r.is_dormant for r in staged.orderBy("account_id").collect()] == [False, True]

    def test_right_closed_tiers(self, spark, rules):
        staged = staging.stage_accounts(self.raw(spark, ("A", 0, 0, "Active", None)), rules, BALANCE_TIERS.right_closed())
        assert staged.first().balance_tier == "Negative"


class TestCustomers:
    def raw(self, spark, **changes):
        base = dict(zip(RAW_CUSTOMERS.names, ["C1", "Ann", None, "a@b.c", "1", "1990-06-30", "  on ", "A1", "Affluent", None, "2014-06-30", True, *STAMP]))
        return spark.createDataFrame([tuple({**base, **changes}.values())], RAW_CUSTOMERS)

    def test_row(self, spark, rules):
        row = staging.stage_customers(self.raw(spark), rules).first()
        assert (row.age_years, row.age_band, row.tenure_years) == (34, "26-35", Decimal("10.0"))
        assert (row.kyc_status, row.province, row.province_code) == ("Unknown", "  on ", "ON")
        assert row.first_name.startswith("MASKED_") and row.last_name is None
        assert row.date_of_birth == date(1990, 6, 30)

    def test_production_is_not_masked(self, spark, rules):
        assert staging.stage_customers(self.raw(spark), replace(rules, environment="prod")).first().first_name == "Ann"

    def test_unknown_birth_has_no_band_and_no_id_no_row(self, spark, rules):
        row = staging.stage_customers(self.raw(spark, date_of_birth="?"), rules).first()
        assert row.age_years is None and row.age_band is None
        assert staging.stage_customers(self.raw(spark, customer_id=None), rules).isEmpty()


class TestCredit:
    def raw(self, spark, *data):
        """(id, original, outstanding, score, days past due)"""
        full = [
            (i, "C1", "Auto", money(o), money(r), Decimal("5"), 60, "2023-06-30", "2026-06-30", s, "A", d, "Current", "None", *STAMP)
            for i, o, r, s, d in data
        ]
        return spark.createDataFrame(full, RAW_CREDIT)

    def test_rows(self, spark, rules):
        staged = staging.stage_credit(self.raw(spark, ("A", 500000, 400000, 780, 0), ("B", 0, 10, 610, 45), ("C", 20000, 0, 901, None)), rules)
        a, b, c = staged.orderBy("loan_id").collect()
        assert (a.ltv_ratio, a.credit_score_band, a.is_delinquent, a.delinquency_bucket) == (Decimal("0.8000"), "Very Good (740-799)", False, "Current")
        assert (b.ltv_ratio, b.credit_score_band, b.is_delinquent, b.delinquency_bucket) == (None, "Fair (580-669)", True, "31-60 DPD")
        assert (c.ltv_ratio, c.credit_score_band, c.is_delinquent, c.delinquency_bucket) == (Decimal("0.0000"), None, False, None)
        assert (a.loan_age_months, a.months_to_maturity) == (12, 24)

    def test_one_row_per_loan(self, spark, rules):
        raw = self.raw(spark, ("A", 1, 1, 700, 0), ("A", 1, 1, 700, 0), ("A", 2, 1, 700, 0))
        assert staging.stage_credit(raw, rules).count() == 1
