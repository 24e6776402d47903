"""Banking feeds derived from the star-schema test tables.

The tables hold no nulls, orphans or repeated order ids, so defects come from
fixed modulus rules; the whole table is used, every row yields a feed row.
Each function returns the raw schema plus ``_ingest_order`` (loans, which have
no number of their own, without it).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerframe.functions.keys import business_id

AS_OF = date(2026, 8, 2)
FIRST_EXTRACT = "2026-08-02T00:00:00"
SECOND_EXTRACT = "2026-08-02T06:00:00"
ORPHAN_ACCOUNT = "ACC_INVALID_9999"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _two_digits(number: str) -> str:
    return f"lpad({number}, 2, '0')"


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, a second and later copy for every 401st order."""
    copies = F.expr("explode(CASE WHEN o_orderkey % 401 = 13 THEN array(0, 1) ELSE array(0) END) AS copy")
    clock = [_two_digits(n) for n in ("o_orderkey % 24", "o_orderkey % 60", "(o_orderkey div 7) % 60")]
    account = business_id("ACC", F.expr("o_custkey * 2 + o_orderkey % 2"), 8)
    return (
        _table(spark, sf_dir, "orders")
        .select("*", copies)
        .select(
            business_id("TXN", F.col("o_orderkey"), 10).alias("transaction_id"),
            F.when(F.expr("o_orderkey % 389 = 11"), ORPHAN_ACCOUNT).otherwise(account).alias("account_id"),
            *map(
                F.expr,
                [
                    """get(array('Debit', 'Credit', 'Transfer', 'Bill Payment', 'ATM Withdrawal'), CAST(o_orderkey % 5 AS INT))
                       AS transaction_type""",
                    """CASE o_orderpriority WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'Mobile' WHEN '3-MEDIUM' THEN 'ATM'
                       WHEN '4-NOT SPECIFIED' THEN 'Branch' ELSE 'POS' END AS channel""",
                    """CASE WHEN o_orderkey % 307 = 5 THEN NULL WHEN o_orderkey % 503 = 7 THEN CAST(-99999999 AS DECIMAL(18,2))
                       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + copy AS DECIMAL(18,2)) END AS amount""",
                    "CASE WHEN (o_orderkey div 7) % 8 = 0 THEN 'USD' ELSE 'CAD' END AS currency",
                    """get(array('Grocery', 'Restaurant', 'Gas', 'Utilities', 'Entertainment', 'Travel', 'Healthcare', 'Retail'),
                       CAST(o_orderkey % 9 AS INT)) AS merchant_category""",
                    "CAST(add_months(to_date(o_orderdate), 300) AS STRING) AS transaction_date",
                    f"concat_ws(':', {', '.join(clock)}) AS transaction_time",
                    """CASE WHEN o_orderkey % 50 = 17 THEN 'Reversed' WHEN o_orderstatus = 'O' THEN 'Completed'
                       WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Failed' END AS status""",
                    "concat('Order ', o_orderpriority) AS description",
                    "'TPS_PAYMENTS_v2' AS _source_system",
                    f"CASE WHEN copy = 1 THEN '{SECOND_EXTRACT}' ELSE '{FIRST_EXTRACT}' END AS _extract_ts",
                    "o_orderkey * 2 + copy AS _ingest_order",
                ],
            ),
        )
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two accounts per customer; every 97th customer's accounts are orphans."""
    customer = F.when(F.expr("c_custkey % 97 = 3"), business_id("CUSTX", F.col("c_custkey"), 7)).otherwise(
        business_id("CUST", F.col("c_custkey"), 7)
    )
    return (
        _table(spark, sf_dir, "customer")
        .selectExpr("c_custkey", "c_acctbal", "explode(array(0, 1)) AS second")
        .selectExpr(
            "c_custkey",
            "c_custkey * 2 + second AS number",
            "CAST(CAST(c_acctbal AS DECIMAL(18,2)) * IF(second = 1, 12, 1) AS DECIMAL(18,2)) AS balance",
        )
        .select(
            business_id("ACC", F.col("number"), 8).alias("account_id"),
            customer.alias("customer_id"),
            *map(
                F.expr,
                [
                    "get(array('Chequing', 'Savings', 'TFSA', 'RRSP', 'GIC'), CAST(number % 5 AS INT)) AS account_type",
                    """CASE number % 20 WHEN 0 THEN 'Dormant' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Frozen' ELSE 'Active' END
                       AS account_status""",
                    "CASE WHEN number % 8 = 0 THEN 'USD' ELSE 'CAD' END AS currency",
                    "balance AS current_balance",
                    "CASE WHEN number % 13 <> 4 THEN CAST(round(balance * 0.95, 2) AS DECIMAL(18,2)) END AS available_balance",
                    "CAST(CASE WHEN number % 211 = 9 THEN 30 ELSE (number % 550) * 0.01 END AS DECIMAL(6,4)) AS interest_rate",
                    "CAST(date_add(DATE'2008-01-01', CAST((number * 311) % 5000 AS INT)) AS STRING) AS open_date",
                    f"""CASE WHEN number % 113 <> 5 THEN CAST(date_sub(DATE'{AS_OF}', CAST((number * 7) % 1500 AS INT)) AS STRING) END
                       AS last_activity_date""",
                ],
            ),
            business_id("BR", F.expr("number % 499 + 1"), 4).alias("branch_id"),
            F.lit("CORE_BANKING_v4").alias("_source_system"),
            F.lit(FIRST_EXTRACT).alias("_extract_ts"),
            F.col("number").alias("_ingest_order"),
        )
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, province taken from the nation table."""
    nations = _table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    key = F.col("c_custkey")
    return (
        _table(spark, sf_dir, "customer")
        .join(nations, "c_nationkey", "left")
        .select(
            business_id("CUST", key, 7).alias("customer_id"),
            F.expr("CASE WHEN c_custkey % 41 <> 6 THEN concat('First', c_custkey % 1000) END AS first_name"),
            F.col("c_name").alias("last_name"),
            F.expr("concat('user', c_custkey, '@example.com') AS email"),
            business_id("+1-555-", key, 7).alias("phone"),
            F.expr(
                """CASE WHEN c_custkey % 173 = 8 THEN 'unknown'
                   ELSE CAST(date_add(DATE'1936-01-01', CAST((c_custkey * 7919) % 26000 AS INT)) AS STRING) END AS date_of_birth"""
            ),
            F.expr("concat('  ', lower(n_name), ' ') AS province"),
            business_id("P", F.expr("c_custkey % 10000"), 5).alias("postal_code"),
            *map(
                F.expr,
                [
                    """CASE c_mktsegment WHEN 'BUILDING' THEN 'Small Business' WHEN 'FURNITURE' THEN 'Affluent'
                       WHEN 'MACHINERY' THEN 'Private Banking' ELSE 'Mass Market' END AS customer_segment""",
                    """CASE WHEN c_custkey % 20 = 3 THEN NULL WHEN c_custkey % 20 = 7 THEN 'Expired'
                       WHEN c_custkey % 20 IN (5, 6) THEN 'Pending' ELSE 'Verified' END AS kyc_status""",
                    "CAST(date_add(DATE'2000-01-01', CAST((c_custkey * 613) % 9000 AS INT)) AS STRING) AS join_date",
                    "c_custkey % 12 <> 5 AS is_active",
                    "'CORE_BANKING_v4' AS _source_system",
                    f"'{FIRST_EXTRACT}' AS _extract_ts",
                    "c_custkey AS _ingest_order",
                ],
            ),
        )
    )


def raw_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line; line numbers repeat, so loan ids do too."""
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "*", "CAST(l_extendedprice AS DECIMAL(18,2)) AS price", "add_months(to_date(l_shipdate), 240) AS originated"
    )
    return lines.select(
        business_id("LN", F.expr("l_orderkey * 10 + l_linenumber"), 8).alias("loan_id"),
        business_id("CUST", F.col("l_partkey"), 7).alias("customer_id"),
        *map(
            F.expr,
            [
                "get(array('Personal', 'Mortgage', 'Auto', 'Line of Credit'), CAST(l_partkey % 4 AS INT)) AS loan_type",
                "CASE WHEN l_partkey % 101 = 9 THEN CAST(0 AS DECIMAL(18,2)) ELSE price END AS original_amount",
                "CAST(round(price * (100 - CAST(l_quantity AS INT)) * 0.01, 2) AS DECIMAL(18,2)) AS outstanding_balance",
                "CAST(2.5 + (l_partkey % 1749) * 0.01 AS DECIMAL(6,4)) AS interest_rate",
                "CAST(l_linenumber * 12 AS INT) AS term_months",
                "CAST(originated AS STRING) AS origination_date",
                "CAST(date_add(originated, CAST(l_partkey % 9000 + 365 AS INT)) AS STRING) AS maturity_date",
                "CAST(300 + (l_partkey * 7) % 600 AS INT) AS credit_score",
                "get(array('AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC'), CAST(l_suppkey % 7 AS INT)) AS risk_rating",
                "CASE WHEN l_suppkey % 4 = 0 THEN CAST(l_partkey % 240 AS INT) ELSE 0 END AS days_past_due",
                "get(array('Current', 'Delinquent', 'Default', 'Paid Off', 'Current'), CAST(l_partkey % 5 AS INT)) AS loan_status",
                "get(array('Property', 'Vehicle', 'None', 'Other'), CAST(l_suppkey % 4 AS INT)) AS collateral_type",
                "'CREDIT_RISK_SYSTEM_v3' AS _source_system",
                f"'{FIRST_EXTRACT}' AS _extract_ts",
            ],
        ),
    )


def lineage_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field-level lineage as large as the tables: every order feeds its
    customer, every customer and supplier its nation, every nation its region."""

    def edges(df: DataFrame, source: str, source_key: str, target: str, target_key: str, step: str) -> DataFrame:
        return df.select(
            F.lit(source).alias("source_dataset"),
            F.col(source_key).cast("string").alias("source_column"),
            F.lit(target).alias("target_dataset"),
            F.col(target_key).cast("string").alias("target_column"),
            F.concat(F.lit(f"{source} to {target} "), F.col(target_key).cast("string")).alias("transformation_rule"),
            F.lit(step).alias("pipeline_step"),
        )

    levels = [
        ("orders", "o_orderkey", "customer", "o_custkey", "load.orders"),
        ("customer", "c_custkey", "nation", "c_nationkey", "load.customer"),
        ("supplier", "s_suppkey", "nation", "s_nationkey", "load.supplier"),
        ("nation", "n_nationkey", "region", "n_regionkey", "load.nation"),
    ]
    graph = None
    for name, key, target, target_key, step in levels:
        level = edges(_table(spark, sf_dir, name), name, key, target, target_key, step)
        graph = level if graph is None else graph.unionByName(level)
    return graph
