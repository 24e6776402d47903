"""The bank's tables in SQL, as named common table expressions.

Written apart from the Spark plans: rounding is integer arithmetic, history
comes from window functions over snapshots, graph walks from recursion.
"""

from __future__ import annotations

import re

AS_OF = "2026-08-02"
STAMP = "2026-08-02 00:00:00"


def half_up(numerator: str, denominator: str, scale: int = 1) -> str:
    """round_half_up(numerator / denominator) / scale, in integers until the end."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(SIGN({n}) * ((2 * ABS({n}) + {d}) // (2 * NULLIF({d}, 0))) / CAST({scale} AS DOUBLE))"


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


def mean_money(column: str) -> str:
    return half_up(f"SUM({cents(column)})", f"COUNT({column})", 100)


def pct(part: str, whole: str, digits: int = 2) -> str:
    return half_up(f"({part}) * {100 * 10**digits}", whole, 10**digits)


def padded(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


def picked(index: str, labels: list[str]) -> str:
    branches = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels))
    return f"CASE {index} {branches} END"


RAW_TRANSACTIONS = f"""
SELECT 'TXN' || {padded('o_orderkey', 10)} AS transaction_id,
  CASE WHEN o_orderkey % 389 = 11 THEN 'ACC_INVALID_9999'
       ELSE 'ACC' || {padded('o_custkey * 2 + o_orderkey % 2', 8)} END AS account_id,
  {picked('o_orderkey % 5', ['Debit', 'Credit', 'Transfer', 'Bill Payment', 'ATM Withdrawal'])} AS transaction_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'Mobile' WHEN '3-MEDIUM' THEN 'ATM'
       WHEN '4-NOT SPECIFIED' THEN 'Branch' ELSE 'POS' END AS channel,
  CAST(CASE WHEN o_orderkey % 307 = 5 THEN NULL WHEN o_orderkey % 503 = 7 THEN -99999999
       ELSE CAST(o_totalprice AS DECIMAL(18,2)) + copy END AS DECIMAL(18,2)) AS amount,
  CASE WHEN (o_orderkey // 7) % 8 = 0 THEN 'USD' ELSE 'CAD' END AS currency,
  {picked('o_orderkey % 9', ['Grocery', 'Restaurant', 'Gas', 'Utilities', 'Entertainment', 'Travel', 'Healthcare', 'Retail'])}
    AS merchant_category,
  CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 300 MONTH AS DATE) AS VARCHAR) AS transaction_date,
  {padded('o_orderkey % 24', 2)} || ':' || {padded('o_orderkey % 60', 2)} || ':' || {padded('(o_orderkey // 7) % 60', 2)}
    AS transaction_time,
  CASE WHEN o_orderkey % 50 = 17 THEN 'Reversed' WHEN o_orderstatus = 'O' THEN 'Completed'
       WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Failed' END AS status,
  'Order ' || o_orderpriority AS description,
  'TPS_PAYMENTS_v2' AS _source_system,
  CASE WHEN copy = 1 THEN '2026-08-02T06:00:00' ELSE '2026-08-02T00:00:00' END AS _extract_ts,
  o_orderkey * 2 + copy AS _ingest_order
FROM orders JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR o_orderkey % 401 = 13
"""

RAW_ACCOUNTS = f"""
SELECT 'ACC' || {padded('number', 8)} AS account_id,
  CASE WHEN c_custkey % 97 = 3 THEN 'CUSTX' ELSE 'CUST' END || {padded('c_custkey', 7)} AS customer_id,
  {picked('number % 5', ['Chequing', 'Savings', 'TFSA', 'RRSP', 'GIC'])} AS account_type,
  CASE number % 20 WHEN 0 THEN 'Dormant' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Frozen' ELSE 'Active' END AS account_status,
  CASE WHEN number % 8 = 0 THEN 'USD' ELSE 'CAD' END AS currency,
  balance AS current_balance,
  CASE WHEN number % 13 <> 4 THEN CAST(ROUND(balance * 0.95, 2) AS DECIMAL(18,2)) END AS available_balance,
  CAST(CASE WHEN number % 211 = 9 THEN 30 ELSE (number % 550) * 0.01 END AS DECIMAL(6,4)) AS interest_rate,
  CAST(DATE '2008-01-01' + CAST((number * 311) % 5000 AS INTEGER) AS VARCHAR) AS open_date,
  CASE WHEN number % 113 <> 5 THEN CAST(DATE '{AS_OF}' - CAST((number * 7) % 1500 AS INTEGER) AS VARCHAR) END
    AS last_activity_date,
  'BR' || {padded('number % 499 + 1', 4)} AS branch_id,
  'CORE_BANKING_v4' AS _source_system, '2026-08-02T00:00:00' AS _extract_ts, number AS _ingest_order
FROM (SELECT c_custkey, c_custkey * 2 + second AS number,
             CAST(CAST(c_acctbal AS DECIMAL(18,2)) * CASE second WHEN 1 THEN 12 ELSE 1 END AS DECIMAL(18,2)) AS balance
      FROM customer, (VALUES (0), (1)) AS s(second))
"""

RAW_CUSTOMERS = f"""
SELECT 'CUST' || {padded('c_custkey', 7)} AS customer_id,
  CASE WHEN c_custkey % 41 <> 6 THEN 'First' || CAST(c_custkey % 1000 AS VARCHAR) END AS first_name,
  c_name AS last_name,
  'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
  '+1-555-' || {padded('c_custkey', 7)} AS phone,
  CASE WHEN c_custkey % 173 = 8 THEN 'unknown'
       ELSE CAST(DATE '1936-01-01' + CAST((c_custkey * 7919) % 26000 AS INTEGER) AS VARCHAR) END AS date_of_birth,
  '  ' || lower(n_name) || ' ' AS province,
  'P' || {padded('c_custkey % 10000', 5)} AS postal_code,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Small Business' WHEN 'FURNITURE' THEN 'Affluent'
       WHEN 'MACHINERY' THEN 'Private Banking' ELSE 'Mass Market' END AS customer_segment,
  CASE c_custkey % 20 WHEN 3 THEN NULL WHEN 7 THEN 'Expired' WHEN 5 THEN 'Pending' WHEN 6 THEN 'Pending' ELSE 'Verified' END
    AS kyc_status,
  CAST(DATE '2000-01-01' + CAST((c_custkey * 613) % 9000 AS INTEGER) AS VARCHAR) AS join_date,
  c_custkey % 12 <> 5 AS is_active,
  'CORE_BANKING_v4' AS _source_system, '2026-08-02T00:00:00' AS _extract_ts, c_custkey AS _ingest_order
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
"""

RAW_CREDIT = f"""
SELECT 'LN' || {padded('l_orderkey * 10 + l_linenumber', 8)} AS loan_id,
  'CUST' || {padded('l_partkey', 7)} AS customer_id,
  {picked('l_partkey % 4', ['Personal', 'Mortgage', 'Auto', 'Line of Credit'])} AS loan_type,
  CASE WHEN l_partkey % 101 = 9 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS original_amount,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(100 - CAST(trunc(l_quantity) AS INTEGER) AS DECIMAL(5,0)) * 0.01, 2)
    AS DECIMAL(18,2)) AS outstanding_balance,
  CAST(2.5 + (l_partkey % 1749) * 0.01 AS DECIMAL(6,4)) AS interest_rate,
  CAST(l_linenumber * 12 AS INTEGER) AS term_months,
  CAST(originated AS VARCHAR) AS origination_date,
  CAST(originated + CAST(l_partkey % 9000 + 365 AS INTEGER) AS VARCHAR) AS maturity_date,
  CAST(300 + (l_partkey * 7) % 600 AS INTEGER) AS credit_score,
  {picked('l_suppkey % 7', ['AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC'])} AS risk_rating,
  CAST(CASE WHEN l_suppkey % 4 = 0 THEN l_partkey % 240 ELSE 0 END AS INTEGER) AS days_past_due,
  {picked('l_partkey % 5', ['Current', 'Delinquent', 'Default', 'Paid Off', 'Current'])} AS loan_status,
  {picked('l_suppkey % 4', ['Property', 'Vehicle', 'None', 'Other'])} AS collateral_type,
  'CREDIT_RISK_SYSTEM_v3' AS _source_system, '2026-08-02T00:00:00' AS _extract_ts
FROM (SELECT *, CAST(CAST(l_shipdate AS DATE) + INTERVAL 240 MONTH AS DATE) AS originated FROM lineitem)
"""


def staged_customers(as_of: str, where: str = "TRUE") -> str:
    def masked(c: str) -> str:
        return f"'MASKED_' || upper(substr(sha256({c}), 1, 12)) AS {c}"

    return f"""
SELECT *, CASE WHEN age_years < 26 THEN '18-25' WHEN age_years < 36 THEN '26-35' WHEN age_years < 51 THEN '36-50'
               WHEN age_years < 66 THEN '51-65' WHEN age_years >= 66 THEN '65+' END AS age_band
FROM (SELECT customer_id, {', '.join(masked(c) for c in ('first_name', 'last_name', 'email', 'phone', 'postal_code'))},
        TRY_CAST(date_of_birth AS DATE) AS date_of_birth, province, upper(trim(province)) AS province_code,
        customer_segment, coalesce(kyc_status, 'Unknown') AS kyc_status, TRY_CAST(join_date AS DATE) AS join_date, is_active,
        CAST(EXTRACT(year FROM age(TIMESTAMP '{as_of}', CAST(TRY_CAST(date_of_birth AS DATE) AS TIMESTAMP))) AS INTEGER) AS age_years,
        {half_up(f"(DATE '{as_of}' - TRY_CAST(join_date AS DATE)) * 1000", '36525', 10)} AS tenure_years
      FROM raw_customers WHERE customer_id IS NOT NULL AND {where})
"""


def staged_accounts(as_of: str, where: str = "TRUE") -> str:
    return f"""
SELECT *, account_status = 'Active' AND coalesce(days_since_activity > 730, FALSE) AS is_dormant
FROM (SELECT account_id, customer_id, account_type, account_status, currency, current_balance,
        coalesce(available_balance, current_balance) AS available_balance, interest_rate,
        CAST(open_date AS DATE) AS open_date, CAST(last_activity_date AS DATE) AS last_activity_date, branch_id,
        CAST(DATE '{as_of}' - CAST(open_date AS DATE) AS INTEGER) AS account_age_days,
        CAST(DATE '{as_of}' - CAST(last_activity_date AS DATE) AS INTEGER) AS days_since_activity,
        current_balance < 0 AS is_overdraft,
        CASE WHEN current_balance < 0 THEN 'Negative' WHEN current_balance < 1000 THEN 'Under $1K'
             WHEN current_balance < 10000 THEN '$1K-$10K' WHEN current_balance < 50000 THEN '$10K-$50K'
             WHEN current_balance < 100000 THEN '$50K-$100K' WHEN current_balance IS NOT NULL THEN 'Over $100K' END AS balance_tier
      FROM raw_accounts WHERE account_id IS NOT NULL AND customer_id IS NOT NULL AND {where})
"""


def staged_transactions(source: str = "raw_transactions", order: str = "_extract_ts DESC, _ingest_order") -> str:
    return f"""
SELECT * EXCLUDE (_source_system, _extract_ts, _ingest_order, rn),
  CASE WHEN transaction_type IN ('Debit', 'ATM Withdrawal', 'Bill Payment') THEN -amount_cad ELSE amount_cad END AS signed_amount_cad,
  amount_cad >= 400000 AS is_large_transaction,
  coalesce(merchant_category, 'Unclassified') AS merchant_category_clean,
  CAST(year(transaction_date) AS INTEGER) AS txn_year, CAST(month(transaction_date) AS INTEGER) AS txn_month,
  CAST(quarter(transaction_date) AS INTEGER) AS txn_quarter, CAST(weekofyear(transaction_date) AS INTEGER) AS txn_week,
  strftime(transaction_date, '%A') AS txn_day_of_week, isodow(transaction_date) IN (6, 7) AS is_weekend
FROM (SELECT * REPLACE (TRY_CAST(transaction_date AS DATE) AS transaction_date),
        CAST(CASE WHEN currency = 'USD' THEN ROUND(amount * 1.36, 2) ELSE amount END AS DECIMAL(18,2)) AS amount_cad
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY {order}) AS rn
            FROM {source} WHERE transaction_id IS NOT NULL)
      WHERE rn = 1 AND account_id IS NOT NULL AND amount IS NOT NULL)
"""


_LOAN_TIES = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "customer_id", "loan_type", "original_amount", "outstanding_balance", "interest_rate", "term_months", "origination_date",
        "maturity_date", "credit_score", "risk_rating", "days_past_due", "loan_status", "collateral_type", "_source_system",
    )
)

STG_CREDIT = f"""
SELECT * EXCLUDE (_source_system, _extract_ts, rn),
  CAST({half_up(f"(DATE '{AS_OF}' - origination_date) * 100", '3044')} AS INTEGER) AS loan_age_months,
  CAST({half_up(f"(maturity_date - DATE '{AS_OF}') * 100", '3044')} AS INTEGER) AS months_to_maturity,
  {half_up(f"{cents('outstanding_balance')} * 10000", cents('original_amount'), 10000)} AS ltv_ratio,
  CASE WHEN credit_score <= 0 OR credit_score > 900 THEN NULL WHEN credit_score <= 579 THEN 'Poor (<580)'
       WHEN credit_score <= 669 THEN 'Fair (580-669)' WHEN credit_score <= 739 THEN 'Good (670-739)'
       WHEN credit_score <= 799 THEN 'Very Good (740-799)' WHEN credit_score <= 900 THEN 'Excellent (800+)' END AS credit_score_band,
  coalesce(days_past_due > 0, FALSE) AS is_delinquent,
  CASE WHEN days_past_due <= -1 THEN NULL WHEN days_past_due <= 0 THEN 'Current' WHEN days_past_due <= 30 THEN '1-30 DPD'
       WHEN days_past_due <= 60 THEN '31-60 DPD' WHEN days_past_due <= 90 THEN '61-90 DPD'
       WHEN days_past_due <= 180 THEN '91-180 DPD' WHEN days_past_due > 180 THEN '180+ DPD' END AS delinquency_bucket
FROM (SELECT * REPLACE (CAST(origination_date AS DATE) AS origination_date, CAST(maturity_date AS DATE) AS maturity_date),
        ROW_NUMBER() OVER (PARTITION BY loan_id ORDER BY _extract_ts DESC, {_LOAN_TIES}) AS rn
      FROM raw_credit WHERE loan_id IS NOT NULL)
WHERE rn = 1
"""

DIM_DATE = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date, strftime(d, '%A') AS day_of_week,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week_num, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  isodow(d) IN (6, 7) AS is_weekend, CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%B') AS month_name,
  strftime(d, '%b') AS month_short, CAST(date_trunc('month', d) AS DATE) AS first_day_of_month,
  CAST(last_day(d) AS DATE) AS last_day_of_month, CAST(quarter(d) AS INTEGER) AS quarter,
  'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter,
  CAST(year(d) AS INTEGER) AS year, CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS fiscal_period,
  strftime(d, '%m-%d') IN ('01-01', '07-01', '11-11', '12-25', '12-26') AS is_holiday_ca
FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2030-12-30', INTERVAL 1 DAY)) AS DATE) AS d)
"""

DIM_MERCHANT = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY merchant_category) AS INTEGER) AS merchant_sk, *
FROM (VALUES ('Grocery', 'Food & Beverage', TRUE), ('Restaurant', 'Food & Beverage', FALSE), ('Gas', 'Transportation', TRUE),
  ('Utilities', 'Home & Bills', TRUE), ('Entertainment', 'Leisure', FALSE), ('Travel', 'Transportation', FALSE),
  ('Healthcare', 'Health', TRUE), ('Retail', 'Shopping', FALSE), ('ATM', 'Banking', TRUE), ('Salary', 'Income', TRUE),
  ('Transfer', 'Banking', TRUE), ('Unclassified', 'Other', FALSE)) AS v(merchant_category, category_group, is_essential)
"""

DIM_CUSTOMER = f"""
SELECT md5(customer_id) AS customer_sk, md5(customer_id || '-{AS_OF}') AS version_sk, customer_id, customer_segment, kyc_status, province_code AS province,
  age_band, tenure_years, is_active, '{AS_OF}' AS effective_from, CAST(NULL AS VARCHAR) AS effective_to, TRUE AS is_current
FROM stg_customers
"""

DIM_ACCOUNT = f"""
SELECT md5(a.account_id) AS account_sk, md5(a.account_id || '-{AS_OF}') AS version_sk, a.account_id, c.customer_sk, account_type, account_status, currency,
  balance_tier, branch_id, is_dormant, is_overdraft, open_date, '{AS_OF}' AS effective_from,
  CAST(NULL AS VARCHAR) AS effective_to, TRUE AS is_current
FROM stg_accounts a LEFT JOIN dim_customer c ON c.customer_id = a.customer_id
"""


def fact(source: str) -> str:
    return f"""
SELECT t.transaction_id, a.account_sk, a.customer_sk, d.date_sk, m.merchant_sk, t.transaction_type, t.channel, t.status,
  t.amount_cad, t.signed_amount_cad, t.is_large_transaction, t.is_weekend, t.transaction_date
FROM {source} t JOIN dim_account a ON a.account_id = t.account_id
LEFT JOIN dim_date d ON d.full_date = t.transaction_date
LEFT JOIN dim_merchant m ON m.merchant_category = t.merchant_category_clean
"""


def reasons(source: str) -> str:
    return f"""
SELECT t.*, concat_ws(';',
  CASE WHEN transaction_id IS NULL THEN 'not_null_transaction_id' END,
  CASE WHEN account_id IS NULL THEN 'not_null_account_id' END,
  CASE WHEN amount IS NULL THEN 'not_null_amount' END,
  CASE WHEN transaction_date IS NULL THEN 'not_null_transaction_date' END,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY _extract_ts DESC NULLS LAST, _ingest_order) > 1 THEN 'unique_transaction_id' END,
  CASE WHEN account_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM raw_accounts a WHERE a.account_id = t.account_id)
       THEN 'referential_integrity_account_id' END) AS reasons
FROM {source} t
"""


EDGES = """
SELECT 'orders' AS source_dataset, CAST(o_orderkey AS VARCHAR) AS source_column, 'customer' AS target_dataset,
  CAST(o_custkey AS VARCHAR) AS target_column, 'orders to customer ' || CAST(o_custkey AS VARCHAR) AS transformation_rule,
  'load.orders' AS pipeline_step FROM orders
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), 'nation', CAST(c_nationkey AS VARCHAR),
  'customer to nation ' || CAST(c_nationkey AS VARCHAR), 'load.customer' FROM customer
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), 'nation', CAST(s_nationkey AS VARCHAR),
  'supplier to nation ' || CAST(s_nationkey AS VARCHAR), 'load.supplier' FROM supplier
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), 'region', CAST(n_regionkey AS VARCHAR),
  'nation to region ' || CAST(n_regionkey AS VARCHAR), 'load.nation' FROM nation
"""

LOAD_DAYS = ("2020-01-01", "2023-01-01", "2026-01-01")

SCD_CUSTOMER = f"""
SELECT md5(customer_id) AS customer_sk, md5(customer_id || '-' || load_day) AS version_sk, customer_id, customer_segment, kyc_status,
  province, age_band, tenure_last AS tenure_years, is_active, load_day AS effective_from,
  LEAD(load_day) OVER (PARTITION BY customer_id ORDER BY load_day) AS effective_to,
  LEAD(load_day) OVER (PARTITION BY customer_id ORDER BY load_day) IS NULL AS is_current
FROM (SELECT *, arg_max(tenure_years, load_day) OVER (PARTITION BY customer_id, version) AS tenure_last
 FROM (SELECT *, COUNT(*) FILTER (WHERE opens) OVER (PARTITION BY customer_id ORDER BY load_day) AS version
  FROM (SELECT *, LAG(print) OVER (PARTITION BY customer_id ORDER BY load_day) IS DISTINCT FROM print AS opens
      FROM (SELECT *, concat_ws('|', customer_segment, kyc_status, coalesce(province, '?'), coalesce(age_band, '?'),
                                CAST(is_active AS VARCHAR)) AS print
            FROM ({' UNION ALL '.join(
                f"SELECT '{d}' AS load_day, customer_id, customer_segment, kyc_status, province_code AS province, age_band, "
                f"tenure_years, is_active FROM ({staged_customers(d, f"join_date <= '{d}'")})" for d in LOAD_DAYS)})))))
WHERE opens
"""

SCD_ACCOUNT = f"""
SELECT md5(account_id) AS account_sk, md5(account_id || '-' || load_day) AS version_sk, account_id, customer_sk, account_type, account_status, currency, balance_tier,
  branch_id, is_dormant, is_overdraft, CAST(open_date AS VARCHAR) AS open_date, load_day AS effective_from,
  LEAD(load_day) OVER (PARTITION BY account_id ORDER BY load_day) AS effective_to,
  LEAD(load_day) OVER (PARTITION BY account_id ORDER BY load_day) IS NULL AS is_current
FROM (SELECT *, LAG(print) OVER (PARTITION BY account_id ORDER BY load_day) IS DISTINCT FROM print AS opens
      FROM (SELECT *, concat_ws('|', coalesce(customer_sk, '?'), account_type, account_status, currency, balance_tier, branch_id,
                                CAST(is_dormant AS VARCHAR), CAST(is_overdraft AS VARCHAR), CAST(open_date AS VARCHAR)) AS print
            FROM (SELECT a.*, c.customer_sk FROM ({' UNION ALL '.join(
                f"SELECT '{d}' AS load_day, * FROM ({staged_accounts(d, f"open_date <= '{d}'")})" for d in LOAD_DAYS)}) a
                  LEFT JOIN scd_customer c ON c.customer_id = a.customer_id AND c.effective_from <= a.load_day
                       AND (c.effective_to IS NULL OR a.load_day < c.effective_to))))
WHERE opens
"""

# name -> body; a body may use the names above it
TABLES = {
    "raw_transactions": RAW_TRANSACTIONS,
    "raw_accounts": RAW_ACCOUNTS,
    "raw_customers": RAW_CUSTOMERS,
    "raw_credit": RAW_CREDIT,
    "stg_customers": staged_customers(AS_OF),
    "stg_accounts": staged_accounts(AS_OF),
    "stg_transactions": staged_transactions(),
    "stg_first": staged_transactions(order="_ingest_order"),
    "stg_credit": STG_CREDIT,
    "dim_date": DIM_DATE,
    "dim_merchant": DIM_MERCHANT,
    "dim_customer": DIM_CUSTOMER,
    "dim_account": DIM_ACCOUNT,
    "fact_transactions": fact("stg_transactions"),
    "flagged": reasons("raw_transactions"),
    "edges": EDGES,
    "scd_customer": SCD_CUSTOMER,
    "scd_account": SCD_ACCOUNT,
}


def with_tables(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``body`` behind exactly the common table expressions it needs."""
    tables = {**TABLES, **(extra or {})}
    names = list(tables)
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in names:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(tables[name])

    visit(body)
    # a table only ever uses others, so dependencies come first
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in names:
            if other != name and other in needed and re.search(rf"\b{other}\b", tables[name]):
                place(other)
        ordered.append(name)

    for name in names:
        if name in needed:
            place(name)
    if not ordered:
        return body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{name} AS ({tables[name]})" for name in ordered) + "\n" + body
