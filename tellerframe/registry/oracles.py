"""SQL for every query, over the given tables."""

from __future__ import annotations

from tellerframe.registry.oracle_tables import (
    AS_OF,
    DIM_ACCOUNT,
    DIM_CUSTOMER,
    STAMP,
    cents,
    fact,
    half_up,
    mean_money,
    pct,
    reasons,
    staged_accounts,
    staged_customers,
    staged_transactions,
    with_tables,
)

ORACLES: dict[str, str] = {}


BODIES: dict[str, str] = {}


def add(name: str, body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> None:
    BODIES[name] = body
    ORACLES[name] = with_tables(body, extra, recursive)


def double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


AUDIT = f"'{STAMP}' AS _transformed_at, '1.0.0' AS _pipeline_version"
LOADED = f"'{STAMP}' AS _loaded_at"

# ---- staging ---------------------------------------------------------------

add("stg_customers", f"SELECT * REPLACE ({text('join_date', 'date_of_birth')}), {AUDIT} FROM stg_customers")
add(
    "stg_customers_prod",
    f"""SELECT s.* REPLACE (r.first_name AS first_name, r.last_name AS last_name, r.email AS email, r.phone AS phone,
          r.postal_code AS postal_code, CAST(s.join_date AS VARCHAR) AS join_date, CAST(s.date_of_birth AS VARCHAR) AS date_of_birth),
        {AUDIT} FROM stg_customers s JOIN raw_customers r ON r.customer_id = s.customer_id""",
)
add(
    "mask_md5",
    """SELECT customer_id, 'MASKED_' || upper(substr(md5(first_name || last_name), 1, 12)) AS first_name,
         'MASKED_' || upper(substr(md5(last_name || customer_id), 1, 12)) AS last_name,
         'MASKED_' || upper(substr(md5(email), 1, 12)) || '@masked.internal' AS email FROM raw_customers""",
)
STAGED_ACCOUNTS = f"""SELECT * REPLACE ({double('current_balance', 'available_balance', 'interest_rate')},
    {text('open_date', 'last_activity_date')}), {AUDIT} FROM stg_accounts"""
add("stg_accounts", STAGED_ACCOUNTS)
add("io_parquet", STAGED_ACCOUNTS)
add(
    "tier_right_closed",
    """SELECT account_id, CASE WHEN current_balance <= 0 THEN 'Negative' WHEN current_balance <= 1000 THEN 'Under $1K'
         WHEN current_balance <= 10000 THEN '$1K-$10K' WHEN current_balance <= 50000 THEN '$10K-$50K'
         WHEN current_balance <= 100000 THEN '$50K-$100K' WHEN current_balance > 100000 THEN 'Over $100K' END AS balance_tier
       FROM raw_accounts""",
)


def staged(source: str) -> str:
    return f"""SELECT * REPLACE ({double('amount', 'amount_cad', 'signed_amount_cad')}, {text('transaction_date')}),
        {AUDIT} FROM {source}"""


add("stg_transactions", staged("stg_transactions"))
add("stg_transactions_first", staged("stg_first"))
add("stg_first_files", staged("stg_first"))
add("stg_transactions_sparse", staged("stg_transactions"))
add("upsert_staging", staged("stg_transactions"))
add("stream_ingest", staged("stg_transactions"))
add(
    "stg_credit",
    f"""SELECT * REPLACE ({double('original_amount', 'outstanding_balance', 'interest_rate')},
        {text('origination_date', 'maturity_date')}), {AUDIT} FROM stg_credit""",
)
add(
    "fx_rate_table",
    """SELECT currency, COUNT(amount) AS n,
         CAST(SUM(CASE WHEN currency = 'USD' THEN ROUND(amount * 1.36, 2) ELSE amount END) AS DOUBLE) AS total_cad
       FROM raw_transactions GROUP BY currency""",
)

# ---- star schema -----------------------------------------------------------

add(
    "dim_date",
    f"""SELECT d.* REPLACE ({text('full_date', 'first_day_of_month', 'last_day_of_month', 'first_day_of_quarter')}),
          (SELECT COUNT(*) FROM raw_transactions r WHERE r.transaction_date = CAST(d.full_date AS VARCHAR)) AS transactions
        FROM dim_date d""",
)
add(
    "dim_merchant",
    f"""SELECT m.*, {LOADED},
          (SELECT COUNT(*) FROM stg_transactions t WHERE t.merchant_category_clean = m.merchant_category) AS transactions
        FROM dim_merchant m""",
)
add("dim_customer", "SELECT * FROM dim_customer")
add("dim_account", "SELECT * REPLACE (CAST(open_date AS VARCHAR) AS open_date) FROM dim_account")
FACT_OUT = f"* REPLACE ({double('amount_cad', 'signed_amount_cad')}, {text('transaction_date')}), {LOADED}"
add("fact_transactions", f"SELECT {FACT_OUT} FROM fact_transactions")

# ---- analyst reports -------------------------------------------------------

FAILED = "CASE WHEN status = 'Failed' THEN 1 ELSE 0 END"
LARGE = "COUNT(*) FILTER (WHERE is_large_transaction)"
VOLUME = "CAST(SUM(amount_cad) AS DOUBLE)"

add(
    "q1_daily_summary",
    f"""SELECT CAST(d.full_date AS VARCHAR) AS full_date, d.day_of_week, COUNT(*) AS transaction_count,
          {VOLUME} AS total_volume_cad, {mean_money('amount_cad')} AS avg_amount_cad,
          COUNT(DISTINCT account_sk) AS active_accounts, {LARGE} AS fintrac_reportable_count,
          {pct(f'SUM({FAILED})', 'COUNT(*)')} AS failure_rate_pct
        FROM fact_transactions f JOIN dim_date d ON d.date_sk = f.date_sk GROUP BY d.full_date, d.day_of_week""",
)
add(
    "q2_segment_analysis",
    f"""SELECT customer_segment, age_band, province, COUNT(DISTINCT f.customer_sk) AS customer_count,
          COUNT(*) AS total_transactions, {VOLUME} AS total_spend_cad, {mean_money('amount_cad')} AS avg_transaction_cad,
          {half_up(f"SUM({cents('amount_cad')})", 'COUNT(DISTINCT f.customer_sk)', 100)} AS avg_spend_per_customer
        FROM fact_transactions f JOIN dim_customer c ON c.customer_sk = f.customer_sk
        GROUP BY customer_segment, age_band, province""",
)
add(
    "q3_dormancy",
    f"""SELECT account_type, balance_tier, COUNT(*) AS total_accounts,
          COUNT(*) FILTER (WHERE is_dormant) AS dormant_accounts,
          {pct('COUNT(*) FILTER (WHERE is_dormant)', 'COUNT(*)')} AS dormancy_rate_pct,
          {half_up('SUM(days_since_activity)', 'COUNT(days_since_activity)')} AS avg_days_inactive
        FROM stg_accounts WHERE account_status = 'Active' GROUP BY account_type, balance_tier""",
)
add(
    "q4_channel_mom",
    f"""SELECT year, month_number, month_name, channel, n AS transaction_count, volume_cad, avg_amount,
          {half_up('(n - before) * 10000', 'before', 100)} AS txn_count_mom_pct
        FROM (SELECT *, LAG(n) OVER (PARTITION BY channel ORDER BY year, month_number) AS before
              FROM (SELECT d.year, d.month_number, d.month_name, f.channel, COUNT(*) AS n, {VOLUME} AS volume_cad,
                      {mean_money('amount_cad')} AS avg_amount
                    FROM fact_transactions f JOIN dim_date d ON d.date_sk = f.date_sk GROUP BY ALL))""",
)
add(
    "q5_large_register",
    """SELECT f.transaction_id, CAST(f.transaction_date AS VARCHAR) AS transaction_date, f.transaction_type, f.channel,
         CAST(f.amount_cad AS DOUBLE) AS amount_cad, a.account_id, a.account_type, a.currency, c.customer_id,
         c.customer_segment, c.kyc_status, c.province
       FROM fact_transactions f JOIN dim_account a ON a.account_sk = f.account_sk
       JOIN dim_customer c ON c.customer_sk = f.customer_sk WHERE f.is_large_transaction AND f.status = 'Completed'""",
)
add(
    "q6_credit_portfolio",
    f"""SELECT risk_rating, loan_type, credit_score_band, delinquency_bucket, COUNT(*) AS loan_count,
          CAST(SUM(original_amount) AS DOUBLE) AS total_original_cad,
          CAST(SUM(outstanding_balance) AS DOUBLE) AS total_outstanding_cad,
          {half_up('SUM(CAST(ROUND(ltv_ratio * 10000) AS HUGEINT))', 'COUNT(ltv_ratio)', 10000)} AS avg_ltv,
          {half_up('SUM(credit_score)', 'COUNT(credit_score)')} AS avg_credit_score,
          COUNT(*) FILTER (WHERE is_delinquent) AS delinquent_count,
          {pct('COUNT(*) FILTER (WHERE is_delinquent)', 'COUNT(*)')} AS delinquency_rate_pct
        FROM stg_credit GROUP BY risk_rating, loan_type, credit_score_band, delinquency_bucket""",
)
add(
    "q7_lifetime_value",
    f"""SELECT customer_segment, age_band, province, COUNT(*) AS customer_count,
          {mean_money('volume')} AS avg_lifetime_value_cad, {half_up('SUM(n)', 'COUNT(n)')} AS avg_txn_count,
          {half_up('SUM(accounts) * 10', 'COUNT(accounts)', 10)} AS avg_products_held,
          {half_up('SUM(days) * 1000', 'COUNT(days) * 36525', 10)} AS avg_active_years
        FROM (SELECT customer_sk, COUNT(*) AS n, SUM(amount_cad) AS volume, COUNT(DISTINCT account_sk) AS accounts,
                MAX(transaction_date) - MIN(transaction_date) AS days
              FROM fact_transactions WHERE status = 'Completed' GROUP BY customer_sk) a
        JOIN dim_customer c ON c.customer_sk = a.customer_sk GROUP BY customer_segment, age_band, province""",
)

# ---- KPI tables and declared metrics ---------------------------------------


def when(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


add(
    "kpi_daily_summary",
    f"""SELECT CAST(transaction_date AS VARCHAR) AS summary_date, COUNT(*) AS transaction_count,
          {VOLUME} AS total_volume_cad, {mean_money('amount_cad')} AS avg_transaction_cad,
          COUNT(DISTINCT account_sk) AS unique_accounts, COUNT(DISTINCT customer_sk) AS unique_customers,
          {pct(f'SUM({FAILED})', 'COUNT(*)')} AS failure_rate_pct, {LARGE} AS large_txn_count,
          {when('is_weekend')} AS weekend_txn_count, {when('NOT is_weekend')} AS weekday_txn_count,
          {', '.join(f"{when(f"channel = '{c}'")} AS {c.lower()}_count" for c in ('Online', 'Mobile', 'ATM', 'Branch'))},
          '{STAMP}' AS _computed_at
        FROM fact_transactions GROUP BY transaction_date""",
)
add(
    "kpi_period_uniques",
    " UNION ALL ".join(
        f"""SELECT CAST(CAST(date_trunc('{unit}', transaction_date) AS DATE) AS VARCHAR) AS summary_date, COUNT(DISTINCT account_sk) AS unique_accounts,
          COUNT(DISTINCT customer_sk) AS unique_customers, '{unit}' AS period FROM fact_transactions GROUP BY ALL"""
        for unit in ("week", "month")
    ),
)
add(
    "kpi_daily_staged",
    f"""SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, COUNT(transaction_id) AS transaction_count,
          {VOLUME} AS total_volume_cad, {mean_money('amount_cad')} AS avg_transaction_cad,
          COUNT(DISTINCT account_id) AS unique_accounts, {LARGE} AS large_txn_count
        FROM stg_transactions WHERE transaction_date IS NOT NULL GROUP BY transaction_date""",
)
add(
    "kpi_customer_segment",
    f"""SELECT CAST(flow.month AS VARCHAR) AS summary_date, flow.customer_segment, active_accounts, avg_balance_cad,
          total_transactions, dormant_accounts, '{STAMP}' AS _computed_at
        FROM (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, customer_segment, COUNT(*) AS total_transactions
              FROM fact_transactions f JOIN dim_customer c ON c.customer_sk = f.customer_sk GROUP BY ALL) flow
        LEFT JOIN (SELECT customer_segment, {when("account_status = 'Active'")} AS active_accounts,
                {mean_money('current_balance')} AS avg_balance_cad, {when('is_dormant')} AS dormant_accounts
              FROM stg_accounts a JOIN dim_customer c ON c.customer_id = a.customer_id GROUP BY customer_segment) stock
        ON stock.customer_segment = flow.customer_segment""",
)
add(
    "aum",
    f"SELECT '{AS_OF}' AS summary_date, CAST(SUM(current_balance) AS DOUBLE) AS total_aum_cad, COUNT(*) AS accounts FROM stg_accounts",
)
add(
    "dormancy_30_60_90",
    """SELECT CASE WHEN days_since_activity <= 30 THEN '0-30 days' WHEN days_since_activity <= 60 THEN '31-60 days'
         WHEN days_since_activity <= 90 THEN '61-90 days' ELSE 'Over 90 days' END AS inactivity_band,
         COUNT(*) AS accounts, CAST(SUM(current_balance) AS DOUBLE) AS balance_cad
       FROM stg_accounts WHERE days_since_activity IS NOT NULL GROUP BY 1""",
)
INTEREST = f"""SELECT coalesce(SUM({cents('{balance}')} * CAST(interest_rate * 10000 AS HUGEINT)), 0) FROM {{table}}"""
EARNED = INTEREST.replace("{balance}", "outstanding_balance").replace("{table}", "stg_credit")
PAID = INTEREST.replace("{balance}", "current_balance").replace("{table}", "stg_accounts")
add(
    "nii",
    f"""SELECT '{AS_OF}' AS summary_date, {half_up('earned', '1000000', 100)} AS interest_earned_cad,
          {half_up('paid', '1000000', 100)} AS interest_paid_cad, {half_up('earned - paid', '1000000', 100)} AS nii_cad
        FROM (SELECT ({EARNED}) AS earned, ({PAID}) AS paid)""",
)

# ---- dashboard -------------------------------------------------------------


def cards(where: str) -> str:
    return f"""SELECT {VOLUME} AS total_volume_cad, COUNT(*) AS transaction_count,
          {pct(f'SUM({FAILED})', 'COUNT(*)', 1)} AS failure_rate_pct, {LARGE} AS large_transactions,
          (SELECT {when("account_status = 'Active'")} FROM stg_accounts) AS active_accounts,
          (SELECT {pct(when('is_dormant'), 'COUNT(*)', 1)} FROM stg_accounts) AS dormancy_rate_pct
        FROM stg_transactions WHERE {where}"""


def counted(name: str, table: str, column: str, labels: tuple[str, ...] = (), key: str = "") -> None:
    rank = f", CAST({ranked(column, labels)} AS INTEGER) AS sort_rank" if labels else ""
    group = f"{column}, {key}" if key else column
    known = f"{column} IS NOT NULL" + (f" AND {key} IS NOT NULL" if key else "")
    add(name, f"SELECT {group}, COUNT(*) AS n{rank} FROM {table} WHERE {known} GROUP BY {group}")


def ranked(column: str, labels: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{label}'" for label in labels)
    return f"coalesce(list_position([{listed}], {column}) - 1, {len(labels)})"


add("dash_kpi_cards", cards("TRUE"))
add(
    "dash_filtered_cards",
    cards(
        "transaction_date >= DATE '2022-01-01' AND transaction_date <= DATE '2024-12-31' "
        "AND channel IN ('Online', 'Mobile') AND transaction_type IN ('Debit', 'Credit', 'Transfer')"
    ),
)
add(
    "dash_trend",
    f"""SELECT CAST(transaction_date AS VARCHAR) AS transaction_date, {VOLUME} AS volume, COUNT(transaction_id) AS n
        FROM stg_transactions WHERE transaction_date IS NOT NULL GROUP BY transaction_date""",
)
add("dash_channel", f"SELECT channel, {VOLUME} AS volume FROM stg_transactions WHERE channel IS NOT NULL GROUP BY channel")
add(
    "dash_top_merchants",
    f"""SELECT merchant_category_clean AS merchant_category, {VOLUME} AS spend FROM stg_transactions
        GROUP BY merchant_category_clean ORDER BY SUM(amount_cad) DESC NULLS LAST, merchant_category_clean LIMIT 8""",
)
counted("dash_account_type", "stg_accounts", "account_type")
counted(
    "dash_tier", "stg_accounts", "balance_tier", ("Negative", "Under $1K", "$1K-$10K", "$10K-$50K", "$50K-$100K", "Over $100K")
)
add(
    "dash_province",
    """SELECT c.province_code AS province, CAST(SUM(a.current_balance) AS DOUBLE) AS deposits
       FROM stg_accounts a JOIN stg_customers c ON c.customer_id = a.customer_id GROUP BY c.province_code""",
)
counted("dash_segment", "stg_customers", "customer_segment")
counted(
    "dash_age_segment", "stg_customers", "age_band", ("18-25", "26-35", "36-50", "51-65", "65+"), "customer_segment"
)
add(
    "dash_risk",
    f"""SELECT risk_rating, COUNT(loan_id) AS loans, CAST(SUM(outstanding_balance) AS DOUBLE) AS outstanding,
          CAST({ranked('risk_rating', ('AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC'))} AS INTEGER) AS sort_rank
        FROM stg_credit WHERE risk_rating IS NOT NULL GROUP BY risk_rating""",
)
counted(
    "dash_delinquency", "stg_credit", "delinquency_bucket",
    ("Current", "1-30 DPD", "31-60 DPD", "61-90 DPD", "91-180 DPD", "180+ DPD"),
)
counted(
    "dash_score_band", "stg_credit", "credit_score_band",
    ("Poor (<580)", "Fair (580-669)", "Good (670-739)", "Very Good (740-799)", "Excellent (800+)"),
)

# ---- profiling -------------------------------------------------------------

RAW_COLUMNS = {
    "raw_customers": (
        "customer_id first_name last_name email phone date_of_birth province postal_code customer_segment kyc_status join_date is_active"
    ).split(),
    "raw_accounts": (
        "account_id customer_id account_type account_status currency current_balance available_balance interest_rate open_date"
        " last_activity_date branch_id"
    ).split(),
    "raw_transactions": (
        "transaction_id account_id transaction_type channel amount currency merchant_category transaction_date transaction_time"
        " status description"
    ).split(),
    "raw_credit": (
        "loan_id customer_id loan_type original_amount outstanding_balance interest_rate term_months origination_date maturity_date"
        " credit_score risk_rating days_past_due loan_status collateral_type"
    ).split(),
}
FEEDS = {
    "customers_raw": "raw_customers",
    "accounts_raw": "raw_accounts",
    "transactions_raw": "raw_transactions",
    "credit_data_raw": "raw_credit",
}

add(
    "prof_null_pct",
    " UNION ALL ".join(
        f"SELECT '{feed}' AS dataset, '{c}' AS column_name, {pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} AS null_pct FROM {table}"
        for feed, table in FEEDS.items()
        for c in RAW_COLUMNS[table]
    ),
)
add(
    "prof_median",
    f"""SELECT transaction_type, SUM({cents('amount_cad')}) / (COUNT(*) * CAST(100 AS DOUBLE)) AS median_amount_cad
        FROM (SELECT transaction_type, amount_cad, ROW_NUMBER() OVER (PARTITION BY transaction_type ORDER BY amount_cad) AS rn,
                COUNT(*) OVER (PARTITION BY transaction_type) AS n
              FROM stg_transactions WHERE transaction_type IS NOT NULL AND amount_cad IS NOT NULL)
        WHERE rn IN ((n + 1) // 2, (n + 2) // 2) GROUP BY transaction_type""",
)


def histogram(name: str, table: str, value: str, cap: int, bins: int, unit: int, where: str = "TRUE") -> None:
    v = f"CAST(least({value}, {cap}) * {unit} AS HUGEINT)"
    add(
        name,
        f"""SELECT CAST(b.bin AS INTEGER) AS bin, {half_up(f'low * {bins} + (high - low) * b.bin', str(bins), unit)} AS lower_edge,
              (SELECT COUNT(*) FROM {table}, (SELECT MIN({v}) AS lo, MAX({v}) AS hi FROM {table} WHERE {where} AND {value} IS NOT NULL)
               WHERE {where} AND {value} IS NOT NULL AND b.bin =
                 CASE WHEN lo = hi THEN {bins // 2} ELSE least((({v} - lo) * {bins}) // NULLIF(hi - lo, 0), {bins - 1}) END) AS n
            FROM (SELECT unnest(range({bins})) AS bin) b,
              (SELECT MIN({v}) AS low, MAX({v}) AS high FROM {table} WHERE {where} AND {value} IS NOT NULL)""",
    )


histogram("prof_hist_amount", "stg_transactions", "amount_cad", 300_000, 60, 100)
histogram("prof_hist_large", "stg_transactions", "amount_cad", 600_000, 30, 100, "is_large_transaction")
histogram("prof_hist_inactivity", "stg_accounts", "days_since_activity", 1_500, 50, 1)
add(
    "prof_dormancy",
    f"""SELECT account_type, {half_up('r6', '10000', 100)} AS dormancy_rate_pct,
          (SELECT {half_up('SUM(r4)', 'COUNT(*) * 100', 100)} FROM rates) AS mean_rate_pct FROM rates""",
    {
        "rates": f"""SELECT account_type, r6, CAST({half_up('r6', '100')} AS HUGEINT) AS r4
            FROM (SELECT account_type, CAST({half_up('COUNT(*) FILTER (WHERE is_dormant) * 100000000', 'COUNT(*)')} AS HUGEINT) AS r6
                  FROM stg_accounts WHERE account_type IS NOT NULL GROUP BY account_type)"""
    },
)


def figures(dataset: str, table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS figure, CAST({sql} AS DOUBLE) AS value FROM {table}" for name, sql in columns.items()
    )


add(
    "prof_summary",
    " UNION ALL ".join(
        [
            figures(
                "transactions",
                "stg_transactions",
                {
                    "records": "COUNT(*)",
                    "total_volume_cad": "SUM(amount_cad)",
                    "avg_transaction_cad": mean_money("amount_cad"),
                    "large_transactions": LARGE,
                    "failure_rate_pct": pct(f"SUM({FAILED})", "COUNT(*)", 1),
                },
            ),
            figures(
                "accounts",
                "stg_accounts",
                {
                    "records": "COUNT(*)",
                    "dormancy_rate_pct": pct(when("is_dormant"), "COUNT(*)", 1),
                    "overdraft_rate_pct": pct(when("is_overdraft"), "COUNT(*)", 1),
                    "total_deposits_cad": "SUM(CASE WHEN current_balance > 0 THEN current_balance END)",
                },
            ),
            figures(
                "credit",
                "stg_credit",
                {
                    "records": "COUNT(*)",
                    "delinquency_rate_pct": pct(when("is_delinquent"), "COUNT(*)", 1),
                    "total_exposure_cad": "SUM(outstanding_balance)",
                    "avg_ltv": half_up("SUM(CAST(ROUND(ltv_ratio * 10000) AS HUGEINT))", "COUNT(ltv_ratio)", 10000),
                },
            ),
        ]
    ),
)
add(
    "prof_bounds",
    "SELECT CAST(MIN(transaction_date) AS VARCHAR) AS min_date, CAST(MAX(transaction_date) AS VARCHAR) AS max_date FROM stg_transactions",
)
add(
    "prof_options",
    """SELECT DISTINCT 'channel' AS filter, channel AS option FROM stg_transactions WHERE channel IS NOT NULL
       UNION ALL SELECT DISTINCT 'transaction_type', transaction_type FROM stg_transactions WHERE transaction_type IS NOT NULL""",
)

# ---- quality ---------------------------------------------------------------


class Rule:
    """One check as scalar subqueries."""

    def __init__(self, name, dimension, column, rule, action, failed, total, details="'OK'", passed="failed_count = 0"):
        self.name, self.dimension, self.column, self.rule, self.action = name, dimension, column, rule, action
        self.failed, self.total, self.details, self.passed = failed, total, details, passed

    def row(self, index: int, dataset: str | None = None) -> str:
        first = f"'{dataset}' AS dataset, " if dataset else ""
        column = f"'{self.column}'" if self.column else "CAST(NULL AS VARCHAR)"
        rule = self.rule.replace("'", "''")
        return f"""SELECT {first}CAST({index} AS INTEGER) AS check_index, '{self.name}' AS check_name, '{self.dimension}' AS dimension,
            {column} AS "column", '{rule}' AS rule_description, {self.passed} AS passed, failed_count,
            coalesce({half_up('failed_count * 10000', 'total', 100)}, 0) AS failed_pct, '{self.action}' AS action, {self.details} AS details
            FROM (SELECT CAST(({self.failed}) AS BIGINT) AS failed_count, CAST(({self.total}) AS BIGINT) AS total)"""


def suite(rules: list[Rule], dataset: str | None = None) -> str:
    return " UNION ALL ".join(rule.row(i, dataset) for i, rule in enumerate(rules))


def counting(before: str, after: str) -> str:
    return f"CASE WHEN failed_count = 0 THEN 'OK' ELSE '{before}' || CAST(failed_count AS VARCHAR) || '{after}' END"


def quoted(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rows(table: str) -> str:
    return f"SELECT COUNT(*) FROM {table}"


def nn(t: str, c: str) -> Rule:
    return Rule(
        f"not_null_{c}", "Completeness", c, f"Column '{c}' must not contain null values", "QUARANTINE",
        f"SELECT COUNT(*) FROM {t} WHERE {c} IS NULL", rows(t), counting("Nulls found in ", " rows"),
    )


def uq(t: str, c: str, every: bool = False) -> Rule:
    failed = f"SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {c} FROM {t})) FROM {t}"
    if every:
        failed = f"SELECT coalesce(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
    return Rule(
        f"unique_{c}", "Uniqueness", c, f"Column '{c}' must contain unique values", "QUARANTINE", failed, rows(t),
        counting("", " duplicate rows detected"),
    )


def rng(t: str, c: str, low, high, most_per_mille: int = 1000) -> Rule:
    broken = " OR ".join([f"{c} < {low}"] * (low is not None) + [f"{c} > {high}"] * (high is not None))
    allowance = 1000 - most_per_mille
    passed = f"failed_count * 1000 <= (SELECT COUNT({c}) FROM {t}) * {allowance}" if allowance else "failed_count = 0"
    return Rule(
        f"range_{c}", "Validity", c, f"'{c}' must be between {low} and {high}", "FLAG",
        f"SELECT COUNT(*) FROM {t} WHERE {broken}", rows(t), counting("", " values outside expected range"), passed,
    )


def alw(t: str, c: str, *values: str) -> Rule:
    values = tuple(sorted(values))
    return Rule(
        f"allowed_values_{c}", "Validity", c, f"'{c}' must be one of: {', '.join(values)}", "FLAG",
        f"SELECT COUNT(*) FROM {t} WHERE {c} NOT IN ({quoted(values)})", rows(t), counting("", " invalid values"),
    )


def ref(t: str, c: str, other: str, key: str | None = None, listed: bool = False) -> Rule:
    orphan = f"FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {other} y WHERE y.{key or c} = x.{c})"
    shown = f"(SELECT CAST(COUNT(DISTINCT x.{c}) AS VARCHAR) {orphan})"
    if listed:
        shown = f"(SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT x.{c} AS v {orphan} ORDER BY v LIMIT 5))"
    return Rule(
        f"referential_integrity_{c}", "Referential Integrity", c, f"All '{c}' values must exist in the reference table", "QUARANTINE",
        f"SELECT COUNT(*) {orphan}", rows(t), f"CASE WHEN failed_count = 0 THEN 'OK' ELSE 'Orphan keys: ' || {shown} END",
    )


def fresh(t: str, c: str, days: int) -> Rule:
    return Rule(
        f"freshness_{c}", "Freshness", c, f"'{c}' values must be within {days} days", "WARN",
        f"SELECT COUNT(*) FROM {t} WHERE DATE '{AS_OF}' - TRY_CAST({c} AS DATE) > {days}", rows(t),
        f"coalesce('Oldest record: ' || (SELECT CAST(MIN(TRY_CAST({c} AS DATE)) AS VARCHAR) FROM {t}), 'No valid dates')",
    )


def present(c: str) -> Rule:
    return Rule(f"exists_{c}", "Schema", c, f"Column '{c}' must exist", "HALT", "SELECT 0", "SELECT 1")


def within(kind: str, label: str, c: str, low: int, high: int, figure: str) -> Rule:
    return Rule(
        f"{kind}_{c}", "Distribution", c, f"{label} of '{c}' must be between {low} and {high}", "FLAG",
        f"SELECT CASE WHEN ({figure}) BETWEEN {low} AND {high} THEN 0 ELSE 1 END", "SELECT 1",
        f"'{label}: ' || coalesce(CAST(({figure}) AS VARCHAR), 'none')",
    )


STATUS = ("Completed", "Pending", "Failed", "Reversed")
TYPES = ("Debit", "Credit", "Transfer", "Bill Payment", "ATM Withdrawal")
ACCOUNT_TYPES = ("Chequing", "Savings", "TFSA", "RRSP", "GIC")
KYC = ("Verified", "Pending", "Expired", "Unknown")
SEGMENTS = ("Mass Market", "Affluent", "Private Banking", "Small Business")


def transaction_rules(listed: bool = False) -> list[Rule]:
    t = "raw_transactions"
    return [
        nn(t, "transaction_id"), nn(t, "account_id"), nn(t, "amount"), nn(t, "transaction_date"), uq(t, "transaction_id"),
        rng(t, "amount", 0, 500000), ref(t, "account_id", "raw_accounts", listed=listed), alw(t, "status", *STATUS),
        alw(t, "transaction_type", *TYPES), fresh(t, "transaction_date", 730),
    ]


def account_rules() -> list[Rule]:
    t = "raw_accounts"
    return [
        nn(t, "account_id"), nn(t, "customer_id"), nn(t, "account_type"), nn(t, "open_date"), uq(t, "account_id"),
        ref(t, "customer_id", "raw_customers"), alw(t, "account_type", *ACCOUNT_TYPES), rng(t, "interest_rate", 0, 25),
    ]


CHECKED = " UNION ALL ".join(
    [
        suite(transaction_rules(), "transactions_raw"),
        suite(account_rules(), "accounts_raw"),
        suite(
            [
                nn("raw_customers", "customer_id"), nn("raw_customers", "date_of_birth"), uq("raw_customers", "customer_id"),
                alw("raw_customers", "kyc_status", *KYC), alw("raw_customers", "customer_segment", *SEGMENTS),
            ],
            "customers_raw",
        ),
        suite(
            [
                nn("raw_credit", "loan_id"), uq("raw_credit", "loan_id"), ref("raw_credit", "customer_id", "raw_customers"),
                rng("raw_credit", "credit_score", 300, 900), rng("raw_credit", "original_amount", 0, None),
            ],
            "credit_data_raw",
        ),
    ]
)

# weights in tenths, percents in hundredths
WEIGHT = "CASE action WHEN 'QUARANTINE' THEN 30 WHEN 'HALT' THEN 50 WHEN 'FLAG' THEN 10 WHEN 'WARN' THEN 5 ELSE 10 END"
PENALTY = half_up(
    f"SUM(CASE WHEN NOT passed THEN {WEIGHT} * CAST(ROUND(failed_pct * 100) AS HUGEINT) ELSE 0 END) * 1000000",
    f"100 * SUM({WEIGHT})",
)
SCORE = half_up(f"greatest(0, 100000000 - {PENALTY})", "100000", 10)
SCORES = {
    "checked": CHECKED,
    "scores": f"""SELECT dataset, {SCORE} AS overall_score, COUNT(*) AS checks_run, {when('passed')} AS checks_passed,
        {when('NOT passed')} AS checks_failed, {when("action = 'HALT' AND NOT passed")} AS halted FROM checked GROUP BY dataset""",
}
ACTION = "CASE WHEN halted > 0 THEN 'HALT' WHEN overall_score < 85 THEN 'WARN' ELSE 'PROCEED' END"

add("dq_checks", suite(transaction_rules(listed=True)))
add("dq_account_checks", suite(account_rules()))
add("dq_score", f"SELECT * EXCLUDE (halted), {ACTION} AS pipeline_action FROM scores", SCORES)
add(
    "dq_gate",
    """SELECT lowest_score, CASE WHEN lowest_score < 70 THEN 'halt' ELSE 'proceed' END AS decision
       FROM (SELECT CAST(MIN(overall_score) AS DOUBLE) AS lowest_score FROM scores WHERE dataset IN ('transactions_raw', 'accounts_raw'))""",
    SCORES,
)
GOOD = "10000 - CAST(ROUND(failed_pct * 100) AS HUGEINT)"


def dimension_mark(dimension: str) -> str:
    only = f"FILTER (WHERE dimension = '{dimension}')"
    return f"{half_up(f'SUM({GOOD}) {only}', f'COUNT(*) {only}', 100)} AS {dimension.split()[0].lower()}"


add(
    "dq_scorecard",
    f"""SELECT m.*, s.overall_score FROM (SELECT dataset,
          {', '.join(dimension_mark(d) for d in ('Completeness', 'Uniqueness', 'Validity', 'Referential Integrity', 'Freshness'))}
        FROM checked GROUP BY dataset) m JOIN scores s ON s.dataset = m.dataset""",
    SCORES,
)
add(
    "dq_by_dimension",
    f"SELECT dimension, {when('passed')} AS checks_passed, {when('NOT passed')} AS checks_failed FROM checked GROUP BY dimension",
    SCORES,
)
add(
    "dq_totals",
    f"""SELECT COUNT(*) AS checks_run, {when('passed')} AS checks_passed, {when('NOT passed')} AS checks_failed,
          {pct(when('passed'), 'COUNT(*)')} AS passed_pct FROM checked""",
    SCORES,
)
add(
    "dq_failures",
    """SELECT dataset, check_index, check_name, failed_count, failed_pct FROM checked WHERE NOT passed
       QUALIFY ROW_NUMBER() OVER (PARTITION BY dataset ORDER BY check_index) <= 5""",
    SCORES,
)
PROFILED = [*RAW_COLUMNS["raw_transactions"], "_extract_ts"]


def profiled(c: str) -> str:
    numeric = c == "amount"
    stats = {
        "min_value": "CAST(MIN(amount) AS DOUBLE)",
        "max_value": "CAST(MAX(amount) AS DOUBLE)",
        "mean_value": "ROUND(AVG(CAST(amount AS DOUBLE)), 1)",
        "std_value": "ROUND(STDDEV_SAMP(CAST(amount AS DOUBLE)), 1)",
    }
    return f"""SELECT '{c}' AS column_name, '{"decimal(18,2)" if numeric else "string"}' AS dtype, COUNT(*) AS total_count,
        COUNT(*) - COUNT({c}) AS null_count, {pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} AS null_pct,
        COUNT(DISTINCT {c}) AS unique_count, {pct(f'COUNT(DISTINCT {c})', 'COUNT(*)')} AS unique_pct,
        {', '.join(f"{sql if numeric else 'CAST(NULL AS DOUBLE)'} AS {name}" for name, sql in stats.items())},
        coalesce((SELECT string_agg(v, ';' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM raw_transactions
          WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)), '') AS sample_values
        FROM raw_transactions"""


add("dq_profile", " UNION ALL ".join(profiled(c) for c in PROFILED))
add("dq_quarantine", "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM flagged WHERE reasons <> ''")
add("dq_clean", "SELECT * EXCLUDE (reasons) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM flagged WHERE reasons = ''")
add(
    "dq_report",
    f"""SELECT 'transactions_raw' AS dataset_name, '2026-08-02T00:00:00' AS run_timestamp,
          (SELECT COUNT(*) FROM flagged WHERE reasons = '') AS total_rows, CAST(14 AS INTEGER) AS total_columns, overall_score,
          (SELECT COUNT(*) FROM flagged WHERE reasons <> '') AS quarantined_rows, {ACTION} AS pipeline_action,
          CAST(checks_run AS INTEGER) AS checks, CAST(checks_failed AS INTEGER) AS failed_checks, CAST(14 AS INTEGER) AS profiles
        FROM scores WHERE dataset = 'transactions_raw'""",
    SCORES,
)
ACCOUNT_COLUMNS = [
    *[(c, "string") for c in RAW_COLUMNS["raw_accounts"][:5]],
    ("current_balance", "decimal(18,2)"), ("available_balance", "decimal(18,2)"), ("interest_rate", "decimal(6,4)"),
    *[(c, "string") for c in ("open_date", "last_activity_date", "branch_id", "_source_system", "_extract_ts")],
]
add(
    "dq_schema_drift",
    " UNION ALL ".join(
        [
            f"""SELECT '{c}' AS column_name, '{kind}' AS expected_type, '{kind}' AS actual_type, 'ok' AS status,
                COUNT(*) - COUNT({c}) AS null_count FROM raw_accounts"""
            for c, kind in ACCOUNT_COLUMNS
        ]
        + ["SELECT '_ingest_order', NULL, 'bigint', 'extra', COUNT(*) - COUNT(_ingest_order) FROM raw_accounts"]
    ),
)
add(
    "dq_row_counts",
    " UNION ALL ".join(
        f"SELECT '{feed}' AS dataset, COUNT(*) AS row_count, CAST({len(RAW_COLUMNS[table]) + 2 + (table != 'raw_credit')} AS INTEGER)"
        f" AS column_count FROM {table}"
        for feed, table in FEEDS.items()
    ),
)

# ---- expectation suites and model tests ------------------------------------

T = "raw_transactions"
MEAN = (
    f"SELECT CAST(CAST({half_up(f'SUM({cents("amount")}) * 100', 'COUNT(amount)')} AS DECIMAL(30,0)) * CAST(0.0001 AS DECIMAL(5,4))"
    f" AS DECIMAL(35,4)) FROM {T}"
)
MEDIAN = f"""SELECT CAST(CAST(SUM({cents('amount')}) * 10 // COUNT(*) AS DECIMAL(30,0)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(34,3))
    FROM (SELECT amount, ROW_NUMBER() OVER (ORDER BY amount) AS rn, COUNT(*) OVER () AS n FROM {T} WHERE amount IS NOT NULL)
    WHERE rn IN ((n + 1) // 2, (n + 2) // 2)"""
TRANSACTION_SUITE = [
    *[nn(T, c) for c in ("transaction_id", "account_id", "amount", "transaction_date", "status")],
    uq(T, "transaction_id", every=True),
    alw(T, "status", *STATUS),
    alw(T, "transaction_type", *TYPES),
    alw(T, "currency", "CAD", "USD"),
    rng(T, "amount", 0, 500000, most_per_mille=999),
    *[present(c) for c in ("transaction_id", "account_id", "amount")],
    Rule(
        "row_count", "Volume", None, "Row count must be between 1 and 10000000", "FLAG",
        f"SELECT CASE WHEN COUNT(*) BETWEEN 1 AND 10000000 THEN 0 ELSE 1 END FROM {T}", "SELECT 1",
        f"'Rows: ' || (SELECT CAST(COUNT(*) AS VARCHAR) FROM {T})",
    ),
    within("mean", "Mean", "amount", 50, 5000, MEAN),
    within("median", "Median", "amount", 10, 1000, MEDIAN),
]
A = "raw_accounts"
ACCOUNT_SUITE = [
    nn(A, "account_id"), nn(A, "customer_id"), uq(A, "account_id", every=True), alw(A, "account_type", *ACCOUNT_TYPES),
    alw(A, "account_status", "Active", "Dormant", "Closed", "Frozen"), rng(A, "interest_rate", 0, 25),
]
add("ge_transactions", suite(TRANSACTION_SUITE))
add("ge_accounts", suite(ACCOUNT_SUITE))
add(
    "ge_summary",
    f"""SELECT dataset, bool_and(passed) AS success, {when('passed')} AS checks_passed, {when('NOT passed')} AS checks_failed,
          CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END AS status FROM results GROUP BY dataset""",
    {"results": suite(TRANSACTION_SUITE, "transactions") + " UNION ALL " + suite(ACCOUNT_SUITE, "accounts")},
)
add(
    "ge_checkpoint",
    f"SELECT * FROM ({BODIES['ge_summary']}) UNION ALL SELECT 'customers', NULL, NULL, NULL, 'skipped'",
    {"results": suite(TRANSACTION_SUITE, "transactions") + " UNION ALL " + suite(ACCOUNT_SUITE, "accounts")},
)
MODEL_RULES = {
    "customers_raw": [nn("raw_customers", "customer_id"), uq("raw_customers", "customer_id"), alw("raw_customers", "kyc_status", *KYC)],
    "accounts_raw": [nn(A, "account_id"), uq(A, "account_id"), nn(A, "customer_id"), ref(A, "customer_id", "raw_customers")],
    "transactions_raw": [nn(T, "transaction_id"), uq(T, "transaction_id"), nn(T, "amount"), rng(T, "amount", 0, 500000)],
    "credit_data_raw": [nn("raw_credit", "loan_id"), uq("raw_credit", "loan_id")],
    "stg_customers": [
        nn("stg_customers", "customer_id"), uq("stg_customers", "customer_id"), nn("stg_customers", "kyc_status"),
        alw("stg_customers", "kyc_status", *KYC), alw("stg_customers", "customer_segment", *SEGMENTS),
        alw("stg_customers", "age_band", "18-25", "26-35", "36-50", "51-65", "65+"),
    ],
    "stg_accounts": [
        nn("stg_accounts", "account_id"), uq("stg_accounts", "account_id"), nn("stg_accounts", "customer_id"),
        ref("stg_accounts", "customer_id", "stg_customers"), nn("stg_accounts", "is_dormant"), nn("stg_accounts", "balance_tier"),
        alw("stg_accounts", "balance_tier", "Negative", "Under $1K", "$1K-$10K", "$10K-$50K", "$50K-$100K", "Over $100K"),
    ],
    "stg_transactions": [
        nn("stg_transactions", "transaction_id"), uq("stg_transactions", "transaction_id"), nn("stg_transactions", "amount_cad"),
        nn("stg_transactions", "is_large_transaction"), alw("stg_transactions", "status", *STATUS),
    ],
    "dim_customer": [
        nn("dim_customer", "customer_sk"), uq("dim_customer", "version_sk"), nn("dim_customer", "customer_id"),
        nn("dim_customer", "is_current"), nn("dim_customer", "effective_from"),
    ],
    "dim_account": [
        nn("dim_account", "account_sk"), uq("dim_account", "version_sk"), nn("dim_account", "account_id"),
        nn("dim_account", "customer_sk"), ref("dim_account", "customer_sk", "dim_customer"),
    ],
    "fact_transactions": [
        nn("fact_transactions", "transaction_id"), uq("fact_transactions", "transaction_id"), nn("fact_transactions", "account_sk"),
        ref("fact_transactions", "account_sk", "dim_account"), nn("fact_transactions", "customer_sk"),
        ref("fact_transactions", "customer_sk", "dim_customer"), nn("fact_transactions", "date_sk"),
        ref("fact_transactions", "date_sk", "dim_date"), nn("fact_transactions", "amount_cad"),
    ],
    "kpi_daily_summary": [
        nn("kpi", "summary_date"), uq("kpi", "summary_date"), rng("kpi", "failure_rate_pct", 0, 100),
    ],
}
add(
    "model_tests",
    "SELECT dataset, check_index, check_name, passed, failed_count, failed_pct FROM results",
    {
        "kpi": f"""SELECT transaction_date AS summary_date, {pct(f'SUM({FAILED})', 'COUNT(*)')} AS failure_rate_pct
            FROM fact_transactions GROUP BY transaction_date""",
        "results": " UNION ALL ".join(suite(rules, name) for name, rules in MODEL_RULES.items()),
    },
)

# ---- profiles of stored days -----------------------------------------------

SKETCHED = ("account_id", "channel", "status", "merchant_category", "amount_cad", "signed_amount_cad", "txn_year", "txn_month")
NUMBERS = SKETCHED[4:]
BASE_MONTHS = "transaction_date BETWEEN DATE '2020-01-01' AND DATE '2021-12-31'"
OTHER_MONTHS = "transaction_date BETWEEN DATE '2022-01-01' AND DATE '2023-12-31'"


def stored_mean(c: str, where: str) -> str:
    """A mean with four decimals, half away from zero."""
    total, n = f"CAST(SUM({c}) FILTER (WHERE {where}) * 100 AS HUGEINT)", f"COUNT({c}) FILTER (WHERE {where})"
    return f"sign({total}) * ((abs({total}) * 200 + {n}) // (2 * NULLIF({n}, 0)))"


def sketched(c: str) -> str:
    number = c in NUMBERS
    least, greatest, mean = (f"CAST(MIN({c}) AS DOUBLE)", f"CAST(MAX({c}) AS DOUBLE)", f"{stored_mean(c, BASE_MONTHS)} / 10000.0") if number else ("NULL",) * 3
    return f"""SELECT '{c}' AS column_name, COUNT(*) AS total_count, COUNT(*) - COUNT({c}) AS null_count, CAST({least} AS DOUBLE) AS min_value,
        CAST({greatest} AS DOUBLE) AS max_value, CAST({mean} AS DOUBLE) AS mean_value, TRUE AS unique_close
        FROM stg_transactions WHERE {BASE_MONTHS} HAVING COUNT(*) > 0"""


add("prof_range", " UNION ALL ".join(sketched(c) for c in SKETCHED))


def drifted(c: str) -> str:
    """Exact: the largest distance between both cumulative shares, and the change of the null share."""
    nulls = [f"(1 - COUNT({c}) FILTER (WHERE {w}) / COUNT(*) FILTER (WHERE {w}))" for w in (BASE_MONTHS, OTHER_MONTHS)]
    apart, shift = "FALSE", "NULL"
    if c in NUMBERS:
        shares = [f"SUM(CASE WHEN {w} THEN 1 ELSE 0 END) OVER (ORDER BY {c}) / (SUM(CASE WHEN {w} THEN 1.0 END) OVER ())" for w in (BASE_MONTHS, OTHER_MONTHS)]
        apart = f"""coalesce((SELECT MAX(abs(one - two)) > 0.25 FROM (SELECT {shares[0]} AS one, {shares[1]} AS two
            FROM stg_transactions WHERE {c} IS NOT NULL AND ({BASE_MONTHS} OR {OTHER_MONTHS}))), FALSE)"""
        shift = f"({stored_mean(c, OTHER_MONTHS)} - {stored_mean(c, BASE_MONTHS)}) / 10000.0"
    return f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {BASE_MONTHS}) AS base_count, COUNT(*) FILTER (WHERE {OTHER_MONTHS}) AS other_count,
        CAST({shift} AS DOUBLE) AS mean_shift, {apart} OR coalesce(abs({nulls[0]} - {nulls[1]}) > 0.25, FALSE) AS drifted
        FROM stg_transactions WHERE {BASE_MONTHS} OR {OTHER_MONTHS} HAVING COUNT(*) > 0"""


add("prof_drift", " UNION ALL ".join(drifted(c) for c in SKETCHED))

# ---- history ---------------------------------------------------------------

add("scd2_customer", "SELECT * FROM scd_customer")
add("scd2_account", "SELECT * FROM scd_account")
# the order of loads makes no difference
add("scd2_any_order", "SELECT * FROM scd_customer")
add("scd2_account_any_order", "SELECT * FROM scd_account")
POINT_IN_TIME = f"""SELECT c.customer_segment, c.age_band, t.txn_year, COUNT(*) AS n, {VOLUME} AS volume_cad
        FROM stg_transactions t JOIN stg_accounts a ON a.account_id = t.account_id
        LEFT JOIN scd_customer c ON c.customer_id = a.customer_id AND CAST(t.transaction_date AS VARCHAR) >= c.effective_from
             AND (c.effective_to IS NULL OR CAST(t.transaction_date AS VARCHAR) < c.effective_to)
        GROUP BY c.customer_segment, c.age_band, t.txn_year"""
add("pit_segment", POINT_IN_TIME)
add("pit_any_order", POINT_IN_TIME)
add("pit_segment_filled", POINT_IN_TIME)
add(
    "pit_last_activity",
    """SELECT txn_year, COUNT(*) AS n, COUNT(day_volume) AS n_before, CAST(SUM(day_volume) AS DOUBLE) AS volume_before
       FROM stg_transactions t LEFT JOIN (
         SELECT account_id AS a, transaction_date AS d, lag(day_volume) OVER (PARTITION BY account_id ORDER BY transaction_date) AS day_volume
         FROM (SELECT account_id, transaction_date, SUM(amount_cad) AS day_volume FROM stg_transactions
               WHERE transaction_date IS NOT NULL GROUP BY account_id, transaction_date))
       ON a = account_id AND d = transaction_date GROUP BY txn_year""",
)

# ---- incremental loads -----------------------------------------------------

MONTH_KEY = "CAST(year(transaction_date) * 100 + month(transaction_date) AS INTEGER) AS month_key"
# every load ends in what a full rebuild gives
add("incremental_fact", f"SELECT {FACT_OUT}, {MONTH_KEY} FROM fact_transactions")
add("incremental_correction", f"SELECT {FACT_OUT}, {MONTH_KEY} FROM fact_transactions")
add(
    "incremental_late",
    f"SELECT {FACT_OUT}, {MONTH_KEY} FROM fact_late",
    {
        "raw_late": """SELECT * REPLACE (CASE WHEN transaction_id = 'TXN0000000007' THEN '2029-12-31' ELSE transaction_date END
            AS transaction_date) FROM raw_transactions""",
        "stg_late": staged_transactions("raw_late"),
        "fact_late": fact("stg_late"),
    },
)

# ---- lineage ---------------------------------------------------------------

EDGE = "source_dataset, source_column, target_dataset, target_column, transformation_rule, pipeline_step"


def walk(near: str, far: str, dataset: str, column: str, name: str) -> str:
    """Recursive member: edges whose ``near`` end is the last edge's ``far`` end."""
    edge = ", ".join(f"e.{c.strip()}" for c in EDGE.split(","))
    return f"""SELECT 1 AS hop, {EDGE} FROM edges WHERE {near}_dataset = '{dataset}' AND {near}_column = '{column}'
        UNION ALL SELECT w.hop + 1, {edge} FROM {name} w JOIN edges e
          ON e.{near}_dataset = w.{far}_dataset AND e.{near}_column = w.{far}_column WHERE w.hop < 10"""


HOPS = f"CAST(hop AS INTEGER) AS hop, {EDGE}"
add("lineage_ancestors", f"SELECT {HOPS} FROM walked", {"walked": walk("target", "source", "region", "1", "walked")}, True)
add("lineage_descendants", f"SELECT {HOPS} FROM walked", {"walked": walk("source", "target", "customer", "7", "walked")}, True)
add(
    "lineage_trace",
    f"SELECT {HOPS}, 'upstream' AS direction FROM up UNION ALL SELECT {HOPS}, 'downstream' FROM down",
    {"up": walk("target", "source", "nation", "3", "up"), "down": walk("source", "target", "nation", "3", "down")},
    True,
)
ENDS = "source_dataset, source_column, target_dataset, target_column"
add(
    "lineage_closure",
    f"SELECT root_dataset, root_column, CAST(hop AS INTEGER) AS hop, {ENDS} FROM walked",
    {
        "walked": f"""SELECT source_dataset AS root_dataset, source_column AS root_column, 1 AS hop, {ENDS} FROM edges
            UNION ALL SELECT w.root_dataset, w.root_column, w.hop + 1, e.source_dataset, e.source_column, e.target_dataset, e.target_column
            FROM walked w JOIN edges e ON e.source_dataset = w.target_dataset AND e.source_column = w.target_column"""
    },
    True,
)
JSON_FIELDS = " || ',' || ".join(f"""'"{c.strip()}":' || coalesce('"' || {c.strip()} || '"', 'null')""" for c in EDGE.split(","))
add("lineage_json", f"SELECT '{{' || {JSON_FIELDS} || '}}' AS value FROM edges")
add("lineage_markdown", f"SELECT '| ' || {" || ' | ' || ".join(f"coalesce({c.strip()}, '')" for c in EDGE.split(','))} || ' |' AS value FROM edges")
add(
    "lineage_checks",
    """SELECT pipeline_step, COUNT(*) AS edges,
         COUNT(*) FILTER (WHERE source_column IS NULL OR target_column IS NULL
           OR (source_dataset = target_dataset AND source_column = target_column)) AS problems
       FROM edges GROUP BY pipeline_step""",
)

# ---- catalog and retention -------------------------------------------------

CATALOG = {
    "customers_raw": (
        "Core Banking System", "Retail Banking Platform", "Data Management Office", "PII — Confidential",
        "first_name;last_name;email;phone;date_of_birth;postal_code", "7 years (FINTRAC)", "Daily",
    ),
    "accounts_raw": (
        "Core Banking System", "Retail Banking Platform", "Data Management Office", "Confidential", "", "7 years (FINTRAC)", "Daily",
    ),
    "transactions_raw": (
        "Transaction Processing System", "Payments Platform", "Data Management Office", "Confidential", "", "7 years (FINTRAC)",
        "Real-time (batch micro-batch every 15 min)",
    ),
    "credit_data_raw": (
        "Credit Risk System", "Risk & Analytics", "Credit Risk Data Office", "Confidential — Regulatory", "",
        "10 years (OSFI B-20 Guideline)", "Daily EOD",
    ),
}
CATALOG_NAMES = "source_system owner steward classification pii_fields retention_policy update_frequency".split()


def catalog_row(feed: str) -> str:
    table = FEEDS[feed]
    columns = [*RAW_COLUMNS[table], "_source_system", "_extract_ts", *(["_ingest_order"] if table != "raw_credit" else [])]
    fixed = ", ".join(f"'{value}' AS {name}" for name, value in zip(CATALOG_NAMES, CATALOG[feed]))
    return f"""SELECT '{feed}' AS name, {fixed}, COUNT(*) AS row_count, '{";".join(columns)}' AS columns,
        '/landing/{feed}.csv' AS landing_path, '2026-08-02T00:00:00' AS extracted_at FROM {table}"""


add("catalog", " UNION ALL ".join(catalog_row(feed) for feed in FEEDS))


def retained(dataset: str, table: str, day: str, years: int, limit: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, CAST({years} AS INTEGER) AS years, '{limit}' AS keep_from,
        {when(f"coalesce({day} >= DATE '{limit}', TRUE)")} AS kept, {when(f"{day} < DATE '{limit}'")} AS expired FROM {table}"""


add(
    "retention",
    retained("transactions", "stg_transactions", "transaction_date", 7, "2023-06-30")
    + " UNION ALL "
    + retained("credit", "stg_credit", "origination_date", 10, "2020-06-30"),
)

add(
    "retention_rows",
    f"""SELECT {MONTH_KEY}, CASE WHEN transaction_date < DATE '2024-06-01' THEN 'archived' ELSE 'kept' END AS place, COUNT(*) AS n
        FROM stg_transactions GROUP BY ALL""",
)

# ---- sources and sinks -----------------------------------------------------

add("io_csv", "SELECT * EXCLUDE (_ingest_order) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM raw_transactions")
add(
    "io_corrupt_rows",
    """SELECT 'kept' AS status, COUNT(*) FILTER (WHERE transaction_id IS NULL OR transaction_id NOT LIKE '%7') AS n FROM raw_transactions
       UNION ALL SELECT 'corrupt', COUNT(*) FILTER (WHERE transaction_id LIKE '%7') FROM raw_transactions""",
)
add("io_named_source", "SELECT account_status, COUNT(*) AS n FROM raw_accounts GROUP BY account_status")
add(
    "io_partitioned",
    f"SELECT {MONTH_KEY}, COUNT(*) AS n, {VOLUME} AS volume_cad FROM fact_transactions GROUP BY 1",
)
add(
    "io_evolve",
    """SELECT CAST(NULL AS VARCHAR) AS balance_tier, COUNT(*) + COUNT(*) FILTER (WHERE balance_tier IS NULL) AS n FROM stg_accounts
       UNION ALL SELECT balance_tier, COUNT(*) FROM stg_accounts WHERE balance_tier IS NOT NULL GROUP BY balance_tier""",
)
add(
    "io_load_modes",
    " UNION ALL ".join(
        f"SELECT '{mode}' AS mode, COUNT(*) * 2 AS given_rows, COUNT(*) * {times} AS stored_rows FROM stg_accounts"
        for mode, times in (("replace", 1), ("append", 2), ("upsert", 1))
    ),
)
add(
    "io_load_all",
    """SELECT 'stg_customers' AS dataset, 'loaded' AS status, COUNT(*) AS row_count FROM stg_customers
       UNION ALL SELECT 'stg_accounts', 'loaded', COUNT(*) FROM stg_accounts
       UNION ALL SELECT 'stg_transactions', 'loaded', COUNT(*) FROM stg_transactions
       UNION ALL SELECT 'stg_credit', 'loaded', COUNT(*) FROM stg_credit
       UNION ALL SELECT 'stg_absent', 'skipped', NULL""",
)
add(
    "io_quarantine",
    f"""SELECT 'transactions_raw' AS dataset, '{AS_OF}' AS run_date, reasons, COUNT(*) AS n
        FROM flagged WHERE reasons <> '' GROUP BY reasons""",
)
add(
    "io_report",
    """SELECT dataset AS dataset_name, overall_score, check_name, passed, failed_count
       FROM checked JOIN scores USING (dataset) WHERE dataset = 'accounts_raw'""",
    SCORES,
)
add(
    "stream_dedup",
    """SELECT transaction_type, COUNT(DISTINCT transaction_id) AS n, COUNT(DISTINCT transaction_id) AS ids
       FROM raw_transactions GROUP BY transaction_type""",
)

add(
    "stream_dedup_late",
    """SELECT b AS batch_id, COUNT(*) AS rows_in, coalesce(MAX(kept), 0) AS kept,
           COUNT(*) - coalesce(MAX(kept), 0) - COUNT(*) FILTER (WHERE late) AS duplicates, COUNT(*) FILTER (WHERE late) AS late
       FROM split LEFT JOIN (SELECT b, COUNT(*) AS kept FROM kept_ids GROUP BY b) USING (b) GROUP BY b""",
    {
        "timed": """SELECT transaction_id, TRY_CAST(transaction_date AS TIMESTAMP) AS event_time,
            CAST(CASE WHEN _extract_ts = '2026-08-02T00:00:00' THEN 0 ELSE 1 END AS INTEGER) AS b FROM raw_transactions""",
        "mark": "SELECT MAX(event_time) - INTERVAL 180 DAY AS m FROM timed WHERE b = 0",
        "split": "SELECT t.*, m, coalesce(b = 1 AND event_time < m, FALSE) AS late FROM timed t, mark",
        "first_ids": """SELECT b, transaction_id, MAX(m) AS m, CASE WHEN COUNT(*) = COUNT(event_time) THEN MIN(event_time) END AS event_time
            FROM split WHERE NOT late GROUP BY b, transaction_id""",
        "kept_ids": """SELECT b, transaction_id FROM first_ids f WHERE b = 0 OR NOT EXISTS (
            SELECT 1 FROM first_ids k WHERE k.b = 0 AND k.event_time >= k.m AND k.transaction_id IS NOT DISTINCT FROM f.transaction_id)""",
    },
)

# ---- all stages ------------------------------------------------------------

add(
    "daily_run",
    """SELECT 'stg_customers' AS dataset, COUNT(*) AS row_count FROM stg_customers
       UNION ALL SELECT 'stg_accounts', COUNT(*) FROM stg_accounts
       UNION ALL SELECT 'stg_transactions', COUNT(DISTINCT transaction_id) FROM clean
       UNION ALL SELECT 'stg_credit', COUNT(*) FROM stg_credit
       UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date
       UNION ALL SELECT 'dim_customer', COUNT(*) FROM stg_customers
       UNION ALL SELECT 'dim_account', COUNT(*) FROM stg_accounts
       UNION ALL SELECT 'dim_merchant', COUNT(*) FROM dim_merchant
       UNION ALL SELECT 'fact_transactions', COUNT(*) FROM clean_fact
       UNION ALL SELECT 'kpi_daily_summary', COUNT(DISTINCT transaction_date) FROM clean_fact
       UNION ALL SELECT 'kpi_customer_segment', COUNT(*) FROM (SELECT DISTINCT date_trunc('month', transaction_date), customer_segment
         FROM clean_fact f JOIN dim_customer c ON c.customer_sk = f.customer_sk)""",
    {
        "clean": "SELECT * EXCLUDE (reasons) FROM flagged WHERE reasons = ''",
        "stg_clean": staged_transactions("clean"),
        "clean_fact": fact("stg_clean"),
    },
)
TWO_DAYS = {
    "day_1": "SELECT * FROM raw_transactions WHERE _extract_ts = '2026-08-02T00:00:00'",
    "day_2": "SELECT * FROM raw_transactions WHERE _extract_ts <> '2026-08-02T00:00:00'",
    "flagged_1": reasons("day_1"),
    "flagged_2": reasons("day_2"),
    "clean": "SELECT * EXCLUDE (reasons) FROM flagged_1 WHERE reasons = '' UNION ALL SELECT * EXCLUDE (reasons) FROM flagged_2 WHERE reasons = ''",
    "stg_clean": staged_transactions("clean"),
    "clean_fact": fact("stg_clean"),
}
add("daily_run_fact", f"SELECT * REPLACE ({double('amount_cad', 'signed_amount_cad')}, {text('transaction_date')}) FROM clean_fact", TWO_DAYS)
add("run_two_days_stg", BODIES["stg_transactions"].replace("FROM stg_transactions", "FROM stg_clean"), TWO_DAYS)
add("run_two_days_kpi", BODIES["kpi_daily_summary"].replace("FROM fact_transactions", "FROM clean_fact"), TWO_DAYS)
add("kpi_segment_maintained", BODIES["kpi_customer_segment"].replace("FROM fact_transactions", "FROM clean_fact"), TWO_DAYS)

# ---- reports after history: the totals of the first load under the third load's attributes

AFTER = {
    "dim_customer": DIM_CUSTOMER.replace("FROM stg_customers", f"FROM ({staged_customers('2026-01-01')})"),
    "dim_account": DIM_ACCOUNT.replace("FROM stg_accounts a", f"FROM ({staged_accounts('2026-01-01')}) a"),
}
for _name in ("q2_segment_analysis", "q5_large_register", "q7_lifetime_value"):
    add(f"{_name[:2]}_after_history", BODIES[_name], AFTER)
add("kpi_segment_after_history", BODIES["kpi_customer_segment"], AFTER)
