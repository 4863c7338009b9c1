"""Independent DuckDB SQL for every registered query.

The SQL restates, in plain ANSI-style SQL over the driver's tables, (1) the
stand-in input rule of ``paylake.sources.adapter`` and (2) each model, panel
and check the way the modelled warehouse writes it (PostgreSQL/dbt), so the
Spark plans are checked against a second engine. Rounding is done in exact
integer arithmetic (half away from zero, as numeric ROUND does), since
DuckDB turns decimal division into DOUBLE.
"""

from __future__ import annotations

from paylake.sources import fixed, relations

# --------------------------------------------------------------------------
# helpers
# --------------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rhu(p: str, den: str, n: int) -> str:
    """round(p / den, n) half-up for integers p >= 0, den >= 0, as DOUBLE (NULL if den = 0)."""
    m = 10 ** n
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST((CAST({p} AS HUGEINT) * {2 * m} + ({den})) "
            f"// (2 * CAST({den} AS HUGEINT)) AS DOUBLE) / {m} END)")


def cents(col: str) -> str:
    return f"CAST(({col}) * 100 AS BIGINT)"


def pct(num: str, den: str, n: int) -> str:
    """round(num * 100.0 / den, n)."""
    return rhu(f"({num}) * 100", den, n)


def avg2(col: str) -> str:
    """round(avg(decimal col), 2) via sum of cents."""
    return rhu(f"SUM({cents(col)})", f"100 * COUNT({col})", 2)


def millions2(col: str) -> str:
    """round(sum(col) / 1e6, 2)."""
    return rhu(f"SUM({cents(col)})", "100000000", 2)


def _list(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def _values(rows) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, str):
            return q(v)
        return repr(v)
    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")"


def _dates(rows) -> str:
    return "(VALUES " + ", ".join(f"(DATE {q(d)}, {q(n)})" for d, n in rows) + ")"


SOURCE_CITIES = relations.source_city_names() + ["Unmapped Town"]
CATEGORY_CODES = [c[0] for c in fixed.MERCHANT_CATEGORIES]
CITY_STATE = {}
for _c, _s, *_ in fixed.SOURCE_CITIES:
    CITY_STATE[_c] = _s
SOURCE_FESTIVAL_IN = ", ".join(f"DATE {q(d)}" for d, _ in fixed.SOURCE_FESTIVALS)

RAW_TIEBREAK = ("created_at DESC NULLS LAST, loaded_at DESC NULLS LAST, amount_inr ASC NULLS FIRST, "
                "city ASC NULLS FIRST, state ASC NULLS FIRST, merchant_category ASC NULLS FIRST, "
                "upi_app ASC NULLS FIRST, payment_type ASC NULLS FIRST, status ASC NULLS FIRST, "
                "failure_reason ASC NULLS FIRST, txn_date ASC NULLS FIRST, txn_hour ASC NULLS FIRST, "
                "is_weekend ASC NULLS FIRST, is_festival ASC NULLS FIRST, sender_upi ASC NULLS FIRST, "
                "receiver_upi ASC NULLS FIRST, device_type ASC NULLS FIRST")

LAKE_COLS = ("txn_id, amount_inr, city, merchant_category, upi_app, payment_type, status, failure_reason, "
             "txn_date, txn_hour, is_weekend, is_festival, sender_upi, receiver_upi, device_type, created_at")

# --------------------------------------------------------------------------
# CTE chain
# --------------------------------------------------------------------------
CTE = {}

CTE["src"] = """
src AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_totalprice AS price, o.o_orderdate AS odate,
         o.o_orderpriority AS prio, c.c_mktsegment AS seg
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

CTE["base"] = f"""
base AS (
  SELECT k,
    'TXN' || lpad(CAST(k AS VARCHAR), 16, '0') AS txn_id,
    CAST(CAST((CAST(round(price * 100) AS BIGINT) // {_list([1, 10, 100, 1000])}[k % 4 + 1])
              * 0.01 AS DECIMAL(12,2)) AS DOUBLE) AS amount_inr,
    {_list(SOURCE_CITIES)}[ck % {len(SOURCE_CITIES)} + 1] AS city,
    {_list(CATEGORY_CODES)}[ck % {len(CATEGORY_CODES)} + 1] AS merchant_category,
    {_list(fixed.SOURCE_APP_NAMES)}[CAST(substr(prio, 1, 1) AS INTEGER)] AS upi_app,
    CASE seg WHEN 'AUTOMOBILE' THEN 'p2p' WHEN 'MACHINERY' THEN 'bill_payment'
             WHEN 'FURNITURE' THEN 'recharge' ELSE 'p2m' END AS payment_type,
    CASE WHEN k % 100 < 94 THEN 'SUCCESS' WHEN k % 100 < 99 THEN 'FAILED' ELSE 'PENDING' END AS status,
    CASE WHEN k % 100 >= 94 AND k % 100 < 99 THEN {_list(fixed.FAILURE_REASONS)}[k % 7 + 1] END AS failure_reason,
    DATE '2023-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(odate AS DATE)) % 731 AS INTEGER) AS txn_date,
    CAST(k % 24 AS TINYINT) AS txn_hour,
    'u' || CAST(ck AS VARCHAR) || '@okicici' AS sender_upi,
    'm' || CAST(k % 1000 AS VARCHAR) || '@ybl' AS receiver_upi,
    CASE WHEN k % 20 = 0 THEN 'Web' WHEN k % 4 = 1 THEN 'iOS' ELSE 'Android' END AS device_type
  FROM src
)"""

CTE["base2"] = f"""
base2 AS (
  SELECT *, dayofweek(txn_date) IN (0, 6) AS is_weekend,
         txn_date IN ({SOURCE_FESTIVAL_IN}) AS is_festival,
         CAST(txn_date AS TIMESTAMP) + to_hours(CAST(txn_hour AS INTEGER)) AS created_at
  FROM base
)"""

CTE["lake"] = f"""
lake AS (
  SELECT {LAKE_COLS} FROM base2
  UNION ALL
  SELECT txn_id, amount_inr + 1.0, ' ' || lower(city) || ' ', upper(merchant_category), upi_app,
         payment_type, lower(status), failure_reason, txn_date, txn_hour, is_weekend, is_festival,
         sender_upi, receiver_upi, device_type, created_at + INTERVAL 1 HOUR
  FROM base2 WHERE k % 50 = 0
  UNION ALL
  SELECT txn_id || 'Z', 0.0, city, merchant_category, upi_app, payment_type, status, failure_reason,
         txn_date, txn_hour, is_weekend, is_festival, sender_upi, receiver_upi, device_type, created_at
  FROM base2 WHERE k % 500 = 0
  UNION ALL
  SELECT CAST(NULL AS VARCHAR), amount_inr, city, merchant_category, upi_app, payment_type, status,
         failure_reason, txn_date, txn_hour, is_weekend, is_festival, sender_upi, receiver_upi,
         device_type, created_at
  FROM base2 WHERE k % 500 = 1
)"""

CTE["city_state"] = f"""
city_state AS (
  SELECT * FROM {_values(sorted(CITY_STATE.items()))} AS t(city, state)
)"""

CTE["cleaned"] = """
cleaned AS (
  SELECT txn_id,
         TRY_CAST(CASE WHEN isnan(amount_inr) THEN NULL ELSE amount_inr END AS DECIMAL(12,2)) AS amount_inr,
         city, merchant_category, upi_app, payment_type, status,
         CASE WHEN failure_reason IN ('NaN', 'nan') THEN NULL ELSE failure_reason END AS failure_reason,
         CAST(txn_date AS DATE) AS txn_date, CAST(txn_hour AS SMALLINT) AS txn_hour,
         is_weekend, COALESCE(is_festival, FALSE) AS is_festival,
         sender_upi, receiver_upi, device_type, CAST(created_at AS TIMESTAMP) AS created_at
  FROM lake
)"""

CTE["raw"] = """
raw AS (
  SELECT l.txn_id, l.amount_inr, l.city, COALESCE(s.state, 'Unknown') AS state, l.merchant_category,
         l.upi_app, l.payment_type, l.status, l.failure_reason, l.txn_date, l.txn_hour, l.is_weekend,
         l.is_festival, l.sender_upi, l.receiver_upi, l.device_type, l.created_at,
         l.created_at + INTERVAL 1 DAY AS loaded_at
  FROM cleaned l LEFT JOIN city_state s ON l.city = s.city
)"""

CTE["ranked"] = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY {RAW_TIEBREAK}) AS rn
  FROM raw
)"""

CTE["stg"] = """
stg AS (
  SELECT txn_id,
         CAST(amount_inr AS DECIMAL(12,2)) AS amount_inr,
         upper(trim(city)) AS city,
         upper(trim(state)) AS state,
         lower(trim(merchant_category)) AS merchant_category,
         lower(trim(upi_app)) AS upi_app,
         lower(trim(payment_type)) AS payment_type,
         upper(trim(status)) AS status,
         failure_reason, txn_date,
         CAST(txn_hour AS SMALLINT) AS txn_hour,
         is_weekend, is_festival, sender_upi, receiver_upi,
         lower(trim(device_type)) AS device_type,
         created_at, loaded_at
  FROM ranked
  WHERE rn = 1 AND amount_inr > 0 AND txn_id IS NOT NULL
)"""

CTE["enr"] = """
enr AS (
  SELECT txn_id, amount_inr, city, state, merchant_category, upi_app, payment_type, status,
         failure_reason, txn_date, txn_hour, is_weekend, is_festival, sender_upi, receiver_upi,
         device_type, created_at,
         CASE WHEN status = 'SUCCESS' THEN TRUE ELSE FALSE END AS is_success,
         CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END AS is_success_int,
         CASE
           WHEN txn_hour BETWEEN 5 AND 8 THEN 'Early Morning'
           WHEN txn_hour BETWEEN 9 AND 11 THEN 'Morning'
           WHEN txn_hour BETWEEN 12 AND 13 THEN 'Lunch'
           WHEN txn_hour BETWEEN 14 AND 16 THEN 'Afternoon'
           WHEN txn_hour BETWEEN 17 AND 19 THEN 'Evening'
           WHEN txn_hour BETWEEN 20 AND 22 THEN 'Night'
           ELSE 'Late Night'
         END AS time_of_day,
         CASE
           WHEN amount_inr < 100 THEN 'Micro (<₹100)'
           WHEN amount_inr < 500 THEN 'Small (₹100-500)'
           WHEN amount_inr < 2000 THEN 'Medium (₹500-2K)'
           WHEN amount_inr < 10000 THEN 'Large (₹2K-10K)'
           ELSE 'High Value (>₹10K)'
         END AS amount_bucket,
         CAST(year(txn_date) AS INTEGER) AS txn_year,
         CAST(month(txn_date) AS INTEGER) AS txn_month,
         rpad(strftime(txn_date, '%A'), 9, ' ') AS day_name
  FROM stg
)"""

CTE["dim_date"] = f"""
dim_date AS (
  SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_sk,
         date_day,
         CAST(year(date_day) AS INTEGER) AS year,
         CAST(month(date_day) AS INTEGER) AS month_num,
         rpad(strftime(date_day, '%B'), 9, ' ') AS month_name,
         strftime(date_day, '%b') AS month_short,
         CAST(day(date_day) AS INTEGER) AS day_of_month,
         CAST(dayofweek(date_day) AS INTEGER) AS day_of_week_num,
         rpad(strftime(date_day, '%A'), 9, ' ') AS day_name,
         strftime(date_day, '%a') AS day_short,
         CAST(quarter(date_day) AS INTEGER) AS quarter,
         CAST(week(date_day) AS INTEGER) AS week_of_year,
         CAST(dayofyear(date_day) AS INTEGER) AS day_of_year,
         CASE WHEN dayofweek(date_day) IN (0, 6) THEN TRUE ELSE FALSE END AS is_weekend,
         CASE WHEN day(date_day) = 1 THEN TRUE ELSE FALSE END AS is_month_start,
         CASE WHEN date_day = CAST(date_trunc('month', date_day) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)
              THEN TRUE ELSE FALSE END AS is_month_end,
         CASE WHEN month(date_day) IN (3, 4, 5) THEN 'Summer'
              WHEN month(date_day) IN (6, 7, 8, 9) THEN 'Monsoon'
              WHEN month(date_day) IN (10, 11) THEN 'Autumn'
              ELSE 'Winter' END AS season,
         CASE WHEN month(date_day) BETWEEN 4 AND 6 THEN 'Q1'
              WHEN month(date_day) BETWEEN 7 AND 9 THEN 'Q2'
              WHEN month(date_day) BETWEEN 10 AND 12 THEN 'Q3'
              ELSE 'Q4' END AS fiscal_quarter,
         COALESCE(f.festival_name IS NOT NULL, FALSE) AS is_festival_day,
         f.festival_name
  FROM (SELECT CAST(range AS DATE) AS date_day
        FROM range(DATE '{fixed.CALENDAR_START}', DATE '{fixed.CALENDAR_END}', INTERVAL 1 DAY)) s
  LEFT JOIN {_dates(fixed.CALENDAR_FESTIVALS)} AS f(festival_date, festival_name)
    ON s.date_day = f.festival_date
)"""

CTE["city_mapping"] = f"""
city_mapping AS (
  SELECT * FROM {_values(fixed.CITY_MAPPING)} AS t(city, state, region, tier, is_metro)
)"""

CTE["dim_location"] = """
dim_location AS (
  SELECT md5(COALESCE(CAST(m.city AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS location_sk,
         m.city, m.state, m.region, m.tier, m.is_metro,
         CASE m.tier WHEN 'Tier 1' THEN 'Large (>4M)' WHEN 'Tier 2' THEN 'Medium (1-4M)'
                     ELSE 'Small (<1M)' END AS population_bucket
  FROM (SELECT DISTINCT city FROM stg) c
  INNER JOIN city_mapping m ON c.city = m.city
)"""

CTE["dim_merchant"] = f"""
dim_merchant AS (
  SELECT md5(COALESCE(CAST(category_code AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS merchant_sk,
         category_code, category_name, category_group, is_essential
  FROM {_values(fixed.MERCHANT_CATEGORIES)} AS t(category_code, category_name, category_group, is_essential)
)"""

CTE["dim_upi_app"] = f"""
dim_upi_app AS (
  SELECT md5(COALESCE(CAST(app_name AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS upi_app_sk,
         app_name, company, CAST(market_share_pct AS DECIMAL(3,1)) AS market_share_pct
  FROM {_values(fixed.UPI_APPS)} AS t(app_name, company, market_share_pct)
)"""

CTE["dim_payment_type"] = f"""
dim_payment_type AS (
  SELECT md5(COALESCE(CAST(type_code AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS payment_type_sk,
         type_code, type_name
  FROM {_values(fixed.PAYMENT_TYPES)} AS t(type_code, type_name)
)"""

CTE["fact"] = """
fact AS (
  SELECT md5(COALESCE(CAST(t.txn_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS txn_sk,
         t.txn_id, d.date_sk, l.location_sk, m.merchant_sk, u.upi_app_sk, p.payment_type_sk,
         t.amount_inr, t.is_success, t.is_success_int, t.status, t.time_of_day, t.amount_bucket,
         t.is_weekend, t.is_festival, t.device_type, t.txn_hour, t.txn_year, t.txn_month, t.created_at
  FROM enr t
  LEFT JOIN dim_location l ON t.city = l.city
  LEFT JOIN dim_date d ON t.txn_date = d.date_day
  LEFT JOIN dim_merchant m ON t.merchant_category = m.category_code
  LEFT JOIN dim_upi_app u ON t.upi_app = u.app_name
  LEFT JOIN dim_payment_type p ON t.payment_type = p.type_code
)"""

DEPS = {
    "src": [], "base": ["src"], "base2": ["base"], "lake": ["base2"], "city_state": [],
    "cleaned": ["lake"], "raw": ["cleaned", "city_state"], "ranked": ["raw"], "stg": ["ranked"],
    "enr": ["stg"], "dim_date": [], "city_mapping": [], "dim_location": ["stg", "city_mapping"],
    "dim_merchant": [], "dim_upi_app": [], "dim_payment_type": [],
    "fact": ["enr", "dim_location", "dim_date", "dim_merchant", "dim_upi_app", "dim_payment_type"],
}
ORDER = list(DEPS)


def with_ctes(needs: list[str], body: str, extra: list[str] | None = None) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on."""
    want: set[str] = set()

    def add(n):
        if n in want:
            return
        for d in DEPS[n]:
            add(d)
        want.add(n)
    for n in needs:
        add(n)
    parts = [CTE[n].strip() for n in ORDER if n in want] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


# --------------------------------------------------------------------------
# panels (snake_case aliases of the panel titles)
# --------------------------------------------------------------------------
def _share(n: int = 1) -> str:
    return rhu("COUNT(*) * 100", "SUM(COUNT(*)) OVER ()", n)


PANEL_SQL = {
    "panel_total_txns": "SELECT COUNT(*) AS value FROM fact",
    "panel_total_value": "SELECT CAST(SUM(amount_inr) AS DECIMAL(22,2)) AS value FROM fact",
    "panel_success_rate": f"SELECT {pct('SUM(is_success_int)', 'COUNT(*)', 2)} AS value FROM fact",
    "panel_avg_success_value": f"SELECT {avg2('amount_inr')} AS value FROM fact WHERE is_success = TRUE",
    "panel_cities_covered": "SELECT COUNT(DISTINCT location_sk) AS value FROM fact",
    "panel_monthly_volume": (
        "SELECT CAST(DATE_TRUNC('month', d.date_day) AS DATE) AS time, COUNT(*) AS transactions, "
        "CAST(SUM(f.amount_inr) AS DECIMAL(22,2)) AS amount_inr "
        "FROM fact f JOIN dim_date d ON f.date_sk = d.date_sk GROUP BY 1 ORDER BY 1"),
    "panel_hourly_volume": (
        "SELECT txn_hour AS hour, COUNT(*) AS transactions FROM fact GROUP BY txn_hour ORDER BY txn_hour"),
    "panel_top_cities": (
        f"SELECT l.city AS city, COUNT(*) AS transactions, {millions2('f.amount_inr')} AS amount_m_inr "
        "FROM fact f JOIN dim_location l ON f.location_sk = l.location_sk "
        "GROUP BY l.city ORDER BY COUNT(*) DESC, l.city LIMIT 10"),
    "panel_merchant_split": (
        f"SELECT m.category_name AS category, COUNT(*) AS transactions, "
        f"{millions2('f.amount_inr')} AS amount_m_inr "
        "FROM fact f JOIN dim_merchant m ON f.merchant_sk = m.merchant_sk "
        "GROUP BY m.category_name ORDER BY COUNT(*) DESC"),
    "panel_app_share": (
        f"SELECT u.app_name AS app, COUNT(*) AS transactions, {_share()} AS share_pct "
        "FROM fact f JOIN dim_upi_app u ON f.upi_app_sk = u.upi_app_sk "
        "GROUP BY u.app_name ORDER BY transactions DESC"),
    "panel_success_by_tier": (
        f"SELECT l.tier AS tier, {pct('SUM(f.is_success_int)', 'COUNT(*)', 2)} AS success_rate_pct "
        "FROM fact f JOIN dim_location l ON f.location_sk = l.location_sk GROUP BY l.tier ORDER BY l.tier"),
    "panel_payment_type_share": (
        f"SELECT p.type_name AS payment_type, COUNT(*) AS transactions, {_share()} AS share_pct "
        "FROM fact f JOIN dim_payment_type p ON f.payment_type_sk = p.payment_type_sk "
        "GROUP BY p.type_name ORDER BY transactions DESC"),
    "panel_weekday_weekend": (
        f"SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, "
        f"COUNT(*) AS transactions, {avg2('amount_inr')} AS avg_amount FROM fact GROUP BY is_weekend"),
    "panel_festival_vs_normal": (
        f"SELECT 'Festival Day' AS day, {avg2('amount_inr')} AS avg_amount FROM fact WHERE is_festival = TRUE "
        f"UNION ALL SELECT 'Normal Day' AS day, {avg2('amount_inr')} AS avg_amount FROM fact "
        "WHERE is_festival = FALSE"),
    "panel_amount_buckets": (
        "SELECT amount_bucket, COUNT(*) AS transactions FROM fact GROUP BY amount_bucket "
        "ORDER BY MIN(amount_inr)"),
    "panel_region_volume": (
        f"SELECT l.region AS region, COUNT(*) AS transactions, {millions2('f.amount_inr')} AS amount_m_inr "
        "FROM fact f JOIN dim_location l ON f.location_sk = l.location_sk "
        "GROUP BY l.region ORDER BY COUNT(*) DESC"),
    "panel_device_share": (
        f"SELECT device_type AS device, COUNT(*) AS transactions, {_share()} AS share_pct "
        "FROM fact GROUP BY device_type ORDER BY transactions DESC"),
    "fn_local_time": (
        "SELECT CAST(hour(created_at + INTERVAL 330 MINUTE) AS INTEGER) AS hour, COUNT(*) AS transactions "
        "FROM fact GROUP BY 1 ORDER BY 1"),
}

MODEL_SQL = {
    "model_stg_transactions": "SELECT * FROM stg",
    "model_int_enriched": "SELECT * FROM enr",
    "model_fact": "SELECT * FROM fact",
    "model_dim_location": "SELECT * FROM dim_location",
}

SQL: dict[str, str] = {}
for _k, _body in {**PANEL_SQL, **MODEL_SQL}.items():
    SQL[_k] = with_ctes(["fact"], _body)


# --------------------------------------------------------------------------
# data-quality tests, written as the generic tests compile (failing rows)
# --------------------------------------------------------------------------
def _head(table: str, col: str, check: str) -> str:
    return f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{check}' AS check_name, "


def t_not_null(cte: str, table: str, col: str) -> str:
    return _head(table, col, "not_null") + f"CAST((SELECT COUNT(*) FROM {cte} WHERE {col} IS NULL) AS BIGINT) AS failures"


def t_unique(cte: str, table: str, col: str) -> str:
    return _head(table, col, "unique") + (
        f"CAST((SELECT COUNT(*) FROM (SELECT {col} AS unique_field, COUNT(*) AS n_records FROM {cte} "
        f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1)) AS BIGINT) AS failures")


def t_accepted(cte: str, table: str, col: str, values) -> str:
    vals = ", ".join(q(v) for v in values)
    return _head(table, col, "accepted_values") + (
        f"CAST((SELECT COUNT(*) FROM (SELECT {col} AS value_field, COUNT(*) AS n_records FROM {cte} "
        f"GROUP BY {col}) a WHERE value_field NOT IN ({vals})) AS BIGINT) AS failures")


def t_rel(cte: str, table: str, col: str, parent: str, field: str) -> str:
    return _head(table, col, "relationships") + (
        f"CAST((SELECT COUNT(*) FROM (SELECT {col} AS from_field FROM {cte} WHERE {col} IS NOT NULL) child "
        f"LEFT JOIN (SELECT {field} AS to_field FROM {parent}) parent ON child.from_field = parent.to_field "
        f"WHERE parent.to_field IS NULL) AS BIGINT) AS failures")


STG_ACC = {"status": fixed.STATUSES, "merchant_category": CATEGORY_CODES,
           "upi_app": [a[0] for a in fixed.UPI_APPS]}
STG_NN = ["txn_id", "amount_inr", "status", "city", "merchant_category", "upi_app", "txn_date"]
FACT_NN = ["txn_sk", "txn_id", "amount_inr", "location_sk", "date_sk", "merchant_sk", "upi_app_sk",
           "payment_type_sk"]
FKS = [("location_sk", "dim_location"), ("date_sk", "dim_date"), ("merchant_sk", "dim_merchant"),
       ("upi_app_sk", "dim_upi_app"), ("payment_type_sk", "dim_payment_type")]
DIM_SPECS = [("dim_location", ["location_sk", "city"], {"tier": fixed.TIERS}),
             ("dim_date", ["date_sk", "date_day"], {}),
             ("dim_merchant", ["merchant_sk", "category_code"], {}),
             ("dim_upi_app", ["upi_app_sk"], {}),
             ("dim_payment_type", ["payment_type_sk"], {})]

UNIQUE_TESTS = ([t_unique("stg", "stg_transactions", "txn_id"),
                 t_unique("fact", "fact_transactions", "txn_sk"),
                 t_unique("fact", "fact_transactions", "txn_id")]
                + [t_unique(d, d, k) for d, ks, _ in DIM_SPECS for k in ks])
NOT_NULL_TESTS = ([t_not_null("stg", "stg_transactions", c) for c in STG_NN]
                  + [t_not_null("fact", "fact_transactions", c) for c in FACT_NN]
                  + [t_not_null(d, d, k) for d, ks, _ in DIM_SPECS for k in ks])
ACCEPTED_TESTS = ([t_accepted("stg", "stg_transactions", c, v) for c, v in STG_ACC.items()]
                  + [t_accepted("fact", "fact_transactions", "status", fixed.STATUSES),
                     t_accepted("dim_location", "dim_location", "tier", fixed.TIERS)])
REL_TESTS = [t_rel("fact", "fact_transactions", c, p, c) for c, p in FKS]
SINGULAR_TESTS = [
    _head("fact_transactions", "amount_inr", "assert_no_negative_amounts")
    + "CAST((SELECT COUNT(*) FROM fact WHERE amount_inr <= 0) AS BIGINT) AS failures",
    _head("fact_transactions", "is_success_int", "assert_success_rate_above_threshold")
    + "CAST((SELECT COUNT(*) FROM (SELECT COUNT(*) AS total, SUM(is_success_int) AS successful FROM fact) s "
      f"WHERE (successful * 100.0 / NULLIF(total, 0)) < {fixed.SUCCESS_RATE_FLOOR}) AS BIGINT) AS failures",
]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


DQ_SQL = {
    "dq_unique": _union(UNIQUE_TESTS),
    "dq_not_null": _union(NOT_NULL_TESTS),
    "dq_accepted_values": _union(ACCEPTED_TESTS),
    "dq_relationships": _union(REL_TESTS),
    "dq_report": _union(UNIQUE_TESTS + NOT_NULL_TESTS + ACCEPTED_TESTS + REL_TESTS + SINGULAR_TESTS),
    "dq_no_negative_amounts": "SELECT * FROM fact WHERE amount_inr <= 0",
    "dq_success_rate_floor": (
        "SELECT * FROM (SELECT COUNT(*) AS total, SUM(is_success_int) AS successful FROM fact) s "
        f"WHERE (successful * 100.0 / NULLIF(total, 0)) < {fixed.SUCCESS_RATE_FLOOR}"),
    "dq_festival_disagreement": (
        "SELECT d.date_day, f.is_festival, d.is_festival_day, COUNT(*) AS transactions "
        "FROM fact f JOIN dim_date d ON f.date_sk = d.date_sk "
        "WHERE f.is_festival IS DISTINCT FROM d.is_festival_day GROUP BY 1, 2, 3"),
}
for _k, _body in DQ_SQL.items():
    SQL[_k] = with_ctes(["fact"], _body)


def _rule(name: str, violated: str) -> str:
    return f"SELECT '{name}' AS rule, CAST(COUNT(*) AS BIGINT) AS failures FROM lake WHERE {violated}"


_CITY_IN = ", ".join(q(c) for c in relations.source_city_names())
_APP_IN = ", ".join(q(a) for a in fixed.SOURCE_APP_NAMES)
_STATUS_IN = ", ".join(q(s) for s in fixed.STATUSES)
ROW_CONDITIONS = [
    ("txn_id_not_null", "txn_id IS NULL"),
    ("txn_id_prefix", "NOT COALESCE(starts_with(txn_id, 'TXN'), FALSE)"),
    ("hour_in_range", "NOT COALESCE(txn_hour BETWEEN 0 AND 23, FALSE)"),
    ("sender_upi_has_at", "NOT COALESCE(contains(sender_upi, '@'), FALSE)"),
    ("receiver_upi_has_at", "NOT COALESCE(contains(receiver_upi, '@'), FALSE)"),
    ("amount_positive", "NOT COALESCE(amount_inr > 0, FALSE)"),
    ("status_valid", f"NOT COALESCE(status IN ({_STATUS_IN}), FALSE)"),
    ("reason_null_on_success", "status = 'SUCCESS' AND failure_reason IS NOT NULL"),
    ("reason_set_on_failed", "status = 'FAILED' AND failure_reason IS NULL"),
    ("city_known", f"NOT COALESCE(city IN ({_CITY_IN}), FALSE)"),
    ("app_known", f"NOT COALESCE(upi_app IN ({_APP_IN}), FALSE)"),
]
ROW_RULES = [_rule(name, cond) for name, cond in ROW_CONDITIONS] + [
    "SELECT 'txn_id_unique' AS rule, CAST(COUNT(*) AS BIGINT) AS failures FROM "
    "(SELECT txn_id FROM lake WHERE txn_id IS NOT NULL GROUP BY txn_id HAVING COUNT(*) > 1)",
    "SELECT 'required_columns' AS rule, CAST(0 AS BIGINT) AS failures",
]
LAKE_SQL = {
    "dq_row_rules": _union(ROW_RULES),
    "dq_amount_in_category_range": (
        "SELECT r.category_code, COUNT(*) AS rows, "
        "COUNT(*) FILTER (WHERE NOT (l.amount_inr BETWEEN r.min_amount AND r.max_amount)) AS out_of_range "
        f"FROM lake l JOIN {_values(fixed.CATEGORY_AMOUNT_RANGES)} AS r(category_code, min_amount, max_amount) "
        "ON l.merchant_category = r.category_code GROUP BY r.category_code"),
    "dq_calendar_flags": (
        "SELECT 'is_weekend' AS flag, CAST(COUNT(*) FILTER (WHERE is_weekend IS DISTINCT FROM "
        "(dayofweek(txn_date) IN (0, 6))) AS BIGINT) AS failures FROM lake "
        "UNION ALL SELECT 'is_festival' AS flag, CAST(COUNT(*) FILTER (WHERE is_festival IS DISTINCT FROM "
        f"(txn_date IN ({SOURCE_FESTIVAL_IN}))) AS BIGINT) AS failures FROM lake"),
}
for _k, _body in LAKE_SQL.items():
    SQL[_k] = with_ctes(["lake"], _body)


# --------------------------------------------------------------------------
# write-side scenarios
# --------------------------------------------------------------------------
import re  # noqa: E402

CHAIN = ["ranked", "stg", "enr", "dim_location", "fact"]


def chain(suffix: str, raw_name: str) -> list[str]:
    """The staging -> fact CTEs restated over another raw relation."""
    out = []
    for n in CHAIN:
        text = re.sub(r"\braw\b", raw_name, CTE[n])
        for m in CHAIN:
            text = re.sub(rf"\b{m}\b", m + suffix, text)
        out.append(text)
    return out


def raw_from(src: str, name: str) -> list[str]:
    """cleaned + state + loaded_at over another lake-shaped relation."""
    c = CTE["cleaned"].replace("cleaned AS (", f"{name}_c AS (").replace("FROM lake", f"FROM {src}")
    r = CTE["raw"].replace("raw AS (", f"{name} AS (").replace("FROM cleaned l", f"FROM {name}_c l")
    return [c, r]


LAKE_K = """
lake_k AS (
  SELECT *, CAST(year(txn_date) AS INTEGER) AS year,
         lpad(CAST(month(txn_date) AS VARCHAR), 2, '0') AS month,
         translate(city, ' -', '__') AS city_part
  FROM lake
)"""
FOLDER_BAD = """
folder_bad AS (SELECT DISTINCT year, month, city_part FROM lake_k WHERE txn_id IS NULL)"""
LOADED = f"""
loaded_src AS (
  SELECT {LAKE_COLS} FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l.txn_id ORDER BY l.year, l.month, l.city_part) AS rn
    FROM lake_k l
    WHERE NOT EXISTS (SELECT 1 FROM folder_bad b
                      WHERE b.year = l.year AND b.month = l.month AND b.city_part = l.city_part)
  ) x WHERE rn = 1
)"""
LAKE_BASE = ["lake", "city_state", "dim_date", "city_mapping", "dim_merchant", "dim_upi_app", "dim_payment_type"]
INGESTED = [LAKE_K, FOLDER_BAD, LOADED] + raw_from("loaded_src", "ingested")

FIRST_RUN = [
    "raw1 AS (SELECT * FROM raw WHERE created_at < TIMESTAMP '2024-07-01 00:00:00' "
    "AND NOT ends_with(txn_id, '3'))",
] + chain("_1", "raw1") + [
    "cut AS (SELECT max(created_at) - INTERVAL 1 HOUR AS cutoff FROM fact_1)",
    "new_rows AS (SELECT * FROM fact WHERE created_at > (SELECT cutoff FROM cut))",
    "final AS (SELECT * FROM fact_1 WHERE txn_sk NOT IN (SELECT txn_sk FROM new_rows) "
    "UNION ALL SELECT * FROM new_rows)",
]

SCENARIO_SQL = {
    "scan_lake": with_ctes(["lake"], f"SELECT {LAKE_COLS} FROM lake"),
    "sink_lake_partitioned": with_ctes(["lake"], "SELECT * FROM lake_k", [LAKE_K]),
    "scan_partition_pruned": with_ctes(
        ["lake"], "SELECT * FROM lake_k WHERE month = '01' AND city_part = 'Mumbai'", [LAKE_K]),
    "sink_max_rows_per_file": with_ctes(
        ["lake"], "SELECT year, month, city_part, FALSE AS over_cap, CAST(COUNT(*) AS BIGINT) AS rows "
        "FROM lake_k GROUP BY 1, 2, 3", [LAKE_K]),
    "ordered_file_listing": with_ctes(
        ["lake"], "SELECT year, month, city_part, row_number() OVER (ORDER BY 'year=' || year || '/month=' || month "
        "|| '/city_part=' || city_part) AS place FROM (SELECT DISTINCT year, month, city_part FROM lake_k) x",
        [LAKE_K]),
    "ingest_incremental_files": with_ctes(LAKE_BASE, "SELECT * FROM ingested", INGESTED),
    "stream_ingest": with_ctes(LAKE_BASE, "SELECT * FROM ingested", INGESTED),
    "load_log_upsert": with_ctes(
        ["lake"],
        "SELECT k.year, k.month, k.city_part, "
        "CAST(CASE WHEN MAX(CASE WHEN k.txn_id IS NULL THEN 1 ELSE 0 END) = 1 THEN 0 ELSE COUNT(*) END AS BIGINT) "
        "AS row_count, CASE WHEN MAX(CASE WHEN k.txn_id IS NULL THEN 1 ELSE 0 END) = 1 THEN 'failed' "
        "ELSE 'success' END AS status FROM lake_k k GROUP BY 1, 2, 3", [LAKE_K]),
    "ingest_failed_files": with_ctes(
        ["lake"],
        "SELECT year, month, city_part, 'failed' AS status FROM folder_bad UNION "
        "SELECT * FROM (SELECT year, month, city_part, 'failed' AS status FROM lake_k "
        "ORDER BY year, month, city_part LIMIT 1) UNION SELECT 2099 AS year, '01' AS month, "
        "unnest(['null_txn_id', 'null_amount_inr', 'null_city', 'null_merchant_category', 'null_upi_app', "
        "'null_payment_type', 'null_status', 'null_txn_date', 'null_txn_hour', 'null_is_weekend', 'null_sender_upi', "
        "'null_receiver_upi', 'null_device_type', 'null_created_at', 'overflow', 'wrong_type', 'damaged_pages']) "
        "AS city_part, 'failed' AS status", [LAKE_K, FOLDER_BAD]),
    "sink_insert_if_absent": with_ctes(
        ["lake", "city_state"],
        "SELECT txn_id, city, amount_inr FROM b1 UNION ALL "
        "SELECT txn_id, city, amount_inr FROM b2 WHERE txn_id NOT IN (SELECT txn_id FROM b1)",
        [LAKE_K,
         f"f1 AS (SELECT {LAKE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY year, month, "
         "city_part) AS rn FROM lake_k WHERE txn_id IS NOT NULL AND year = 2023) x WHERE rn = 1)",
         f"f2 AS (SELECT {LAKE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY year, month, "
         "city_part) AS rn FROM lake_k WHERE txn_id IS NOT NULL) x WHERE rn = 1)"]
        + raw_from("f1", "b1") + raw_from("f2", "b2")),
    "anti_loaded_keys": with_ctes(
        ["lake"],
        "SELECT year, month, city_part FROM (SELECT DISTINCT year, month, city_part FROM lake_k WHERE year = 2024 "
        "UNION SELECT year, month, city_part FROM folder_bad WHERE year = 2023)", [LAKE_K, FOLDER_BAD]),
    "materialize_table": with_ctes(["fact"], "SELECT * FROM dim_location"),
    "fact_incremental_upsert": with_ctes(["fact"], "SELECT * FROM final", FIRST_RUN),
    "sync_all_columns": with_ctes(
        ["fact"],
        "SELECT txn_sk, CAST(NULL AS VARCHAR) AS day_name, txn_year, txn_month, amount_inr FROM fact_1 "
        "WHERE txn_sk NOT IN (SELECT txn_sk FROM new_rows) UNION ALL "
        "SELECT n.txn_sk, e.day_name, n.txn_year, n.txn_month, n.amount_inr FROM new_rows n "
        "JOIN enr e ON n.txn_id = e.txn_id", FIRST_RUN),
    "late_rows_audit": with_ctes(
        ["fact"],
        "SELECT txn_id, created_at, amount_inr FROM stg WHERE created_at <= (SELECT cutoff FROM cut) "
        "AND txn_id NOT IN (SELECT txn_id FROM final)", FIRST_RUN),
    "stream_dedup_1h": with_ctes(["raw"], "SELECT DISTINCT txn_id FROM raw WHERE txn_id IS NOT NULL"),
    "stream_fact_upsert": with_ctes(LAKE_BASE, "SELECT * FROM fact_i", INGESTED + chain("_i", "ingested")),
}
SQL.update(SCENARIO_SQL)


# --------------------------------------------------------------------------
# operator inventory
# --------------------------------------------------------------------------
FD = "(SELECT d.* FROM fact f JOIN dim_date d ON f.date_sk = d.date_sk) fd"


def _usage_sql(dim: str, key: str) -> str:
    return (f"SELECT d.*, CAST(COALESCE(c.fact_rows, 0) AS BIGINT) AS fact_rows FROM {dim} d LEFT JOIN "
            f"(SELECT {key}, COUNT(*) AS fact_rows FROM fact GROUP BY {key}) c ON d.{key} = c.{key}")


INV_FACT = {
    "fn_trim_case": "SELECT DISTINCT city AS raw_city, upper(trim(city)) AS city, merchant_category AS raw_category, "
                    "lower(trim(merchant_category)) AS merchant_category, status AS raw_status, "
                    "upper(trim(status)) AS status FROM raw",
    "stg_filter_valid": (
        "SELECT outcome, COUNT(*) AS rows FROM (SELECT CASE WHEN rn > 1 THEN 'older_version' "
        "WHEN NOT (amount_inr > 0) OR amount_inr IS NULL THEN 'non_positive_amount' ELSE 'kept' END AS outcome "
        "FROM ranked WHERE txn_id IS NOT NULL) x GROUP BY outcome "
        "UNION ALL SELECT 'null_id' AS outcome, COUNT(*) AS rows FROM raw WHERE txn_id IS NULL"),
    "success_flags": "SELECT status, is_success, is_success_int, COUNT(*) AS rows FROM enr GROUP BY 1, 2, 3",
    "time_of_day_bucket": "SELECT txn_hour, time_of_day, COUNT(*) AS rows FROM enr GROUP BY 1, 2",
    "amount_bucket": "SELECT amount_bucket, COUNT(*) AS rows, MIN(amount_inr) AS min_amount, "
                     "MAX(amount_inr) AS max_amount FROM enr GROUP BY 1",
    "txn_year_month": "SELECT txn_year, txn_month, COUNT(*) AS rows FROM enr GROUP BY 1, 2",
    "txn_day_name": "SELECT day_name, COUNT(*) AS rows FROM enr GROUP BY 1",
    "season": f"SELECT season, COUNT(*) AS rows FROM {FD} GROUP BY 1",
    "fiscal_quarter": f"SELECT fiscal_quarter, COUNT(*) AS rows FROM {FD} GROUP BY 1",
    "population_bucket": "SELECT l.tier, l.population_bucket, COUNT(*) AS rows FROM fact f "
                         "JOIN dim_location l ON f.location_sk = l.location_sk GROUP BY 1, 2",
    "filter_boolean": "SELECT 'is_success' AS predicate, COUNT(*) AS n FROM fact WHERE is_success = TRUE "
                      "UNION ALL SELECT 'is_festival', COUNT(*) FROM fact WHERE is_festival = TRUE "
                      "UNION ALL SELECT 'not_is_festival', COUNT(*) FROM fact WHERE is_festival = FALSE",
    "day_type_label": "SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, "
                      "COUNT(*) AS rows FROM fact GROUP BY 1",
    "festival_flag_coalesce": f"SELECT is_festival_day, festival_name, COUNT(*) AS rows FROM {FD} GROUP BY 1, 2",
    "safe_ratio": "SELECT merchant_category, "
                  + pct("COUNT(*) FILTER (WHERE status = 'PENDING')", "COUNT(*) FILTER (WHERE status = 'FAILED')", 2)
                  + " AS pending_per_failed_pct FROM enr GROUP BY 1",
    "date_flags": f"SELECT txn_date, dayofweek(txn_date) IN (0, 6) AS is_weekend, "
                  f"txn_date IN ({SOURCE_FESTIVAL_IN}) AS is_festival, COUNT(*) AS rows FROM lake GROUP BY txn_date",
    "calendar_weekend_flag": f"SELECT day_of_week_num, is_weekend, COUNT(*) AS rows FROM {FD} GROUP BY 1, 2",
    "lake_city_key": "SELECT DISTINCT city, translate(city, ' -', '__') AS city_part FROM lake",
    "star_left_joins": "SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE location_sk IS NULL) AS no_location_sk, "
                       "COUNT(*) FILTER (WHERE date_sk IS NULL) AS no_date_sk, "
                       "COUNT(*) FILTER (WHERE merchant_sk IS NULL) AS no_merchant_sk, "
                       "COUNT(*) FILTER (WHERE upi_app_sk IS NULL) AS no_upi_app_sk, "
                       "COUNT(*) FILTER (WHERE payment_type_sk IS NULL) AS no_payment_type_sk FROM fact",
    "date_festival_left": "SELECT d.date_day, d.festival_name, CAST(COUNT(f.date_sk) AS BIGINT) AS fact_rows "
                          "FROM dim_date d LEFT JOIN fact f ON f.date_sk = d.date_sk WHERE d.is_festival_day "
                          "GROUP BY 1, 2",
    "fact_dim_inner": " UNION ALL ".join(
        f"SELECT '{k}' AS fk, CAST(COUNT(*) AS BIGINT) AS rows FROM fact f JOIN {d} x ON f.{k} = x.{k}"
        for k, d in FKS),
    "enrich_state_lookup": "SELECT DISTINCT city, state FROM raw",
    "clean_on_load": "SELECT * FROM cleaned",
    "agg_max_scalar": "SELECT MAX(created_at) - INTERVAL 1 HOUR AS cutoff FROM fact",
    "agg_distinct_rows": "SELECT DISTINCT city FROM stg",
    "agg_dup_keys": "SELECT txn_id, COUNT(*) AS n FROM raw WHERE txn_id IS NOT NULL GROUP BY txn_id "
                    "HAVING COUNT(*) > 1",
    "dedup_latest": "SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 AND txn_id IS NOT NULL",
    "fn_extract": f"SELECT year, quarter, month_num, week_of_year, day_of_year, COUNT(*) AS rows FROM {FD} "
                  "GROUP BY 1, 2, 3, 4, 5",
    "fn_date_key": "SELECT txn_date, CAST(strftime(txn_date, '%Y%m%d') AS INTEGER) AS date_key, COUNT(*) AS rows "
                   "FROM enr GROUP BY 1",
    "fn_date_names": "SELECT rpad(strftime(txn_date, '%B'), 9, ' ') AS month_name, strftime(txn_date, '%b') "
                     "AS month_short, rpad(strftime(txn_date, '%A'), 9, ' ') AS day_name, strftime(txn_date, '%a') "
                     "AS day_short, COUNT(*) AS rows FROM enr GROUP BY 1, 2, 3, 4",
    "fn_month_end": "SELECT day(txn_date) = 1 AS is_month_start, txn_date = last_day(txn_date) AS is_month_end, "
                    "COUNT(*) AS rows FROM enr GROUP BY 1, 2",
    "fn_surrogate_key": "SELECT DISTINCT city, md5(COALESCE(CAST(city AS VARCHAR), "
                        "'_dbt_utils_surrogate_key_null_')) AS city_key FROM stg",
    "fn_null_handling": "SELECT status, COALESCE(failure_reason, '(none)') AS reason, COUNT(*) AS rows, "
                        "COUNT(*) FILTER (WHERE failure_reason IS NULL) AS null_reasons FROM stg GROUP BY 1, 2",
    "fn_clip": "SELECT r.category_code, "
               "COUNT(*) FILTER (WHERE least(greatest(l.amount_inr, r.min_amount), r.max_amount) > l.amount_inr) "
               "AS raised, COUNT(*) FILTER (WHERE least(greatest(l.amount_inr, r.min_amount), r.max_amount) "
               f"< l.amount_inr) AS lowered FROM lake l JOIN {_values(fixed.CATEGORY_AMOUNT_RANGES)} "
               "AS r(category_code, min_amount, max_amount) ON l.merchant_category = r.category_code GROUP BY 1",
    "src_date_spine": "SELECT d.date_day, CAST(COALESCE(c.n, 0) AS BIGINT) AS transactions FROM dim_date d "
                      "LEFT JOIN (SELECT txn_date, COUNT(*) AS n FROM stg GROUP BY 1) c ON d.date_day = c.txn_date",
    "src_values_dims": " UNION ALL ".join(
        f"SELECT '{col}' AS relation, v.code, CAST(COALESCE(c.n, 0) AS BIGINT) AS transactions FROM "
        f"(SELECT {key} AS code FROM {dim}) v LEFT JOIN (SELECT {col} AS code, COUNT(*) AS n FROM stg GROUP BY 1) c "
        "ON v.code = c.code"
        for col, dim, key in [("merchant_category", "dim_merchant", "category_code"),
                              ("upi_app", "dim_upi_app", "app_name"),
                              ("payment_type", "dim_payment_type", "type_code")]),
    "model_dim_date": _usage_sql("dim_date", "date_sk"),
    "model_dim_merchant": _usage_sql("dim_merchant", "merchant_sk"),
    "model_dim_upi_app": _usage_sql("dim_upi_app", "upi_app_sk"),
    "model_dim_payment_type": _usage_sql("dim_payment_type", "payment_type_sk"),
    "materialize_view": "SELECT city, COUNT(*) AS transactions FROM stg GROUP BY city",
}
for _k, _body in INV_FACT.items():
    SQL[_k] = with_ctes(["fact"], _body)

SQL["fn_interval_arith"] = with_ctes(
    ["enr"],
    "SELECT txn_date, COUNT(*) AS rows, "
    "CAST(date_trunc('month', txn_date) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end, "
    "CAST(txn_date - INTERVAL 7 DAY AS DATE) AS week_before, CAST(txn_date - INTERVAL 1 MONTH AS DATE) AS month_before, "
    "date_trunc('month', txn_date) + INTERVAL 1 MONTH - INTERVAL 1 DAY <= txn_date + INTERVAL 1 DAY "
    "AS ends_within_a_day FROM enr GROUP BY txn_date")
_LOAD_NULL = " OR ".join(f"{c} IS NULL" for c in [
    "txn_id", "a", "city", "merchant_category", "upi_app", "payment_type", "status", "txn_date", "txn_hour",
    "is_weekend", "is_festival", "sender_upi", "receiver_upi", "device_type", "created_at"])
SQL["fn_casts"] = with_ctes(
    ["lake"],
    "SELECT merchant_category, COUNT(*) FILTER (WHERE abs(a) < 1e10) AS fits, "
    "COUNT(*) FILTER (WHERE abs(a) >= 1e10) AS overflows, COUNT(*) FILTER (WHERE a IS NULL) AS missing, "
    f"COUNT(*) FILTER (WHERE abs(a) >= 1e10 OR {_LOAD_NULL}) AS refused, CAST(SUM(txn_hour) AS BIGINT) AS hours "
    "FROM (SELECT *, CASE WHEN txn_hour = 0 THEN NULL WHEN txn_hour % 2 = 0 THEN CAST(amount_inr AS DOUBLE) * 1e9 "
    "ELSE CAST(amount_inr AS DOUBLE) END AS a FROM lake) x GROUP BY merchant_category")
_BROKEN = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in ROW_CONDITIONS)
SQL["dq_quarantine"] = with_ctes(
    ["lake"], "SELECT * FROM (SELECT txn_id, amount_inr, city, created_at, "
    f"concat_ws(',', {_BROKEN}) AS violations FROM lake) x WHERE violations <> ''")
SQL["dq_negative_amounts_found"] = with_ctes(
    ["ranked"], "SELECT txn_id, CAST(amount_inr AS DECIMAL(12,2)) AS amount_inr, upper(trim(status)) AS status "
    "FROM ranked WHERE rn = 1 AND txn_id IS NOT NULL AND amount_inr <= 0")
SQL["dq_success_rate_too_low"] = with_ctes(
    ["fact"], "SELECT COUNT(*) AS total, CAST(SUM(is_success_int) AS BIGINT) AS successful FROM fact "
    "WHERE status <> 'SUCCESS'")

SAME_AS_SQL = {
    "stg_clean": "model_stg_transactions", "location_inner": "model_dim_location",
    "anti_orphan_fk": "dq_relationships", "agg_count_all": "panel_total_txns",
    "agg_sum": "panel_total_value", "agg_avg": "panel_avg_success_value",
    "agg_count_distinct": "panel_cities_covered", "agg_conditional_rate": "panel_success_rate",
    "agg_min_order": "panel_amount_buckets", "agg_group_month": "panel_monthly_volume",
    "share_of_total": "panel_device_share", "topk_cities": "panel_top_cities",
    "order_by_agg": "panel_merchant_split", "union_all": "panel_festival_vs_normal",
    "fn_date_trunc": "panel_monthly_volume",
    "fn_round_half_up": "panel_success_by_tier",
}
for _k, _v in SAME_AS_SQL.items():
    SQL[_k] = SQL[_v]
