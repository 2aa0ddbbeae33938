"""Independent SQL text (DuckDB dialect) for every registered query.

Each query starts from the fixture adapter as CTE ``o`` over the pre-registered
``orders`` view and re-states the operator's semantics in plain SQL. Output
column names and types line up with the Spark query of the same key.
Rounding of shares is written as exact integer HALF_UP arithmetic so it
cannot drift between engines.
"""

from __future__ import annotations

from ordwise import model
from ordwise.functions.hashing import MODULUS, draw_sql
from ordwise.sources import fixture, synth
from ordwise.sources.fixture import with_orders_cte

TIER_SQL = (f"CASE WHEN order_total < {model.TIER_LOW_BELOW} THEN 'low' "
            f"WHEN order_total < {model.TIER_MID_BELOW} THEN 'mid' ELSE 'high' END")
_IN = lambda vals: ", ".join(f"'{v}'" for v in vals)

TRANSFORM_DF_SQL = f"""
SELECT order_id, customer_id, order_status, order_total, item_count, product_category, created_at,
       delivery_date, is_loyalty_member, rating, shipping_address,
       {TIER_SQL} AS revenue_tier,
       json_extract_string(metadata, '$.device') AS device,
       CAST(created_at AS DATE) AS order_date,
       CAST(is_loyalty_member AS INTEGER) AS loyalty_flag,
       COALESCE(CAST(rating AS DOUBLE), 0.0) AS rating_safe
FROM o"""

TRANSFORM_SQL_SQL = f"""
SELECT order_id, customer_id, order_status, CAST(order_total AS DOUBLE) AS order_total, item_count,
       product_category, created_at, delivery_date, is_loyalty_member, rating,
       {TIER_SQL} AS revenue_tier,
       json_extract_string(metadata, '$.device') AS device,
       json_extract_string(metadata, '$.coupon_code') AS coupon_code,
       CAST(created_at AS DATE) AS order_date,
       CAST(COALESCE(rating, 0.0) AS DECIMAL(3,1)) AS rating_safe,
       CAST(is_loyalty_member AS INTEGER) AS loyalty_flag,
       shipping_address
FROM o"""

# The half-up share as Spark's decimal(26,1) result of ROUND(cnt * 100.0 / total, 1).
PCT_DECIMAL = "CAST(CAST((2000 * {cnt} + {tot}) // (2 * {tot}) AS DECIMAL(18,0)) * 0.1 AS DECIMAL(26,1))"


def _mean_units(c: str, scale: int) -> str:
    """Spark's ``avg`` of a decimal(p, scale) column in units of 10^-(scale + 4):
    the exact mean rounded half-up (away from zero), in integer arithmetic."""
    units = f"SUM(CAST({c} * {10 ** scale} AS HUGEINT))"
    return f"(sign({units}) * ((2 * abs({units}) * 10000 + COUNT({c})) // (2 * NULLIF(COUNT({c}), 0))))"


def decimal_avg(c: str, scale: int, out: str) -> str:
    """Spark's ``avg(decimal(p, scale))``, typed ``out`` (decimal(p + 4, scale + 4))."""
    return f"CAST(CAST({_mean_units(c, scale)} AS DECIMAL(38,0)) * 0.{'0' * (scale + 3)}1 AS {out})"


def decimal_mean_2dp(c: str, scale: int, out: str) -> str:
    """Spark's ``round(avg(decimal(p, scale)), 2)``: the average above, then
    half-up to 2 places."""
    m = _mean_units(c, scale)
    d = 10 ** (scale + 2)
    return f"CAST(CAST(sign({m}) * ((2 * abs({m}) + {d}) // {2 * d}) AS DECIMAL(18,0)) * 0.01 AS {out})"


DECIMAL_MEAN_2DP = decimal_mean_2dp("{c}", 2, "DECIMAL(13,2)")   # money, decimal(12,2)
RATING_MEAN_2DP = decimal_mean_2dp("{c}", 1, "DECIMAL(5,2)")     # rating_safe, decimal(3,1)

GATE_PREDICATES = [
    ("bad_order_total", "order_total IS NULL OR order_total < 0"),
    ("null_order_status", "order_status IS NULL"),
]
CONSTRAINT_PREDICATES = (
    [(f"not_null_{c}", f"{c} IS NULL") for c in model.NOT_NULL_COLUMNS]
    + [
        ("status_domain", f"NOT (order_status IN ({_IN(model.ORDER_STATUSES)}))"),
        ("order_total_nonnegative", "order_total < 0"),
        ("item_count_positive", "item_count <= 0"),
        ("rating_range", f"NOT (rating BETWEEN {model.RATING_MIN} AND {model.RATING_MAX})"),
    ]
    + [(f"length_{c}", f"length({c}) > {n}") for c, n in model.VARCHAR_LENGTHS.items()]
    + [
        ("order_total_fits_decimal", "order_total IS NOT NULL AND TRY_CAST(order_total AS DECIMAL(12,2)) IS NULL"),
        ("rating_fits_decimal", "rating IS NOT NULL AND TRY_CAST(rating AS DECIMAL(3,1)) IS NULL"),
    ]
)
_SHIPS = f"order_status IN ({_IN(model.DELIVERY_STATUSES)})"
CONSISTENCY_PREDICATES = [
    ("delivery_without_shipment", f"delivery_date IS NOT NULL AND NOT ({_SHIPS})"),
    ("shipment_without_delivery", f"delivery_date IS NULL AND {_SHIPS}"),
    ("delivery_lead_days", f"NOT (date_diff('day', CAST(created_at AS DATE), delivery_date) "
                           f"BETWEEN {model.DELIVERY_DAYS_MIN} AND {model.DELIVERY_DAYS_MAX})"),
    ("rating_not_delivered", f"rating IS NOT NULL AND order_status <> '{model.RATED_STATUS}'"),
    ("address_missing", f"shipping_address IS NULL AND order_status <> '{model.NO_ADDRESS_STATUS}'"),
    ("address_on_cancelled", f"shipping_address IS NOT NULL AND order_status = '{model.NO_ADDRESS_STATUS}'"),
]


def _check_report(preds: list[tuple[str, str]], min_rows: int | None = None) -> str:
    aggs = ["COUNT(*) AS c0"] + [f"COUNT(*) FILTER (WHERE {p}) AS c{i}" for i, (_, p) in enumerate(preds, 1)]
    rows = []
    if min_rows is not None:
        rows.append(f"SELECT 'row_count' AS \"check\", c0 AS observed, CAST({min_rows} AS BIGINT) AS threshold, "
                    f"c0 >= {min_rows} AS passed FROM a")
    for i, (name, _) in enumerate(preds, 1):
        rows.append(f"SELECT '{name}' AS \"check\", c{i} AS observed, CAST(0 AS BIGINT) AS threshold, "
                    f"c{i} <= 0 AS passed FROM a")
    return f", a AS (SELECT {', '.join(aggs)} FROM o)\n" + "\nUNION ALL\n".join(rows)


def _cte(body: str, corrupted: bool = False) -> str:
    return with_orders_cte(body, corrupted)


def _column_profile_sql() -> str:
    rows = []
    for name, t, _, _ in model.ORDER_COLUMNS:
        longest = f"MAX(length({name}))" if t.typeName() == "string" else "NULL"
        rows.append(f"SELECT '{name}' AS column_name, COUNT(*) FILTER (WHERE {name} IS NULL) AS null_count, "
                    f"CAST({longest} AS INTEGER) AS max_length FROM o")
    return _cte("\n" + "\nUNION ALL\n".join(rows), corrupted=True)


def _schema_profile_sql() -> str:
    """The catalogue from DuckDB's own typeof of each column of the fixture. Three of
    its columns are picked from literals whatever the key, so they cannot be null."""
    kinds = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, CAST({i} AS INTEGER) AS ordinal_position, "
        f"(SELECT typeof({name}) FROM o LIMIT 1) AS kind" for i, (name, *_) in enumerate(model.ORDER_COLUMNS, start=1))
    return _cte(f""",
k AS ({kinds}),
d AS (SELECT *, regexp_extract(kind, 'DECIMAL\\((\\d+),(\\d+)\\)', 1) AS p, regexp_extract(kind, 'DECIMAL\\((\\d+),(\\d+)\\)', 2) AS s FROM k)
SELECT column_name, ordinal_position,
  CASE WHEN kind LIKE 'DECIMAL%' THEN 'numeric' WHEN kind = 'VARCHAR' THEN 'text'
       WHEN kind = 'TIMESTAMP' THEN 'timestamp without time zone' ELSE lower(kind) END AS data_type,
  CAST(NULL AS INTEGER) AS character_maximum_length,
  CAST(CASE WHEN kind LIKE 'DECIMAL%' THEN p WHEN kind = 'INTEGER' THEN '32' END AS INTEGER) AS numeric_precision,
  CAST(CASE WHEN kind LIKE 'DECIMAL%' THEN s WHEN kind = 'INTEGER' THEN '0' END AS INTEGER) AS numeric_scale,
  CASE WHEN column_name IN ('order_status', 'product_category', 'metadata') THEN 'NO' ELSE 'YES' END AS is_nullable
FROM d""")


def _status_drift_sql(tolerance_pp: float = 2.0) -> str:
    values = ", ".join(f"('{s}', {round(w * 10000)})" for s, w in model.ORDER_STATUS_WEIGHTS)
    tol = round(tolerance_pp * 100)
    return _cte(f""",
g AS (SELECT order_status, COUNT(*) AS cnt FROM o GROUP BY order_status),
w AS (SELECT * FROM (VALUES {values}) AS t(s, bp)),
t AS (SELECT COALESCE(g.order_status, w.s) AS order_status, COALESCE(g.cnt, 0) AS cnt,
             (SELECT COUNT(*) FROM o) AS total, COALESCE(w.bp, 0) AS bp
      FROM g FULL JOIN w ON g.order_status = w.s)
SELECT order_status, cnt,
       {PCT_DECIMAL.format(cnt='cnt', tot='total')} AS observed_pct,
       CAST(bp AS DOUBLE) / 100 AS expected_pct,
       abs(cnt * 10000 - bp * total) <= {tol} * total AS within_tolerance
FROM t""")


def _jdbc_plan_sql() -> str:
    return _cte(f"""
SELECT COUNT(*) AS rows, CAST(MIN(order_id) AS BIGINT) AS lower, CAST(MAX(order_id) AS BIGINT) + 1 AS upper,
  CAST(least({model.JDBC_MAX_PARTITIONS}, greatest({model.JDBC_MIN_PARTITIONS}, COUNT(*) // {model.JDBC_ROWS_PER_PARTITION})) AS INTEGER) AS partitions
FROM o""")


def _violations_sql() -> str:
    preds = CONSTRAINT_PREDICATES + CONSISTENCY_PREDICATES
    return _cte("\n" + "\nUNION ALL\n".join(
        f"SELECT o.*, '{name}' AS \"check\" FROM o WHERE {p}" for name, p in preds), corrupted=True)


def _quality_suite_sql() -> str:
    groups = [("gates", GATE_PREDICATES), ("constraints", CONSTRAINT_PREDICATES), ("consistency", CONSISTENCY_PREDICATES)]
    rows = [f"SELECT 'gates' AS report, 'row_count' AS \"check\", COUNT(*) AS observed, CAST({model.MIN_ROWS} AS BIGINT) AS threshold, "
            f"COUNT(*) >= {model.MIN_ROWS} AS passed FROM o"]
    rows += [f"SELECT '{report}', '{name}', COUNT(*) FILTER (WHERE {p}), CAST(0 AS BIGINT), COUNT(*) FILTER (WHERE {p}) = 0 FROM o"
             for report, preds in groups for name, p in preds]
    return _cte("\n" + "\nUNION ALL\n".join(rows), corrupted=True)


def _quarantine_sql() -> str:
    """Rules by row, listed in the rules' order."""
    cases = ", ".join(f"CASE WHEN {p} THEN '{name}' END" for name, p in CONSTRAINT_PREDICATES + CONSISTENCY_PREDICATES)
    return _cte(f"""
SELECT *, CASE WHEN failed_checks = '' THEN 'good' ELSE 'quarantine' END AS route
FROM (SELECT *, concat_ws(',', {cases}) AS failed_checks FROM o)""", corrupted=True)


def _validation_sql(k: int = 5) -> str:
    measures = {
        "row_count": {"total_rows": "COUNT(*)"},
        "null_profile": {"total": "COUNT(*)", **{f"null_{n}": f"COUNT(*) FILTER (WHERE {c} IS NULL)" for n, c in (
            ("rating", "rating"), ("delivery", "delivery_date"), ("address", "shipping_address"), ("metadata", "metadata"))}},
        "numeric_ranges": {"min_total": "MIN(order_total)", "max_total": "MAX(order_total)",
                           "avg_total": decimal_avg("order_total", 2, "DECIMAL(16,6)"), "min_items": "MIN(item_count)",
                           "max_items": "MAX(item_count)", "min_rating": "MIN(rating)", "max_rating": "MAX(rating)"},
        "date_ranges": {"earliest_order": "MIN(created_at)", "latest_order": "MAX(created_at)",
                        "earliest_delivery": "MIN(delivery_date)", "latest_delivery": "MAX(delivery_date)"},
    }
    rows = [f"SELECT '{report}' AS report, '{item}' AS item, CAST({e} AS VARCHAR) AS value FROM o"
            for report, items in measures.items() for item, e in items.items()]
    rows.append(f"SELECT 'status_distribution', order_status, COUNT(*)::VARCHAR || ' ' || "
                f"CAST({PCT_DECIMAL.format(cnt='COUNT(*)', tot='SUM(COUNT(*)) OVER ()')} AS VARCHAR) FROM o GROUP BY order_status")
    rows.append("SELECT 'device_distribution', json_extract_string(metadata, '$.device'), COUNT(*)::VARCHAR FROM o "
                "WHERE metadata IS NOT NULL GROUP BY 2")
    rows.append(f"SELECT * FROM (SELECT 'sample_rows', CAST(order_id AS VARCHAR), order_status FROM o "
                f"ORDER BY {draw_sql('CAST(order_id AS BIGINT)', 42, MODULUS, dialect='duckdb')}, order_id LIMIT {k})")
    return _cte("\n" + "\nUNION ALL\n".join(rows))


def oracle_sql() -> dict[str, str]:
    m2 = lambda c: f"CAST({DECIMAL_MEAN_2DP.format(c=c)} AS DOUBLE)"
    q = {
        "jdbc_plan_partitions": _jdbc_plan_sql(),
        "schema_profile": _schema_profile_sql(),
        "column_profile": _column_profile_sql(),
        "synth_orders": synth.synth_sql("SELECT o_orderkey + 1 AS order_id FROM orders", seed=7),
        "parquet_roundtrip": _cte(TRANSFORM_DF_SQL),
        "parquet_dynamic_overwrite": _cte(TRANSFORM_DF_SQL.replace(
            "item_count,", "item_count + CASE WHEN order_status IN ('pending', 'refunded') THEN 100 ELSE 0 END AS item_count,")),
        "transform_df": _cte(TRANSFORM_DF_SQL),
        "transform_sql": _cte(TRANSFORM_SQL_SQL),
        "revenue_tier": _cte(f"SELECT order_id, {TIER_SQL} AS revenue_tier FROM o"),
        "json_device": _cte("SELECT order_id, json_extract_string(metadata, '$.device') AS device FROM o"),
        "json_coupon": _cte("SELECT order_id, json_extract_string(metadata, '$.coupon_code') AS coupon_code FROM o"),
        "order_date": _cte("SELECT order_id, CAST(created_at AS DATE) AS order_date FROM o"),
        "loyalty_flag": _cte("SELECT order_id, CAST(is_loyalty_member AS INTEGER) AS loyalty_flag FROM o"),
        "rating_safe": _cte("SELECT order_id, COALESCE(CAST(rating AS DOUBLE), 0.0) AS rating_safe, "
                            "CAST(COALESCE(rating, 0.0) AS DECIMAL(3,1)) AS rating_safe_dec FROM o"),
        "apply_defaults": _cte(
            "SELECT order_id, customer_id, order_status, order_total, item_count, product_category, "
            "delivery_date, rating, metadata, shipping_address, "
            "TIMESTAMP '2024-01-01 00:00:00' AS created_at, false AS is_loyalty_member FROM o"),
        "filter_bad_total": _cte("SELECT * FROM o WHERE order_total IS NULL OR order_total < 0", corrupted=True),
        "row_count": _cte("SELECT COUNT(*) AS total_rows FROM o"),
        "status_counts": _cte('SELECT order_status, COUNT(*) AS "count" FROM o GROUP BY order_status'),
        "tier_counts": _cte(f'SELECT {TIER_SQL} AS revenue_tier, COUNT(*) AS "count" FROM o GROUP BY 1'),
        "summary_stats": _cte(
            f"SELECT {DECIMAL_MEAN_2DP.format(c='order_total')} AS avg_total, "
            "CAST(SUM(order_total) AS DECIMAL(23,2)) AS sum_total, "
            "AVG(COALESCE(CAST(rating AS DOUBLE), 0.0)) AS avg_rating FROM o"),
        "null_profile": _cte(
            "SELECT COUNT(*) AS total, "
            "COUNT(*) FILTER (WHERE rating IS NULL) AS null_rating, "
            "COUNT(*) FILTER (WHERE delivery_date IS NULL) AS null_delivery, "
            "COUNT(*) FILTER (WHERE shipping_address IS NULL) AS null_address, "
            "COUNT(*) FILTER (WHERE metadata IS NULL) AS null_metadata FROM o"),
        "numeric_ranges": _cte(
            "SELECT MIN(order_total) AS min_total, MAX(order_total) AS max_total, "
            f"{decimal_avg('order_total', 2, 'DECIMAL(16,6)')} AS avg_total, "
            "MIN(item_count) AS min_items, MAX(item_count) AS max_items, "
            "MIN(rating) AS min_rating, MAX(rating) AS max_rating FROM o"),
        "date_ranges": _cte(
            "SELECT MIN(created_at) AS earliest_order, MAX(created_at) AS latest_order, "
            "MIN(delivery_date) AS earliest_delivery, MAX(delivery_date) AS latest_delivery FROM o"),
        "device_distribution": _cte(
            "SELECT json_extract_string(metadata, '$.device') AS device, COUNT(*) AS cnt "
            "FROM o WHERE metadata IS NOT NULL GROUP BY 1 ORDER BY cnt DESC"),
        "status_distribution": _cte(
            f"SELECT order_status, COUNT(*) AS cnt, "
            f"{PCT_DECIMAL.format(cnt='COUNT(*)', tot='SUM(COUNT(*)) OVER ()')} AS pct "
            f"FROM o GROUP BY order_status ORDER BY cnt DESC"),
        "tier_breakdown": _cte(
            f"SELECT revenue_tier, COUNT(*) AS order_count, {m2('order_total')} AS avg_total, "
            f"CAST(SUM(order_total) AS DOUBLE) AS total_revenue "
            f"FROM (SELECT {TIER_SQL} AS revenue_tier, order_total FROM o) GROUP BY revenue_tier "
            f"ORDER BY total_revenue DESC"),
        "category_performance": _cte(
            f"SELECT product_category, COUNT(*) AS orders, {m2('order_total')} AS avg_order_value, "
            f"{RATING_MEAN_2DP.format(c='rating_safe')} AS avg_rating "
            f"FROM (SELECT product_category, order_total, COALESCE(rating, 0.0) AS rating_safe FROM o) "
            f"GROUP BY product_category ORDER BY orders DESC, product_category LIMIT 10"),
        "sample_rows": _cte(
            f"SELECT * FROM o ORDER BY {draw_sql('CAST(order_id AS BIGINT)', 42, MODULUS, dialect='duckdb')}, order_id LIMIT 5"),
        "head_rows": _cte("SELECT * FROM o ORDER BY order_id LIMIT 5"),
        "qc_report": _cte(_check_report(GATE_PREDICATES, min_rows=model.MIN_ROWS), corrupted=True),
        "qc_gate": _cte(TRANSFORM_DF_SQL),
        "pk_duplicates": _cte(
            "SELECT order_id, COUNT(*) AS n FROM o GROUP BY order_id HAVING COUNT(*) > 1 OR order_id IS NULL",
            corrupted=True),
        "constraint_report": _cte(_check_report(CONSTRAINT_PREDICATES), corrupted=True),
        "consistency_report": _cte(_check_report(CONSISTENCY_PREDICATES), corrupted=True),
        "status_drift": _status_drift_sql(),
        "violations": _violations_sql(),
        "extract_df": _cte(TRANSFORM_DF_SQL),
        "extract_sql": _cte(TRANSFORM_SQL_SQL),
    }
    changed = q["parquet_dynamic_overwrite"]
    q |= {
        "atomic_publish": changed,
        "compacted_publish": q["parquet_roundtrip"],
        "quality_suite": _quality_suite_sql(),
        "key_uniqueness": _cte(
            "SELECT COUNT(*) AS rows, COUNT(*) - COUNT(order_id) AS null_keys, COUNT(DISTINCT order_id) AS distinct_keys, "
            "COUNT(order_id) - COUNT(DISTINCT order_id) AS repeated_rows, COUNT(DISTINCT order_id) = COUNT(*) AS is_key FROM o", corrupted=True),
        "quarantine_orders": _quarantine_sql(),
        "validation_suite": _validation_sql(),
        "declared_defaults": _cte(
            "SELECT order_id, customer_id, order_status, order_total, item_count, product_category, TIMESTAMP '2024-01-01 00:00:00' AS created_at, "
            "delivery_date, false AS is_loyalty_member, rating, metadata, shipping_address FROM o"),
        "sql_projection": q["transform_sql"],
        "sql_gates": _cte(_check_report(GATE_PREDICATES[:1], min_rows=model.MIN_ROWS), corrupted=True),
        "state_status_drift": q["status_drift"],
    }
    for name in ("status_distribution", "tier_breakdown", "category_performance"):
        q[f"sql_{name}"] = q[f"state_{name}"] = q[name]
    return q


__all__ = ["oracle_sql", "fixture"]
