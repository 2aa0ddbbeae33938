"""Adapter from the driver's TPC-H-style ``orders`` table to the 12-column model.

Every column is a pure function of the row's own key and values (hash draws
from :mod:`ordwise.functions.hashing`), so the adapter is a single narrow
projection over the scan: no shuffle, no driver work, identical under any
partitioning. The projection is SQL expression text rendered per dialect:
Spark compiles it in one ``selectExpr``; DuckDB runs the same text as the
oracle's copy of the fixture.

``created_at`` stays ``timestamp_ntz`` here, so no result depends on a
session time zone; :func:`as_model` casts it to the source's TIMESTAMPTZ type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ordwise import model
from ordwise.functions.hashing import draw_stages
from ordwise.functions.picks import DUCKDB, SPARK, Dialect, cumulative, nest_selects, render_select

# Salt and modulus of each draw.
DRAWS = {
    "status": (1, 100), "items": (2, 20), "category": (3, 10), "hour": (4, 24), "minute": (5, 60),
    "delivery": (6, 14), "loyalty": (7, 100), "rated": (8, 100), "rating": (9, 100),
    "device": (10, 5), "coupon": (11, 7), "referral": (12, 5),
}
SOURCE_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
IP_COUNTRY = "AU"
CUSTOMER_PREFIX = "00000000-0000-4000-8000-"
ADDRESS_SUFFIX = " Example St"

# Corruption of the check-operator variant: the rows whose key leaves remainder 0
# by a modulus break one rule. Every rule of operators/quality.py is broken.
NULL_MODS = {"customer_id": 127, "order_status": 101, "order_total": 131, "item_count": 137,
             "product_category": 139, "created_at": 149, "is_loyalty_member": 151}
NULL_ID_MOD, DUP_ID_MOD = 113, 109
NEGATIVE_TOTAL_MOD, WIDE_TOTAL_MOD, ZERO_ITEMS_MOD = 97, 157, 163
BAD_RATING_MOD, WIDE_RATING_MOD = 103, 167
LONG_TEXT_MODS = {"customer_id": (173, 40), "order_status": (179, 25), "product_category": (181, 60)}
UNKNOWN_STATUS_MOD, LATE_MOD, STRAY_DELIVERY_MOD, NO_DELIVERY_MOD = 191, 83, 79, 73
NULL_ADDRESS_MOD, STRAY_ADDRESS_MOD = 107, 71
BAD_RATING, WIDE_RATING, WIDE_TOTAL = "9.9", "1234.5", "99999999999.99"
WIDE_TOTAL_TYPE, WIDE_RATING_TYPE = "DECIMAL(16,2)", "DECIMAL(6,1)"

STATUS_BOUNDS = cumulative(model.ORDER_STATUS_WEIGHTS)   # pending<5, ... refunded<100
RATING_BOUNDS = cumulative(model.RATING_WEIGHTS)         # 1.0<2, ... 5.0<100

# Columns of the driver table the adapter reads, with their types: an explicit
# schema saves a footer read per query and prunes the scan to four columns.
SOURCE_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
])


def _stages(d: Dialect) -> list[list[str]]:
    """Projections from the driver row (key o_orderkey) to the 12 model columns."""
    draw_x, draw_u = draw_stages("o_orderkey", DRAWS, SOURCE_COLUMNS, d.name)
    rating = d.pick_by_bounds("_u_rating", RATING_BOUNDS, lambda v: f"CAST({v} AS DECIMAL(3,1))")
    cents = d.idiv("CAST(round(o_totalprice * 100) AS BIGINT)", "1000")
    base = [
        "CAST(o_orderkey + 1 AS INT) AS order_id",
        f"'{CUSTOMER_PREFIX}' || lpad(CAST(o_custkey AS STRING), 12, '0') AS customer_id",
        f"{d.pick_by_bounds('_u_status', STATUS_BOUNDS)} AS order_status",
        f"CAST(CAST({cents} AS DECIMAL(14,0)) * 0.01 AS DECIMAL(12,2)) AS order_total",
        "CAST(_u_items + 1 AS INT) AS item_count",
        f"{d.pick_from(model.PRODUCT_CATEGORIES, '_u_category')} AS product_category",
        f"{d.shift_ts('o_orderdate', '+', '0', '_u_hour', '_u_minute')} AS created_at",
        f"{d.date_plus('o_orderdate', '_u_delivery + 1')} AS _delivery",
        "_u_loyalty < 35 AS is_loyalty_member",
        "_u_rated AS _rated",
        f"{rating} AS _rating",
        f"{d.pick_from(model.DEVICES, '_u_device')} AS _device",
        f"{d.pick_from(model.COUPONS, '_u_coupon')} AS _coupon",
        f"{d.pick_from(model.REFERRALS, '_u_referral')} AS _referral",
        "o_custkey",
    ]
    return [draw_x, draw_u, base, _stage2()]


def _stage2() -> list[str]:
    """Status-dependent columns and the metadata document (same text in both dialects)."""
    jp = lambda key, v: f"""'"{key}": "' || {v} || '"'"""
    ships = ", ".join(f"'{s}'" for s in model.DELIVERY_STATUSES)
    return [
        "order_id", "customer_id", "order_status", "order_total", "item_count", "product_category", "created_at",
        f"CASE WHEN order_status IN ({ships}) THEN _delivery END AS delivery_date",
        "is_loyalty_member",
        f"CASE WHEN order_status = '{model.RATED_STATUS}' AND _rated < 80 THEN _rating END AS rating",
        "'{' || concat_ws(', ', " + ", ".join([
            jp("device", "_device"), jp("coupon_code", "_coupon"),
            jp("ip_country", f"'{IP_COUNTRY}'"), jp("referral", "_referral")]) + ") || '}' AS metadata",
        f"CASE WHEN order_status <> '{model.NO_ADDRESS_STATUS}' "
        f"THEN CAST(o_custkey AS STRING) || '{ADDRESS_SUFFIX}' END AS shipping_address",
    ]


def _corrupt(d: Dialect) -> list[str]:
    """Rule breakers keyed on order_id - 1; every row is kept, values change in
    place, and the decimals are wider than declared so that they can overflow."""
    hit = lambda m: f"(order_id - 1) % {m} = 0 AND order_id > 1"

    def broken(col: str, *cases: tuple[int, str], value: str | None = None) -> str:
        whens = [(NULL_MODS[col], "NULL")] if col in NULL_MODS else []
        if col in LONG_TEXT_MODS:
            m, n = LONG_TEXT_MODS[col]
            whens.append((m, f"rpad({col}, {n}, 'x')"))
        text = " ".join(f"WHEN {hit(m)} THEN {v}" for m, v in [*whens, *cases])
        return f"CASE {text} ELSE {value or col} END AS {col}"

    return [
        broken("order_id", (NULL_ID_MOD, "NULL"), (DUP_ID_MOD, "order_id - 1")),
        broken("customer_id"),
        broken("order_status", (UNKNOWN_STATUS_MOD, "'unknown'")),
        broken("order_total", (NEGATIVE_TOTAL_MOD, f"CAST(-order_total AS {WIDE_TOTAL_TYPE})"),
               (WIDE_TOTAL_MOD, f"CAST({WIDE_TOTAL} AS {WIDE_TOTAL_TYPE})"),
               value=f"CAST(order_total AS {WIDE_TOTAL_TYPE})"),
        broken("item_count", (ZERO_ITEMS_MOD, "0")),
        broken("product_category"),
        broken("created_at"),
        broken("delivery_date", (LATE_MOD, d.date_plus("delivery_date", "60")), (NO_DELIVERY_MOD, "NULL"),
               (STRAY_DELIVERY_MOD, "CAST(created_at AS DATE)")),
        broken("is_loyalty_member"),
        broken("rating", (BAD_RATING_MOD, f"CAST({BAD_RATING} AS {WIDE_RATING_TYPE})"),
               (WIDE_RATING_MOD, f"CAST({WIDE_RATING} AS {WIDE_RATING_TYPE})"),
               value=f"CAST(rating AS {WIDE_RATING_TYPE})"),
        "metadata",
        broken("shipping_address", (NULL_ADDRESS_MOD, "NULL"), (STRAY_ADDRESS_MOD, f"'0{ADDRESS_SUFFIX}'")),
    ]


def adapt_orders(orders: DataFrame) -> DataFrame:
    """Driver ``orders`` -> the 12 model columns (created_at as timestamp_ntz)."""
    for exprs in _stages(SPARK):
        orders = orders.selectExpr(*exprs)
    return orders


def corrupt_orders(adapted: DataFrame) -> DataFrame:
    """Variant of the adapter with rule breakers, for the check operators."""
    return adapted.selectExpr(*_corrupt(SPARK))


def as_model(adapted: DataFrame) -> DataFrame:
    """Cast ``created_at`` to the source type (timestamp with session zone)."""
    return adapted.withColumn("created_at", adapted["created_at"].cast("timestamp"))


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's orders table, only the columns the adapter needs."""
    return spark.read.schema(SOURCE_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/orders.parquet")


def load_orders(spark: SparkSession, sf_dir: str, corrupted: bool = False) -> DataFrame:
    """The adapted (optionally corrupted) orders of ``sf_dir``, listed anew on every call."""
    df = adapt_orders(read_orders(spark, sf_dir))
    return corrupt_orders(df) if corrupted else df


# -- the same fixture as DuckDB text, for the oracle ---------------------------

ADAPTER_SQL = nest_selects(_stages(DUCKDB), "orders")
CORRUPTED_SQL = render_select(_corrupt(DUCKDB), f"({ADAPTER_SQL}) AS c")


def with_orders_cte(body: str, corrupted: bool = False) -> str:
    """Prefix an oracle query with the adapter as CTE ``o``."""
    return f"WITH o AS ({CORRUPTED_SQL if corrupted else ADAPTER_SQL})\n{body}"
