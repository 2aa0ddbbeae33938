"""Distributed synthetic orders (A10).

Rows follow the surveyed generator's rules, but every value is a hash draw
of ``(order_id, seed, salt)`` (:mod:`ordwise.functions.hashing`) instead of a
sequential random stream, so

* generation is a narrow projection over ``spark.range`` (or any key frame),
  spread over as many tasks as wanted, with no driver loop;
* a row does not depend on partitioning or retries, and the same
  ``(n, seed, as_of)`` always yields the same table;
* the clock is a parameter (``as_of``), not the wall time.

Rules: status by weights 5/10/20/50/10/5 %; created_at = as_of minus 0..730 days,
0..23 hours, 0..59 minutes; delivery date 1..14 days after creation only for
shipped / delivered; 1..20 items; total = round(unit price 5.00..500.00 x items
x 0.85..1.00, 2); loyalty with p = .35; rating only for delivered orders with
p = .80, weighted over 1.0..5.0; metadata keys device, coupon_code, ip_country,
referral with null keys left out; no address for cancelled orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise import model
from ordwise.functions.hashing import draw_stages
from ordwise.functions.picks import DUCKDB, SPARK, Dialect, nest_selects
from ordwise.sources.fixture import RATING_BOUNDS, STATUS_BOUNDS

DEFAULT_AS_OF = "2025-01-01 00:00:00"

# Short pick lists for the free-text columns (our own stand-ins for realistic
# names; only their shape matters to the operators).
COUNTRIES = ["AU", "NZ", "US", "GB", "SG", "JP", "IN", "DE", "FR", "CA"]
STREETS = ["George", "Pitt", "Collins", "Queen", "King", "Victoria", "Elizabeth", "Bourke"]
STREET_TYPES = ["St", "Rd", "Ave", "Lane", "Pde"]
SUBURBS = ["Newtown", "Fitzroy", "Paddington", "Carlton", "Subiaco", "Glenelg", "Manly", "Toowong"]
STATES = ["NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT"]

# Draw slots: name -> (slot, modulus). The salt of a slot is seed * 100 + slot.
SLOTS = {
    "status": (1, 100), "days": (2, 731), "hours": (3, 24), "minutes": (4, 60), "delivery": (5, 14),
    "items": (6, 20), "unit_cents": (7, 49501), "discount": (8, 15001), "loyalty": (9, 100),
    "rated": (10, 100), "rating": (11, 100), "device": (12, 5), "coupon": (13, 7),
    "country": (14, len(COUNTRIES)), "referral": (15, 5), "category": (16, 10), "number": (17, 250),
    "street": (18, len(STREETS)), "street_type": (19, len(STREET_TYPES)), "suburb": (20, len(SUBURBS)),
    "state": (21, len(STATES)), "postcode": (22, 9000),
    **{f"hex{i}": (30 + i, 1 << 20) for i in range(6)},   # 6 x 5 hex digits for the UUID
}


def _draws(seed: int) -> dict[str, tuple[int, int]]:
    return {n: (seed * 100 + slot, m) for n, (slot, m) in SLOTS.items()}


def _stages(d: Dialect, seed: int, as_of: str, key: str) -> list[list[str]]:
    draw_x, draw_u = draw_stages(f"CAST({key} AS BIGINT)", _draws(seed), [key], d.name)
    hexes = " || ".join(f"lpad(lower(hex(_u_hex{i})), 5, '0')" for i in range(6))   # 30 hex digits
    cents = d.idiv("(_u_unit_cents + 500) * (_u_items + 1) * (_u_discount + 85000) + 50000", "100000")
    rating = d.pick_by_bounds("_u_rating", RATING_BOUNDS, lambda v: f"CAST({v} AS DECIMAL(3,1))")
    address = " || ".join([
        "CAST(_u_number + 1 AS STRING)", "' '", d.pick_from(STREETS, "_u_street"), "' '",
        d.pick_from(STREET_TYPES, "_u_street_type"), "', '", d.pick_from(SUBURBS, "_u_suburb"), "' '",
        d.pick_from(STATES, "_u_state"), "' '", "CAST(_u_postcode + 1000 AS STRING)"])
    base = [
        f"CAST({key} AS INT) AS order_id",
        f"{hexes} AS _h",
        f"{d.pick_from(['8', '9', 'a', 'b'], '_u_hex0 % 4')} AS _variant",
        f"{d.pick_by_bounds('_u_status', STATUS_BOUNDS)} AS order_status",
        f"CAST(CAST({cents} AS DECIMAL(14,0)) * 0.01 AS DECIMAL(12,2)) AS order_total",
        "CAST(_u_items + 1 AS INT) AS item_count",
        f"{d.pick_from(model.PRODUCT_CATEGORIES, '_u_category')} AS product_category",
        f"{d.shift_ts(d.ts_literal(as_of), '-', '_u_days', '_u_hours', '_u_minutes')} AS created_at",
        "_u_delivery + 1 AS _lead",
        "_u_loyalty < 35 AS is_loyalty_member",
        "_u_rated AS _rated",
        f"{rating} AS _rating",
        f"{d.pick_from(model.DEVICES, '_u_device')} AS _device",
        f"{d.pick_from(model.COUPONS, '_u_coupon')} AS _coupon",
        f"{d.pick_from(COUNTRIES, '_u_country')} AS _country",
        f"{d.pick_from(model.REFERRALS, '_u_referral')} AS _referral",
        f"{address} AS _address",
    ]
    return [draw_x, draw_u, base, _stage2(d)]


def _stage2(d: Dialect) -> list[str]:
    ships = ", ".join(f"'{s}'" for s in model.DELIVERY_STATUSES)
    if d.name == "spark":   # to_json leaves out null fields
        metadata = ("to_json(named_struct('device', _device, 'coupon_code', _coupon, "
                    "'ip_country', _country, 'referral', _referral))")
    else:
        jp = lambda k, v: f"""'"{k}":"' || {v} || '"'"""
        metadata = ("'{' || concat_ws(',', " + ", ".join([
            jp("device", "_device"), jp("coupon_code", "_coupon"), jp("ip_country", "_country"),
            jp("referral", "_referral")]) + ") || '}'")
    return [
        "order_id",
        "substring(_h, 1, 8) || '-' || substring(_h, 9, 4) || '-4' || substring(_h, 13, 3) || '-' "
        "|| _variant || substring(_h, 16, 3) || '-' || substring(_h, 19, 12) AS customer_id",
        "order_status", "order_total", "item_count", "product_category", "created_at",
        f"CASE WHEN order_status IN ({ships}) THEN {d.date_plus('created_at', '_lead')} END AS delivery_date",
        "is_loyalty_member",
        f"CASE WHEN order_status = '{model.RATED_STATUS}' AND _rated < 80 THEN _rating END AS rating",
        f"{metadata} AS metadata",
        f"CASE WHEN order_status <> '{model.NO_ADDRESS_STATUS}' THEN _address END AS shipping_address",
    ]


def synth_from_keys(keys: DataFrame, seed: int = 42, as_of: str = DEFAULT_AS_OF,
                    key: str = "order_id") -> DataFrame:
    """12-column orders for each key of ``keys`` (created_at as timestamp_ntz)."""
    for exprs in _stages(SPARK, seed, as_of, key):
        keys = keys.selectExpr(*exprs)
    return keys


def synth_orders(spark: SparkSession, n: int, seed: int = 42, as_of: str = DEFAULT_AS_OF,
                 num_partitions: int | None = None) -> DataFrame:
    """``n`` orders with ids 1..n, spread over ``num_partitions`` tasks."""
    keys = spark.range(1, n + 1, numPartitions=num_partitions).withColumnRenamed("id", "order_id")
    return synth_from_keys(keys, seed, as_of)


def synth_sql(keys_sql: str, seed: int = 42, as_of: str = DEFAULT_AS_OF) -> str:
    """The same rules as DuckDB text over a relation ``keys(order_id)``."""
    return nest_selects(_stages(DUCKDB, seed, as_of, "order_id"), f"({keys_sql}) AS k")
