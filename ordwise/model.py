"""Orders data model: schema, declared constraints and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the surveyed job's values for results to
# match; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Order status domain and the generator's expected share of each status.
ORDER_STATUS_WEIGHTS = [
    ("pending", 0.05),
    ("processing", 0.10),
    ("shipped", 0.20),
    ("delivered", 0.50),
    ("cancelled", 0.10),
    ("refunded", 0.05),
]
ORDER_STATUSES = [s for s, _ in ORDER_STATUS_WEIGHTS]

PRODUCT_CATEGORIES = [
    "Electronics", "Clothing", "Home & Garden", "Sports & Outdoors",
    "Books", "Toys & Games", "Beauty & Health", "Automotive",
    "Food & Grocery", "Pet Supplies",
]

DEVICES = ["mobile", "desktop", "tablet", "app-ios", "app-android"]
# None entries mean "key absent from the metadata document".
COUPONS = [None, None, None, "SAVE10", "WELCOME20", "FLASH15", "MEMBER5"]
REFERRALS = [None, "google", "email", "social", "direct"]

# Rating values and their relative weights (sum 100).
RATING_WEIGHTS = [(1.0, 2), (2.0, 3), (3.0, 8), (3.5, 10), (4.0, 20), (4.5, 25), (5.0, 32)]

# Revenue tier: total < 50 -> low, < 200 -> mid, otherwise (including null) high.
TIER_LOW_BELOW = 50
TIER_MID_BELOW = 200

# Statuses that carry a delivery date; the only status that carries a rating;
# the status that has no shipping address.
DELIVERY_STATUSES = ["shipped", "delivered"]
RATED_STATUS = "delivered"
NO_ADDRESS_STATUS = "cancelled"
DELIVERY_DAYS_MIN, DELIVERY_DAYS_MAX = 1, 14

# Row-count gate: the job fails below this many rows.
MIN_ROWS = 900

# JDBC partition planner: max(4, min(20, rows // 100)).
JDBC_MIN_PARTITIONS, JDBC_MAX_PARTITIONS, JDBC_ROWS_PER_PARTITION = 4, 20, 100
JDBC_FETCH_SIZE = 5000

# Declared column constraints of the source table.
VARCHAR_LENGTHS = {"customer_id": 36, "order_status": 20, "product_category": 50}
TOTAL_TYPE = T.DecimalType(12, 2)
RATING_TYPE = T.DecimalType(3, 1)
RATING_MIN, RATING_MAX = "1.0", "5.0"
NOT_NULL_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_total", "item_count",
    "product_category", "created_at", "is_loyalty_member",
]

# ---------------------------------------------------------------------------
# Schema of the 12-column source table, in ordinal order.
# (name, spark type, declared nullable, source type name)
# ---------------------------------------------------------------------------
ORDER_COLUMNS = [
    ("order_id", T.IntegerType(), False, "integer"),
    ("customer_id", T.StringType(), False, "character varying"),
    ("order_status", T.StringType(), False, "character varying"),
    ("order_total", TOTAL_TYPE, False, "numeric"),
    ("item_count", T.IntegerType(), False, "integer"),
    ("product_category", T.StringType(), False, "character varying"),
    ("created_at", T.TimestampType(), False, "timestamp with time zone"),
    ("delivery_date", T.DateType(), True, "date"),
    ("is_loyalty_member", T.BooleanType(), False, "boolean"),
    ("rating", RATING_TYPE, True, "numeric"),
    ("metadata", T.StringType(), True, "jsonb"),
    ("shipping_address", T.StringType(), True, "text"),
]
ORDER_COLUMN_NAMES = [c[0] for c in ORDER_COLUMNS]

ORDERS_SCHEMA = T.StructType([T.StructField(n, t, nullable) for n, t, nullable, _ in ORDER_COLUMNS])

# DDL column types for a JDBC target table (createTableColumnTypes). Spark has no
# name for JSONB, so metadata and shipping_address stay its default text type
# when Spark creates the table; a table that exists keeps its own types.
JDBC_COLUMN_TYPES = ", ".join([
    "order_id INTEGER",
    "customer_id VARCHAR(36)",
    "order_status VARCHAR(20)",
    "order_total DECIMAL(12,2)",
    "item_count INTEGER",
    "product_category VARCHAR(50)",
    "created_at TIMESTAMP",
    "delivery_date DATE",
    "is_loyalty_member BOOLEAN",
    "rating DECIMAL(3,1)",
])

# Column that partitions the written dataset.
PARTITION_COLUMN = "order_status"
