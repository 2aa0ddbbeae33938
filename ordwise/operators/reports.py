"""Profiling and summary reports.

Each report is a ``DataFrame -> DataFrame`` function over the orders model or
one of its derived flavours. Grouped reports group on low-cardinality keys
(status, tier, category, device), so Spark's partial aggregation collapses
every task's rows to one row per key before the shuffle: the exchange moves
a few rows per task however large or skewed the table is. Shares of total
use a window over the *aggregated* rows only.

Money is always summed as an exact decimal. ``order_total`` arrives either as
decimal(12,2) (DataFrame flavour) or as a double cast from it (SQL flavour);
casting back to decimal(12,2) is exact for cent values, and a no-op for the
decimal flavour.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordwise import model
from ordwise.functions.derive import device as device_expr
from ordwise.functions.hashing import MODULUS, draw



def money(col: str = "order_total") -> Column:
    return F.col(col).cast(model.TOTAL_TYPE)


def mean_2dp(c: Column) -> Column:
    """A double mean rounded to 2 places, as the SQL job reports it, taken from
    the exact decimal average rounded half-up: no summation-order noise, and no
    double near x.xx5 that engines round differently."""
    return F.round(F.avg(c), 2).cast("double")


# -- E1 - E4 ------------------------------------------------------------------

def _row_count() -> dict[str, Column]:
    return {"total_rows": F.count(F.lit(1))}


def _null_profile() -> dict[str, Column]:
    null = lambda c: F.count_if(F.col(c).isNull())
    return {"total": F.count(F.lit(1)), "null_rating": null("rating"), "null_delivery": null("delivery_date"),
            "null_address": null("shipping_address"), "null_metadata": null("metadata")}


def _numeric_ranges() -> dict[str, Column]:
    return {"min_total": F.min("order_total"), "max_total": F.max("order_total"), "avg_total": F.avg(money()),
            "min_items": F.min("item_count"), "max_items": F.max("item_count"),
            "min_rating": F.min("rating"), "max_rating": F.max("rating")}


def _date_ranges() -> dict[str, Column]:
    return {"earliest_order": F.min("created_at"), "latest_order": F.max("created_at"),
            "earliest_delivery": F.min("delivery_date"), "latest_delivery": F.max("delivery_date")}


# The global aggregates, so that a suite can take them in one pass.
GLOBAL_MEASURES = {"row_count": _row_count, "null_profile": _null_profile,
                   "numeric_ranges": _numeric_ranges, "date_ranges": _date_ranges}


def _global(df: DataFrame, name: str) -> DataFrame:
    return df.agg(*[c.alias(k) for k, c in GLOBAL_MEASURES[name]().items()])


def row_count(df: DataFrame) -> DataFrame:
    return _global(df, "row_count")


def status_counts(df: DataFrame) -> DataFrame:
    """Rows per status, most frequent first (status breaks ties)."""
    return (df.groupBy("order_status").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last("order_status")))


def tier_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("revenue_tier").agg(F.count(F.lit(1)).alias("count"))


def summary_stats(df: DataFrame) -> DataFrame:
    """Average and total order value, and average rating_safe (unrated count as 0).

    The DataFrame job's own expressions over the exact decimal, so the types
    are its types too: avg_total decimal(13,2) (the decimal mean, rounded
    half-up), sum_total decimal(23,2), avg_rating double.
    """
    return df.agg(
        F.round(F.avg(money()), 2).alias("avg_total"),
        F.round(F.sum(money()), 2).alias("sum_total"),
        F.avg("rating_safe").cast("double").alias("avg_rating"),
    )


# -- E5 - E8 (validation profile over the raw model) ---------------------------

def null_profile(df: DataFrame) -> DataFrame:
    return _global(df, "null_profile")


def numeric_ranges(df: DataFrame) -> DataFrame:
    """Min / max / mean of the numeric columns; the mean of the decimal total
    is Spark's exact decimal average, decimal(16,6)."""
    return _global(df, "numeric_ranges")


def date_ranges(df: DataFrame) -> DataFrame:
    return _global(df, "date_ranges")


def device_distribution(df: DataFrame) -> DataFrame:
    """Rows per JSON ``device`` among rows that carry metadata."""
    return (df.filter(F.col("metadata").isNotNull())
            .groupBy(device_expr().alias("device"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc_nulls_last("device")))


# -- E9 / F1, E10, E11 ----------------------------------------------------------

def status_distribution(df: DataFrame) -> DataFrame:
    """Count and percent of total per status.

    The total comes from a window with an empty partition over the grouped
    rows, so the single-partition exchange carries one row per status.
    """
    return share_of_total(df.groupBy("order_status").agg(F.count(F.lit(1)).alias("cnt")))


def share_of_total(grouped: DataFrame) -> DataFrame:
    """(order_status, cnt, pct) of counted groups."""
    total = F.sum("cnt").over(Window.partitionBy())
    return (grouped.select(
        "order_status", "cnt",
        F.round(F.col("cnt") * F.lit(Decimal("100.0")) / total, 1).alias("pct"))
        .orderBy(F.desc("cnt"), F.asc_nulls_last("order_status")))


def tier_breakdown(df: DataFrame) -> DataFrame:
    """Orders, average and revenue per tier, by revenue descending.

    Doubles, as in the surveyed SQL job, but computed from the exact decimal
    sum, so the value does not depend on the order rows are added in.
    """
    return (df.groupBy("revenue_tier").agg(
        F.count(F.lit(1)).alias("order_count"),
        mean_2dp(money()).alias("avg_total"),
        F.round(F.sum(money()), 2).cast("double").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), F.asc("revenue_tier")))


def category_performance(df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k categories by order count with average value and rating."""
    return (df.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("orders"),
        mean_2dp(money()).alias("avg_order_value"),
        F.round(F.avg("rating_safe"), 2).alias("avg_rating"))
        .orderBy(F.desc("orders"), F.asc("product_category"))
        .limit(k))


# -- G3, G4 -------------------------------------------------------------------

def sample_rows(df: DataFrame, k: int = 5, seed: int = 42, key: str = "order_id") -> DataFrame:
    """k rows in a repeatable random order: top-k on a hash of the key, one
    ``TakeOrderedAndProject`` in which each task keeps k rows."""
    h = draw(f"CAST(`{key}` AS BIGINT)", seed, MODULUS)
    return df.orderBy(h.asc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)


def head_rows(df: DataFrame, k: int = 5, key: str = "order_id") -> DataFrame:
    """First k rows by key (an explicit order, so the result is defined)."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(k)


# -- A9 -----------------------------------------------------------------------

# The source catalogue's names of Spark's types.
TYPE_NAMES = {
    "byte": "smallint", "short": "smallint", "integer": "integer", "long": "bigint", "float": "real",
    "double": "double precision", "decimal": "numeric", "boolean": "boolean", "date": "date", "string": "text",
    "char": "character", "varchar": "character varying", "timestamp": "timestamp with time zone",
    "timestamp_ntz": "timestamp without time zone", "binary": "bytea",
}
INTEGER_BITS = {"byte": 16, "short": 16, "integer": 32, "long": 64}


def _catalogue(df: DataFrame) -> list[tuple]:
    """(name, ordinal, type, max_len, precision, scale, is_nullable) per column, all
    from the frame's own schema and the varchar types in its field metadata."""
    rows = []
    for i, f in enumerate(df.schema.fields, start=1):
        kind, max_len, prec, scale = f.dataType.typeName(), None, None, None
        declared = (f.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING", "")
        if "(" in declared:
            kind, _, n = declared.rstrip(")").partition("(")
            max_len = int(n)
        if isinstance(f.dataType, T.DecimalType):
            kind, prec, scale = "decimal", f.dataType.precision, f.dataType.scale
        elif kind in INTEGER_BITS:
            prec, scale = INTEGER_BITS[kind], 0
        rows.append((f.name, i, TYPE_NAMES.get(kind, f.dataType.simpleString()), max_len, prec, scale,
                     "YES" if f.nullable else "NO"))
    return rows


def schema_profile(df: DataFrame) -> DataFrame:
    """Column catalogue in ordinal order; no data is read."""
    schema = ("column_name string, ordinal_position int, data_type string, character_maximum_length int, "
              "numeric_precision int, numeric_scale int, is_nullable string")
    return df.sparkSession.createDataFrame(_catalogue(df), schema).orderBy("ordinal_position")


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, max_length) per column, from one aggregate."""
    aggs, args = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        longest = F.max(F.length(c)) if isinstance(f.dataType, T.StringType) else F.lit(None)
        aggs += [F.count_if(c.isNull()).alias(f"_n{i}"), longest.cast("int").alias(f"_l{i}")]
        args += [F.lit(f.name), F.col(f"_n{i}"), F.col(f"_l{i}")]
    return df.agg(*aggs).select(F.stack(F.lit(len(df.schema)), *args).alias("column_name", "null_count", "max_length"))
