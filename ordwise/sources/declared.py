"""The orders table as a catalogue table with its declared types and defaults.

Column defaults and CHAR/VARCHAR lengths are Spark's own table metadata: an insert that names fewer columns gets
the defaults (an explicit null stays null), text longer than declared fails the insert, and the column
catalogue reads both back. NOT NULL, CHECK and PRIMARY KEY have no effect on Spark's file tables, so they stay checks
(:mod:`ordwise.operators.quality`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise import model
from ordwise.operators.reports import _catalogue

# The source's defaults.
DEFAULTS = {"created_at": "current_timestamp()", "is_loyalty_member": "false"}
CURRENT_DEFAULT = "CURRENT_DEFAULT"


def columns_sql(defaults: dict[str, str] | None = None) -> str:
    defaults = DEFAULTS if defaults is None else defaults
    parts = []
    for name, t, *_ in model.ORDER_COLUMNS:
        kind = f"VARCHAR({model.VARCHAR_LENGTHS[name]})" if name in model.VARCHAR_LENGTHS else t.simpleString()
        parts.append(f"{name} {kind}" + (f" DEFAULT {defaults[name]}" if name in defaults else ""))
    return ", ".join(parts)


def create_orders_table(spark: SparkSession, name: str, location: str, defaults: dict[str, str] | None = None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns_sql(defaults)}) USING parquet LOCATION '{location}'")


def insert_orders(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append ``rows``; columns they lack get their defaults, and those without a default null."""
    named = [c for c in model.ORDER_COLUMN_NAMES if c in rows.columns]
    rows.select(*named).createOrReplaceTempView(f"{name}_rows")
    try:
        spark.sql(f"INSERT INTO {name} ({', '.join(named)}) SELECT {', '.join(named)} FROM {name}_rows")
    finally:
        spark.catalog.dropTempView(f"{name}_rows")


def declared_profile(table: DataFrame) -> DataFrame:
    """The column catalogue of a table with its column defaults."""
    defaults = [(f.metadata or {}).get(CURRENT_DEFAULT) for f in table.schema.fields]
    schema = ("column_name string, ordinal_position int, data_type string, character_maximum_length int, "
              "numeric_precision int, numeric_scale int, is_nullable string, column_default string")
    return table.sparkSession.createDataFrame([(*r, d) for r, d in zip(_catalogue(table), defaults)], schema).orderBy("ordinal_position")
