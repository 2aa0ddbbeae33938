"""JDBC read planning (A3): how many connections a read opens, and the WHERE
clauses of a read that is cut at key quantiles.

An equal-width split is Spark's own (``column``, ``lowerBound``, ``upperBound``,
``numPartitions``) over the key's real bounds. Spark has no quantile split, so
sparse or clustered keys get explicit predicates, one partition each: the first
range also takes null keys and both ends are open, so every row is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise import model


def num_partitions_for(rows: int, max_connections: int = model.JDBC_MAX_PARTITIONS) -> int:
    """rows // 100, at least 4, at most the caller's connections (20 unless given)."""
    return max(1, min(max_connections, max(model.JDBC_MIN_PARTITIONS, rows // model.JDBC_ROWS_PER_PARTITION)))


def quantile_predicates(column: str, lower: int, cuts: list[int | None]) -> list[str]:
    """One WHERE clause per range between the distinct cuts above ``lower``."""
    bounds = sorted({int(c) for c in cuts if c is not None and int(c) > lower})
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *inner, f"{column} >= {bounds[-1]}"]


def read_plan(df: DataFrame, column: str, max_connections: int = model.JDBC_MAX_PARTITIONS) -> DataFrame:
    """(rows, lower, upper, partitions) of a read of ``df`` split on ``column``: one
    aggregate, the upper bound exclusive."""
    n = F.count(F.lit(1))
    wanted = F.greatest(F.lit(model.JDBC_MIN_PARTITIONS), F.floor(n / model.JDBC_ROWS_PER_PARTITION))
    return df.agg(
        n.alias("rows"), F.min(column).cast("bigint").alias("lower"), (F.max(column).cast("bigint") + 1).alias("upper"),
        F.least(F.lit(max_connections), wanted).cast("int").alias("partitions"))
