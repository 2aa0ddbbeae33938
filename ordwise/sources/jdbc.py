"""JDBC source and sink.

Credentials are the caller's business: every function takes the JDBC URL and
a properties map (user, password, driver, ssl options ...). Nothing here
opens a connection until Spark runs a job.

Reading a table is planned from the database's own statistics: one pushed
down ``COUNT/MIN/MAX`` query (the aggregate runs in the database, one row
comes back), then a range split over the real key range with at most
``max_connections`` concurrent readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise import model
from ordwise.sources.partitions import num_partitions_for, quantile_predicates


def connection_properties(user: str, password: str, driver: str = "org.postgresql.Driver", *,
                          ssl: bool = True, fetch_size: int = model.JDBC_FETCH_SIZE,
                          socket_timeout_s: int | None = 120, connect_timeout_s: int | None = 30,
                          **extra: str) -> dict[str, str]:
    """Options map (A5): TLS required, 5000-row fetches, optional timeouts."""
    props = {"user": user, "password": password, "driver": driver, "fetchsize": str(fetch_size)}
    if ssl:
        props.update({"ssl": "true", "sslmode": "require"})
    if socket_timeout_s is not None:
        props["socketTimeout"] = str(socket_timeout_s)
    if connect_timeout_s is not None:
        props["connectTimeout"] = str(connect_timeout_s)
    props.update({k: str(v) for k, v in extra.items()})
    return props


def scan(spark: SparkSession, url: str, table: str, properties: dict) -> DataFrame:
    """Unpartitioned scan (A4): one reader, one partition."""
    return spark.read.jdbc(url=url, table=table, properties=properties)


def query_scan(spark: SparkSession, url: str, query: str, properties: dict) -> DataFrame:
    """A subquery as a table (A2), so aggregates run inside the database."""
    return spark.read.jdbc(url=url, table=f"({query}) AS q", properties=properties)


def partitioned_scan(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                     num_partitions: int, properties: dict) -> DataFrame:
    """Stride-partitioned scan (A1): ``num_partitions`` concurrent range queries."""
    return spark.read.jdbc(url=url, table=table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties)


def predicate_scan(spark: SparkSession, url: str, table: str, predicates: list[str],
                   properties: dict) -> DataFrame:
    """One partition per WHERE clause; every clause is one concurrent range query."""
    return spark.read.jdbc(url=url, table=table, predicates=predicates, properties=properties)


def source_stats(spark: SparkSession, url: str, table: str, column: str,
                 properties: dict) -> tuple[int, int | None, int | None]:
    """(rows, min key, max key) computed by the database in one query."""
    r = query_scan(spark, url, f"SELECT COUNT(*) AS n, MIN({column}) AS lo, MAX({column}) AS hi FROM {table}",
                   properties).first()
    return int(r["n"] or 0), r["lo"], r["hi"]


def quantile_cuts(spark: SparkSession, url: str, table: str, column: str, partitions: int,
                  properties: dict) -> list:
    """Key values at the 1/n .. (n-1)/n quantiles, computed by the database.

    One ordered-set aggregate over an array of fractions (PostgreSQL
    ``percentile_disc``), so the key is sorted once.
    """
    at = ", ".join(f"{i / partitions:.9f}" for i in range(1, partitions))
    query = f"SELECT percentile_disc(ARRAY[{at}]) WITHIN GROUP (ORDER BY {column}) AS q FROM {table}"
    return list(query_scan(spark, url, query, properties).first()["q"] or [])


def planned_scan(spark: SparkSession, url: str, table: str, column: str, properties: dict,
                 max_connections: int = model.JDBC_MAX_PARTITIONS,
                 split: str = "width") -> tuple[DataFrame, int]:
    """Count -> plan -> one range query per partition; returns the frame and its
    number of ranges.

    ``split="width"`` lets Spark cut the real key span into equal widths (right
    for dense keys, as the surveyed table has); ``split="quantile"`` cuts at key
    quantiles computed by the database, so sparse or clustered keys still give
    every connection about ``rows / n`` rows.
    """
    if split not in ("width", "quantile"):
        raise ValueError("split must be 'width' or 'quantile'")
    rows, lo, hi = source_stats(spark, url, table, column, properties)
    n = num_partitions_for(rows, max_connections) if rows and lo is not None else 1
    if n <= 1:
        return scan(spark, url, table, properties), 1
    if split == "quantile":
        clauses = quantile_predicates(column, int(lo), quantile_cuts(spark, url, table, column, n, properties))
        return predicate_scan(spark, url, table, clauses, properties), len(clauses)
    return partitioned_scan(spark, url, table, column, int(lo), int(hi) + 1, n, properties), n


def load_options(url: str, properties: dict, batch_size: int, column_types: str | None) -> dict[str, str]:
    """Write options of a load. PostgreSQL gets ``stringtype=unspecified``: its
    server then casts strings to the target's type, such as JSONB."""
    out = {**properties, "truncate": "true", "batchsize": str(batch_size)}
    if url.startswith("jdbc:postgresql:"):
        out.setdefault("stringtype", "unspecified")
    if column_types:
        out["createTableColumnTypes"] = column_types
    return out


def truncate_load(df: DataFrame, url: str, table: str, properties: dict, *, batch_size: int = 5000,
                  max_connections: int = model.JDBC_MAX_PARTITIONS,
                  column_types: str | None = model.JDBC_COLUMN_TYPES) -> None:
    """Replace the table's rows (B4): TRUNCATE when the table exists, else create it.

    The rows are dealt to ``max_connections`` writers by a shuffle of their own;
    the ``numPartitions`` write option would coalesce instead and pull
    everything upstream into as few tasks. Spark commits per writing task, so a
    failed load can leave part of the rows; load into a staging table and swap it
    in the database when that matters.
    """
    (df.repartition(max_connections).write.mode("overwrite")
     .options(**load_options(url, properties, batch_size, column_types)).jdbc(url=url, table=table))
