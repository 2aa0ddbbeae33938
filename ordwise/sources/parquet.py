"""Parquet sink (B1-B3) and reader.

Layout: one directory per ``order_status`` value. Rows are placed with the
``rebalance`` hint on the partition column instead of the surveyed job's
``repartition(4)``:

* a fixed 4 tasks would write 100 TB through 4 writers;
* round-robin places every status in every task (tasks x statuses files);
* a plain hash repartition on status puts half the table (``delivered``)
  into one task.

``REBALANCE(order_status)`` hash-partitions by status and lets AQE split a
hot status into advisory-size pieces and merge small ones, so each directory
gets files of roughly ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

That costs one shuffle of the whole table, paid only to size files. Where the
input is very large, ``placement="local"`` skips it: each task writes its own
rows, one file per status it holds (Spark sorts by status inside the task, so
one writer is open at a time). Files then scale with the input split; with
``spark.sql.files.maxPartitionBytes`` at 512m-1g a task writes status files
of tens to hundreds of MB, and there is no exchange at all. An integer
placement reproduces the surveyed job's ``repartition(n)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise import model

OVERWRITE_MODES = ("static", "dynamic")


def write_partitioned(df: DataFrame, path: str, *, partition_by: str = model.PARTITION_COLUMN,
                      mode: str = "overwrite", overwrite_mode: str = "static",
                      compression: str = "snappy", placement: str | int = "rebalance") -> str:
    """Write ``df`` as Parquet partitioned by ``partition_by``; returns ``path``.

    ``overwrite_mode`` is set per write (never session-wide): ``static``
    replaces the whole target, ``dynamic`` replaces only the partitions
    present in ``df`` and keeps the rest.

    ``placement``: ``"rebalance"`` (one shuffle, AQE-sized files), ``"local"``
    (no exchange, files per task and status) or an int ``n`` (round-robin over
    ``n`` writers, as the surveyed job does with 4).
    """
    if overwrite_mode not in OVERWRITE_MODES:
        raise ValueError(f"overwrite_mode must be one of {OVERWRITE_MODES}")
    placed = _place(df, partition_by, placement)
    (placed
       .write.mode(mode)
       .option("partitionOverwriteMode", overwrite_mode)
       .option("compression", compression)
       .partitionBy(partition_by)
       .parquet(path))
    return path


def _place(df: DataFrame, partition_by: str, placement: str | int) -> DataFrame:
    if placement == "rebalance":
        return df.hint("rebalance", partition_by)
    if placement == "local":
        return df
    if isinstance(placement, int) and not isinstance(placement, bool) and placement > 0:
        return df.repartition(placement)
    raise ValueError(f"placement must be 'rebalance', 'local' or a positive int, not {placement!r}")


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Read a written dataset; the partition column comes back last, from the path. A published table
    (see :mod:`ordwise.sources.published`) is read through its manifest."""
    from ordwise.sources.published import PublishedTable

    table = PublishedTable(spark, path)
    return table.read() if table.manifest() else spark.read.parquet(path)
