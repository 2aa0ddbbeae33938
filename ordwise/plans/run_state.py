"""Partial aggregates per run, so that a report after an append reads only new files.

For every live folder of a published table the state holds one row per status, category and tier: rows, and exact
sums of totals and ratings. Partial sums merge by addition, so the reports over the whole table are
sums over the state rows of the folders that the newest manifest names. :func:`refresh` computes the state of
folders that have none yet, in one pass over their files alone; folders replaced by a later publish drop out because the
manifest no longer names them, and folders whose files changed by a compaction count as new.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordwise import model
from ordwise.functions.derive import revenue_tier
from ordwise.operators import quality
from ordwise.operators.reports import money, share_of_total
from ordwise.sources.published import STATE, Entry, Manifest, PublishedTable, row_folder

STATE_SCHEMA = ("entry string, order_status string, product_category string, revenue_tier string, n bigint, "
                "total decimal(38,2), rated bigint, rating decimal(38,1)")
KEYS = ["order_status", "product_category", "revenue_tier"]


def entry_id(e: Entry) -> str:
    """A folder with a given set of files."""
    return hashlib.sha256("\n".join([e.folder, *(e.files or ())]).encode()).hexdigest()[:32]


def _whole(table: PublishedTable) -> list[str]:
    """State folders whose write ended."""
    return [f"{STATE}/{n}" for n in table.storage.children(STATE) if table.storage.exists(f"{STATE}/{n}/_SUCCESS")]


def _state(table: PublishedTable, live: list[str]) -> DataFrame:
    folders = _whole(table)
    if not folders:
        return table.spark.createDataFrame([], STATE_SCHEMA)
    rows = table.spark.read.schema(STATE_SCHEMA).parquet(*[f"{table.path}/{f}" for f in folders])
    # Two refreshes at once may both add a folder's state; its rows are then equal.
    return rows.where(F.col("entry").isin(live)).dropDuplicates(["entry", *KEYS])


def refresh(table: PublishedTable, manifest: Manifest | None = None) -> int:
    """Add the state of live folders that have none; returns how many there were."""
    m = manifest or table.manifest()
    by_id = {entry_id(e): e for e in m.entries}
    known = {r["entry"] for r in _state(table, list(by_id)).select("entry").distinct().collect()}
    new = {k: e for k, e in by_id.items() if k not in known and e.rows}
    if not new:
        return 0
    rows = table.read(Manifest(m.number, m.partition_by, m.schema, tuple(new.values())))
    folder = row_folder()
    # One literal a new folder: as many as the statuses of the runs since the last refresh.
    names = F.create_map(*[F.lit(x) for k, e in new.items() for x in (e.folder, k)])
    (rows.select(names[folder].alias("entry"), "order_status", "product_category", revenue_tier().alias("revenue_tier"),
                 money().alias("total"), F.col("rating").cast(model.RATING_TYPE).alias("rating"))
     .groupBy("entry", *KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("total").cast("decimal(38,2)").alias("total"),
                                  F.count("rating").alias("rated"), F.sum("rating").cast("decimal(38,1)").alias("rating"))
     .write.mode("error").parquet(f"{table.path}/{STATE}/{uuid.uuid4().hex[:16]}"))
    return len(new)


def merged(table: PublishedTable, *keys: str) -> DataFrame:
    """The state of the live folders, added up by ``keys``: n, total, rated, rating."""
    m = table.manifest()
    refresh(table, m)
    rows = _state(table, [entry_id(e) for e in m.entries])
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                                   F.sum("rated").alias("rated"), F.sum("rating").alias("rating"))


def _mean(total: Column, n: Column, scale: int, digits: int = 2) -> Column:
    """Spark's ``round(avg(decimal), digits)`` from an exact sum: the average is rounded to four more places first."""
    return F.round((total.cast(f"decimal(28,{scale})") / n.cast("decimal(20,0)")).cast(f"decimal(38,{scale + 4})"), digits)


def status_distribution(table: PublishedTable) -> DataFrame:
    return share_of_total(merged(table, "order_status").select("order_status", F.col("n").alias("cnt")))


def status_drift(table: PublishedTable, tolerance_pp: float = 2.0) -> DataFrame:
    return quality.drift_of(merged(table, "order_status").select("order_status", F.col("n").alias("cnt")), tolerance_pp)


def tier_breakdown(table: PublishedTable) -> DataFrame:
    rows = merged(table, "revenue_tier")
    return rows.select("revenue_tier", F.col("n").alias("order_count"),
                       _mean(F.col("total"), F.col("n"), 2).cast("double").alias("avg_total"),
                       F.col("total").cast("double").alias("total_revenue")).orderBy(F.desc("total_revenue"), "revenue_tier")


def category_performance(table: PublishedTable, k: int = 10) -> DataFrame:
    """Unrated orders count as 0 in the mean rating, as in the job's own report."""
    rows = merged(table, "product_category")
    return rows.select("product_category", F.col("n").alias("orders"),
                       _mean(F.col("total"), F.col("n"), 2).cast("double").alias("avg_order_value"),
                       _mean(F.coalesce("rating", F.lit(0)), F.col("n"), 1).cast("decimal(5,2)").alias("avg_rating"),
                       ).orderBy(F.desc("orders"), "product_category").limit(k)
