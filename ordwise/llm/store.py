"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import pathlib
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ordwise.session import new_output_path, remove_path, set_if_unset

# Batches that Spark hands to Python, by bytes and not only by rows: whole texts are long.
BATCH_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The written table cuts the lineage, so a lost executor costs no recompute
    of what made it. It goes when the driver ends.
    """
    spark = df.sparkSession
    path = new_output_path(spark, f"llm-{name}")
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        remove_path(spark, path)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python
    workers find it wherever they run."""
    set_if_unset(spark, BATCH_CONF)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = pathlib.Path(__file__).resolve().parents[2]
    target = pathlib.Path(tempfile.mkdtemp(prefix="ordwise-ship-"), "ordwise.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((root / "ordwise").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(target))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tidied(run):
    """``run`` over batches, with the task's memory given back to the system at its end: Spark keeps
    Python workers for the next task, and what they hold adds up over the steps of a job."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass
