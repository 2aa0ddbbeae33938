"""Session helpers: builder for jobs and tests, and the shared output folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Applied everywhere, and only where the application did not set them: let AQE
# size post-shuffle partitions (and so written files) by bytes rather
# than by the cluster's parallelism, which on 1000 executors would cut a
# rebalanced write into many small files.
SQL_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def build_session(master: str | None = None, app_name: str = "ordwise",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE and a UTC session zone.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    cluster's own ``spark.checkpoint.dir`` is kept.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Fall back from whole-stage codegen when a fused method grows past the
        # HotSpot JIT limit (8000 bytes): wide generated projections otherwise
        # run as interpreted bytecode, several times slower.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    set_if_unset(spark, SQL_DEFAULTS)
    return spark


def set_if_unset(spark: SparkSession, conf: dict[str, str]) -> dict[str, str]:
    """Set SQL options the application's configuration does not already name;
    returns what was set."""
    given = spark.sparkContext.getConf()
    applied = {k: v for k, v in conf.items() if not given.contains(k)}
    for k, v in applied.items():
        spark.conf.set(k, v)
    return applied


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors, taken from ``spark.checkpoint.dir``.

    The cluster names it. Only a local-mode session without the setting (tests,
    local runs) gets a fresh folder of its own, registered as the context's
    checkpoint folder so every later caller sees the same one.
    """
    sc = spark.sparkContext
    d = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ordwise-"))
    return sc.getCheckpointDir().rstrip("/")


def new_output_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/out/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder tree on the path's own file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))
