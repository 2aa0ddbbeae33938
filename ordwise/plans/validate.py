"""The validation suite (M3): the post-load checks as one set of reports, and its CLI.

:func:`profiled` takes everything that reads rows from one scan: grouping sets give the global row (row
count, null profile, numeric ranges, date ranges) and the two distributions, and one more set, on the keys whose
hash is among the smallest, gives the repeatable sample, so each task keeps a bounded number of sample rows. What is
left, one row a group, is written to the shared folder and the reports read that. The column catalogue reads no data.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.functions.derive import device
from ordwise.functions.hashing import MODULUS, draw
from ordwise.operators import reports
from ordwise.session import new_output_path

# Draws lie in [0, DRAWS): the hash drops ten low bits.
DRAWS = (MODULUS >> 10) + 1

# The sets of ``profiled`` by grouping id, a bit for each of (status, device, sample) that is not grouped by.
ALL, STATUS, DEVICE, SAMPLE = 0b111, 0b011, 0b101, 0b110
SAMPLE_KEYS = 200


def _sampled_below(rows: int, k: int) -> int:
    """Hash bound under which about SAMPLE_KEYS (at least 40 a wanted row) distinct keys are expected."""
    want = max(SAMPLE_KEYS, 40 * k)
    return DRAWS if rows <= want else -(-DRAWS * want // rows)


def grouped_profile(orders: DataFrame, rows: int, sample_size: int = 5, seed: int = 42) -> DataFrame:
    """One row a group of each set: ``gid``, the groups, ``n``, ``n_meta``, the global measures and ``row``, the least
    row of a sampled key. The set of sampled keys beside ``row`` keeps the aggregate a hash aggregate."""
    h = draw("CAST(`order_id` AS BIGINT)", seed, MODULUS)
    sampled = F.when(F.coalesce(h, F.lit(MODULUS)) < _sampled_below(rows, sample_size), F.col("order_id"))
    base = orders.select("*", F.col("order_status").alias("_status"), device().alias("_device"), sampled.alias("_sample"))
    base = base.withColumn("_key", F.col("_sample"))
    measures = [c.alias(f"{name}__{m}") for name, make in reports.GLOBAL_MEASURES.items() for m, c in make().items()]
    return base.groupingSets([[], ["_status"], ["_device"], ["_sample"]], "_status", "_device", "_sample").agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.count("metadata").alias("n_meta"), *measures,
        F.min(F.when(F.col("_key").isNotNull(), F.struct(*orders.columns))).alias("row"),
        F.collect_set("_key").alias("keys"))


def profiled(orders: DataFrame, sample_size: int = 5, seed: int = 42, rows: int | None = None) -> DataFrame:
    """:func:`grouped_profile`, written and read back. ``rows`` saves the count, which reads file footers."""
    path = new_output_path(orders.sparkSession, "validate")
    grouped_profile(orders, orders.count() if rows is None else rows, sample_size, seed).write.parquet(path)
    return orders.sparkSession.read.parquet(path)


def validation_suite(orders: DataFrame, sample_size: int = 5, seed: int = 42) -> dict[str, DataFrame]:
    """The eight validation reports over a frame in the 12-column model, from one scan. Rows that share a
    key count once in the sample (the least of them); without enough keys the sample is taken by itself."""
    total = orders.count()
    if not total:  # grouping sets of nothing have no global row
        names = [*reports.GLOBAL_MEASURES, "schema_profile", "status_distribution", "device_distribution", "sample_rows"]
        return {name: getattr(reports, name)(orders) for name in names}
    groups = profiled(orders, sample_size, seed, total)
    every = groups.where(f"gid = {ALL}")
    out = {name: every.select(*[F.col(f"{name}__{m}").alias(m) for m in make()])
           for name, make in reports.GLOBAL_MEASURES.items()}
    out["schema_profile"] = reports.schema_profile(orders)
    out["status_distribution"] = reports.share_of_total(
        groups.where(f"gid = {STATUS}").groupBy(F.col("_status").alias("order_status")).agg(F.sum("n").alias("cnt")))
    out["device_distribution"] = (groups.where(f"gid = {DEVICE} and n_meta > 0").select(
        F.col("_device").alias("device"), F.col("n_meta").alias("cnt")).orderBy(F.desc("cnt"), F.asc_nulls_last("device")))
    kept = groups.where(f"gid = {SAMPLE} and _sample is not null")
    if kept.count() >= min(sample_size, total):
        out["sample_rows"] = reports.sample_rows(kept.select("row.*"), k=sample_size, seed=seed)
    else:
        out["sample_rows"] = reports.sample_rows(orders, k=sample_size, seed=seed)
    return out


def long_form(suite: dict[str, DataFrame]) -> DataFrame:
    """The reports that read rows as (report, item, value), values as text."""
    parts = []
    for name, make in reports.GLOBAL_MEASURES.items():
        items = [x for m in make() for x in (F.lit(m), F.col(m).cast("string"))]
        parts.append(suite[name].select(F.lit(name).alias("report"), F.stack(F.lit(len(items) // 2), *items).alias("item", "value")))
    value = F.concat_ws(" ", F.col("cnt").cast("string"), F.col("pct").cast("string"))
    parts.append(suite["status_distribution"].select(F.lit("status_distribution").alias("report"), F.col("order_status").alias("item"), value.alias("value")))
    parts.append(suite["device_distribution"].select(F.lit("device_distribution").alias("report"), F.col("device").alias("item"), F.col("cnt").cast("string").alias("value")))
    parts.append(suite["sample_rows"].select(F.lit("sample_rows").alias("report"), F.col("order_id").cast("string").alias("item"), F.col("order_status").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_validation(orders: DataFrame, show: bool = True) -> dict[str, list[dict]]:
    """Evaluate the suite and optionally print it, every report whole. The device
    report has a row for each device that the JSON holds."""
    out = {name: [r.asDict() for r in df.collect()] for name, df in validation_suite(orders).items()}
    if show:
        for name, rows in out.items():
            print(f"-- {name}")
            for r in rows:
                print("  ", r)
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Validation reports over an orders table")
    p.add_argument("--parquet", required=True, help="Parquet path in the 12-column model")
    args = p.parse_args(argv)
    from ordwise.session import build_session
    spark = build_session(app_name="ordwise-validate")
    run_validation(spark.read.parquet(args.parquet))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
