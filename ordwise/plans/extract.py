"""The extract job, DataFrame flavour (M1) and SQL flavour (M2), and its CLI.

Shape of one run::

    source (JDBC or Parquet) --> derive --> stage in final layout --> gate --> publish (renames, one manifest)
                                                                        +--> reports

* The source is read once and the rows are written once: they are staged in the target's layout (see
  :mod:`ordwise.sources.published`) and published by renames, so a run that stops at any step leaves the
  rows of the last run readable.
* **gate**: the DataFrame flavour observes its three checks while it writes; the SQL flavour runs its two as SQL over
  the staged rows, which reads one column of them. All failures are raised together; the target is then untouched.
* **reports** and the row count are about this run: they read its folders, not
  the whole target, which may hold partitions of earlier runs.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordwise import model
from ordwise.functions.derive import transform_df
from ordwise.operators import quality, reports
from ordwise.plans import sql_job
from ordwise.sources import jdbc
from ordwise.sources.published import Manifest, PublishedTable, Staged


@dataclass
class ExtractResult:
    output_path: str
    run: str
    manifest: Manifest
    rows: int
    checks: list[dict]
    reports: dict[str, DataFrame] = field(default_factory=dict)

    def output(self, spark: SparkSession) -> DataFrame:
        """The whole target, as it is now."""
        return PublishedTable(spark, self.output_path).read()

    def written(self, spark: SparkSession) -> DataFrame:
        """The rows of this run, as it published them."""
        return PublishedTable(spark, self.output_path).read(self.manifest, {self.run})

    def close(self, spark: SparkSession) -> None:
        """Drop folders that neither this nor the previous publish names."""
        PublishedTable(spark, self.output_path).vacuum(keep=2)


def _observed_checks(staged: Staged, min_rows: int) -> list[dict]:
    got = staged.observed
    rows = [{"check": "row_count", "observed": got["rows"], "threshold": min_rows, "passed": got["rows"] >= min_rows}]
    return rows + [{"check": c.name, "observed": got[c.name], "threshold": c.threshold, "passed": got[c.name] <= c.threshold}
                   for c in quality.gate_checks()]


def _publish(table: PublishedTable, staged: Staged, checks: list[dict], mode: str) -> Manifest:
    """Publish a staged run, or raise all failures of its checks and drop it."""
    failures = [c for c in checks if not c["passed"]]
    if failures:
        table.discard(staged.run)
        raise quality.QualityGateError(failures)
    return table.publish(staged, mode)


def _result(spark: SparkSession, path: str, staged: Staged, manifest: Manifest, checks: list[dict],
            make_reports: Callable[[DataFrame], dict[str, DataFrame]]) -> ExtractResult:
    res = ExtractResult(path, staged.run, manifest, checks[0]["observed"], checks)
    res.reports = make_reports(res.written(spark))
    return res


def run_extract_df(spark: SparkSession, source: DataFrame, output_path: str, *,
                   min_rows: int = model.MIN_ROWS, overwrite_mode: str = "dynamic",
                   placement: str | int = "rebalance") -> ExtractResult:
    """M1: derive (decimal flavour) -> stage -> gate -> publish -> reports."""
    table = PublishedTable(spark, output_path)
    staged = table.stage(transform_df(source), placement,
                         {c.name: F.count_if(c.violation) for c in quality.gate_checks()})
    checks = _observed_checks(staged, min_rows)
    manifest = _publish(table, staged, checks, overwrite_mode)
    return _result(spark, output_path, staged, manifest, checks, lambda out: {
        "status_counts": reports.status_counts(out),
        "tier_counts": reports.tier_counts(out),
        "summary_stats": reports.summary_stats(out),
    })


def run_extract_sql(spark: SparkSession, source: DataFrame, output_path: str, *,
                    min_rows: int = model.MIN_ROWS, overwrite_mode: str = "static",
                    placement: str | int = "rebalance") -> ExtractResult:
    """M2: the same job in the double flavour, as SQL text over views of this run's own
    that are dropped at the end. It has two gates: rows and totals."""
    raw, made, out = (f"orders_{name}_{uuid.uuid4().hex[:12]}" for name in ("raw", "staged", "written"))
    table = PublishedTable(spark, output_path)
    try:
        source.createOrReplaceTempView(raw)
        staged = table.stage(sql_job.projection(spark, raw), placement)
        table.staged_rows(staged).createOrReplaceTempView(made)
        checks = [r.asDict() for r in sql_job.gates(spark, made, min_rows).collect()]
        manifest = _publish(table, staged, checks, overwrite_mode)

        def make_reports(rows: DataFrame) -> dict[str, DataFrame]:
            rows.createOrReplaceTempView(out)
            return sql_job.reports(spark, out)

        return _result(spark, output_path, staged, manifest, checks, make_reports)
    finally:
        for view in (raw, made, out):
            spark.catalog.dropTempView(view)


# -- CLI -------------------------------------------------------------------------

def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Extract, gate, write and report on the orders table")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet", help="source Parquet path in the 12-column model")
    src.add_argument("--jdbc-url", help="source JDBC URL")
    p.add_argument("--table", default="ecommerce.orders")
    p.add_argument("--key", default="order_id", help="integer key that splits the JDBC read")
    p.add_argument("--properties-file", help="JSON file with JDBC connection properties")
    p.add_argument("--max-connections", type=int, default=model.JDBC_MAX_PARTITIONS)
    p.add_argument("--split", choices=("width", "quantile"), default="width",
                   help="JDBC key ranges: equal widths, or database-computed key quantiles")
    p.add_argument("--output-path", required=True)
    p.add_argument("--flavour", choices=("df", "sql"), default="df")
    p.add_argument("--min-rows", type=int, default=model.MIN_ROWS)
    p.add_argument("--overwrite-mode", choices=("static", "dynamic"), default=None)
    p.add_argument("--placement", default="rebalance",
                   help="rebalance (one shuffle, sized files), local (no shuffle) or a writer count")
    args = p.parse_args(argv)
    placement = int(args.placement) if args.placement.isdigit() else args.placement

    from ordwise.session import build_session
    spark = build_session(app_name=f"ordwise-extract-{args.flavour}")
    if args.parquet:
        source = spark.read.parquet(args.parquet)
    else:
        with open(args.properties_file) as fh:
            props = json.load(fh)
        source, n = jdbc.planned_scan(spark, args.jdbc_url, args.table, args.key, props, args.max_connections,
                                      split=args.split)
        print(f"JDBC read: {n} key ranges")
    missing = [c for c in model.ORDER_COLUMN_NAMES if c not in source.columns]
    if missing:
        print(f"source lacks columns: {', '.join(missing)}", file=sys.stderr)
        return 2
    run = run_extract_df if args.flavour == "df" else run_extract_sql
    mode = args.overwrite_mode or ("dynamic" if args.flavour == "df" else "static")
    try:
        result = run(spark, source, args.output_path, min_rows=args.min_rows, overwrite_mode=mode,
                     placement=placement)
    except quality.QualityGateError as e:
        print(f"QC FAIL: {e}", file=sys.stderr)
        return 1
    out = result.written(spark)
    out.printSchema()
    print(f"rows written: {result.rows}")
    reports.head_rows(out, k=5).show(truncate=False)
    for name, df in result.reports.items():
        print(name)
        df.show(truncate=False)
    result.close(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
