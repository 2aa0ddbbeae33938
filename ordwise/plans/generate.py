"""Generate, load and validate: the seeding job as one command.

Synthetic orders are made on the executors, written to Parquet or loaded into the
declared database table, and, for Parquet, validated from what was written.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from ordwise.plans.validate import run_validation
from ordwise.sources import jdbc, synth


def generated(spark: SparkSession, rows: int, seed: int) -> DataFrame:
    """``rows`` synthetic orders with ids from 1."""
    return synth.synth_orders(spark, rows, seed)


def generate_to_parquet(spark: SparkSession, rows: int, seed: int, path: str, show: bool = True) -> dict[str, list[dict]]:
    """Write the orders and return the validation reports over the written files."""
    generated(spark, rows, seed).write.mode("overwrite").parquet(path)
    return run_validation(spark.read.parquet(path), show=show)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Generate synthetic orders, load and validate them")
    p.add_argument("--rows", type=int, default=1000)
    p.add_argument("--seed", type=int, default=42)
    to = p.add_mutually_exclusive_group(required=True)
    to.add_argument("--parquet", help="target path")
    to.add_argument("--jdbc-url", help="target database")
    p.add_argument("--table", default="ecommerce.orders")
    p.add_argument("--properties-file", help="JSON file with JDBC connection properties")
    args = p.parse_args(argv)
    from ordwise.session import build_session
    spark = build_session(app_name="ordwise-generate")
    if args.parquet:
        generate_to_parquet(spark, args.rows, args.seed, args.parquet)
        return 0
    with open(args.properties_file) as fh:
        props = json.load(fh)
    jdbc.truncate_load(generated(spark, args.rows, args.seed), args.jdbc_url, args.table, props)
    run_validation(jdbc.scan(spark, args.jdbc_url, args.table, props))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
