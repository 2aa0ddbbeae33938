"""Routing of rows by the rules they break (J12 with J4): one write, good rows and quarantined ones.

Every row is written once, to the ``good`` or the ``quarantine`` folder of a published table
(:mod:`ordwise.sources.published`), with the names of the rules it breaks. Counts of both routes and of every
rule are observed on the way and must agree with the rows in the files before anything is published; the gate on the
share of bad rows is judged on the same counts, so a refused batch leaves the table as it was.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordwise.operators import quality
from ordwise.sources.published import CountMismatch, Manifest, PublishedTable

ROUTE, FAILED = "route", "failed_checks"
GOOD, BAD = "good", "quarantine"


@dataclass
class Routed:
    manifest: Manifest
    rows: int
    good: int
    bad: int
    by_rule: dict[str, int]


def routed(df: DataFrame, checks: list[quality.Check] | None = None) -> DataFrame:
    """``df`` with failed_checks (the rules a row breaks, in their order) and its route."""
    return df.withColumn(FAILED, quality.broken_rules(checks)).withColumn(
        ROUTE, F.when(F.size(FAILED) == 0, GOOD).otherwise(BAD))


def quarantine(spark: SparkSession, df: DataFrame, path: str, checks: list[quality.Check] | None = None, *,
               max_bad_share: float = 1.0, mode: str = "append", placement: str | int = "local") -> Routed:
    """Route the rows of ``df`` into the table at ``path``; raise if more than ``max_bad_share`` of them are bad."""
    checks = checks if checks is not None else quality.constraint_checks() + quality.consistency_checks()
    table = PublishedTable(spark, path, partition_by=ROUTE)
    staged = table.stage(routed(df, checks), placement, {
        "good": F.count_if(F.size(FAILED) == 0),
        **{f"rule_{c.name}": F.count_if(F.array_contains(FAILED, c.name)) for c in checks}})
    got = staged.observed
    bad = got["rows"] - got["good"]
    held = (staged.rows.get(f"{ROUTE}={GOOD}", 0), staged.rows.get(f"{ROUTE}={BAD}", 0))
    if held != (got["good"], bad):
        table.discard(staged.run)
        raise CountMismatch(f"{got['good']} good and {bad} bad rows were written, the files hold {held}")
    by_rule = {c.name: got[f"rule_{c.name}"] for c in checks}
    if bad > max_bad_share * got["rows"]:
        table.discard(staged.run)
        raise quality.QualityGateError([{"check": n, "observed": k, "threshold": 0, "passed": False} for n, k in by_rule.items() if k])
    return Routed(table.publish(staged, mode), got["rows"], got["good"], bad, by_rule)


def good_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that break no rule, as they came in; other folders are not listed."""
    return PublishedTable(spark, path, partition_by=ROUTE).read().where(F.col(ROUTE) == GOOD).drop(ROUTE, FAILED)


def quarantined_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that break rules, with their names."""
    return PublishedTable(spark, path, partition_by=ROUTE).read().where(F.col(ROUTE) == BAD).drop(ROUTE)
