"""Data-quality checks.

Checks are data: a :class:`Check` names a row-level violation predicate.
A list of checks compiles to

* one aggregate (``count_if`` per check) -> one pass over the data however
  many checks there are, each task reducing its rows to a single row of
  counters before anything moves; and
* the row-level ``violations`` frame, from the same predicates.

A check follows SQL CHECK semantics: a row violates only when its predicate
is true; a null predicate (unknown) passes.
"""

from __future__ import annotations

from decimal import Decimal

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordwise import model


@dataclass(frozen=True)
class Check:
    name: str
    violation: Column          # true -> the row breaks the rule
    threshold: int = 0         # violations allowed


class QualityGateError(RuntimeError):
    """Raised by :func:`qc_gate`; ``failures`` lists every failed check."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        msg = "; ".join(f"{f['check']}: observed {f['observed']} (threshold {f['threshold']})" for f in failures)
        super().__init__(f"quality gate failed: {msg}")


# -- check catalogues ----------------------------------------------------------

def _c(name: str) -> Column:
    return F.col(name)


def gate_checks() -> list[Check]:
    """The surveyed job's row-level gates."""
    return [
        Check("bad_order_total", _c("order_total").isNull() | (_c("order_total") < 0)),
        Check("null_order_status", _c("order_status").isNull()),
    ]


def constraint_checks() -> list[Check]:
    """Declared constraints of the source table that JDBC does not carry."""
    checks = [Check(f"not_null_{c}", _c(c).isNull()) for c in model.NOT_NULL_COLUMNS]
    checks += [
        Check("status_domain", ~_c("order_status").isin(*model.ORDER_STATUSES)),
        Check("order_total_nonnegative", _c("order_total") < 0),
        Check("item_count_positive", _c("item_count") <= 0),
        Check("rating_range", ~_c("rating").between(F.lit(model.RATING_MIN).cast(model.RATING_TYPE),
                                                    F.lit(model.RATING_MAX).cast(model.RATING_TYPE))),
    ]
    checks += [Check(f"length_{c}", F.char_length(_c(c)) > n) for c, n in model.VARCHAR_LENGTHS.items()]
    checks += [
        Check("order_total_fits_decimal",
              _c("order_total").isNotNull() & _c("order_total").try_cast(model.TOTAL_TYPE).isNull()),
        Check("rating_fits_decimal",
              _c("rating").isNotNull() & _c("rating").try_cast(model.RATING_TYPE).isNull()),
    ]
    return checks


def consistency_checks() -> list[Check]:
    """Cross-column invariants of the order life cycle."""
    status = _c("order_status")
    ships = status.isin(*model.DELIVERY_STATUSES)
    lead = F.datediff(_c("delivery_date"), F.to_date(_c("created_at")))
    return [
        Check("delivery_without_shipment", _c("delivery_date").isNotNull() & ~ships),
        Check("shipment_without_delivery", _c("delivery_date").isNull() & ships),
        Check("delivery_lead_days", ~lead.between(model.DELIVERY_DAYS_MIN, model.DELIVERY_DAYS_MAX)),
        Check("rating_not_delivered", _c("rating").isNotNull() & (status != model.RATED_STATUS)),
        Check("address_missing", _c("shipping_address").isNull() & (status != model.NO_ADDRESS_STATUS)),
        Check("address_on_cancelled", _c("shipping_address").isNotNull() & (status == model.NO_ADDRESS_STATUS)),
    ]


# -- compile: one aggregate pass -----------------------------------------------

REPORT_COLUMNS = ("check", "observed", "threshold", "passed")


def check_report(df: DataFrame, checks: list[Check], min_rows: int | None = None) -> DataFrame:
    """(check, observed, threshold, passed) per check, from ONE aggregate.

    ``min_rows`` adds the row-count gate, which passes when observed >= threshold;
    every other check passes when observed <= threshold.
    """
    aggs, rows = [], []
    if min_rows is not None:
        aggs.append(F.count(F.lit(1)).alias("_c0"))
        rows.append(("row_count", "_c0", min_rows, F.col("_c0") >= min_rows))
    for i, ch in enumerate(checks, start=1):
        aggs.append(F.count_if(ch.violation).alias(f"_c{i}"))
        rows.append((ch.name, f"_c{i}", ch.threshold, F.col(f"_c{i}") <= ch.threshold))
    args = []
    for name, col, thr, ok in rows:
        args += [F.lit(name), F.col(col), F.lit(thr).cast("bigint"), ok]
    return df.agg(*aggs).select(F.stack(F.lit(len(rows)), *args).alias(*REPORT_COLUMNS))


def qc_report(df: DataFrame, min_rows: int = model.MIN_ROWS) -> DataFrame:
    """The surveyed job's three gates (J1-J3) in one pass."""
    return check_report(df, gate_checks(), min_rows=min_rows)


def constraint_report(df: DataFrame) -> DataFrame:
    return check_report(df, constraint_checks())


def consistency_report(df: DataFrame) -> DataFrame:
    return check_report(df, consistency_checks())


def merged_report(df: DataFrame, reports: dict[str, tuple[list[Check], int | None]]) -> DataFrame:
    """Several check reports from ONE aggregate over one scan: (report, check, observed, threshold,
    passed). ``reports`` names each one's checks and, if it has that gate, its least number of rows."""
    aggs, args = [F.count(F.lit(1)).alias("_rows")], []
    for name, (checks, min_rows) in reports.items():
        if min_rows is not None:
            args.append((name, "row_count", "_rows", min_rows, F.col("_rows") >= min_rows))
        for ch in checks:
            col = f"_c{len(aggs)}"
            aggs.append(F.count_if(ch.violation).alias(col))
            args.append((name, ch.name, col, ch.threshold, F.col(col) <= ch.threshold))
    flat = [x for report, check, col, limit, ok in args
            for x in (F.lit(report), F.lit(check), F.col(col), F.lit(limit).cast("bigint"), ok)]
    return df.agg(*aggs).select(F.stack(F.lit(len(args)), *flat).alias("report", *REPORT_COLUMNS))


def quality_suite(df: DataFrame, min_rows: int = model.MIN_ROWS) -> DataFrame:
    """Gates, constraints and cross-column rules (J1-J3, J6-J10) in one pass."""
    return merged_report(df, {"gates": (gate_checks(), min_rows), "constraints": (constraint_checks(), None),
                              "consistency": (consistency_checks(), None)})


def qc_gate(df: DataFrame, min_rows: int = model.MIN_ROWS, checks: list[Check] | None = None) -> DataFrame:
    """Evaluate the gates (one small action) and raise listing ALL failures.

    Returns ``df`` unchanged when every check passes, so a caller writes only
    gated data. The collected result is one row per check.
    """
    report = check_report(df, gate_checks() if checks is None else checks, min_rows=min_rows)
    failures = [r.asDict() for r in report.collect() if not r["passed"]]
    if failures:
        raise QualityGateError(failures)
    return df


# -- J5: primary key -------------------------------------------------------------

def pk_duplicates(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Key values that occur more than once, plus the null key if present.

    Grouping on the key is the one shuffle a uniqueness check needs; partial
    aggregation collapses a hot key (e.g. many nulls) inside each task first.
    """
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | F.col(key).isNull()))


def key_uniqueness(df: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: rows, null_keys, distinct_keys, repeated_rows and is_key, without moving keys.

    Every task sets one bit for each key in a bitmap per 32,768 consecutive values; the bitmaps (4 KB each)
    are joined by OR, and a key is unique if as many bits are set as there are keys. So what crosses the
    exchange is bounded by the key range / 8 bytes a task, however often a key repeats: for ids dealt out in
    sequence a fraction of a byte a row. For sparse keys use :func:`pk_duplicates`, which also lists them.
    """
    k = F.col(key).cast("bigint")
    buckets = df.groupBy(F.bitmap_bucket_number(k).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.count(k).alias("keys"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(k))).alias("bits"))
    total = buckets.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "keys", "bits")])
    return total.select(
        F.col("n").alias("rows"), (F.col("n") - F.col("keys")).alias("null_keys"), F.col("bits").alias("distinct_keys"),
        (F.col("keys") - F.col("bits")).alias("repeated_rows"), (F.col("bits") == F.col("n")).alias("is_key"))


# -- J11: status drift -----------------------------------------------------------

def status_drift(df: DataFrame, tolerance_pp: float = 2.0,
                 weights: list[tuple[str, float]] | None = None) -> DataFrame:
    """Observed status share against expected weights, within a tolerance; an
    expected status without rows counts 0.

    The comparison is exact integer arithmetic in basis points:
    |cnt * 10000 - weight_bp * total| <= tol_bp * total.
    """
    return drift_of(df.groupBy("order_status").agg(F.count(F.lit(1)).alias("cnt")), tolerance_pp, weights)


def drift_of(counts: DataFrame, tolerance_pp: float = 2.0, weights: list[tuple[str, float]] | None = None) -> DataFrame:
    """The same from counted groups (order_status, cnt)."""
    weights = weights or model.ORDER_STATUS_WEIGHTS
    expected_bp = F.create_map(*[x for s, w in weights for x in (F.lit(s), F.lit(round(w * 10000)))])
    tol_bp = round(tolerance_pp * 100)
    absent = counts.sparkSession.createDataFrame([(s, 0) for s, _ in weights], "order_status string, cnt bigint")
    grouped = counts.unionByName(absent).groupBy("order_status").agg(F.sum("cnt").alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy())
    bp = F.coalesce(F.try_element_at(expected_bp, F.col("order_status")), F.lit(0)).cast("bigint")
    return grouped.select(
        "order_status", "cnt",
        F.round(F.col("cnt") * F.lit(Decimal("100.0")) / total, 1).alias("observed_pct"),
        (bp / F.lit(100.0)).cast("double").alias("expected_pct"),
        (F.abs(F.col("cnt") * 10000 - bp * total) <= F.lit(tol_bp) * total).alias("within_tolerance"),
    )


# -- J12: violating rows -----------------------------------------------------------

def violations(df: DataFrame, checks: list[Check] | None = None) -> DataFrame:
    """One row per (row, broken rule): the whole row and ``check``. Narrow: no
    shuffle. The gates repeat constraints under other names, so they are left out."""
    checks = checks if checks is not None else constraint_checks() + consistency_checks()
    return df.select("*", F.explode(broken_rules(checks)).alias("check"))


def broken_rules(checks: list[Check] | None = None) -> Column:
    """The names of the rules a row breaks, in the rules' order."""
    checks = checks if checks is not None else constraint_checks() + consistency_checks()
    return F.array_compact(F.array(*[F.when(ch.violation, F.lit(ch.name)) for ch in checks]))
