"""Registered queries: one ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the driver's ``orders`` table through the fixture adapter
(:mod:`ordwise.sources.fixture`), so its work grows with the table. Check
operators run on the corrupted variant, which keeps every row and changes
values in place, so they report non-zero counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordwise.functions import derive
from ordwise.operators import quality, reports
from ordwise.plans import quarantine, run_state, sql_job, validate
from ordwise.plans.extract import run_extract_df, run_extract_sql
from ordwise.session import new_output_path
from ordwise.sources import declared, fixture, parquet, partitions, synth
from ordwise.sources.published import PublishedTable

DEFAULTS_AS_OF = "2024-01-01 00:00:00"
SAMPLE_SEED = 42
SYNTH_SEED = 7


def _orders(spark: SparkSession, sf_dir: str, corrupted: bool = False) -> DataFrame:
    return fixture.load_orders(spark, sf_dir, corrupted=corrupted)


def _df_flavour(spark, sf_dir, corrupted=False):
    return derive.transform_df(_orders(spark, sf_dir, corrupted))


def _sql_flavour(spark, sf_dir):
    return derive.transform_sql(_orders(spark, sf_dir))


# -- sources -------------------------------------------------------------------

def q_jdbc_plan_partitions(spark, sf_dir):
    """Bounds and number of ranges of a JDBC read of this table split on order_id."""
    return partitions.read_plan(_orders(spark, sf_dir), "order_id")


def q_schema_profile(spark, sf_dir):
    return reports.schema_profile(_orders(spark, sf_dir))


def q_column_profile(spark, sf_dir):
    return reports.column_profile(_orders(spark, sf_dir, corrupted=True))


def q_synth_orders(spark, sf_dir):
    """One synthetic order per key of the orders table (ids 1..n)."""
    keys = fixture.read_orders(spark, sf_dir).select((F.col("o_orderkey") + 1).alias("order_id"))
    return synth.synth_from_keys(keys, seed=SYNTH_SEED)


# -- sinks -----------------------------------------------------------------------

def q_parquet_roundtrip(spark, sf_dir):
    path = new_output_path(spark, "parquet_roundtrip")
    parquet.write_partitioned(_df_flavour(spark, sf_dir), path)
    return parquet.read_dataset(spark, path)


def q_parquet_dynamic_overwrite(spark, sf_dir):
    """Write all statuses, then two of them with their item counts raised by 100.

    Dynamic mode replaces those two directories and keeps the other four
    (static mode would leave only the two; a lost write would leave old counts).
    """
    path = new_output_path(spark, "parquet_dynamic_overwrite")
    full = _df_flavour(spark, sf_dir)
    parquet.write_partitioned(full, path)
    changed = full.filter(F.col("order_status").isin("pending", "refunded")).withColumn(
        "item_count", F.col("item_count") + 100)
    parquet.write_partitioned(changed, path, overwrite_mode="dynamic")
    return parquet.read_dataset(spark, path)


def _changed(full: DataFrame) -> DataFrame:
    return full.filter(F.col("order_status").isin("pending", "refunded")).withColumn("item_count", F.col("item_count") + 100)


def q_atomic_publish(spark, sf_dir):
    """The same two writes through the publish protocol: staged once, verified, moved, sealed."""
    table = PublishedTable(spark, new_output_path(spark, "atomic_publish"))
    full = _df_flavour(spark, sf_dir)
    table.write(full, "static")
    table.write(_changed(full), "dynamic")
    table.vacuum()
    return table.read()


def q_compacted_publish(spark, sf_dir):
    """Many small files (writers without a shuffle, several appends), then packed to a target size."""
    table = PublishedTable(spark, new_output_path(spark, "compacted_publish"))
    full = _df_flavour(spark, sf_dir)
    for k in range(3):
        table.write(full.where(F.col("order_id") % 3 == k), "append", placement="local")
    table.compact()
    table.vacuum()
    return table.read()


def q_quarantine_orders(spark, sf_dir):
    """The corrupted orders routed in one write; every bad row lists the rules it breaks."""
    path = new_output_path(spark, "quarantine")
    quarantine.quarantine(spark, _orders(spark, sf_dir, corrupted=True), path)
    rows = PublishedTable(spark, path, partition_by=quarantine.ROUTE).read()
    return rows.withColumn(quarantine.FAILED, F.array_join(quarantine.FAILED, ","))


def _grown_table(spark, sf_dir):
    """Three publishes with the state refreshed after each: odd ids, then even ids, then two statuses anew."""
    table = PublishedTable(spark, new_output_path(spark, "run_state"))
    full = _df_flavour(spark, sf_dir)
    for rows, mode in ((full.where("order_id % 2 = 1"), "static"), (full.where("order_id % 2 = 0"), "append"), (_changed(full), "dynamic")):
        table.write(rows, mode)
        run_state.refresh(table)
    return table


def q_state_status_distribution(spark, sf_dir):
    return run_state.status_distribution(_grown_table(spark, sf_dir))


def q_state_tier_breakdown(spark, sf_dir):
    return run_state.tier_breakdown(_grown_table(spark, sf_dir))


def q_state_category_performance(spark, sf_dir):
    return run_state.category_performance(_grown_table(spark, sf_dir))


def q_state_status_drift(spark, sf_dir):
    return run_state.status_drift(_grown_table(spark, sf_dir))


def q_declared_defaults(spark, sf_dir):
    """Orders without created_at and the flag, inserted into the declared table."""
    name = f"orders_declared_{uuid.uuid4().hex[:12]}"
    path = new_output_path(spark, "declared")
    declared.create_orders_table(spark, name, path, {"created_at": f"TIMESTAMP '{DEFAULTS_AS_OF}'", "is_loyalty_member": "false"})
    try:
        declared.insert_orders(spark, name, _orders(spark, sf_dir).drop("created_at", "is_loyalty_member"))
        rows = spark.read.schema(spark.table(name).schema).parquet(path)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


# -- projections -------------------------------------------------------------------

def _project(*cols):
    """Query selecting order_id plus derived columns (built lazily, per session)."""
    def q(spark, sf_dir):
        return _orders(spark, sf_dir).select("order_id", *[c() for c in cols])
    return q


q_revenue_tier = _project(lambda: derive.revenue_tier().alias("revenue_tier"))
q_json_device = _project(lambda: derive.device().alias("device"))
q_json_coupon = _project(lambda: derive.coupon_code().alias("coupon_code"))
q_order_date = _project(lambda: derive.order_date().alias("order_date"))
q_loyalty_flag = _project(lambda: derive.loyalty_flag().alias("loyalty_flag"))
q_rating_safe = _project(lambda: derive.rating_safe(flavour="df").alias("rating_safe"),
                         lambda: derive.rating_safe(flavour="sql").alias("rating_safe_dec"))


def q_transform_df(spark, sf_dir):
    return _df_flavour(spark, sf_dir)


def q_transform_sql(spark, sf_dir):
    return _sql_flavour(spark, sf_dir)


def q_apply_defaults(spark, sf_dir):
    """A source that omits created_at and is_loyalty_member gets the DDL defaults."""
    partial = _orders(spark, sf_dir).drop("created_at", "is_loyalty_member")
    # A typed literal, not a Python datetime: the value must not depend on the
    # driver process's time zone.
    return derive.apply_defaults(partial, {"created_at": F.expr(f"TIMESTAMP_NTZ '{DEFAULTS_AS_OF}'")})


def q_filter_bad_total(spark, sf_dir):
    return _orders(spark, sf_dir, corrupted=True).filter(
        F.col("order_total").isNull() | (F.col("order_total") < 0))


# -- reports -------------------------------------------------------------------------

def q_row_count(spark, sf_dir):
    return reports.row_count(_df_flavour(spark, sf_dir))


def q_status_counts(spark, sf_dir):
    return reports.status_counts(_df_flavour(spark, sf_dir))


def q_tier_counts(spark, sf_dir):
    return reports.tier_counts(_df_flavour(spark, sf_dir))


def q_summary_stats(spark, sf_dir):
    return reports.summary_stats(_df_flavour(spark, sf_dir))


def q_null_profile(spark, sf_dir):
    return reports.null_profile(_orders(spark, sf_dir))


def q_numeric_ranges(spark, sf_dir):
    return reports.numeric_ranges(_orders(spark, sf_dir))


def q_date_ranges(spark, sf_dir):
    return reports.date_ranges(_orders(spark, sf_dir))


def q_device_distribution(spark, sf_dir):
    return reports.device_distribution(_orders(spark, sf_dir))


def q_status_distribution(spark, sf_dir):
    return reports.status_distribution(_sql_flavour(spark, sf_dir))


def q_tier_breakdown(spark, sf_dir):
    return reports.tier_breakdown(_sql_flavour(spark, sf_dir))


def q_category_performance(spark, sf_dir):
    return reports.category_performance(_sql_flavour(spark, sf_dir))


def q_sample_rows(spark, sf_dir):
    return reports.sample_rows(_orders(spark, sf_dir), k=5, seed=SAMPLE_SEED)


def q_head_rows(spark, sf_dir):
    return reports.head_rows(_orders(spark, sf_dir), k=5)


# -- quality ---------------------------------------------------------------------------

def q_qc_report(spark, sf_dir):
    return quality.qc_report(_df_flavour(spark, sf_dir, corrupted=True))


def q_quality_suite(spark, sf_dir):
    return quality.quality_suite(_orders(spark, sf_dir, corrupted=True))


def q_key_uniqueness(spark, sf_dir):
    return quality.key_uniqueness(_orders(spark, sf_dir, corrupted=True))


def q_qc_gate(spark, sf_dir):
    """The gate passes on the clean table and hands the derived frame on."""
    return quality.qc_gate(_df_flavour(spark, sf_dir))


def q_pk_duplicates(spark, sf_dir):
    return quality.pk_duplicates(_orders(spark, sf_dir, corrupted=True))


def q_constraint_report(spark, sf_dir):
    return quality.constraint_report(_orders(spark, sf_dir, corrupted=True))


def q_consistency_report(spark, sf_dir):
    return quality.consistency_report(_orders(spark, sf_dir, corrupted=True))


def q_status_drift(spark, sf_dir):
    return quality.status_drift(_orders(spark, sf_dir))


def q_violations(spark, sf_dir):
    return quality.violations(_orders(spark, sf_dir, corrupted=True))


def q_validation_suite(spark, sf_dir):
    return validate.long_form(validate.validation_suite(_orders(spark, sf_dir), seed=SAMPLE_SEED))


# -- the SQL job's own text ---------------------------------------------------------

def _sql_view(spark, df):
    name = f"orders_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def _sql_over(spark, df, make):
    """A statement over a view of its own, which goes once the statement is analysed."""
    view = _sql_view(spark, df)
    try:
        return make(view)
    finally:
        spark.catalog.dropTempView(view)


def _sql_rows(spark, sf_dir, corrupted=False):
    return _sql_over(spark, _orders(spark, sf_dir, corrupted), lambda v: sql_job.projection(spark, v))


def q_sql_projection(spark, sf_dir):
    return _sql_rows(spark, sf_dir)


def q_sql_gates(spark, sf_dir):
    return _sql_over(spark, _sql_rows(spark, sf_dir, corrupted=True), lambda v: sql_job.gates(spark, v))


def _q_sql_report(name):
    def q(spark, sf_dir):
        return _sql_over(spark, _sql_rows(spark, sf_dir), lambda v: sql_job.reports(spark, v)[name])
    return q


# -- composed jobs -------------------------------------------------------------------------

def q_extract_df(spark, sf_dir):
    res = run_extract_df(spark, _orders(spark, sf_dir), new_output_path(spark, "extract_df"))
    return res.output(spark)


def q_extract_sql(spark, sf_dir):
    res = run_extract_sql(spark, _orders(spark, sf_dir), new_output_path(spark, "extract_sql"))
    return res.output(spark)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "jdbc_plan_partitions": q_jdbc_plan_partitions,
    "schema_profile": q_schema_profile,
    "column_profile": q_column_profile,
    "synth_orders": q_synth_orders,
    "parquet_roundtrip": q_parquet_roundtrip,
    "parquet_dynamic_overwrite": q_parquet_dynamic_overwrite,
    "transform_df": q_transform_df,
    "transform_sql": q_transform_sql,
    "revenue_tier": q_revenue_tier,
    "json_device": q_json_device,
    "json_coupon": q_json_coupon,
    "order_date": q_order_date,
    "loyalty_flag": q_loyalty_flag,
    "rating_safe": q_rating_safe,
    "apply_defaults": q_apply_defaults,
    "filter_bad_total": q_filter_bad_total,
    "row_count": q_row_count,
    "status_counts": q_status_counts,
    "tier_counts": q_tier_counts,
    "summary_stats": q_summary_stats,
    "null_profile": q_null_profile,
    "numeric_ranges": q_numeric_ranges,
    "date_ranges": q_date_ranges,
    "device_distribution": q_device_distribution,
    "status_distribution": q_status_distribution,
    "tier_breakdown": q_tier_breakdown,
    "category_performance": q_category_performance,
    "sample_rows": q_sample_rows,
    "head_rows": q_head_rows,
    "qc_report": q_qc_report,
    "qc_gate": q_qc_gate,
    "pk_duplicates": q_pk_duplicates,
    "constraint_report": q_constraint_report,
    "consistency_report": q_consistency_report,
    "status_drift": q_status_drift,
    "violations": q_violations,
    "atomic_publish": q_atomic_publish,
    "compacted_publish": q_compacted_publish,
    "quality_suite": q_quality_suite,
    "key_uniqueness": q_key_uniqueness,
    "quarantine_orders": q_quarantine_orders,
    "validation_suite": q_validation_suite,
    "declared_defaults": q_declared_defaults,
    "sql_projection": q_sql_projection,
    "sql_gates": q_sql_gates,
    "sql_status_distribution": _q_sql_report("status_distribution"),
    "sql_tier_breakdown": _q_sql_report("tier_breakdown"),
    "sql_category_performance": _q_sql_report("category_performance"),
    "state_status_distribution": q_state_status_distribution,
    "state_tier_breakdown": q_state_tier_breakdown,
    "state_category_performance": q_state_category_performance,
    "state_status_drift": q_state_status_drift,
    "extract_df": q_extract_df,
    "extract_sql": q_extract_sql,
}
