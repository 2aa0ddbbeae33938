"""One-scan reports, key bitmaps, declared tables and the SQL job."""

import pytest
from pyspark.sql import functions as F

from ordwise import model
from ordwise.operators import quality, reports
from ordwise.plans import sql_job, validate
from ordwise.session import new_output_path
from ordwise.sources import declared
from ordwise.sources.fixture import as_model, load_orders
from tests.conftest import SF_SMALL, plan_text


def test_quality_suite_is_one_scan_and_equals_its_parts(spark):
    df = load_orders(spark, SF_SMALL, corrupted=True)
    suite = quality.quality_suite(df)
    plan = plan_text(suite, "simple")
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1
    rows = suite.collect()
    assert len(rows) == 26
    parts = {"gates": quality.qc_report(df), "constraints": quality.constraint_report(df), "consistency": quality.consistency_report(df)}
    for name, part in parts.items():
        assert [tuple(r)[1:] for r in rows if r["report"] == name] == [tuple(r) for r in part.collect()]


def test_quality_suite_of_nothing(spark):
    rows = quality.quality_suite(load_orders(spark, SF_SMALL).where("order_id < 0")).collect()
    assert [r["check"] for r in rows if not r["passed"]] == ["row_count"]


@pytest.mark.parametrize("ids, want", [
    ([], (0, 0, 0, 0, True)),
    ([1, 2, 3], (3, 0, 3, 0, True)),
    ([1, 1, 1, None, None], (5, 2, 1, 2, False)),
    ([0, -1, -32768, 32768, 32769, -32769, 2**31 - 1, -2**31], (8, 0, 8, 0, True)),
    ([-5, 5, -5, 40000, -40000], (5, 0, 4, 1, False)),
])
def test_key_uniqueness_edges(spark, ids, want):
    got = quality.key_uniqueness(spark.createDataFrame([(i,) for i in ids], "order_id int")).first()
    assert tuple(got) == want


def test_key_uniqueness_agrees_with_the_grouped_form_and_moves_bitmaps(spark):
    for corrupted in (False, True):
        df = load_orders(spark, SF_SMALL, corrupted)
        assert quality.key_uniqueness(df).first()["is_key"] == (quality.pk_duplicates(df).count() == 0)
    hot = spark.range(200_000).select((F.col("id") % 1000).cast("int").alias("order_id"))
    q = quality.key_uniqueness(hot)
    assert tuple(q.first()) == (200_000, 0, 1000, 199_000, False)
    plan = plan_text(q, "simple")
    assert "partial_bitmap_construct_agg" in plan and "hashpartitioning(bucket" in plan.replace("_groupingexpression", "bucket")


# -- validation suite ---------------------------------------------------------------------

def test_suite_is_one_scan_of_the_rows(spark):
    df = load_orders(spark, SF_SMALL)
    plan = plan_text(validate.grouped_profile(df, 1500), "simple")
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    assert "SortAggregate" not in plan and "ObjectHashAggregate" in plan


def test_suite_equals_the_reports_taken_alone(spark):
    df = load_orders(spark, SF_SMALL)
    suite = validate.validation_suite(df, sample_size=7, seed=3)
    for name in ("row_count", "null_profile", "numeric_ranges", "date_ranges", "status_distribution", "device_distribution"):
        assert suite[name].collect() == getattr(reports, name)(df).collect(), name
    assert suite["sample_rows"].collect() == reports.sample_rows(df, k=7, seed=3).collect()


def test_suite_on_bad_metadata_nulls_few_rows_and_hot_keys(spark):
    df = load_orders(spark, SF_SMALL, corrupted=True).withColumn("order_total", F.col("order_total").try_cast(model.TOTAL_TYPE)).withColumn(
        "metadata", F.when(F.col("order_id") % 3 == 0, F.lit("not json")).when(F.col("order_id") % 3 == 1, F.col("metadata")))
    suite = validate.validation_suite(df)
    for name in ("status_distribution", "device_distribution", "null_profile"):
        assert suite[name].collect() == getattr(reports, name)(df).collect(), name
    few = validate.validation_suite(df.where("order_id < 4"))
    assert few["sample_rows"].count() == df.where("order_id < 4").count()
    one = df.where("order_id is not null").withColumn("order_id", F.lit(5))
    assert validate.validation_suite(one)["sample_rows"].count() == 5
    assert validate.validation_suite(df.where("order_id < 0"))["sample_rows"].count() == 0


def test_suite_keeps_a_bounded_sample(spark):
    df = load_orders(spark, "/root/testdata/sf0.01")
    groups = validate.profiled(df)
    n = groups.where(f"gid = {validate.SAMPLE} and _sample is not null").count()
    assert 100 < n < 400


# -- declared table -----------------------------------------------------------------------

@pytest.fixture
def table(spark):
    name = "t_declared_orders"
    declared.create_orders_table(spark, name, new_output_path(spark, "t-declared"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_defaults_for_omitted_columns_only(spark, table):
    rows = as_model(load_orders(spark, SF_SMALL)).limit(20)
    declared.insert_orders(spark, table, rows.drop("created_at", "is_loyalty_member"))
    got = spark.table(table)
    assert got.where("is_loyalty_member = false and created_at > current_timestamp() - interval 1 hour").count() == 20
    declared.insert_orders(spark, table, rows.withColumn("is_loyalty_member", F.lit(None).cast("boolean")))
    assert got.where("is_loyalty_member is null").count() == 20
    declared.insert_orders(spark, table, rows.drop("rating"))
    assert spark.table(table).where("rating is null").count() >= 20


def test_text_beyond_its_length_fails(spark, table):
    rows = as_model(load_orders(spark, SF_SMALL)).limit(3)
    with pytest.raises(Exception, match="(?i)length|limit"):
        declared.insert_orders(spark, table, rows.withColumn("customer_id", F.rpad("customer_id", F.lit(40), F.lit("x"))))
    assert spark.table(table).count() == 0


def test_catalogue_reads_types_and_defaults_back(spark, table):
    got = {r["column_name"]: r for r in declared.declared_profile(spark.table(table)).collect()}
    assert list(got) == model.ORDER_COLUMN_NAMES
    assert {c: got[c]["character_maximum_length"] for c in model.VARCHAR_LENGTHS} == model.VARCHAR_LENGTHS
    assert got["customer_id"]["data_type"] == "character varying" and got["order_total"]["numeric_scale"] == 2
    assert {c: r["column_default"] for c, r in got.items() if r["column_default"]} == declared.DEFAULTS


# -- the SQL job ----------------------------------------------------------------------------

def test_sql_statements_take_named_parameters_only():
    for text in (sql_job.PROJECTION, sql_job.GATES, sql_job.STATUS_SHARE, sql_job.TIER_REVENUE, sql_job.TOP_CATEGORIES):
        assert "IDENTIFIER(:rows)" in text and "{" not in text


def test_sql_tier_tests_the_source_decimal_and_null_is_high(spark):
    totals = F.array(*[F.lit(x).cast(model.TOTAL_TYPE) for x in ("49.99", "50.00", "199.99", None)])
    load_orders(spark, SF_SMALL).withColumn("order_total", totals[F.col("order_id") % 4]).createOrReplaceTempView("t_tiers")
    got = {r["order_total"]: r["revenue_tier"] for r in sql_job.projection(spark, "t_tiers").collect()}
    assert got == {49.99: "low", 50.0: "mid", 199.99: "mid", None: "high"}
    spark.catalog.dropTempView("t_tiers")


def test_sql_gates_push_to_one_scan(spark):
    load_orders(spark, SF_SMALL).createOrReplaceTempView("t_gates")
    plan = plan_text(sql_job.gates(spark, "t_gates"), "simple")
    assert plan.count("FileScan") == 1
    assert [tuple(r) for r in sql_job.gates(spark, "t_gates", 10**6).collect()] == [("row_count", 1500, 10**6, False), ("bad_order_total", 0, 0, True)]
    spark.catalog.dropTempView("t_gates")
