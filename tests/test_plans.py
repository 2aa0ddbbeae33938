"""Physical plan shapes and the extract jobs."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ordwise.functions.derive import transform_df, transform_sql
from ordwise.operators import quality, reports
from ordwise.plans.extract import run_extract_df, run_extract_sql
from ordwise.session import new_output_path
from ordwise.sources.fixture import load_orders
from tests.conftest import SF_SMALL, plan_text


def test_top_k_is_take_ordered(spark):
    df = load_orders(spark, SF_SMALL)
    for q in (reports.sample_rows(df), reports.head_rows(df),
              reports.category_performance(transform_sql(df))):
        assert "TakeOrderedAndProject" in plan_text(q, "simple")


def test_share_of_total_moves_grouped_rows_only(spark):
    plan = plan_text(reports.status_distribution(transform_sql(load_orders(spark, SF_SMALL))), "simple")
    # the single-partition exchange sits above the final aggregate, never under it
    single = plan.index("Exchange SinglePartition")
    assert plan.index("HashAggregate", single) > single
    assert plan.count("Exchange hashpartitioning(order_status") == 1   # one shuffle for the aggregate


def test_scan_reads_only_needed_columns(spark):
    plan = plan_text(reports.tier_breakdown(transform_sql(load_orders(spark, SF_SMALL))), "simple")
    read_schema = plan[plan.index("ReadSchema:"):].splitlines()[0]
    assert "o_totalprice" in read_schema and "o_custkey" not in read_schema


def test_filter_pushed_into_scan_on_written_output(spark):
    path = new_output_path(spark, "t-push")
    run_extract_df(spark, load_orders(spark, SF_SMALL), path)
    out = spark.read.parquet(path).filter(F.col("order_total").isNull() | (F.col("order_total") < 0))
    plan = plan_text(out, "simple")
    assert "PushedFilters: [Or(IsNull(order_total),LessThan(order_total,0.00))]" in plan


def test_extract_df_writes_gated_output(spark):
    path = new_output_path(spark, "t-extract")
    res = run_extract_df(spark, load_orders(spark, SF_SMALL), path)
    assert {c["check"] for c in res.checks} == {"row_count", "bad_order_total", "null_order_status"}
    assert all(c["passed"] for c in res.checks)
    assert res.output(spark).count() == 1500
    assert res.reports["summary_stats"].count() == 1
    assert len(res.output(spark).columns) == 16


def test_failed_gate_writes_nothing(spark):
    path = new_output_path(spark, "t-gate")
    with pytest.raises(quality.QualityGateError):
        run_extract_df(spark, load_orders(spark, SF_SMALL, corrupted=True), path)
    assert not os.path.exists(path)
    with pytest.raises(quality.QualityGateError):
        run_extract_sql(spark, load_orders(spark, SF_SMALL), path, min_rows=10**9)
    assert not os.path.exists(path)


def test_extract_sql(spark):
    path = new_output_path(spark, "t-extract-sql")
    res = run_extract_sql(spark, load_orders(spark, SF_SMALL), path)
    assert len(res.output(spark).columns) == 17
    assert res.reports["category_performance"].count() == 10
    assert res.reports["tier_breakdown"].count() == 3
    assert len(glob.glob(f"{path}/order_status=*")) == 6


def test_one_pass_gate_reads_only_checked_columns(spark):
    df = transform_df(load_orders(spark, SF_SMALL))
    plan = plan_text(quality.qc_report(df), "simple")
    read_schema = plan[plan.index("ReadSchema:"):].splitlines()[0]
    assert "o_orderdate" not in read_schema and "o_custkey" not in read_schema


def test_run_folder_goes_with_the_run(spark):
    from ordwise.session import shared_dir
    runs = lambda: set(glob.glob(f"{shared_dir(spark)}/out/extract-run-*"))
    before = runs()
    res = run_extract_df(spark, load_orders(spark, SF_SMALL), new_output_path(spark, "t-run-ok"))
    res.close(spark)
    with pytest.raises(quality.QualityGateError):
        run_extract_df(spark, load_orders(spark, SF_SMALL, corrupted=True), new_output_path(spark, "t-run-fail"))
    assert runs() == before


def test_second_run_reports_its_own_rows(spark):
    path = new_output_path(spark, "t-two-runs")
    orders = load_orders(spark, SF_SMALL)
    run_extract_df(spark, orders, path, overwrite_mode="dynamic").close(spark)
    some = orders.filter(F.col("order_status").isin("delivered", "shipped"))
    res = run_extract_df(spark, some, path, overwrite_mode="dynamic")
    n = some.count()
    assert res.rows == n == res.written(spark).count()
    assert {r.order_status for r in res.reports["status_counts"].collect()} == {"delivered", "shipped"}
    assert res.output(spark).count() == 1500


def test_failed_gate_keeps_the_target(spark):
    path = new_output_path(spark, "t-kept")
    run_extract_df(spark, load_orders(spark, SF_SMALL), path)
    with pytest.raises(quality.QualityGateError):
        run_extract_df(spark, load_orders(spark, SF_SMALL, corrupted=True), path)
    assert spark.read.parquet(path).count() == 1500


def test_views_of_a_run_are_its_own(spark):
    spark.range(3).createOrReplaceTempView("orders_raw")
    run_extract_sql(spark, load_orders(spark, SF_SMALL), new_output_path(spark, "t-views"))
    assert spark.table("orders_raw").count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("orders_")] == ["orders_raw"]
    spark.catalog.dropTempView("orders_raw")


def test_top_k_is_exact_and_lazy(spark):
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "order_id int, v string")
    assert sorted(r.v for r in reports.head_rows(dup, k=2).collect()) == ["a", "b"]
    assert sorted(r.v for r in reports.head_rows(dup, k=4).collect()) == ["a", "b", "c", "d"]
    assert reports.head_rows(dup.filter("false"), k=3).count() == 0
    plan = plan_text(reports.head_rows(load_orders(spark, SF_SMALL)), "simple")
    assert plan.count("FileScan") == 1 and "TakeOrderedAndProject" in plan


def test_catalogue_follows_the_frame(spark):
    df = load_orders(spark, SF_SMALL).withColumn("order_total", F.col("order_total").cast("double")).withColumn(
        "item_count", F.col("item_count").cast("bigint"))
    got = {r.column_name: r for r in reports.schema_profile(df).collect()}
    assert got["order_total"].data_type == "double precision" and got["order_total"].numeric_precision is None
    assert (got["item_count"].data_type, got["item_count"].numeric_precision) == ("bigint", 64)


def test_cli_exit_codes(spark, capsys):
    """The job's main maps a failed gate to exit code 1 and writes nothing."""
    from ordwise.plans.extract import main
    from ordwise.sources.fixture import as_model
    clean, bad = new_output_path(spark, "t-cli-src"), new_output_path(spark, "t-cli-bad")
    as_model(load_orders(spark, SF_SMALL)).write.parquet(clean)
    as_model(load_orders(spark, SF_SMALL, corrupted=True)).write.parquet(bad)
    out = new_output_path(spark, "t-cli-out")
    assert main(["--parquet", clean, "--output-path", out, "--placement", "local"]) == 0
    assert "rows written: 1500" in capsys.readouterr().out
    assert main(["--parquet", clean, "--output-path", new_output_path(spark, "t-cli-sql"), "--flavour", "sql"]) == 0
    failed = new_output_path(spark, "t-cli-fail")
    assert main(["--parquet", bad, "--output-path", failed]) == 1
    assert "QC FAIL" in capsys.readouterr().err
    assert not os.path.exists(failed)
