from pyspark.sql import functions as F

from ordwise.plans.validate import run_validation, validation_suite
from ordwise.sources.fixture import load_orders
from tests.conftest import SF_SMALL


def test_validation_suite_runs_all_eight(spark):
    suite = validation_suite(load_orders(spark, SF_SMALL))
    assert set(suite) == {"row_count", "schema_profile", "status_distribution", "null_profile",
                          "numeric_ranges", "device_distribution", "date_ranges", "sample_rows"}
    out = run_validation(load_orders(spark, SF_SMALL), show=False)
    assert out["row_count"] == [{"total_rows": 1500}]
    for name in ("null_profile", "numeric_ranges", "date_ranges"):
        assert out[name] == [suite[name].first().asDict()]
    assert [r["ordinal_position"] for r in out["schema_profile"]] == list(range(1, 13))
    assert len(out["sample_rows"]) == 5


def test_generate_writes_and_validates(spark, tmp_path):
    from ordwise.plans.generate import generate_to_parquet
    out = generate_to_parquet(spark, 1000, 42, str(tmp_path / "orders"), show=False)
    assert out["row_count"] == [{"total_rows": 1000}]
    assert len(out["status_distribution"]) == 6


def test_device_report_is_whole(spark):
    orders = load_orders(spark, SF_SMALL)
    many = orders.withColumn("metadata", F.format_string('{"device": "d%d"}', F.col("order_id") % 150))
    out = run_validation(many, show=False)["device_distribution"]
    assert len({r["device"] for r in out}) == len(out) == 150 and sum(r["cnt"] for r in out) == 1500
