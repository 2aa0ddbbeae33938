"""Quality operators: edge rows, one-pass plans, gate behaviour."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ordwise import model
from ordwise.operators import quality
from tests.conftest import SF_SMALL, plan_text


def _rows(spark, rows):
    base = dict(order_id=1, customer_id="c" * 36, order_status="delivered", order_total=Decimal("10.00"),
                item_count=1, product_category="Books", created_at=datetime(2024, 1, 1, 12, 0),
                delivery_date=date(2024, 1, 3), is_loyalty_member=False, rating=Decimal("4.0"),
                metadata='{"device": "mobile"}', shipping_address="x")
    data = [tuple({**base, **r}[c] for c in model.ORDER_COLUMN_NAMES) for r in rows]
    schema = T.StructType([T.StructField(n, t, True) for n, t, _, _ in model.ORDER_COLUMNS])
    return spark.createDataFrame(data, schema)


def _report(df):
    return {r["check"]: r["observed"] for r in df.collect()}


def test_constraint_edge_rows(spark):
    df = _rows(spark, [
        {"order_id": 1},
        {"order_id": 2, "rating": Decimal("0.9")},
        {"order_id": 3, "rating": Decimal("5.1")},
        {"order_id": 4, "rating": None},                      # null passes the range check
        {"order_id": 5, "order_status": "lost"},
        {"order_id": 6, "order_status": None},
        {"order_id": 7, "customer_id": "c" * 37},
        {"order_id": 8, "order_total": Decimal("-0.01")},
        {"order_id": 9, "item_count": 0},
    ])
    r = _report(quality.constraint_report(df))
    assert r["rating_range"] == 2
    assert r["status_domain"] == 1
    assert r["not_null_order_status"] == 1
    assert r["length_customer_id"] == 1
    assert r["order_total_nonnegative"] == 1
    assert r["item_count_positive"] == 1
    assert r["not_null_order_id"] == 0


def test_pk_duplicates_and_null_key(spark):
    df = _rows(spark, [{"order_id": 1}, {"order_id": 1}, {"order_id": None}, {"order_id": 2}])
    got = {(r.order_id, r.n) for r in quality.pk_duplicates(df).collect()}
    assert got == {(1, 2), (None, 1)}


def test_row_count_gate_boundary(spark):
    ok = _rows(spark, [{"order_id": i} for i in range(900)])
    assert quality.qc_gate(ok) is ok
    with pytest.raises(quality.QualityGateError) as e:
        quality.qc_gate(_rows(spark, [{"order_id": i} for i in range(899)]))
    assert [f["check"] for f in e.value.failures] == ["row_count"]


def test_gate_lists_all_failures(spark):
    df = _rows(spark, [{"order_id": 1, "order_total": None}, {"order_id": 2, "order_status": None}])
    with pytest.raises(quality.QualityGateError) as e:
        quality.qc_gate(df, min_rows=900)
    assert {f["check"] for f in e.value.failures} == {"row_count", "bad_order_total", "null_order_status"}


def test_consistency_rules(spark):
    df = _rows(spark, [
        {"order_id": 1},
        {"order_id": 2, "order_status": "pending"},                          # delivery without shipment, rating
        {"order_id": 3, "order_status": "shipped", "delivery_date": None, "rating": None},
        {"order_id": 4, "delivery_date": date(2024, 1, 20)},                 # 19 days
        {"order_id": 5, "order_status": "cancelled", "delivery_date": None, "rating": None},
        {"order_id": 6, "shipping_address": None},
    ])
    r = _report(quality.consistency_report(df))
    assert r == {"delivery_without_shipment": 1, "shipment_without_delivery": 1, "delivery_lead_days": 1,
                 "rating_not_delivered": 1, "address_missing": 1, "address_on_cancelled": 1}


def test_violations_rows(spark):
    df = _rows(spark, [{"order_id": 1}, {"order_id": 2, "order_total": Decimal("-1.00")}])
    got = sorted((r.order_id, r.check) for r in quality.violations(df, quality.gate_checks()).collect())
    assert got == [(2, "bad_order_total")]
    row = quality.violations(df).first()
    assert (row.check, row.order_total, set(df.columns) < set(row.asDict())) == (
        "order_total_nonnegative", Decimal("-1.00"), True)


def test_corrupted_table_breaks_every_rule(spark):
    from ordwise.sources.fixture import load_orders
    bad = load_orders(spark, SF_SMALL, corrupted=True)
    for report in (quality.qc_report(bad), quality.constraint_report(bad), quality.consistency_report(bad)):
        assert {r.check: r.observed for r in report.collect() if r.observed == 0} == {}
    assert bad.count() == 1500


def test_vanished_status_is_drift(spark):
    from ordwise.sources.fixture import load_orders
    rows = {r.order_status: r for r in quality.status_drift(
        load_orders(spark, SF_SMALL).filter("order_status <> 'refunded'")).collect()}
    assert rows["refunded"].cnt == 0 and not rows["refunded"].within_tolerance


def test_check_report_is_one_scan_one_aggregate(spark):
    from ordwise.sources.fixture import load_orders
    df = load_orders(spark, SF_SMALL, corrupted=True)
    plan = plan_text(quality.constraint_report(df), "simple")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("HashAggregate") <= 2      # partial + final, one aggregate


def test_status_drift_within_tolerance(spark):
    from ordwise.sources.fixture import load_orders
    rows = quality.status_drift(load_orders(spark, SF_SMALL)).collect()
    assert {r.order_status for r in rows} == set(model.ORDER_STATUSES)
    assert all(r.within_tolerance for r in rows)
