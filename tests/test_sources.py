"""Partition planner, Parquet sink, generator."""

import glob
import os

from pyspark.sql import functions as F

from ordwise import model
from ordwise.functions.derive import transform_df
from ordwise.operators import quality
from ordwise.session import new_output_path
from ordwise.sources import fixture, parquet, partitions, synth
from ordwise.sources.fixture import load_orders
from tests.conftest import SF_SMALL


def test_partition_count_rule():
    assert [partitions.num_partitions_for(n) for n in (0, 399, 1000, 5000)] == [4, 4, 10, 20]
    assert partitions.num_partitions_for(5000, max_connections=8) == 8


def test_the_callers_connections_are_the_bound():
    assert partitions.num_partitions_for(1_000_000) == 20
    assert partitions.num_partitions_for(1_000_000, max_connections=64) == 64
    assert partitions.num_partitions_for(500, max_connections=64) == 5


def test_read_plan_is_one_aggregate(spark):
    ids = spark.range(5, 1005).withColumnRenamed("id", "order_id")
    assert tuple(partitions.read_plan(ids, "order_id").first()) == (1000, 5, 1005, 10)
    assert tuple(partitions.read_plan(ids.where("order_id < 0"), "order_id").first()) == (0, None, None, 4)


def test_quantile_predicates_cover_every_key_once():
    assert partitions.quantile_predicates("id", 1, [5, 5, None, 9]) == [
        "id < 5 OR id IS NULL", "id >= 5 AND id < 9", "id >= 9"]
    assert partitions.quantile_predicates("id", 7, [7, None]) == ["1 = 1"]


def test_load_options():
    from ordwise.sources import jdbc
    props = jdbc.connection_properties("u", "p")
    got = jdbc.load_options("jdbc:postgresql://h/db", props, 5000, model.JDBC_COLUMN_TYPES)
    assert got["stringtype"] == "unspecified" and got["truncate"] == "true" and got["batchsize"] == "5000"
    assert "numPartitions" not in got and "sslmode" in got
    assert "stringtype" not in jdbc.load_options("jdbc:mysql://h/db", props, 10, None)


def test_width_split_is_sparks_own(spark, monkeypatch):
    from ordwise.sources import jdbc
    calls = []
    monkeypatch.setattr(jdbc, "source_stats", lambda *a: (10_000, 3, 900))
    monkeypatch.setattr(jdbc, "partitioned_scan", lambda *a: calls.append(a[3:7]))
    assert jdbc.planned_scan(spark, "u", "t", "k", {}, 64)[1] == 64
    assert calls == [("k", 3, 901, 64)]


def test_appended_files_are_seen(spark, tmp_path):
    from ordwise.operators import reports
    rows = spark.read.schema(fixture.SOURCE_SCHEMA).parquet(f"{SF_SMALL}/orders.parquet")
    path = str(tmp_path / "orders.parquet")
    rows.limit(1000).write.parquet(path)
    assert reports.row_count(load_orders(spark, str(tmp_path))).first()[0] == 1000
    rows.limit(500).write.mode("append").parquet(path)
    assert reports.row_count(load_orders(spark, str(tmp_path))).first()[0] == 1500


def test_hot_status_splits_into_files(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    path = new_output_path(spark, "t-hot")
    try:
        spark.conf.set(key, "512k")
        big = synth.synth_orders(spark, 60_000, num_partitions=8)
        parquet.write_partitioned(big, path)
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{path}/order_status=delivered/*.parquet")) > 1


def test_parquet_layout_and_overwrite_modes(spark):
    df = transform_df(load_orders(spark, SF_SMALL))
    path = new_output_path(spark, "t-layout")
    parquet.write_partitioned(df, path)
    dirs = sorted(os.path.basename(d) for d in glob.glob(f"{path}/order_status=*"))
    assert dirs == sorted(f"order_status={s}" for s in model.ORDER_STATUSES)
    files = glob.glob(f"{path}/order_status=*/*.parquet")
    assert len(files) == 6                                          # one file per status, not tasks x statuses
    assert all(f.endswith(".snappy.parquet") for f in files)
    back = parquet.read_dataset(spark, path)
    assert back.columns[-1] == "order_status" and back.count() == df.count()

    two = df.filter(F.col("order_status").isin("pending", "refunded"))
    parquet.write_partitioned(two, path, overwrite_mode="dynamic")
    assert parquet.read_dataset(spark, path).select("order_status").distinct().count() == 6
    parquet.write_partitioned(two, path, overwrite_mode="static")
    assert parquet.read_dataset(spark, path).select("order_status").distinct().count() == 2


def test_partition_pruning_on_read(spark):
    df = transform_df(load_orders(spark, SF_SMALL))
    path = new_output_path(spark, "t-prune")
    parquet.write_partitioned(df, path)
    from tests.conftest import plan_text
    plan = plan_text(parquet.read_dataset(spark, path).filter(F.col("order_status") == "delivered"), "simple")
    assert "PartitionFilters: [isnotnull(order_status" in plan and "delivered" in plan


def test_synth_is_partition_independent(spark):
    a = synth.synth_orders(spark, 1000, seed=42, num_partitions=1)
    b = synth.synth_orders(spark, 1000, seed=42, num_partitions=8)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == 1000


def test_synth_shares_and_invariants(spark):
    df = synth.synth_orders(spark, 20000, seed=3, num_partitions=8)
    assert all(r.within_tolerance for r in quality.status_drift(df).collect())
    cons = {r["check"]: r["observed"] for r in quality.consistency_report(df).collect()}
    assert all(v == 0 for v in cons.values()), cons
    cons = {r["check"]: r["observed"] for r in quality.constraint_report(df).collect()}
    assert all(v == 0 for v in cons.values()), cons
    assert quality.pk_duplicates(df).count() == 0
    loyal = df.agg(F.avg(F.col("is_loyalty_member").cast("int"))).first()[0]
    assert 0.33 < loyal < 0.37
    r = df.agg(F.min("order_total"), F.max("order_total"), F.min("item_count"), F.max("item_count")).first()
    assert r[0] >= 4.25 and r[1] <= 10000 and (r[2], r[3]) == (1, 20)


def test_placement_choices(spark):
    from tests.conftest import plan_text
    df = transform_df(load_orders(spark, SF_SMALL))
    assert "Exchange" not in plan_text(parquet._place(transform_df(synth.synth_orders(spark, 100)),
                                                      "order_status", "local"), "simple")
    n = df.count()
    counts = {}
    for placement in ("rebalance", "local", 4):
        path = new_output_path(spark, f"t-place-{placement}")
        parquet.write_partitioned(df, path, placement=placement)
        counts[placement] = len(glob.glob(f"{path}/order_status=*/*.parquet"))
        assert parquet.read_dataset(spark, path).count() == n
    assert counts["rebalance"] == 6
    assert 6 <= counts[4] <= 4 * 6
    assert 6 <= counts["local"] <= df.rdd.getNumPartitions() * 6
    import pytest
    with pytest.raises(ValueError):
        parquet.write_partitioned(df, new_output_path(spark, "t-place-bad"), placement="everywhere")


def test_adapter_rows_do_not_depend_on_partitioning(spark):
    raw = spark.read.schema(fixture.SOURCE_SCHEMA).parquet(f"{SF_SMALL}/orders.parquet")
    one = fixture.adapt_orders(raw.coalesce(1))
    many = fixture.adapt_orders(raw.repartition(8, "o_orderkey"))
    assert many.rdd.getNumPartitions() == 8
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_cluster_defaults_respect_given_settings(spark):
    from ordwise.session import set_if_unset
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        applied = set_if_unset(spark, {key: "256m", "spark.sql.session.timeZone": "Asia/Tokyo"})
        assert applied == {key: "256m"}                      # the session zone was given, so it stays
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set(key, before)


