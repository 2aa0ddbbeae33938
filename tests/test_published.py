"""Publish protocol, compaction, run state and quarantine."""

import json
import re

import pytest
from pyspark.sql import functions as F

from ordwise.functions.derive import transform_df
from ordwise.operators import quality, reports
from ordwise.plans import quarantine, run_state
from ordwise.plans.extract import run_extract_df, run_extract_sql
from ordwise.session import new_output_path
from ordwise.sources import published
from ordwise.sources.fixture import load_orders
from ordwise.sources.parquet import read_dataset
from ordwise.sources.published import CountMismatch, PublishConflict, PublishedTable, pack
from tests.conftest import SF_SMALL, plan_text


class Killed(BaseException):
    """The driver dies here."""


@pytest.fixture(scope="module")
def orders(spark):
    return transform_df(load_orders(spark, SF_SMALL))


def _table(spark, name, stop=None, **kw):
    def on_step(step):
        steps.append(step)
        if stop is not None and step.startswith(stop):
            raise Killed(step)
    steps = []
    t = PublishedTable(spark, name, on_step=on_step, **kw)
    t.steps = steps
    return t


def _ids(df):
    return sorted((r[0], r[1]) for r in df.select("order_id", "item_count").collect())


@pytest.mark.parametrize("mode", ["static", "dynamic", "append"])
@pytest.mark.parametrize("stop", ["stage", "verify", "move order_status=cancelled", "move order_status=shipped", "seal"])
def test_killed_publish_leaves_old_rows(spark, orders, mode, stop):
    path = new_output_path(spark, "t-kill")
    _table(spark, path).write(orders, "static")
    old = _ids(orders)
    new = orders.where("order_status in ('cancelled', 'shipped')").withColumn("item_count", F.col("item_count") + 1000)
    dead = _table(spark, path, stop)
    with pytest.raises(Killed):
        dead.write(new, mode)
    assert _ids(PublishedTable(spark, path).read()) == old == _ids(read_dataset(spark, path))
    # The next publish is whole, and vacuum drops what the dead one left.
    t = _table(spark, path)
    t.write(new, "static")
    t.vacuum()
    assert _ids(t.read()) == _ids(new)
    assert t.storage.children("_staging") == []
    assert all(len(t.storage.children(p)) <= 1 for p in t.storage.children() if p.startswith("order_status="))


def test_killed_after_the_seal_shows_the_new_rows(spark, orders):
    path = new_output_path(spark, "t-kill-late")
    _table(spark, path).write(orders, "static")
    with pytest.raises(Killed):
        _table(spark, path, "clean").write(orders.where("order_id < 100"), "static")
    assert PublishedTable(spark, path).read().count() == orders.where("order_id < 100").count()


def test_killed_first_publish_publishes_nothing(spark, orders):
    path = new_output_path(spark, "t-kill-first")
    with pytest.raises(Killed):
        _table(spark, path, "seal").write(orders, "static")
    with pytest.raises(FileNotFoundError):
        PublishedTable(spark, path).read()


def test_modes_and_running_readers(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-modes"))
    t.write(orders, "static")
    first = t.read()
    some = orders.where("order_status = 'pending'").withColumn("item_count", F.lit(7))
    m = t.write(some, "dynamic")
    assert m.rows == orders.count() == t.read().count()
    assert {r[0] for r in t.read().where("order_status = 'pending'").select("item_count").distinct().collect()} == {7}
    assert t.write(some, "append").rows == orders.count() + some.count()
    # A reader that began before keeps its rows, until its folders are vacuumed.
    assert _ids(first) == _ids(orders)
    t.vacuum(keep=3)
    assert _ids(first) == _ids(orders)
    assert t.write(some, "static").rows == some.count()


def test_of_two_publishes_one_wins(spark, orders):
    path = new_output_path(spark, "t-conflict")
    PublishedTable(spark, path).write(orders, "static")
    other = orders.where("order_status = 'shipped'")

    def meanwhile(step):
        if step == "seal":
            PublishedTable(spark, path).write(other, "static")

    with pytest.raises(PublishConflict):
        PublishedTable(spark, path, on_step=meanwhile).write(orders, "dynamic")
    assert _ids(PublishedTable(spark, path).read()) == _ids(other)


def test_missing_rows_stop_the_publish(spark, orders):
    path = new_output_path(spark, "t-mismatch")
    PublishedTable(spark, path).write(orders, "static")
    t = PublishedTable(spark, path)

    def lose(step):
        if step == "verify":
            run = t.storage.children("_staging")[0]
            t.storage.remove(f"_staging/{run}/order_status=shipped")

    t.on_step = lose
    with pytest.raises(CountMismatch):
        t.write(orders, "static")
    assert _ids(PublishedTable(spark, path).read()) == _ids(orders)


def test_torn_manifest_is_passed_over(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-torn"))
    t.write(orders, "static")
    t.storage.write_new("_manifest/v00000002.json", json.dumps({"number": 2})[:7])
    assert t.manifest().number == 1 and t.read().count() == orders.count()
    assert t.write(orders.where("order_id < 50"), "static").number == 3


def test_odd_partition_values_nulls_and_empty_tables(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-odd"))
    odd = orders.limit(60).withColumn("order_status", F.element_at(
        F.array(*[F.lit(x) for x in ("a b", "c/d=e", "50%+1", "é", "")], F.lit(None).cast("string")), F.col("order_id") % 6 + 1))
    t.write(odd, "static", placement=2)
    # Spark's own layout reads an empty partition value back as null.
    want = sorted((r["order_id"], r["order_status"] or None) for r in odd.select("order_id", "order_status").collect())
    got = sorted((r["order_id"], r["order_status"]) for r in t.read().select("order_id", "order_status").collect())
    assert [(a, b or "") for a, b in got] == [(a, b or "") for a, b in want]
    assert t.compact(1 << 20) is not None
    assert _ids(t.read()) == _ids(odd)
    assert t.write(odd.where("order_id < 0"), "static").rows == 0
    assert t.read().schema.fieldNames()[-1] == "order_status" and t.read().count() == 0


def test_schema_change_needs_a_static_publish(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-schema"))
    t.write(orders, "static")
    with pytest.raises(ValueError):
        t.write(orders.drop("device"), "append")
    assert "device" not in t.write(orders.drop("device"), "static").schema


def test_one_write_of_the_table(spark, orders):
    """Rows are written by one job; what follows are renames: the files staged are the files read."""
    seen = {}
    path = new_output_path(spark, "t-one-write")
    t = PublishedTable(spark, path)

    def look(step):
        if step == "verify":
            run = t.storage.children("_staging")[0]
            seen["staged"] = {f.rsplit("/", 1)[-1]: n for f, n in t.storage.files(f"_staging/{run}").items()}

    t.on_step = look
    t.write(orders, "static")
    live = {f.rsplit("/", 1)[-1]: n for f, n in t.storage.files("").items() if f.startswith("order_status")}
    assert live == seen["staged"]


def test_reads_are_pruned_to_the_live_folders(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-prune"))
    t.write(orders, "static")
    t.write(orders, "static")
    q = t.read().where("order_status = 'shipped'").select("order_id")
    plan = plan_text(q, "simple")
    assert "PartitionFilters: [isnotnull(order_status" in plan
    assert len(t.read().inputFiles()) < len(t.storage.files("")) and t.read().count() == orders.count()


# -- compaction ------------------------------------------------------------------------

def test_pack_fills_bins():
    files = {f"f{i}": n for i, n in enumerate([70, 60, 50, 40, 30, 30, 20, 10])}
    bins = pack(files, 100)
    assert sorted(f for b in bins for f in b) == sorted(files)
    assert all(sum(files[f] for f in b) <= 100 for b in bins) and len(bins) == 4


def test_compaction_moves_small_files_only(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-compact"))
    t.write(orders, "static", placement=1)
    for k in range(6):
        t.write(orders.where(f"order_id % 6 = {k}").withColumn("item_count", F.lit(k)), "append", placement=3)
    before, files = _ids(t.read()), t.storage.files("")
    live = {f: n for f, n in files.items() if f.startswith("order_status")}
    target = 60_000
    plan = t.plan_compaction(target)
    moved = {f for bins in plan.values() for b in bins for f in b}
    assert all(live[f] < 0.75 * target for f in moved)
    large = {f for f, n in live.items() if n >= 0.75 * target}
    m = t.compact(target)
    assert _ids(t.read()) == before and m.rows == 2 * orders.count()
    after = {f: n for e in m.entries for f in (e.paths() if e.files is not None else [f"{e.folder}/{x}" for x in t.storage.files(e.folder)])
             for n in [t.storage.files("")[f]]}
    assert large <= set(after) and not moved & set(after)
    # One file a bin; per status at most one file below half the target stays, besides the rest bin.
    made = set(after) - set(live)
    assert len(made) == sum(len(b) for b in plan.values())
    assert len(after) < len(live) / 3
    t.vacuum()
    assert _ids(t.read()) == before


def test_writes_hold_no_task_in_memory_to_sort_it(spark, orders, monkeypatch):
    """Publishes and compactions write a task's folders side by side; more folders than that are sorted, and whole."""
    from pyspark.sql.readwriter import DataFrameWriter

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **k: (seen.append(int(spark.conf.get(name))), write(w, path, *a, **k))[1])
    t = PublishedTable(spark, new_output_path(spark, "t-unsorted"))
    for k in range(3):
        t.write(orders.where(f"order_id % 3 = {k}"), "append", placement="local")
    assert t.compact().rows == orders.count() and _ids(t.read()) == _ids(orders)
    assert len(seen) == 4 and min(seen) >= orders.select("order_status").distinct().count()
    assert spark.conf.get(name) == before
    many = PublishedTable(spark, new_output_path(spark, "t-many"), partition_by="item_count")
    wide = orders.withColumn("item_count", (F.col("order_id") % (3 * published.OPEN_FILES)).cast("int")).coalesce(1)
    assert many.write(wide, "static", placement="local").rows == orders.count() and _ids(many.read()) == _ids(wide)


@pytest.mark.parametrize("stop", ["stage", "verify", "move", "seal"])
def test_killed_compaction_leaves_the_table(spark, orders, stop):
    path = new_output_path(spark, "t-compact-kill")
    t = PublishedTable(spark, path)
    for k in range(2):
        t.write(orders.where(f"order_id % 2 = {k}"), "append", placement=2)
    with pytest.raises(Killed):
        _table(spark, path, stop).compact()
    assert _ids(PublishedTable(spark, path).read()) == _ids(orders)
    assert PublishedTable(spark, path).compact().rows == orders.count()
    assert PublishedTable(spark, path).compact() is None


# -- the extract job on it ----------------------------------------------------------------

def test_failed_gate_keeps_the_last_run(spark):
    path = new_output_path(spark, "t-extract-keep")
    good = load_orders(spark, SF_SMALL)
    run_extract_df(spark, good, path)
    with pytest.raises(quality.QualityGateError):
        run_extract_df(spark, good, path, min_rows=10**6)
    with pytest.raises(quality.QualityGateError):
        run_extract_sql(spark, load_orders(spark, SF_SMALL, corrupted=True), path)
    assert read_dataset(spark, path).count() == 1500
    assert PublishedTable(spark, path).storage.children("_staging") == []


def test_sql_job_has_two_gates(spark):
    """Rows and totals; null statuses pass the SQL job and fail the other."""
    no_status = load_orders(spark, SF_SMALL).withColumn("order_status", F.when(F.col("order_id") > 9, F.col("order_status")))
    res = run_extract_sql(spark, no_status, new_output_path(spark, "t-sql-gates"))
    assert [c["check"] for c in res.checks] == ["row_count", "bad_order_total"] and res.rows == 1500
    with pytest.raises(quality.QualityGateError):
        run_extract_df(spark, no_status, new_output_path(spark, "t-df-gates"))


# -- run state -----------------------------------------------------------------------------

def test_state_reads_new_files_only_and_merges(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-state"))
    t.write(orders.where("order_id % 2 = 1"), "static")
    assert run_state.refresh(t) == 6 and run_state.refresh(t) == 0
    before = set(t.storage.children("_state"))
    t.write(orders.where("order_id % 2 = 0 and order_status in ('pending', 'shipped')"), "append")
    assert run_state.refresh(t) == 2
    new = t.storage.children("_state")
    added = [n for n in new if n not in before]
    got = spark.read.schema(run_state.STATE_SCHEMA).parquet(f"{t.path}/_state/{added[0]}").agg(F.sum("n")).first()[0]
    assert got == orders.where("order_id % 2 = 0 and order_status in ('pending', 'shipped')").count()
    t.write(orders.where("order_status = 'pending'").withColumn("order_total", F.lit("3.33").cast("decimal(12,2)")), "dynamic")
    t.compact()
    live = t.read()
    full = live.withColumn("rating_safe", F.coalesce("rating", F.lit(0).cast("decimal(3,1)")))
    full = full.withColumn("revenue_tier", F.when(F.col("order_total") < 50, "low").when(F.col("order_total") < 200, "mid").otherwise("high"))
    for name in ("status_distribution", "tier_breakdown", "category_performance"):
        assert getattr(run_state, name)(t).collect() == getattr(reports, name)(full).collect(), name
    assert sorted(run_state.status_drift(t).collect()) == sorted(quality.status_drift(full).collect())


def test_state_of_a_dead_refresh_is_not_read(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-state-dead"))
    t.write(orders, "static")
    run_state.refresh(t)
    done = t.storage.children("_state")[0]
    t.storage.remove(f"_state/{done}/_SUCCESS")
    assert run_state.refresh(t) == 6
    assert run_state.merged(t, "order_status").agg(F.sum("n")).first()[0] == orders.count()


# -- quarantine ---------------------------------------------------------------------------

def test_quarantine_adds_up_and_lists_rules(spark):
    bad = load_orders(spark, SF_SMALL, corrupted=True)
    path = new_output_path(spark, "t-quarantine")
    r = quarantine.quarantine(spark, bad, path)
    assert r.good + r.bad == r.rows == bad.count() and r.bad > 0
    good, rest = quarantine.good_rows(spark, path), quarantine.quarantined_rows(spark, path)
    assert (good.count(), rest.count()) == (r.good, r.bad)
    assert sorted(good.columns) == sorted(bad.columns)
    broken = {c["check"]: c["observed"] for c in quality.quality_suite(bad).collect() if c["report"] != "gates"}
    assert r.by_rule == broken
    listed = {x["c"]: x["n"] for x in rest.select(F.explode("failed_checks").alias("c")).groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert listed == {k: v for k, v in broken.items() if v}
    assert rest.where("size(failed_checks) = 0").count() == 0
    assert all(c["observed"] == 0 for c in quality.quality_suite(good).collect() if c["check"] != "row_count")


def test_quarantine_gate_and_appends(spark):
    clean, bad = load_orders(spark, SF_SMALL), load_orders(spark, SF_SMALL, corrupted=True)
    path = new_output_path(spark, "t-quarantine-gate")
    wide = clean.select(*[F.col(c).cast(t).alias(c) for c, t in bad.dtypes])
    assert quarantine.quarantine(spark, wide, path).bad == 0
    with pytest.raises(quality.QualityGateError) as e:
        quarantine.quarantine(spark, bad, path, max_bad_share=0.01)
    assert {"not_null_order_id", "rating_range"} <= {f["check"] for f in e.value.failures}
    assert quarantine.quarantined_rows(spark, path).count() == 0 and quarantine.good_rows(spark, path).count() == 1500
    r = quarantine.quarantine(spark, bad, path)
    assert quarantine.good_rows(spark, path).count() == 1500 + r.good
    assert quarantine.quarantine(spark, bad.where("order_id < -5"), path).rows == 0


def test_quarantine_is_one_narrow_write(spark):
    plan = plan_text(quarantine.routed(load_orders(spark, SF_SMALL, corrupted=True)), "simple")
    assert "Exchange" not in re.sub(r"Exchange hashpartitioning\(o_orderkey[^\n]*", "", plan) and plan.count("FileScan") == 1


def test_published_modes_are_checked(spark, orders):
    t = PublishedTable(spark, new_output_path(spark, "t-bad-mode"))
    with pytest.raises(ValueError):
        t.write(orders, "upsert")
    assert published.MODES == ("static", "dynamic", "append")
