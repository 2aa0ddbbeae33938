"""The corpus pipeline, stage by stage, on the smallest table."""

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from ordwise.llm import minhash_forest, quality_rules, registry
from ordwise.llm.store import read, saved
from tests.conftest import SF_SMALL


def test_registered():
    assert set(registry.QUERIES) | {"pipeline"} <= set(E.queries())
    assert {k.split("_")[0] for k in registry.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, docs, SF_SMALL), f"t-{name}")
        if name != "packing":
            assert out.columns == docs.columns
        seen.append((docs, out))
        docs = out
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    before, after = seen[0]
    want = {r.doc_id for r in quality_rules.q_quality_rules(spark, SF_SMALL).where("kept").collect()}
    assert ids(after) == want
    before, after = seen[1]
    groups = minhash_forest.near_groups(before.select("doc_id", "text")).collect()
    assert ids(after) == {r.doc_id for r in groups if r.component_id == r.doc_id}
    before, after = seen[2]
    assert ids(before) == ids(after)
    text = dict(after.select("doc_id", "text").collect())
    assert all(len(text[r.doc_id]) <= len(r.text) for r in before.collect())
    before, after = seen[3]
    assert ids(after) <= ids(before) and after.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 3
    before, packed = seen[4]
    assert packed.where("piece = 0").count() == before.count()
    rows = packed.collect()
    used = np.bincount([r.sequence_id for r in rows], weights=[r.length for r in rows])
    assert used.max() <= 2048


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0


def _odd_documents(spark):
    """Null, shared and missing ids, null, empty, short, long and repeated texts, nulls in every
    column, extra columns with names that the operators use."""
    words = " ".join(f"w{i % 997}x{i}" for i in range(3000))
    other = " ".join(f"v{i}" for i in range(400))
    texts = [None, "", " \n ", "few words only", words, words, words + " tail", other, other + " " + words[:4000]]
    rows = [(i, t, ["en", None][i % 2], ["s1", None][i % 2], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(6, " ".join(f"u{i}" for i in range(500)), "de", "s2", 9), (7, other + " changed at its end", None, "s2", None), (None, other[::-1], "fr", "s1", 5),
             (None, words[::-1], None, None, None), rows[4], rows[0], (None, None, None, None, None)]
    extra = ("comp", 3, "kept", True, 9.5, "x")
    return spark.createDataFrame(
        [r + extra for r in rows], "doc_id long, text string, lang string, source string, n_chars long,"
        " component_id string, size int, kept string, base_failed boolean, target double, part string")


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_run_on_odd_documents(spark, tmp_path, rows):
    """Every stage keeps the columns and its invariants on the result of the stage before."""
    docs = _odd_documents(spark)
    docs = docs.limit(0) if rows == "empty" else docs
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = read(spark, str(tmp_path), "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(saved(stage(spark, seen[-1], str(tmp_path)), f"t-odd-{name}"))
        assert seen[-1].columns == docs.columns, name
    texts = [[r.text for r in x.collect()] for x in seen]
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if rows == "empty":
        assert not any(texts) and not packed
        return
    assert all(t and len(t.split()) >= 10 for t in texts[1])
    near = {(r.doc_id, r.text) for r in seen[2].collect()}
    before = seen[1].collect()
    gone = [r for r in before if (r.doc_id, r.text) not in near]
    assert {r.doc_id for r in gone} == {5, 6} and len(texts[2]) == len(before) - len(gone)
    assert len(texts[3]) == len(texts[2])
    assert sum(r.piece == 0 for r in packed) == len(texts[4])
    ends = sorted((r.sequence_id, r.offset, r.offset + r.length) for r in packed)
    assert all(a == (0 if k == 0 or ends[k - 1][0] != s else ends[k - 1][2]) and z <= 2048 for k, (s, a, z) in enumerate(ends))
