"""Spot signatures, Merkle manifest and centroid clustering against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordwise.llm import merkle, spot_sigs, vector_means
from ordwise.llm.store import ship
from tests.conftest import plan_text
from tests.llm.test_operators import _docs, _words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, comp long"


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark)


# -- spot signatures -----------------------------------------------------------------

def _py_words(text):
    return [w for w in re.split(r"[^\w]|_", text.lower()) if w]


def _py_sigs(text, anchors):
    ws = _py_words(text)
    content = [w for w in ws if w not in anchors]
    at = [i for i, w in enumerate(ws) if w in anchors]
    if at:
        chains = [[ws[p], *content[p - j: p - j + spot_sigs.CHAIN]] for j, p in enumerate(at)]
    elif ws:
        chains = [ws[i: i + spot_sigs.CHAIN] for i in range(len(ws))]
    else:
        chains = [[text]] if text else []
    return sorted({hashlib.md5(" ".join(c).encode()).hexdigest()[:8] for c in chains})


def _py_like(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_spot_signatures_brute(spark, docs):
    anchors = spot_sigs.find_anchors(docs)
    rows = docs.collect()
    count, langs = {}, {}
    for r in rows:
        for w in _py_words(r["text"] or ""):
            count[r["lang"], w] = count.get((r["lang"], w), 0) + 1
            langs[r["lang"]] = langs.get(r["lang"], 0) + 1
    total = sum(langs.values())
    assert anchors == sorted({w for (lang, w), n in count.items() if langs[lang] * spot_sigs.LANG_SHARE >= total
                              and n * spot_sigs.ANCHOR_SHARE >= langs[lang]})
    got = [(r["doc_id"], r["fingerprint"]) for r in spot_sigs.fingerprints(docs, ["one", "tail", "b"]).collect()]
    want = [(r["doc_id"], ",".join(_py_sigs(r["text"] or "", {"one", "tail", "b"}))) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_spot_next_and_edges(spark, docs):
    """Shared ids, null ids, repeated rows: the next different document, null ids last."""
    rows = [(5, "the cat sat on the mat and ran"), (5, "the cat sat on the mat and ran"), (5, "another text"), (9, None), (2, ""),
            (None, "no id here at all"), (None, "no id either"), (-3, "é" * 7)]
    frame = spark.createDataFrame([(i, t, "en", "extra") for i, t in rows], "doc_id long, text string, lang string, next_start string")
    out = spot_sigs.compared(frame).collect()
    assert len(out) == len(rows)
    key = lambda r: (r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"])
    assert len({key(r) for r in out}) == len(set(rows))
    nxt = {r["doc_id"]: r["next_doc_id"] for r in out if r["doc_id"] in (9, 2)}
    assert nxt == {9: 5, 2: -3}
    assert {r["next_doc_id"] for r in out if r["doc_id"] == 5} == {5, 2}
    assert {r["next_doc_id"] for r in out if r["doc_id"] is None} == {None, 9}
    for r in out:
        if r["doc_id"] == 9:
            assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"]) == (0, "", "", 1.0)
    lone = spot_sigs.compared(frame.where("doc_id = -3")).first()
    assert lone["next_doc_id"] == -3 and lone["near_next"] == 1.0
    assert lone["edited_sha256"] == hashlib.sha256(("é" * 5 + "é" * 2).encode()).hexdigest()
    assert spot_sigs.compared(frame.where("doc_id = 77")).count() == 0


def test_spot_compared_brute_over_many_ranges(spark):
    r = random.Random(3)
    texts = [_words(i, r.randint(0, 90)) + (" the" if i % 3 else "") for i in range(120)]
    ids = r.sample(range(-500, 5000), 120)
    frame = spark.createDataFrame([(i, t, "en") for i, t in zip(ids, texts)], "doc_id long, text string, lang string").repartition(7)
    anchors = set(spot_sigs.find_anchors(frame))
    order = sorted(zip(ids, texts), reverse=True)
    want = {}
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        m = len(t) // 3
        e = t[: len(t) - m] + nxt[:m]
        own, ed = _py_sigs(t, anchors), _py_sigs(e, anchors)
        want[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), ",".join(own), ",".join(ed), _py_like(own, ed),
                   _py_like(own, _py_sigs(nxt, anchors)))
    got = {r[0]: tuple(r)[1:7] for r in spot_sigs.compared(frame).collect()}
    assert got == want


def test_spot_search_brute(spark):
    r = random.Random(8)
    base = [_words(i, 60).split() for i in range(30)]
    texts = []
    for i in range(150):
        w = list(base[i % 30])
        for _ in range(r.randint(0, 8)):
            w[r.randrange(len(w))] = "new" + str(r.randrange(50))
        texts.append(" ".join(w[: r.randint(45, 60)]))
    texts += [texts[0]] * 5 + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    prints = spot_sigs.fingerprints(docs, ["a", "b"])
    sets = {i: _py_sigs(t or "", {"a", "b"}) for i, t in enumerate(texts)}
    want = {(q, d) for q in range(0, len(texts), 10) for d in sets if sets[q] and sets[d] and _py_like(sets[q], sets[d]) >= 0.75}
    got = spot_sigs.search(prints.where("doc_id % 10 = 0"), prints).collect()
    assert len(got) == len(want) and {(g["query_id"], g["doc_id"]) for g in got} == want
    for g in got:
        assert g["likeness"] == pytest.approx(_py_like(sets[g["query_id"]], sets[g["doc_id"]]))


def test_spot_sigs_plan_is_native_and_deals_texts_once(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(spot_sigs.compared(docs), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for op in ("Python", "Arrow", "Pandas", "CartesianProduct"):
        assert op not in plan
    dealt = re.findall(r"Exchange hashpartitioning\(k1#\d+L, k2#\d+L, \d+\), REPARTITION_BY_COL", plan)
    assert len(dealt) == 2  # the same rows and columns: one is reused when the plan runs
    scans = set(re.findall(r"ReadSchema: (struct<doc_id[^ ]*)", plan))
    assert len(scans) <= 1


# -- Merkle manifest -------------------------------------------------------------------

def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _py_leaf(r, n_chars=None):
    vals = [r["doc_id"], r["source"], r["lang"], r["n_chars"] if n_chars is None else n_chars, r["text"]]
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def _py_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([_sha("".join(x[i: i + 2])) for i in range(0, len(x), 2)])
    return levels


def _py_proof(levels, at):
    out = []
    for x in levels[:-1]:
        s = at ^ 1
        out.append((x[s], s < at) if s < len(x) else None)
        at >>= 1
    return out


def _py_audit(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, members = {}, {}
    for lang in langs:
        members[lang] = sorted((r for r in rows if r["lang"] == lang),
                               key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _py_leaf(r)))
        trees[lang] = _py_tree([_py_leaf(r) for r in members[lang]])
    top = _py_tree([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(members[lang]):
            proof = _py_proof(trees[lang], i) + _py_proof(top, k)
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            h = _py_leaf(r, r["n_chars"] + 1) if bad else _py_leaf(r)
            for s in proof:
                h = _sha(h if s is None else s[0] + h if s[1] else h + s[0])
            out.append((r["doc_id"], _py_leaf(r), trees[lang][-1][0], top[-1][0], _sha("".join(s[0] for s in proof if s)), h,
                        h == top[-1][0]))
    return sorted(out, key=str)


def test_merkle_brute_with_edges(docs):
    assert sorted(map(tuple, merkle.audited(docs).collect()), key=str) == _py_audit(docs.collect())
    one = docs.where("doc_id = 4")
    assert sorted(map(tuple, merkle.audited(one).collect()), key=str) == _py_audit(one.collect())
    assert merkle.audited(docs.where("doc_id = 1000")).count() == 0


def test_merkle_small_tiers_and_a_hot_language(spark, monkeypatch):
    """Several tiers, trees of odd sizes, a language with most rows, ranges that cut a language."""
    monkeypatch.setattr(merkle, "TIER", 2)
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 0)
    ship(spark)
    rows = [(i, f"t{i % 17}", "hot" if i % 10 else f"l{i % 70}", "s", i % 5, 0, "x", 1) for i in range(467)]
    frame = spark.createDataFrame(rows + rows[:3], SCHEMA).repartition(9)
    assert sorted(map(tuple, merkle.audited(frame).collect()), key=str) == _py_audit(frame.collect())


@pytest.mark.parametrize("total", [1, 2, 3, 7, 8, 21, 64])
def test_multiproof_is_minimal_and_sufficient(total):
    r = random.Random(total)
    leaves = [_sha(str(i)) for i in range(total)]
    levels = _py_tree(leaves)
    for n in {1, 2, total // 2 or 1, total}:
        asked = sorted(r.sample(range(total), min(n, total)))
        need = merkle.missing(np.array(asked), total)
        # Nothing asked for follows from the leaves, and every single coordinate is needed.
        inner = {(lv, p >> lv) for lv in range(len(levels)) for p in asked}
        assert not inner & set(need) and len(need) == len(set(need))
        proofs = merkle.expand({p: leaves[p] for p in asked}, {(a, b): levels[a][b] for a, b in need}, total)
        for p in asked:
            assert proofs[p] == _py_proof(levels, p)
            assert merkle.fold(leaves[p], proofs[p]) == levels[-1][0]
        for gone in need:
            with pytest.raises(KeyError):
                merkle.expand({p: leaves[p] for p in asked}, {(a, b): levels[a][b] for a, b in need if (a, b) != gone}, total)


def test_merkle_proofs_of_some_leaves(spark, docs):
    m = merkle.Manifest(docs.select("doc_id", "lang", merkle.digest(F.col("doc_id"), F.col("text")).alias("leaf")), "lang", "doc_id", "leaf")
    some = m.proofs(m.leaves.where("doc_id % 4 = 1")).collect()
    assert {r["doc_id"] for r in some} == {1, 5, 9, 13}
    for r in some:
        steps = [None if not s else (s[1:], s[0] == "L") for s in [*r["proof"], *r["top_proof"]]]
        assert merkle.fold(r["leaf"], steps) == r["root"]


# -- centroid clustering -----------------------------------------------------------------

def _py_means(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == vector_means.DIMS and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(((_sha(f"2:{i}"), q) for i, q in kept if i is not None))[:k]
    cent = [q for _, q in first]

    def best(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(cent))

    for _ in range(rounds):
        who = [best(q)[1] for _, q in kept]
        for j in range(len(cent)):
            mine = [q for (_, q), w in zip(kept, who) if w == j]
            if mine:
                cent[j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [(i, *best(q)) for i, q in kept]
    of = {}
    for _, d, j in last:
        of[j] = of.get(j, 0) + d
    return sorted([(i, j, d, of[j], sum(of.values()), _sha(",".join(map(str, cent[j])))) for i, d, j in last], key=str)


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def _vectors(spark, n=300, spread=1.0, seed=4):
    r = random.Random(seed)
    f = lambda: float(np.float32(r.gauss(0, spread)))
    rows = [(i, [f() for _ in range(64)], 1, "x", "y") for i in range(n)]
    rows += [(900, None, 1, "x", "y"), (901, [], 1, "x", "y"), (902, [1.0] * 63, 1, "x", "y"), (903, [1.0] * 63 + [None], 1, "x", "y"),
             (904, [float("nan")] * 64, 1, "x", "y"), (905, [float("inf")] * 64, 1, "x", "y"), (906, [0.0] * 64, None, "x", "y"),
             (None, [0.5] * 64, 1, "x", "y"), rows[0], rows[0], (1, [0.25] * 64, 1, "x", "y")]
    return spark.createDataFrame(rows, VECTORS)


def test_vector_means_brute_with_edges(spark):
    ship(spark)
    v = _vectors(spark)
    want = _py_means([(r["vec_id"], r["embedding"]) for r in v.collect()], 40, 5)
    assert sorted(map(tuple, vector_means.clusters(v).collect()), key=str) == want


def test_vector_means_few_vectors_ties_and_empty(spark):
    same = spark.createDataFrame([(i, [0.5] * 64, 1, "x", "y") for i in range(5)], VECTORS)
    out = vector_means.clusters(same).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in out} == {(0, 0, 0)} and len(out) == 5
    assert vector_means.clusters(same.where("vec_id = 50")).collect() == []
    huge = spark.createDataFrame([(1, [3e38] * 64, 1, "x", "y"), (2, [-500000.0] * 64, 1, "x", "y"), (3, [500000.0] * 64, 1, "x", "y")], VECTORS)
    assert {r["vec_id"]: r["distance"] for r in vector_means.clusters(huge).collect()} == {2: 0, 3: 0}


def test_nearest_is_exact_and_prunes():
    rng = np.random.default_rng(1)
    points = rng.integers(-300, 300, (200, 64)) + rng.integers(-2000, 2000, (200, 1))
    x = points[rng.integers(0, 200, 3000)] + rng.integers(-40, 40, (3000, 64))
    x[:50], points[7] = points[9], points[9]  # ties go to the smaller number
    who, dist, measured = vector_means.nearest(x, vector_means.Centroids.of(points))
    full = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (who == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()
    assert measured < 0.1 * full.size
