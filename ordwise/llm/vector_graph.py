"""Embedding near-dedup on a robust-pruned flat graph.

Equal vectors of a label are one class, and only class representatives are
indexed. Each label's vectors go to overlapping cluster shards (the ``OVERLAP``
nearest of about n / SHARD centroids, fitted on a bounded sample). A shard
builds a flat graph: every member's pool is its nearest members and an even
sample of the shard, robust pruning keeps a neighbour only if no kept one is
closer to it by the factor ALPHA, and reverse links are added within the shard. The
search for a vector starts at the shard's medoid, walks greedily to its neighbourhood,
and once inside widens over every neighbour within the ``EXPAND`` cosine until nothing
new is found; all that reach the threshold in double precision are links.

Vectors that share no shard are searched across the borders: the adjacency lists of all
shards are united by vector, and a vector's search goes on from what it has in range to
the neighbours of those that lie in none of its shards, and again from the links it finds
there, until a round finds none. A link whose ends share shards counts in the smallest
of these alone, so a task returns a sum a vector and a spanning set of its links for the
components, not all pairs; ``graph_links`` lists the pairs.

An audit compares the number of links of the vectors whose id is divisible by 100, in
blocks of about AUDIT, with brute force against all rows; if the mean recall of those that
have links is below RECALL the index is built again with twice the overlap, at most
twice, and if it is still short the query fails.

A shard of more than MEMBERS is cut into parts and every pair of parts is a task
of its own, so a hot neighbourhood does not meet in one task. Centroids are at
most CENTROIDS in number and are broadcast.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors with a null label, link with nothing and are their own
component; vectors of different length never link; repeated rows are links of
each other; a null id is left out of components; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.components import components
from ordwise.llm.store import read, saved

COSINE = 0.98
SHARD, OVERLAP, MEMBERS = 800, 3, 8_000
CENTROIDS, SAMPLE = 50_000, 20_000
NEAREST, STRIDE_SAMPLE, DEGREE, ALPHA = 48, 48, 32, 1.2
EXPAND, BEAM = 0.9, 24
# The least cosine of a neighbour of a vector in range that can still be a link.
WITHIN = float(np.cos(np.arccos(COSINE) + np.arccos(EXPAND)))
AUDIT, RECALL, ROUNDS = 5_000, 0.99, 2


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, part, v, h1, h2) of the vectors that can link; part is label and length."""
    x = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False))
    some = F.coalesce(F.exists("v", lambda e: e != 0), F.lit(False))
    return (x.where("label is not null").where(fine).where(some)
            .withColumn("v", F.transform("v", lambda e: e + F.lit(0.0)))
            .select("vec_id", F.concat_ws("/", F.col("label").cast("string"), F.size("v")).alias("part"), "v",
                    F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), F.reverse("v")).alias("h2")))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; starts at evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], c)
    return c


def fit_centroids(reps: DataFrame) -> dict[str, np.ndarray]:
    """Unit centroids of the parts with more than SHARD vectors, from a sample of
    at most an expected SAMPLE vectors."""
    big = reps.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > SHARD)
    big = big.orderBy(F.desc("n"), "part").limit(CENTROIDS // 2).collect()
    total = sum(r["n"] for r in big)
    if not total:
        return {}
    k = {r["part"]: max(2, min(-(-r["n"] // SHARD), CENTROIDS * r["n"] // total)) for r in big}
    share = min(1.0, SAMPLE / total)
    rows = reps.where(F.pmod("h1", F.lit(1 << 30)) < int(share * (1 << 30))).join(
        F.broadcast(reps.sparkSession.createDataFrame([(p,) for p in k], "part string")), "part").select("part", "v").collect()
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["part"], []).append(r["v"])
    return {p: _centres(_unit(np.array(x)), min(k[p], len(x))) for p, x in by.items()}


def sharded(reps: DataFrame, centres: dict[str, np.ndarray], overlap: int) -> DataFrame:
    """A row per vector and task (part, shard, i, j), with all shards of the vector: shards
    of more than MEMBERS are cut into parts, and each pair of parts i <= j is a task."""
    shared = reps.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        for b in batches:
            part, vecs = b.column(1).to_pylist(), b.column(2)
            ids, shards, sets = [], [], []
            for k, p in enumerate(part):
                c = shared.value.get(p)
                if c is None:
                    near = [0]
                else:
                    v = _unit(vecs[k].values.to_numpy()[None, :])[0]
                    near = np.argsort(-(c @ v), kind="stable")[:overlap]
                near = sorted(int(s) for s in near)
                ids += [k] * len(near)
                shards += near
                sets += [near] * len(near)
            at = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).take(at) for c in range(4)], pa.array(shards, pa.int32()), pa.array(sets, pa.list_(pa.int32()))],
                names=["vec_id", "part", "v", "size", "shard", "shards"])

    out = saved(reps.select("vec_id", "part", "v", "size").mapInArrow(
        run, "vec_id long, part string, v array<double>, size long, shard int, shards array<int>"), "graph-shards")
    cuts = out.groupBy("part", "shard").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("cuts"))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("cuts")).cast("int")
    return (out.join(cuts, ["part", "shard"]).withColumn("mine", mine)
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
            .select("vec_id", "part", "v", "size", "shard", "shards", "mine", F.least("mine", "with").alias("i"),
                    F.greatest("mine", "with").alias("j")))


def robust_prune(x: np.ndarray, pool: np.ndarray, sims: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Neighbours kept from a pool sorted by similarity: the nearest one stays
    and removes all that are nearer to it, by the factor ALPHA, than to the point."""
    dist = np.sqrt(np.maximum(0, 2 - 2 * sims))
    live = np.ones(len(pool), bool)
    between = np.sqrt(np.maximum(0, 2 - 2 * (x[pool] @ x[pool].T)))
    kept = []
    for k in range(len(pool)):
        if live[k]:
            kept.append(k)
            if len(kept) == degree:
                break
            live &= ALPHA * between[k] > dist
    return pool[kept]


def build_graph(x: np.ndarray) -> list[np.ndarray]:
    """Adjacency of a shard's unit vectors."""
    n = len(x)
    even = np.unique(np.linspace(0, n - 1, min(n, STRIDE_SAMPLE)).astype(int))
    out = []
    for a in range(0, n, 512):
        sims = x[a: a + 512] @ x.T
        for r in range(len(sims)):
            s = sims[r]
            near = np.argpartition(-s, NEAREST)[: NEAREST + 1] if n > NEAREST + 1 else np.arange(n)
            pool = np.union1d(near, even)
            pool = pool[pool != a + r]
            pool = pool[np.argsort(-s[pool], kind="stable")]
            out.append(robust_prune(x, pool, s[pool]))
    return out


def united(lists: list[np.ndarray]) -> list[np.ndarray]:
    """Each list with its reverse links."""
    back: list[list[int]] = [[] for _ in lists]
    for i, near in enumerate(lists):
        for j in near:
            back[j].append(i)
    return [np.union1d(a, np.array(b, np.int64)).astype(np.int64) for a, b in zip(lists, back)]


def range_search(x: np.ndarray, graph: list[np.ndarray], q: np.ndarray, start: int, low: float = EXPAND) -> np.ndarray:
    """Members within ``low`` of q that the search reaches from ``start``."""
    seen = np.zeros(len(x), bool)
    seen[start] = True
    ids, sims = np.array([start]), x[[start]] @ q
    done = np.zeros(len(x), bool)
    while True:  # greedy: expand the best BEAM until they are all expanded
        top = ids[np.argsort(-sims, kind="stable")[:BEAM]]
        top = top[~done[top]]
        if not len(top):
            break
        done[top] = True
        new = np.unique(np.concatenate([graph[t] for t in top]))
        new = new[~seen[new]]
        seen[new] = True
        ids, sims = np.concatenate([ids, new]), np.concatenate([sims, x[new] @ q])
    while True:  # widen: expand everything in range
        front = ids[(sims >= low) & ~done[ids]]
        if not len(front):
            return ids[sims >= low]
        done[front] = True
        new = np.unique(np.concatenate([graph[t] for t in front]))
        new = new[~seen[new]]
        seen[new] = True
        ids, sims = np.concatenate([ids, new]), np.concatenate([sims, x[new] @ q])


# What a task returns: kind LINKS, a vector's links counted here (n, by size); SPAN, a link
# (a, b) of a spanning set; EDGE, a neighbour b of a in other shards; PAIR, a link (a, b).
LINKS, SPAN, EDGE, PAIR = range(4)
FOUND = "kind int, a long, b long, n long, sa array<int>, sb array<int>"


def _search_task(pairs: bool):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, shard, i, j = key
        ids, size, mine = (pdf[c].to_numpy() for c in ("vec_id", "size", "mine"))
        x, sets = _unit(np.array(pdf["v"].tolist())), np.array(pdf["shards"].tolist())
        out = []
        if len(x) > 1:
            span, pair = [], []
            lists = build_graph(x)
            graph = united(lists)
            start = int((x @ x.mean(axis=0)).argmax())
            far, root = np.zeros(len(x), np.int64), np.arange(len(x))
            for k in range(len(x)):
                found = range_search(x, graph, x[k], start)
                near = found[(x[found] @ x[k] >= COSINE) & (ids[found] > ids[k])]
                trees, first = np.unique(root[near], return_index=True)
                other = trees != root[k]
                if other.any():
                    span += [(ids[k], m) for m in ids[near[first[other]]]]
                    root[np.isin(root, trees[other])] = root[k]
                earlier = sets[k][sets[k] < shard]
                own = ~np.isin(sets[near], earlier).any(axis=1) & ((i == j) | (mine[near] != mine[k]))
                near = near[own]
                far[k] += size[near].sum()
                far[near] += size[k]
                if pairs:
                    pair += [(ids[k], m) for m in ids[near]]
            some = far > 0
            out = [_rows(LINKS, ids[some], n=far[some]), _border_edges(ids, x, lists, sets)]
            out += [_rows(kind, *zip(*x)) for kind, x in ((SPAN, span), (PAIR, pair)) if x]
        return pd.concat(out, ignore_index=True) if out else _rows(LINKS, [])
    return run


def _rows(kind: int, a, b=None, n=None, sa=None, sb=None) -> pd.DataFrame:
    none = [None] * len(a)
    return pd.DataFrame({"kind": pd.array([kind] * len(a), "Int32"),
                         **{c: pd.array(none if x is None else np.asarray(x, np.int64), "Int64") for c, x in (("a", a), ("b", b), ("n", n))},
                         **{c: pd.Series(none if x is None else x, dtype=object) for c, x in (("sa", sa), ("sb", sb))}})


def _border_edges(ids, x, lists: list[np.ndarray], sets) -> pd.DataFrame:
    """Neighbours near enough to lead to a link, where the two lie in different shards."""
    a = np.repeat(np.arange(len(x)), [len(near) for near in lists])
    b = np.concatenate(lists)
    cross = (sets[a] != sets[b]).any(axis=1)
    a, b = a[cross], b[cross]
    near = np.einsum("ij,ij->i", x[a], x[b]) >= WITHIN
    a, b = a[near], b[near]
    return _rows(EDGE, ids[a], ids[b], sa=list(sets[a]), sb=list(sets[b]))


def search_shards(reps: DataFrame, centres: dict[str, np.ndarray], overlap: int, pairs: bool = False) -> DataFrame:
    tasks = sharded(reps, centres, overlap)
    return saved(tasks.groupBy("part", "shard", "i", "j").applyInPandas(_search_task(pairs), FOUND), "graph-found")


def _cosines(batches):
    """The rows (a, b, va, vb) that are links."""
    for batch in batches:
        n = batch.column(2).value_lengths().to_numpy()
        if len(n):
            va, vb = (batch.column(c).flatten().to_numpy() for c in (2, 3))
            at = np.cumsum(n) - n
            va, vb = (v / np.repeat(np.maximum.reduceat(np.abs(v), at), n) for v in (va, vb))
            dot, aa, bb = (np.add.reduceat(y, at) for y in (va * vb, va * va, vb * vb))
            keep = pa.array(dot / (np.sqrt(aa) * np.sqrt(bb)) >= COSINE)
            yield batch.select(["a", "b"]).filter(keep)


def border_links(reps: DataFrame, found: DataFrame) -> DataFrame:
    """Links (a, b), a < b, of vectors that share no shard, by search over the united lists.

    A vector goes from each neighbour m, in either direction, to those m lists, so a much listed
    m costs its listers times its own list, never the square of its listers.
    """
    vecs = reps.select("vec_id", "v")
    edges = found.where(F.col("kind") == EDGE).select("a", "b", "sa", "sb").distinct()
    edges = saved(edges, "graph-edges")
    hops = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"),
                                          F.col("sb").alias("sa"), F.col("sa").alias("sb"))).distinct()
    hops = hops.select(F.col("a").alias("q"), F.col("sa").alias("sq"), F.col("b").alias("m"))
    steps = edges.select(F.col("a").alias("m"), F.col("b").alias("n"), F.col("sb").alias("sn"))
    known, rounds = None, []
    while True:
        reach = hops.join(steps, "m").where(~F.arrays_overlap("sq", "sn"))
        both = reach.select(F.least("q", "n").alias("a"), F.greatest("q", "n").alias("b"),
                            F.when(F.col("q") < F.col("n"), F.col("sq")).otherwise(F.col("sn")).alias("sa"),
                            F.when(F.col("q") < F.col("n"), F.col("sn")).otherwise(F.col("sq")).alias("sb"))
        pairs = both.dropDuplicates(["a", "b"])
        if known is not None:
            pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
        pairs = saved(pairs, "graph-border-pairs")
        links = (pairs.join(vecs.select(F.col("vec_id").alias("a"), F.col("v").alias("va")), "a")
                 .join(vecs.select(F.col("vec_id").alias("b"), F.col("v").alias("vb")), "b")
                 .select("a", "b", "va", "vb").mapInArrow(_cosines, "a long, b long"))
        links = saved(links.join(pairs, ["a", "b"]), "graph-border-links")
        rounds.append(links.select("a", "b"))
        if links.limit(1).count() == 0:
            break
        known = pairs if known is None else known.unionByName(pairs)
        hops = links.select(F.col("a").alias("q"), F.col("sa").alias("sq"), F.col("b").alias("m")).unionByName(
            links.select(F.col("b").alias("q"), F.col("sb").alias("sq"), F.col("a").alias("m")))
    out = rounds[0]
    for links in rounds[1:]:
        out = out.unionByName(links)
    return out


def graph_links(reps: DataFrame, centres: dict[str, np.ndarray], overlap: int) -> DataFrame:
    """All links (a, b), a < b, that the searches find; in a dense group their number grows with its square."""
    found = search_shards(reps.withColumn("size", F.lit(1).cast("long")), centres, overlap, pairs=True)
    return found.where(F.col("kind") == PAIR).select("a", "b").unionByName(border_links(reps, found))


def graph_counts(reps: DataFrame, centres: dict[str, np.ndarray], overlap: int) -> tuple[DataFrame, DataFrame]:
    """(vec_id, far), the sizes of a vector's links summed, and links (a, b) that span the components."""
    found = search_shards(reps, centres, overlap)
    border = border_links(reps, found)
    ends = border.unionByName(border.select(F.col("b").alias("a"), F.col("a").alias("b")))
    across = ends.join(reps.select(F.col("vec_id").alias("b"), F.col("size").alias("n")), "b").select("a", "n")
    far = found.where(F.col("kind") == LINKS).select("a", "n").unionByName(across).groupBy("a").agg(F.sum("n").alias("far"))
    span = found.where(F.col("kind") == SPAN).select("a", "b").unionByName(border)
    return saved(far.select(F.col("a").alias("vec_id"), "far"), "graph-far"), span


def audit(reps: DataFrame, far: DataFrame) -> float:
    """Mean over the audit vectors that have links of the share of them found."""
    queries = reps.where("vec_id % 100 = 0")
    blocks = -(-queries.count() // AUDIT)
    parts = [_audit_block(reps, far, queries.where(F.pmod("h2", F.lit(blocks)) == k)) for k in range(blocks)]
    n = sum(count for _, count in parts)
    return sum(recall for recall, _ in parts) / n if n else 1.0


def _audit_block(reps: DataFrame, far: DataFrame, queries: DataFrame) -> tuple[float, int]:
    """Sum of the recall of the queries that have links, and their number."""
    asked: dict[str, list] = {}
    for r in queries.select("part", "vec_id", "v").collect():
        asked.setdefault(r["part"], []).append((r["vec_id"], r["v"]))
    shared = reps.sparkSession.sparkContext.broadcast(
        {p: (np.array([i for i, _ in x]), _unit(np.array([v for _, v in x]))) for p, x in asked.items()})

    def run(batches):
        total: dict[int, int] = {}
        for b in batches:
            for vec, part, v, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                if part in shared.value:
                    ids, x = shared.value[part]
                    for q in ids[(x @ _unit(v.values.to_numpy()[None, :])[0] >= COSINE) & (ids != vec)].tolist():
                        total[q] = total.get(q, 0) + size
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (total, total.values())],
                                         names=["vec_id", "n"])

    truth = reps.select("vec_id", "part", "v", "size").mapInArrow(run, "vec_id long, n long").groupBy("vec_id").agg(
        F.sum("n").alias("n"))
    each = truth.join(far, "vec_id", "left").select(
        F.least(F.lit(1.0), F.coalesce("far", F.lit(0)) / F.col("n")).alias("recall"))
    recall, n = each.agg(F.sum("recall"), F.count("*")).first()
    return recall or 0.0, n


def near_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id) of every vector."""
    good = saved(usable(vectors), "graph-vectors")
    key = ["part", "h1", "h2"]
    classes = saved(good.where("vec_id is not null").groupBy(*key).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("size")), "graph-classes")
    reps = saved(good.join(classes, key).where("vec_id = rep").dropDuplicates(["rep"]).select(
        "vec_id", "part", "v", "h1", "h2", "size"), "graph-reps")
    centres, overlap = fit_centroids(reps), OVERLAP
    for _ in range(ROUNDS + 1):
        far, span = graph_counts(reps, centres, overlap)
        recall = audit(reps, far)
        if recall >= RECALL:
            break
        overlap *= 2
    else:
        raise RuntimeError(f"op7_vector_graph: audit recall {recall:.4f} is below {RECALL} after {ROUNDS} rebuilds")
    far = far.withColumnRenamed("vec_id", "rep")
    comps = components(span).select(F.col("id").alias("rep"), "comp")
    by_class = classes.join(far, "rep", "left").join(comps, "rep", "left").select(
        *key, (F.col("size") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"),
        F.coalesce("comp", "rep").alias("component_id"))
    linked = good.where("vec_id is not null").join(by_class, key).select("vec_id", "n_links", "component_id")
    rest = vectors.select("vec_id", "label", "embedding")
    alone = _unusable(rest).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)


def _unusable(vectors: DataFrame) -> DataFrame:
    x = vectors.withColumn("v", F.col("embedding").cast("array<double>"))
    fine = F.coalesce(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False))
    some = F.coalesce(F.exists("v", lambda e: e != 0), F.lit(False))
    return x.where(F.col("label").isNull() | F.col("vec_id").isNull() | ~fine | ~some)


def q_vector_graph(spark, sf_dir):
    out = near_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ORACLE_SQL = f"""
WITH x AS (
  SELECT vec_id, label, embedding::double[] AS v, sqrt(list_inner_product(embedding::double[], embedding::double[])) AS n
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM x a JOIN x b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_inner_product(a.v, b.v) / (a.n * b.n) >= {COSINE}),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
degree AS (SELECT a, count(*) AS n FROM edges GROUP BY 1),
reach AS (
  WITH RECURSIVE r(id, low) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, r.low FROM r JOIN edges e ON r.id = e.a)
  SELECT id, min(low) AS low FROM r GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::bigint AS n_links, low AS component_id, vec_id = low AS kept
FROM embeddings LEFT JOIN degree ON vec_id = a JOIN reach ON vec_id = id"""
