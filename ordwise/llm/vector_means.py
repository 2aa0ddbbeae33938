"""Centroid clustering by equal-average equal-variance nearest-neighbour search.

Vectors of exactly ``DIMS`` finite components become integers, floor(256 * x).
Of d-dimensional integer vectors x and c with component sums S and
squared deviations V^2 = sum(x^2) - S^2 / d,

    distance^2 >= (Sx - Sc)^2 / d + (Vx - Vc)^2,

and the first term alone is the equal-average bound. So centroids are sorted by
their sum (their mean), a vector starts at its own place in that order and looks
outward in both directions: a direction ends once the first term exceeds the
best distance so far, a centroid is passed over if both terms do, and only what
is left is measured, in exact integers. The tests are in doubles with a margin
above their error, so no nearest centroid is lost, and ties go to the smaller number.

The vectors are quantised once and written out. Every round is one pass over them
with the centroids in its closure (k rows of DIMS numbers); a task adds up its
vectors per cluster and emits k * (DIMS + 1) sums at most, so a cluster that
holds any share of the rows costs nothing extra, and the driver reads k * (DIMS + 1)
exact sums.

Edge cases: null vectors, other lengths, null or non-finite components are left out,
and so are vectors with a component of absolute value beyond ``LIMIT`` / 256, since their
squared distances do not fit the result's 64 bits (a sum that does not is null); fewer vectors than ``K`` start as many centroids; a null
vec_id is clustered but starts no centroid (without any id the result is empty); rows that share an id are vectors of their
own, ordered by their components; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.store import read, saved

DIMS = 64
K = 40
ROUNDS = 5
SCALE = 256
LIMIT = 1 << 27
BLOCK = 4096
SAFE = 1 - 1e-9


def quantised(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """(vec_id, q array<bigint>) of the vectors that are kept."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) <= LIMIT, F.lit(False)))
    return vectors.where((F.size("embedding") == dims) & fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("q"))


def matrix(col: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow list column whose lists all have ``dims`` items."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


@dataclass
class Centroids:
    """Centroids sorted by component sum; ``number`` is each one's own number."""

    points: np.ndarray
    number: np.ndarray
    sums: np.ndarray
    spread: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Centroids:
        sums = points.sum(axis=1)
        order = np.argsort(sums, kind="stable")
        p = points[order]
        return cls(p, order, sums[order], deviation(p))


def deviation(x: np.ndarray) -> np.ndarray:
    """V of each row: the root of the squared deviations from the row's mean."""
    y = x.astype(np.float64)
    return np.sqrt(((y - y.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))


def nearest(x: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, exact squared distance) of each row, and how many
    distances were measured."""
    n, d = x.shape
    k = len(c.number)
    sums, spread = x.sum(axis=1), deviation(x)
    start = np.searchsorted(c.sums, sums)
    best = np.full(n, np.iinfo(np.int64).max)
    who = np.full(n, k, np.int64)
    measured = 0

    def look(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Compare rows with the centroids at these places; returns the rows that go on in this direction."""
        nonlocal measured
        mean = (sums[rows] - c.sums[at]).astype(np.float64) ** 2 / d
        on = mean * SAFE - 1 <= best[rows]
        rows, at, mean = rows[on], at[on], mean[on]
        close = (mean + (spread[rows] - c.spread[at]) ** 2) * SAFE - 1 <= best[rows]
        r, a = rows[close], at[close]
        measured += len(r)
        diff = x[r] - c.points[a]
        dist = np.einsum("ij,ij->i", diff, diff)
        win = (dist < best[r]) | ((dist == best[r]) & (c.number[a] < who[r]))
        best[r[win]], who[r[win]] = dist[win], c.number[a[win]]
        return rows

    up = down = np.arange(n)
    for step in range(k):
        up = up[start[up] + step < k]
        if len(up):
            up = look(up, start[up] + step)
        down = down[start[down] - 1 - step >= 0]
        if len(down):
            down = look(down, start[down] - 1 - step)
        if not len(up) and not len(down):
            break
    return who, best, measured


def first_centroids(kept: DataFrame, k: int = K, salt: str = "2:") -> np.ndarray:
    """The k vectors of smallest hash, one top-k of k rows."""
    rows = (kept.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256))
            .orderBy("h", "q").limit(k).collect())
    return np.array([r["q"] for r in rows], np.int64).reshape(len(rows), len(rows[0]["q"]) if rows else 0)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        for i in range(0, b.num_rows, BLOCK):
            part = b.slice(i, BLOCK)
            yield part.column(0), matrix(part.column(1), dims)


def moved(kept: DataFrame, points: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floor of the mean of each non-empty cluster."""
    k, dims = points.shape
    c = Centroids.of(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for _, x in _blocks(batches, dims):
            who = nearest(x, c)[0]
            order = np.argsort(who, kind="stable")
            at = np.flatnonzero(np.diff(who[order], prepend=-1))
            total[who[order][at], :dims] += np.add.reduceat(x[order], at, axis=0)
            total[:, dims] += np.bincount(who, minlength=k)
        some = np.flatnonzero(total[:, dims])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, dims + 1)), pa.array(np.tile(np.arange(dims + 1), len(some))), pa.array(total[some].ravel())],
            names=["cluster", "place", "part"])

    sums = (kept.select("vec_id", "q").mapInArrow(run, "cluster long, place long, part long")
            .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    total = {(r["cluster"], r["place"]): int(r["total"]) for r in sums}
    out = points.copy()
    for j in range(k):
        n = total.get((j, dims), 0)
        if n:
            out[j] = [total[j, i] // n for i in range(dims)]
    return out


def fit(kept: DataFrame, k: int = K, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds, by number."""
    points = first_centroids(kept, k)
    for _ in range(rounds if len(points) else 0):
        points = moved(kept, points)
    return points


def assign(kept: DataFrame, points: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    c, dims = Centroids.of(points), points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, dims):
            who, dist, _ = nearest(x, c)
            yield pa.RecordBatch.from_arrays([ids, pa.array(who.astype(np.int32)), pa.array(dist)],
                                             names=["vec_id", "cluster", "distance"])

    return kept.select("vec_id", "q").mapInArrow(run, "vec_id long, cluster int, distance long")


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """One row a kept vector: its cluster, squared distance, the sums of both, and its centroid's hash."""
    spark = vectors.sparkSession
    kept = saved(quantised(vectors, dims), "means-vectors")
    points = fit(kept, k, rounds)
    if not len(points):
        return spark.createDataFrame([], RESULT)
    rows = saved(assign(kept, points), "means-assigned")
    of = rows.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    digests = spark.createDataFrame(
        [(j, hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest()) for j, p in enumerate(points)],
        "cluster int, centroid_sha256 string")
    inertia = of.agg(F.try_sum("cluster_inertia").alias("inertia"))
    # k rows at most.
    facts = saved(of.join(F.broadcast(digests), "cluster").join(F.broadcast(inertia)), "means-clusters")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def q_vector_means(spark, sf_dir):
    return clusters(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _oracle() -> str:
    dist = "list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.p[i]) * (v.q[i] - c.p[i])))::bigint"
    floor = "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT row, vec_id, q, best.j AS j, best.d AS d FROM (
  SELECT v.row, any_value(v.vec_id) AS vec_id, any_value(v.q) AS q, min({{'d': {dist}, 'j': c.j}}) AS best FROM v, c{r} c GROUP BY v.row))""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS MATERIALIZED (SELECT j, list(s ORDER BY i) AS p FROM (SELECT j, i, {floor}::bigint AS s FROM (
  SELECT j, unnest(q) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY j, i) GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.p, c.p) AS p FROM c{r} c LEFT JOIN m{r} m USING (j))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id::varchar), q) - 1)::int AS j, q AS p FROM v
  WHERE vec_id IS NOT NULL ORDER BY j LIMIT {K}),{",".join(steps)},
t AS (SELECT j, sum(d)::bigint AS s FROM a{ROUNDS} GROUP BY j)
SELECT vec_id, a.j::int AS cluster, d AS distance, t.s AS cluster_inertia, (SELECT sum(s)::bigint FROM t) AS inertia,
  sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN t USING (j) JOIN c{ROUNDS} c USING (j)"""


ORACLE_SQL = _oracle()
