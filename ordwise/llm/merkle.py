"""Merkle manifest of a dataset with octopus multiproofs.

A leaf is the hash of a row's fields. The leaves of a language, ascending by id, are the
bottom level of its tree; every two consecutive nodes (the last may be alone) become
their hash, level by level, up to the language's subroot. The subroots, ordered by
language (null first, then bytewise), are the bottom level of the top tree.

**Places.** Leaves are dealt by ranges of (language, id, leaf), numbered inside a range,
and get the counts of earlier ranges added, so no task holds more than a range
whatever share of the rows a language has.

**Tree.** ``2 ** TIER`` consecutive nodes of a level are one group, whose task makes the
TIER levels above them; the groups' tops are the next tier's nodes. Every task holds at
most ``2 ** TIER`` nodes; the number of tiers is the logarithm of the largest tree.
All nodes go to one table (tree, level, place, digest) in the shared folder.

**Proofs.** Leaves to prove are dealt by leaf partitions of ``2 ** TIER`` consecutive
places. A partition's coordinates that are missing are, level by level, the siblings of
what it knows that it does not know itself; the union over its leaves is minimal,
since nodes that follow from its own leaves are not asked for. All partitions'
coordinates are fetched in one join with the node table, the shared interior nodes are
derived once, and each leaf's own proof is then expanded inside the partition. The path from
a subroot to the root is the same for all leaves of a language and is proved once a
language.

Edge cases: null fields hash as ``-``; null ids come first and are never tampered with;
rows that share an id are leaves of their own, ordered by their hash, and equal rows have
equal leaves but places of their own; a lone leaf is its own subroot and a lone subroot the root; a
proof without siblings is the hash of nothing; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordwise.llm.store import read, saved

TIER = 12
BROADCAST_ROWS = 200_000
TAMPER = 7
TOP = "top"


def digest(*fields: Column) -> Column:
    """Hash of fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def _h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# -- places ------------------------------------------------------------------------

def placed(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place``, 0, 1, ... per ``tree`` in ascending ``order`` (nulls first)."""
    cols = [tree, *order]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["part int", "inside long"])
    at = rows.columns.index(tree)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            runs = b.column(at).dictionary_encode()
            code = runs.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(code, prepend=code[0] - 1))
            inside = np.arange(b.num_rows) - np.repeat(starts, np.diff(np.append(starts, b.num_rows)))
            head, tail = b.column(at)[0].as_py(), b.column(at)[-1].as_py()
            if last is not None and last[0] == head:
                inside[: starts[1] if len(starts) > 1 else None] += n
            n, last = int(inside[-1]) + 1, (tail,)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(inside)],
                names=[*b.schema.names, "part", "inside"])

    dealt = saved(rows.repartitionByRange(*cols).sortWithinPartitions(*cols).mapInArrow(number, schema), name)
    # One row for each tree of a range; broadcast when counted within the bound.
    counts = saved(dealt.groupBy(F.col(tree).alias("__tree"), F.col("part").alias("__part")).agg(F.count("*").alias("n"))
                   .withColumn("before", F.sum("n").over(Window.partitionBy("__tree").orderBy("__part")) - F.col("n")),
                   f"{name}-counts")
    small = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
    return (dealt.join(small, F.col(tree).eqNullSafe(F.col("__tree")) & (F.col("part") == F.col("__part")))
            .select(*rows.columns, (F.col("inside") + F.col("before")).alias("place")))


# -- the tree ----------------------------------------------------------------------

NODES = "tree string, level int, place long, digest string"


def _climb(frame: pd.DataFrame, tier: int) -> pd.DataFrame:
    """The ``tier`` levels above the consecutive nodes of one group, as far as the tree goes."""
    tree, level = frame["tree"].iloc[0], int(frame["level"].iloc[0])
    frame = frame.sort_values("place")
    first, total = int(frame["place"].iloc[0]), int(frame["total"].iloc[0])
    nodes, out = frame["digest"].tolist(), []
    for _ in range(tier):
        if total == 1:
            break
        nodes = [_h(nodes[i: i + 2]) for i in range(0, len(nodes), 2)]
        first, level, total = first >> 1, level + 1, (total + 1) >> 1
        out.append((level, first, nodes))
    return pd.DataFrame({
        "tree": tree, "level": np.repeat([x[0] for x in out], [len(x[2]) for x in out]).astype(np.int32),
        "place": np.concatenate([x[1] + np.arange(len(x[2])) for x in out]) if out else np.zeros(0, np.int64),
        "digest": [d for x in out for d in x[2]]})


def grow(leaves: DataFrame, name: str = "merkle") -> DataFrame:
    """All nodes of the trees whose leaves are (tree, place, digest), level 0 included."""
    base = leaves.select("tree", F.lit(0).alias("level"), "place", "digest")
    sizes = saved(base.groupBy("tree").agg(F.count("*").alias("total")), f"{name}-sizes")
    tier = saved(base, f"{name}-0")
    up = TIER
    out, largest, level = tier, sizes.agg(F.max("total")).first()[0] or 0, 0
    while largest > 1:
        # Nodes of this level per tree: the leaves halved, rounded up, once a level.
        here = sizes.select("tree", F.ceil(F.col("total") / F.lit(float(1 << level))).cast("long").alias("total")).where("total > 1")
        here = F.broadcast(here) if here.count() <= BROADCAST_ROWS else here
        rows = tier.where(F.col("level") == level).join(here, "tree").withColumn("grp", F.shiftright("place", up))
        tier = saved(rows.groupBy("tree", "grp").applyInPandas(lambda f: _climb(f, up), NODES), f"{name}-{level + up}")
        out = out.unionByName(tier)
        level, largest = level + up, -(-largest >> up)
    return out


def tops(nodes: DataFrame) -> DataFrame:
    """(tree, digest) of every tree's top node."""
    return nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))


# -- proofs ------------------------------------------------------------------------

def missing(places: np.ndarray, total: int) -> list[tuple[int, int]]:
    """Coordinates (level, place) that prove these leaves of a tree of ``total`` leaves and
    follow from none of them: the siblings of what is known, level by level."""
    known, out, level = np.unique(places), [], 0
    while total > 1:
        sibling = known ^ 1
        lacking = np.setdiff1d(sibling[sibling < total], known, assume_unique=True)
        out += [(level, int(p)) for p in lacking]
        known, total, level = np.unique(known >> 1), (total + 1) >> 1, level + 1
    return out


def expand(leaves: dict[int, str], fetched: dict[tuple[int, int], str], total: int) -> dict[int, list[tuple[str, bool]]]:
    """Per leaf its siblings from the bottom up, each with whether it stands to the left;
    None stands for a level at which the node is alone. Shared interior nodes are derived once."""
    known = {(0, p): d for p, d in leaves.items()}
    known.update(fetched)
    level, at, n = 0, sorted(leaves), total
    while n > 1:
        ups = sorted({p >> 1 for p in at})
        for p in ups:
            if (level + 1, p) not in known:
                known[level + 1, p] = _h([known[level, q] for q in (2 * p, 2 * p + 1) if q < n])
        at, n, level = ups, (n + 1) >> 1, level + 1
    proofs = {}
    for p in leaves:
        proof, n, q = [], total, p
        for up in range(level):
            proof.append((known[up, q ^ 1], bool(q & 1)) if (q ^ 1) < n else None)
            n, q = (n + 1) >> 1, q >> 1
        proofs[p] = proof
    return proofs


def fold(leaf: str, proof: list) -> str:
    """The top that a leaf and its siblings lead to."""
    for step in proof:
        leaf = _h([leaf] if step is None else [step[0], leaf] if step[1] else [leaf, step[0]])
    return leaf


def prove(wanted: DataFrame, nodes: DataFrame, name: str = "merkle-proof") -> DataFrame:
    """Proofs against a node table of the leaves ``wanted`` (tree, place, digest and any
    further columns, which come along).

    ``proof`` holds one entry a level: ``L`` or ``R`` and the sibling that stands to the left or
    right, or an empty string where the node is alone. It is made where the leaf's partition
    is, so proofs themselves are not shuffled."""
    sizes = saved(nodes.where("level = 0").groupBy("tree").agg(F.count("*").alias("total")), f"{name}-sizes")
    small = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    asked = wanted.join(small, "tree").withColumn("grp", F.shiftright("place", TIER))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema] + ["proof array<string>"])
    columns = wanted.columns

    def coordinates(f: pd.DataFrame) -> pd.DataFrame:
        out = missing(f["place"].to_numpy(), int(f["total"].iloc[0]))
        return pd.DataFrame({"tree": f["tree"].iloc[0], "grp": f["grp"].iloc[0], "level": np.array([x[0] for x in out], np.int32),
                             "place": np.array([x[1] for x in out], np.int64)})

    need = asked.select("tree", "grp", "place", "total").groupBy("tree", "grp").applyInPandas(
        coordinates, "tree string, grp long, level int, place long")
    fetched = saved(need.join(nodes, ["tree", "level", "place"]), name)

    def proofs(f: pa.Table, g: pa.Table) -> pa.Table:
        places = f.column("place").to_pylist()
        got = expand(dict(zip(places, f.column("digest").to_pylist())),
                     {(a, b): d for a, b, d in zip(*[g.column(c).to_pylist() for c in ("level", "place", "digest")])},
                     f.column("total")[0].as_py()) if places else {}
        steps = {p: ["" if s is None else ("L" if s[1] else "R") + s[0] for s in x] for p, x in got.items()}
        return f.select(columns).append_column("proof", pa.array([steps[p] for p in places], pa.list_(pa.string())))

    return asked.groupBy("tree", "grp").cogroup(fetched.groupBy("tree", "grp")).applyInArrow(proofs, schema)


def folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash of all siblings and the root that a leaf leads to, for rows with a leaf and two proofs."""
    for b in batches:
        proofs = [[*x, *y] for x, y in zip(b["proof"], b["top_proof"])]
        b["proof_sha256"] = [_h([s[1:] for s in p]) for p in proofs]
        b["folded_root"] = [fold(leaf, [None if not s else (s[1:], s[0] == "L") for s in p])
                            for leaf, p in zip(b["shown"], proofs)]
        yield b.drop(columns=["proof", "top_proof", "shown"])


# -- the manifest ------------------------------------------------------------------

class Manifest:
    """Leaves with their places, the nodes of all trees, the languages' subroots and the root."""

    def __init__(self, rows: DataFrame, tree: str, order: str, leaf: str):
        """``rows`` has the tree's name (null allowed), the order and the leaf's digest."""
        self.leaf = leaf
        key = F.when(F.col(tree).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(tree)))
        self.leaves = saved(placed(rows.withColumn("tree", key), "tree", [order, leaf], "merkle-order"), "merkle-leaves")
        self.nodes = saved(grow(self.leaves.select("tree", "place", F.col(leaf).alias("digest"))), "merkle-nodes")
        # "-" sorts before "=", so the null language comes first and the others bytewise.
        ends = tops(self.nodes).select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest")
        self.subroots = saved(placed(ends, "tree", ["of"], "merkle-tops"), "merkle-subroots")
        self.top_nodes = saved(grow(self.subroots.select("tree", "place", "digest"), "merkle-top"), "merkle-top-nodes")

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """``wanted``, rows of ``leaves`` (all if None), with proof, subroot, top_proof and root."""
        inner = prove((self.leaves if wanted is None else wanted).withColumn("digest", F.col(self.leaf)), self.nodes)
        top = prove(self.subroots, self.top_nodes, "merkle-top-proof").select("place", F.col("proof").alias("top_proof"))
        ends = saved(self.subroots.select(F.col("of").alias("tree"), "place", F.col("digest").alias("subroot"))
                     .join(top, "place").drop("place").join(F.broadcast(tops(self.top_nodes).select(F.col("digest").alias("root")))),
                     "merkle-ends")
        # One row a language; broadcast when counted within the bound.
        return inner.join(F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends, "tree")


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def audited(docs: DataFrame) -> DataFrame:
    """Per document its leaf, subroot and root, the hash of its proof, and the root that
    its leaf as shown leads to: one in ``TAMPER`` is shown with another n_chars."""
    docs = docs.select(*FIELDS)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    fields = {c: F.col(c) for c in FIELDS}
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", digest(*fields.values()).alias("leaf"),
        F.when(changed & F.col("n_chars").isNotNull(),
               digest(*{**fields, "n_chars": F.col("n_chars") + 1}.values())).alias("tampered"))
    m = Manifest(rows, "lang", "doc_id", "leaf")
    out = m.proofs().select("doc_id", "leaf", "subroot", "root", F.coalesce("tampered", "leaf").alias("shown"), "proof",
                            "top_proof").mapInPandas(
        folded, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def q_merkle_manifest(spark, sf_dir):
    return audited(read(spark, sf_dir, "documents"))


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"


def _leaf(n: str = "n_chars") -> str:
    return "sha256(" + " || ".join(_field(c if c != "n_chars" else n) for c in FIELDS) + ")"


# crc32 of the decimal id, bit by bit: DuckDB has no such function.
_CRC = ("(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), "
        "lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(1, 9)), "
        "lambda r, i: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384::bigint ELSE 0::bigint END))))")

_TREE = """SELECT tree, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(total) + 1) // 2
  FROM {t} WHERE total > 1 GROUP BY tree, level, place // 2"""

ORACLE_SQL = f"""
WITH RECURSIVE
d AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS total FROM (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, lang, {_leaf()} AS leaf,
    CASE WHEN xor({_CRC}, 4294967295) % {TAMPER} = 0 AND n_chars IS NOT NULL THEN {_leaf("(n_chars + 1)")} END AS tampered
  FROM documents)),
nodes(tree, level, place, digest, total) AS (
  SELECT tree, 0, place, leaf, total FROM d UNION ALL {_TREE.format(t="nodes")}),
subs AS MATERIALIZED (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS total
  FROM nodes WHERE total = 1),
top(tree, level, place, digest, total) AS (
  SELECT 'top', 0, place, digest, total FROM subs UNION ALL {_TREE.format(t="top")}),
-- Every leaf's node path: within its language, then within the top tree.
steps AS MATERIALIZED (
  SELECT d.tree, d.place AS leaf, n.level AS lvl, n.place AS p, s.digest AS sibling, s.place < n.place AS is_left
  FROM d JOIN nodes n ON n.tree = d.tree AND n.place = d.place >> n.level AND n.total > 1
  LEFT JOIN nodes s ON s.tree = n.tree AND s.level = n.level AND s.place = xor(n.place, 1)
  UNION ALL
  SELECT d.tree, d.place, 1000 + n.level, n.place, s.digest, s.place < n.place
  FROM d JOIN subs ON subs.tree = d.tree JOIN top n ON n.place = subs.place >> n.level AND n.total > 1
  LEFT JOIN top s ON s.level = n.level AND s.place = xor(n.place, 1)),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree, leaf ORDER BY lvl) AS k FROM steps),
climb(tree, leaf, k, h) AS (
  SELECT tree, place, 0, coalesce(tampered, leaf) FROM d
  UNION ALL
  SELECT c.tree, c.leaf, c.k + 1, sha256(CASE WHEN sibling IS NULL THEN h WHEN is_left THEN sibling || h ELSE h || sibling END)
  FROM climb c JOIN ranked r ON r.tree = c.tree AND r.leaf = c.leaf AND r.k = c.k + 1),
ends AS (SELECT tree, leaf, max_by(h, k) AS folded_root FROM climb GROUP BY 1, 2),
proofs AS (SELECT tree, leaf, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256 FROM ranked GROUP BY 1, 2),
root AS (SELECT digest AS root FROM top WHERE total = 1)
SELECT doc_id, d.leaf, subs.digest AS subroot, root.root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = root.root AS verified
FROM d JOIN subs USING (tree) JOIN ends ON ends.tree = d.tree AND ends.leaf = d.place
LEFT JOIN proofs p ON p.tree = d.tree AND p.leaf = d.place, root"""
