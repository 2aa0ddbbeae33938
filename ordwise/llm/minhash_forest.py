"""MinHash near-duplicates by an LSH forest.

A document's set is its distinct five-word shingles. Equal sets are one class.
Class representatives get ``TREES * DEPTH`` min-hash values; tree t orders them
by the signature rotated to start at value ``DEPTH * t``. The order goes by hashes
of the first 4, 8, 16 and 32 values, each of which holds the one before, so
members that share a longer prefix stand closer together: a region is read as
deep as its members agree, however dense it is. All entries of all trees are
sorted at once over ranges of the order, so a region of any size spans as many
tasks as it needs, and neighbours across a cut are compared too. Candidates are
neighbours in the order within a region (the same first DEPTH values), those with the
longest common prefix: at first each document and the next one, and once most
of a dense group is one component, all members of different components up to ``NEAR``
apart. They grow in proportion to the documents.

Candidates whose signatures agree in less than 0.6 of the values are dropped (a
pair at the threshold is four standard deviations away). The others are confirmed
on the full sets, in three steps that keep the texts moved small:

1. each document against its most similar candidate of smaller id,
2. each component against its most similar candidate component of smaller id,
3. components that candidates still hold together, candidates now being also all
   members of different components up to NEAR apart in an order, both as they stand and
   once runs of one component are reduced to their ends, are a family: all its pairs
   between different components are compared, whether the orders name them or not.

Only connectivity is asked for, so a pair inside a component needs no check, and each
step's links join the components of the step before. Many copies of a text can be linked
to that text alone: no order puts all of them next to it, so the third step counts the
shared shingles of whole blocks of a family (:func:`family_links`). Blocks are
bounded in rows and bytes; pairs within a family's largest component are not formed. The
work of a family is the number of its members outside that component times all its
members, and is dealt over as many tasks as it has pairs of blocks. What remains open: a
document all of whose neighbours in the 32 orders agree with it in less than 0.6.

At similarity 0.75 a pair shares no region of depth DEPTH with probability (1 - 0.75^4)^32,
about 5e-6; at 0.8 it is 5e-8.

Edge cases: null or empty text has an empty set, links with nothing and is its
own component; fewer than five words are one shingle; repeated rows and copies
are one class; rows that share an id but not the text are documents of their own,
whose components have that id as a member; a null id links with nothing (null
component, kept); an empty table gives an empty result; extra columns are not
read by :func:`near_groups`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordwise.llm.components import components
from ordwise.llm.store import give_back, read, saved, tidied
from ordwise.llm.words import LOWER, combine, mix, slices, split_words, text_buffer

SHINGLE = 5
TREES, DEPTH = 32, 4
VALUES = TREES * DEPTH
NEAR = 4
LEVELS = (DEPTH, 8, 16, 32)
AGREE = int(VALUES * 0.6)
SIMILAR = (75, 100)
# A family: members dealt as one block, blocks it is dealt over at most while they are small, and bounds of a block.
WHOLE, SPREAD, BLOCK_ROWS, BLOCK_BYTES = 64, 16, 4096, 16 << 20

_RNG = np.random.default_rng(20240229)
_MUL = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within a row, and n + 1 bounds."""
    w = split_words(LOWER[buf], offsets)
    n = len(w.hash) - SHINGLE + 1
    full = np.zeros(0, np.uint64)
    if n > 0:
        full = w.hash[:n]
        for k in range(1, SHINGLE):
            full = combine(full, w.hash[k: n + k])
    sets = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= SHINGLE:
            sets.append(np.unique(full[a: b - SHINGLE + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for k in range(a, b):
                h = combine(h, w.hash[k: k + 1])
            sets.append(h)
        else:
            sets.append(full[:0])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else full), bounds


def signatures(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, VALUES) min-hash values of non-empty sets; empty ones stay all ones."""
    n = np.diff(bounds)
    out = np.full((len(n), VALUES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(n)
    if len(some):
        at = bounds[:-1][some]
        for k in range(VALUES):
            out[some, k] = np.minimum.reduceat(((flat * _MUL[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32), at)
    return out


def _sum(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.uint64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(flat, bounds[:-1][some])
    return out


SETS = "doc_id long, tie long, n_shingles long, k1 long, k2 long, sig binary"


def set_pass(docs: DataFrame) -> DataFrame:
    """Per row a hash of its text, the set's size, a 128-bit key of it, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offs = text_buffer(b.column(2))
            for i, j in slices(offs, 2 << 20):
                flat, bounds = shingle_sets(buf[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                n = np.diff(bounds)
                sig = signatures(flat, bounds)
                keys = [_sum(mix(flat ^ np.uint64(s)), bounds).view(np.int64) for s in (0x51, 0xA7)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(n), *[pa.array(k) for k in keys],
                     pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["doc_id", "tie", "n_shingles", "k1", "k2", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text").mapInArrow(tidied(run), SETS)


ORDER = [f"h{n}" for n in LEVELS] + ["id"]
ENTRY = ", ".join(f"{c} long" for c in ORDER)


def prefixes(sig: np.ndarray, tree: int) -> list[np.ndarray]:
    """Hashes of the first values of each level in the tree's order, two values at a time."""
    at = (DEPTH * tree + np.arange(LEVELS[-1])) % VALUES
    pairs = np.ascontiguousarray(sig[:, at]).view(np.uint64)
    h, out = np.full(len(sig), tree + 1, np.uint64), []
    for k in range(pairs.shape[1]):
        h = combine(h, pairs[:, k])
        if 2 * (k + 1) in LEVELS:
            out.append(h)
    return out


def entries(reps: DataFrame) -> DataFrame:
    """One row per representative and tree: its place in the tree's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(b.num_rows, VALUES)
            for t in range(TREES):
                yield pa.RecordBatch.from_arrays([*[pa.array(h.view(np.int64)) for h in prefixes(sig, t)], b.column(0)], names=ORDER)

    return reps.select("id", "sig").mapInArrow(tidied(run), ENTRY)


def sorted_pairs(rows: DataFrame, near: int, members: bool = False) -> DataFrame:
    """Distinct (a, b), a < b, of members of different components (column comp), at most
    ``near`` apart in a region's order once runs of one component are reduced to their two
    ends; with ``members`` also those at most ``near`` apart as the members stand.

    For regions of any size: all entries are sorted over ranges of the order and
    each range is read once. A range also gives its first and last few ends (and members),
    and what meets across ranges is found among those."""
    cols, border = [*ORDER, "comp"], near + 4
    at_id, at_comp = len(ORDER) - 1, len(ORDER)

    def pairs(x: np.ndarray, new: int) -> pa.RecordBatch:
        a, b = [], []
        for k in range(1, near + 1):
            at = np.arange(max(new, k), len(x))
            at = at[(x[at, 0] == x[at - k, 0]) & (x[at, at_comp] != x[at - k, at_comp])]
            a.append(x[at, at_id])
            b.append(x[at - k, at_id])
        a, b = np.concatenate(a), np.concatenate(b)
        pair = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
        none = pa.nulls(len(pair), pa.int64())
        return pa.RecordBatch.from_arrays([*[none] * at_id, pa.array(pair[:, 0]), none, pa.array(pair[:, 1])], names=[*cols, "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = head = tail = np.zeros((0, len(cols)), np.int64)  # x: the last row, whose successor is not known yet
        front = back = x
        starts, n = True, 0
        for b in batches:
            if not b.num_rows:
                continue
            new = np.column_stack([c.to_numpy() for c in b.columns])
            if members:
                both = np.concatenate([back, new])
                yield pairs(both, len(back))
                front, back = np.concatenate([front, new])[:near], both[-near:]
            x = np.concatenate([x, new])
            turn = (x[1:, 0] != x[:-1, 0]) | (x[1:, at_comp] != x[:-1, at_comp])
            first = np.concatenate([[starts], turn])
            ends = np.concatenate([tail, x[:-1][first[:-1] | turn]])
            n += len(ends) - len(tail)
            yield pairs(ends, len(tail))
            head = np.concatenate([head, ends[len(tail):]])[:border]
            x, tail, starts = x[-1:], ends[-border:], bool(first[-1])
        if len(x):
            ends = np.concatenate([tail, x])
            yield pairs(ends, len(tail))
            rim = np.unique(np.concatenate([head, ends[-min(border, max(n + 1 - len(head), 1)):], front, back]), axis=0)
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in rim.T], pa.nulls(len(rim), pa.int64())],
                                             names=[*cols, "other"])

    dealt = rows.select(*cols).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    found = saved(dealt.mapInArrow(tidied(run), ", ".join(f"{c} long" for c in [*cols, "other"])), "forest-sorted")
    inside = found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b"))
    return inside.unionByName(_across(found.where("other is null"), near, members)).distinct()


def _across(rims: DataFrame, near: int, members: bool) -> DataFrame:
    """The same pairs among the rows at the ranges' borders, by one window for each region."""
    order = Window.partitionBy(ORDER[0]).orderBy(*ORDER[1:])
    ends = (rims.withColumn("before", F.lag("comp").over(order)).withColumn("after", F.lead("comp").over(order))
            .where("before is null or after is null or comp <> before or comp <> after"))
    others = F.array(*[F.lag(F.struct("id", "comp"), k).over(order) for k in range(1, near + 1)])
    found = ends.withColumn("near", others).select("id", "comp", "near")
    if members:
        found = found.unionByName(rims.withColumn("near", others).select("id", "comp", "near"))
    return (found.select("id", "comp", F.explode("near").alias("o")).where("o.id is not null and o.comp <> comp")
            .select(F.least("id", "o.id").alias("a"), F.greatest("id", "o.id").alias("b")))


def similar(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, agree) of the pairs whose signatures agree in at least AGREE of the
    values, compared by the values' low bytes."""
    def low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, VALUES, 4)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([r.tobytes() for r in sig[:, :, 0]], pa.binary())], names=["id", "low"])

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, VALUES) for k in (2, 3))
                n = (x == y).sum(axis=1)
                at = pa.array(np.flatnonzero(n >= AGREE))
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(n).take(at)],
                                                 names=["a", "b", "agree"])

    sig = reps.select("id", "sig").mapInArrow(tidied(low), "id long, low binary")
    both = (pairs.join(sig.select(F.col("id").alias("a"), F.col("low").alias("la")), "a")
            .join(sig.select(F.col("id").alias("b"), F.col("low").alias("lb")), "b"))
    return both.select("a", "b", "la", "lb").mapInArrow(tidied(agree), "a long, b long, agree long")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = (text_buffer(b.column(k)) for k in (2, 3))
            keep = []
            for i in range(b.num_rows):
                x, y = (shingle_sets(buf[o[i]: o[i + 1]], np.array([0, o[i + 1] - o[i]]))[0] for buf, o in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both))
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)], names=["a", "b"])

    both = (pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"))
    return both.select("a", "b", "ta", "tb").mapInArrow(tidied(run), "a long, b long")


def _comp_of(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs with the components of both ends, only those that differ."""
    out = pairs
    for end, name in (("a", "ca"), ("b", "cb")):
        out = out.join(comps.select(F.col("id").alias(end), F.col("comp").alias(name)), end, "left").withColumn(
            name, F.coalesce(name, end))
    return out.where("ca <> cb")


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after these links: only the components are linked anew, members follow."""
    apart = _comp_of(links, comps)
    tops = components(apart.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    ids = comps.select("id", "comp").unionByName(tops.select("id", F.col("id").alias("comp")).join(comps, "id", "left_anti"))
    top = tops.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
    return saved(ids.join(top, "comp", "left").select("id", F.coalesce("top", "comp").alias("comp")), "forest-comps")


def link_classes(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, comp) of the representatives (id, sig) that are linked to others; texts has (id, text)."""
    forest = saved(entries(reps), "forest-entries")
    near = saved(sorted_pairs(forest.withColumn("comp", F.col("id")), 1), "forest-near")
    cand = saved(similar(near, reps), "forest-candidates")
    ids = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct()
    texts = saved(texts.join(ids, "id", "left_semi"), "forest-texts")
    first = saved(cand.groupBy("b").agg(F.max_by("a", F.struct("agree", "a")).alias("a")).select("a", "b"), "forest-1")
    comps = components(saved(confirmed(first, texts), "forest-links-1"))
    open_ = saved(_comp_of(cand.join(first, ["a", "b"], "left_anti"), comps), "forest-open")
    if open_.limit(1).count():
        best = open_.withColumn("hi", F.greatest("ca", "cb")).groupBy("hi").agg(
            F.max_by(F.struct("a", "b"), F.struct("agree", "a", "b")).alias("p")).select("p.a", "p.b")
        second = saved(best, "forest-2")
        comps = _joined(comps, saved(confirmed(second, texts), "forest-links-2"))
        first = first.unionByName(second)
    placed = forest.join(ids, "id", "left_semi").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    wide = similar(sorted_pairs(placed, NEAR, members=True).join(cand, ["a", "b"], "left_anti"), reps)
    pairs = cand.select("a", "b").unionByName(wide.select("a", "b")).join(first.withColumn("done", F.lit(1)), ["a", "b"], "left")
    held = saved(_comp_of(pairs, comps), "forest-3")
    third = saved(family_links(families(held, comps, ids), texts), "forest-links-3")
    return _joined(comps, third) if third.limit(1).count() else comps


def families(held: DataFrame, comps: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, comp, fam) of the ids in families: components that the pairs ``held`` (ca, cb, done) hold
    together, unless those done are all there are between them."""
    fams = saved(components(held.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(
        F.col("id").alias("comp"), F.col("comp").alias("fam")), "forest-families")
    members = ids.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")).join(fams, "comp").select("id", "comp", "fam")
    n = F.col("n")
    cross = members.groupBy("fam", "comp").agg(F.count("*").alias("n")).groupBy("fam").agg(
        ((F.sum("n") * F.sum("n") - F.sum(n * n)) / 2).alias("cross"))
    done = held.where("done = 1").join(fams, F.col("ca") == F.col("comp")).groupBy("fam").agg(F.count("*").alias("done"))
    open_ = saved(cross.join(done, "fam", "left").where("done is null or done < cross").select("fam"), "forest-open-families")
    return saved(members.join(open_, "fam", "left_semi"), "forest-members")


def _blocks(n, size):
    """Blocks for so many members and bytes."""
    return F.greatest(F.least(F.ceil(n / WHOLE), F.lit(SPREAD)), F.ceil(n / BLOCK_ROWS), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("long")


def dealt(members: DataFrame) -> DataFrame:
    """Members (id, comp, fam, shingles), each once for every pair (i, j) of blocks of its family that its block
    ``at`` is one of. The largest component's blocks come first and are not paired with each other."""
    sizes = members.groupBy("fam", "comp").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles")).alias("size"))
    sizes = sizes.groupBy("fam").agg(F.max_by("comp", F.struct("n", "comp")).alias("top"), F.max("n").alias("n"), F.sum("n").alias("all"),
                                     F.max_by("size", F.struct("n", "comp")).alias("size"), F.sum("size").alias("whole"))
    big = sizes.where((F.col("all") > WHOLE) | (F.col("whole") > BLOCK_BYTES)).select(
        "fam", "top", _blocks(F.col("n"), F.col("size")).alias("c"),
        _blocks(F.col("all") - F.col("n"), F.col("whole") - F.col("size")).alias("o"))
    rows = members.join(saved(big, "forest-blocks"), "fam", "left")  # written, so that a small one is broadcast and no family meets in a task
    key = "pmod(xxhash64(id), {})"
    rows = rows.withColumn("at", F.expr(f"case when top is null then 0 when comp = top then {key.format('c')} else c + {key.format('o')} end"))
    pairs = """case when top is null then array(struct(0L as i, 0L as j))
        when comp = top then transform(sequence(0L, o - 1), x -> struct(at as i, c + x as j))
        else concat(transform(sequence(0L, c - 1), x -> struct(x as i, at as j)),
                    transform(sequence(0L, o - 1), x -> struct(least(at, c + x) as i, greatest(at, c + x) as j))) end"""
    return rows.withColumn("p", F.explode(F.expr(pairs))).select("fam", "p.i", "p.j", "at", "comp", "shingles")


def shared(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that each of the sets x shares with each of y. Frequent shingles are
    counted as products of 0/1 matrices, the others pair by pair."""
    out = np.zeros((len(x), len(y)), np.int32)
    names, sides = None, []
    for sets in (x, y):
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        names = np.unique(flat) if names is None else np.intersect1d(names, flat)
        sides.append((flat, row))
    if not len(names):
        return out
    lists, n = [], []
    for flat, row in sides:
        at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
        some = names[at] == flat
        at, row = at[some], row[some]
        order = np.argsort(at, kind="stable")
        lists.append((at[order], row[order]))
        n.append(np.bincount(at, minlength=len(names)))
    often = n[0] * n[1] * 64 > len(x) * len(y)
    places = np.cumsum(often) - 1
    dense = [(places[at[often[at]]], row[often[at]]) for at, row in lists]
    for k in range(0, int(often.sum()), 1024):
        sheets = []
        for (at, row), m in zip(dense, out.shape):
            p, q = np.searchsorted(at, [k, k + 1024])
            sheet = np.zeros((m, 1024), np.float32)
            sheet[row[p:q], at[p:q] - k] = 1
            sheets.append(sheet)
        out += (sheets[0] @ sheets[1].T).astype(np.int32)
    (at, row), (_, other) = lists
    begin = np.cumsum(n[1]) - n[1]
    at, row = at[~often[at]], row[~often[at]]
    steps = np.cumsum(n[1][at])
    i = 0
    while i < len(at):
        j = max(int(np.searchsorted(steps, (steps[i - 1] if i else 0) + (1 << 20), side="right")), i + 1)
        m = n[1][at[i:j]]
        to = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(begin[at[i:j]], m)
        np.add.at(out, (np.repeat(row[i:j], m), other[to]), 1)
        i = j
    return out


def _block_links(i: int, j: int, at: np.ndarray, comp: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Links between components with a member in block i and one in block j, as a forest over the components."""
    left, right = np.flatnonzero(at == i), np.flatnonzero(at == j)
    if not len(left) or not len(right) or len(np.unique(comp)) < 2:
        return [], []
    x, y = [sets[k] for k in left], [sets[k] for k in right]
    both, found = shared(x, y), []
    n, m = (np.array([len(s) for s in z], np.int64) for z in (x, y))
    for k in range(0, len(x), 256):
        c = both[k: k + 256].astype(np.int64)
        a, b = np.nonzero((c > 0) & (SIMILAR[1] * c >= SIMILAR[0] * (n[k: k + 256, None] + m - c)) & (comp[left[k: k + 256], None] != comp[right]))
        pair = np.column_stack([comp[left[k + a]], comp[right[b]]])
        found.append(np.unique(np.sort(pair, axis=1), axis=0))
    root: dict[int, int] = {}

    def top(z: int) -> int:
        while root.get(z, z) != z:
            root[z] = z = root.get(root[z], root[z])
        return z

    out: tuple[list[int], list[int]] = ([], [])
    for a, b in np.concatenate(found).tolist():
        s, t = top(a), top(b)
        if s != t:
            root[s] = t
            out[0].append(a)
            out[1].append(b)
    return out


def family_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): components of one family that hold members whose full sets reach the similarity. Links that join
    nothing more within a pair of blocks are left out."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offs = text_buffer(b.column(3))
            for i, j in slices(offs, 2 << 20):
                flat, bounds = shingle_sets(buf[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                cells = pa.array([flat[p:q].tobytes() for p, q in zip(bounds[:-1], bounds[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(i, j - i) for k in range(3)], cells], names=["id", "comp", "fam", "shingles"])

    def links(t: pa.Table) -> pa.Table:
        cells = t.column("shingles").to_pylist()
        at, comp = t.column("at").to_numpy(), t.column("comp").to_numpy()
        a, b = _block_links(t.column("i")[0].as_py(), t.column("j")[0].as_py(), at, comp, [np.frombuffer(c, np.uint64) for c in cells])
        if t.nbytes > 1 << 20:
            give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    known = saved(members.join(texts, "id").select("id", "comp", "fam", "text").mapInArrow(
        tidied(sets), "id long, comp long, fam long, shingles binary"), "forest-shingles")
    return dealt(known).repartition("fam", "i", "j").groupBy("fam", "i", "j").applyInArrow(links, "a long, b long")


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    return tied_groups(docs).drop("tie")


def tied_groups(docs: DataFrame) -> DataFrame:
    """:func:`near_groups` with ``tie``, the hash of the row's text: rows may share an id."""
    sets = saved(set_pass(docs), "forest-sets")
    some = sets.where("n_shingles > 0 and doc_id is not null")
    # A class is a set; its number stands for it, its first row's id and text hash name its text.
    classes = saved(some.groupBy("k1", "k2", "n_shingles").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "tie")).alias("row"), F.first("sig").alias("sig")).select(
        "k1", "k2", "n_shingles", "low", F.col("row.doc_id").alias("doc_id"), F.col("row.tie").alias("tie"),
        F.monotonically_increasing_id().alias("id"), "sig"), "forest-classes")
    named = classes.select("doc_id", "tie", "id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text").join(
        named, ["doc_id", "tie"]).select("id", "text")
    comps = link_classes(classes.select("id", "sig"), texts)
    # A component is named by its least document.
    member = classes.select("k1", "k2", "n_shingles", "low", "id").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = member.groupBy("comp").agg(F.min("low").alias("component_id"))
    top = saved(member.join(least, "comp").select("k1", "k2", "n_shingles", "component_id"), "forest-top")
    full = some.select("doc_id", "tie", "n_shingles", "k1", "k2").join(top, ["k1", "k2", "n_shingles"]).select(
        "doc_id", "tie", "n_shingles", "component_id")
    bare = sets.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "tie", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(bare)


def dedup(docs: DataFrame) -> DataFrame:
    """One document of each group, the one of smallest id, with the input's columns. Rows that
    share an id are judged by their own texts; those of a group's smallest id all stay."""
    inner = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    groups = tied_groups(docs.select("doc_id", "text"))
    gone = groups.where("component_id < doc_id").select(F.col("doc_id").alias("__gone"), F.col("tie").alias("__tie")).distinct()
    out = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in inner.items()])
    same = (F.col(inner["doc_id"]).cast("long") == F.col("__gone")) & (F.xxhash64(inner["text"]) == F.col("__tie"))
    out = out.join(gone, same, "left_anti")
    return out.select(*[F.col(a).alias(c) for c, a in inner.items()])


def q_minhash_forest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM words WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id
  WHERE 100 * common >= 75 * (s.n + t.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(id, low) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.low FROM r JOIN edges e ON r.id = e.a)
  SELECT id, min(low) AS low FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::bigint AS n_shingles, low AS component_id, d.doc_id = low AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON d.doc_id = reach.id"""
