"""Exact substring dedup by bucket-pointer refinement of sampled suffixes.

A byte goes if a ``SPAN``-byte string over it also starts earlier: in a document
of smaller id, or in the same document further left.

Suffixes are put in buckets by their first q bytes, and buckets are refined by
the bucket identifiers of later offsets: the identifier of the first 2k bytes is
made from those of k bytes at the offset and k bytes further on, so each
refinement reuses the one before (2, 4, 8, 16, 32, 64 bytes, then SPAN).
Identifiers are hashes of their strings and not ranks, so all executors agree on
them without a global sort. Only sampled suffixes are sorted: every window of
SPAN bytes names the suffix in it whose 32-byte bucket is least (leftmost on
ties), so equal windows name equal suffixes at equal offsets, and about one
suffix in 35 is kept, with the run of windows that name it.

1. A suffix goes to its 32-byte bucket; buckets of one member are final.
2. Within a bucket, members are sorted by the identifier of their whole run (its
   first and last SPAN bytes) and by position. All but the first of equal runs
   are covered. A first one is refined further only if the bucket has others.
3. Those runs fall into blocks of up to BLOCK windows at fixed distances from the
   suffix, and the blocks into buckets of the bytes that all windows of a block
   share. Equal blocks and lone blocks are settled as in step 2.
4. What is left falls into single windows, keyed by the identifiers of SPAN
   bytes; all but the first of equal windows are covered.
5. Covered windows are merged by document, and their bytes go.

Hot strings are combined before each shuffle: of equal runs (windows) in one
batch of text only the first travels under its key, the others are already known
to be covered; and of the different runs that share a bucket, only two travel
under the bucket and the rest under their own identifiers, marked for the next
step; the last one is exact by itself. So no key meets more than two rows a batch.

Keys have 128 bits and are not compared as text. Edge cases: null text is empty;
a null id orders after all others; rows that share an id (or have none) but not the
text are documents of their own, ordered by a hash of the text; rows equal in both are one
document for the order, so copies of a row do not remove each other; texts shorter than SPAN stay;
a text of any length is read in segments; an empty table gives an empty result;
other columns are not read, and :func:`apply_dedup` keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordwise.llm.merkle import placed
from ordwise.llm.store import read, saved, tidied
from ordwise.llm.words import combine, mix, slices, text_buffer

SPAN = 100
GRAM = 32
REACH = SPAN - GRAM + 1
BLOCK = 8
CORE = SPAN - BLOCK + 1
SEGMENT = 2 << 20
BATCH_BYTES = 32 << 20
LAST_ID = (1 << 63) - 1

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MUL = np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


def _refine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifiers of a longer prefix from those at the offset and at a later one."""
    x = a * _MUL
    x += b
    x ^= x >> np.uint64(31)
    x *= _MUL
    x ^= x >> np.uint64(29)
    return x


def bucket_ids(buf: np.ndarray) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]:
    """Identifiers of 4, 32 and 64 bytes, and two of SPAN bytes, at every offset
    that has them."""
    level = {1: _BYTE[buf]}
    k = 1
    while k < 64:
        level[2 * k] = _refine(level[k][:-k], level[k][k:])
        if k not in (4, 32):
            del level[k]
        k *= 2
    n = len(buf) - SPAN + 1
    whole = _refine(_refine(level[64][:n], level[32][64: 64 + n]), level[4][96: 96 + n])
    other = _refine(_refine(level[4][:n], level[64][36: 36 + n]), level[32][4: 4 + n])
    return level, whole, other


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    rest = width - k
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def runs(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, n, off, bucket, run) of the sampled suffixes' runs of windows:
    start is the first window's offset within its row, n their number, off how
    far the suffix is from it."""
    size = np.diff(offsets)
    z = np.zeros(0, np.int64)
    if not len(size) or size.max() < SPAN:
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    level, whole, _ = bucket_ids(buf)
    gram = level[GRAM]
    key = (mix(gram) & _HIGH) | np.arange(len(gram), dtype=np.uint64)
    at = (_sliding_min(key, REACH) & _LOW).astype(np.int64)
    valid = np.zeros(len(at) + 1, bool)
    for a, b in zip(offsets[:-1], offsets[1:] - SPAN + 1):
        if b > a:
            valid[a:b] = True
    valid = valid[:-1]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    lo = np.flatnonzero(first)
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (at[1:] != at[:-1])
    hi = np.flatnonzero(last)
    row = np.searchsorted(offsets, lo, side="right") - 1
    run = combine(combine(whole[lo], whole[hi]), (hi - lo).astype(np.uint64))
    return row, lo - offsets[row], hi - lo + 1, at[lo] - lo, gram[at[lo]], run


def units(offsets: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, byte bounds, start within the row) of pieces of about ``limit``
    bytes: several whole rows, or a segment of a long one that overlaps the next
    by SPAN - 1 bytes."""
    for i, j in slices(offsets, limit):
        if j - i > 1 or offsets[j] - offsets[i] <= 2 * limit:
            yield i, offsets[i: j + 1], np.zeros(j - i, np.int64)
        else:
            for a in range(int(offsets[i]), int(offsets[j]) - SPAN + 1, limit):
                b = min(a + limit + SPAN - 1, int(offsets[j]))
                yield i, np.array([a, b]), np.array([a - offsets[i]])


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*parts)]


def _starts(*keys: np.ndarray) -> np.ndarray:
    """True where a sorted run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _later(group: np.ndarray, doc: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """In rows sorted by group, doc, lo: which are strictly later than their group's first."""
    first = np.flatnonzero(group)[np.cumsum(group) - 1]
    return (doc != doc[first]) | (lo != lo[first])


def _merged(doc: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window ranges of each document that touch, as one."""
    order = np.lexsort((lo, doc))
    doc, lo, end = doc[order], lo[order], (lo + n)[order]
    if not len(doc):
        return doc, lo, n
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > end[:-1])
    at = np.flatnonzero(new)
    return doc[at], lo[at], np.maximum.reduceat(end, at) - lo[at]


ROW = "key long, bucket long, run long, doc long, lo long, n long, off int, state int"
COVERED, ALONE, SHARED = 1, 0, 2


def _rows(key, bucket, run, doc, lo, n, off, state) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (key, bucket, run, doc, lo, n)]
        + [pa.array(x.astype(np.int32)) for x in (off, state)],
        names=["key", "bucket", "run", "doc", "lo", "n", "off", "state"])


def _known(doc, lo, n) -> pa.RecordBatch:
    """Rows that are covered already; their key only spreads them."""
    doc, lo, n = _merged(doc, lo, n)
    zero = np.zeros(len(doc), np.uint64)
    return _rows(mix(doc.view(np.uint64) + lo.astype(np.uint64)), zero, zero, doc, lo, n, zero,
                 np.full(len(doc), COVERED))


def combined_runs(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch of text, equal runs met."""
    doc, lo, n, off, bucket, run = _joined(parts)
    order = np.lexsort((lo, doc, run, bucket))
    doc, lo, n, off, bucket, run = (x[order] for x in (doc, lo, n, off, bucket, run))
    new_run, new_bucket = _starts(bucket, run), _starts(bucket)
    later = _later(new_run, doc, lo) if len(doc) else new_run
    yield _known(doc[later], lo[later], n[later])
    doc, lo, n, off, bucket, run, new_run, new_bucket = (
        x[~later] for x in (doc, lo, n, off, bucket, run, new_run, new_bucket))
    if not len(doc):
        return
    group = np.cumsum(new_bucket) - 1
    n_runs = np.bincount(group, weights=new_run)[group]
    nr = np.cumsum(new_run)
    nr_in = nr - nr[np.flatnonzero(new_bucket)][group]
    inner = (nr_in > 0) & (nr_in < n_runs - 1)
    key = np.where(inner, combine(bucket, run), bucket)
    yield _rows(key, bucket, run, doc, lo, n, off, np.where(n_runs > 1, SHARED, ALONE))


def combined_windows(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The single windows of a batch of text, equal windows met."""
    doc, lo, whole, other = _joined(parts)
    order = np.lexsort((lo, doc, other, whole))
    doc, lo, whole, other = (x[order] for x in (doc, lo, whole, other))
    later = _later(_starts(whole, other), doc, lo) if len(doc) else np.zeros(0, bool)
    one = np.ones(len(doc), np.int64)
    yield _known(doc[later], lo[later], one[later])
    doc, lo, whole, other = (x[~later] for x in (doc, lo, whole, other))
    zero = np.zeros(len(doc), np.int64)
    yield _rows(whole, other, zero.view(np.uint64), doc, lo, zero + 1, zero, zero)


def suffix_pass(docs: DataFrame) -> DataFrame:
    """Rows of all sampled suffixes of (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            ids = b.column(0).to_numpy()
            buf, offs = text_buffer(b.column(1))
            for i, at, shift in units(offs):
                row, lo, n, off, bucket, ident = runs(buf[at[0]: at[-1]], at - at[0])
                parts.append([ids[i + row], lo + shift[row], n, off, bucket, ident])
                held += int(at[-1] - at[0])
                if held >= BATCH_BYTES:
                    yield from combined_runs(parts)
                    parts, held = [], 0
        if parts:
            yield from combined_runs(parts)

    return docs.mapInArrow(tidied(run), ROW)


def _gathered(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """From rows of (doc, text, at), at listing runs as lo, n, off: the bytes of
    all runs end to end, and per run its document, lo, n, off and place there."""
    buf, offs = text_buffer(b.column(1))
    k = np.repeat(np.arange(b.num_rows), b.column(2).value_lengths().to_numpy())
    lo, n, off = (x.to_numpy().astype(np.int64) for x in b.column(2).flatten().flatten())
    ids, size = b.column(0).to_numpy()[k], n + SPAN - 1
    end = np.cumsum(size)
    for i, j in slices(np.concatenate([[0], end]), SEGMENT):
        place = end[i:j] - size[i:j] - (end[i] - size[i])
        at = np.repeat(offs[k[i:j]] + lo[i:j] - place, size[i:j]) + np.arange(int(size[i:j].sum()))
        yield buf[at], ids[i:j], lo[i:j], n[i:j], off[i:j], place


def _expand(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the owner, and number within it, of ``count`` items each."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def blocks(buf, ids, lo, n, off, place) -> list[np.ndarray]:
    """The runs' blocks: windows whose distance to the suffix has the same quotient by BLOCK."""
    level, whole, _ = bucket_ids(buf)
    least = (off - n + 1) // BLOCK
    r, j = _expand(off // BLOCK - least + 1)
    j += least[r]
    high = lo[r] + off[r] - BLOCK * j
    low = high - BLOCK + 1
    a, z = np.maximum(lo[r], low), np.minimum(lo[r] + n[r] - 1, high)
    shift = place[r] - lo[r]
    core = _refine(_refine(level[64][high + shift], level[32][high + shift + CORE - 32]), j.astype(np.uint64))
    run = _refine(_refine(whole[a + shift], whole[z + shift]), ((a - low) * BLOCK + z - low).astype(np.uint64))
    return [ids[r], a, z - a + 1, np.zeros(len(r), np.int64), core, run]


def windows(buf, ids, lo, n, off, place) -> list[np.ndarray]:
    """The runs' single windows."""
    _, whole, other = bucket_ids(buf)
    r, k = _expand(n)
    return [ids[r], lo[r] + k, whole[place[r] + k], other[place[r] + k]]


def refine_pass(wanted: DataFrame, split, combined) -> DataFrame:
    """Rows of the runs of (doc, text, at), split into smaller ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            for piece in _gathered(b):
                parts.append(split(*piece))
                held += len(piece[0])
                if held >= BATCH_BYTES // 4:
                    yield from combined(parts)
                    parts, held = [], 0
        if parts:
            yield from combined(parts)

    return wanted.mapInArrow(tidied(run), ROW)


def _first_of(rows: DataFrame) -> DataFrame:
    """Adds ``later``: an equal run (or window) starts strictly earlier."""
    w = Window.partitionBy("key", "bucket", "run").orderBy("doc", "lo")
    return rows.withColumn("head", F.first(F.struct("doc", "lo")).over(w)).withColumn(
        "later", (F.col("state") == COVERED) | (F.col("doc") > F.col("head.doc")) | (F.col("lo") > F.col("head.lo")))


def _settled(rows: DataFrame) -> DataFrame:
    """Rows that are covered (later), or the first of theirs in a bucket with others."""
    bucket = Window.partitionBy("key")
    mixed = (F.min("run").over(bucket) < F.max("run").over(bucket)) | (F.col("state") == SHARED)
    return _first_of(rows).withColumn("mixed", mixed).where("later or mixed").select("doc", "lo", "n", "off", "later")


def _open(docs: DataFrame, settled: DataFrame) -> DataFrame:
    """Documents with the list of their runs that need a further split."""
    wanted = settled.where("not later").groupBy("doc").agg(F.collect_list(F.struct("lo", "n", "off")).alias("at"))
    return docs.join(wanted, "doc").select("doc", "text", "at")


def covered(docs: DataFrame) -> DataFrame:
    """(doc, at): per document the list of covered window ranges (lo, n)."""
    by_run = saved(_settled(suffix_pass(docs)), "suffix-runs")
    by_block = _settled(refine_pass(_open(docs, by_run), blocks, combined_runs))
    by_window = _first_of(refine_pass(_open(docs, by_block), windows, combined_windows))
    spans = [x.where("later").select("doc", "lo", "n") for x in (by_run, by_block, by_window)]
    return spans[0].unionByName(spans[1]).unionByName(spans[2]).groupBy("doc").agg(
        F.collect_list(F.struct("lo", "n")).alias("at"))


def removed(at: list, size: int) -> list[tuple[int, int]]:
    """Maximal removed byte runs from covered window ranges."""
    out: list[list[int]] = []
    for a, b in sorted((x["lo"], x["lo"] + x["n"] + SPAN - 1) for x in at or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept_bytes(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in gone:
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts)


def ordered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with their number ``__doc`` in the order of ids. Unique ids are their own numbers; if any repeats,
    all distinct (id, text) are numbered by ranges of the order."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID))
    odd = docs.groupBy(key.alias("k")).agg(F.count("*").alias("n"), F.count(doc_id).alias("ids")).where(
        (F.col("n") > 1) | (F.col("k") == LAST_ID) & (F.col("ids") > 0))
    if not odd.limit(1).count():
        return docs.withColumn("__doc", key)
    keyed = docs.withColumn("__k", key).withColumn("__tie", F.xxhash64(F.coalesce(text, F.lit(""))))
    rows = keyed.select(F.lit("").alias("tree"), "__k", "__tie").distinct()
    numbers = placed(rows, "tree", ["__k", "__tie"], "suffix-order").select("__k", "__tie", F.col("place").alias("__doc"))
    return saved(keyed.join(numbers, ["__k", "__tie"]).drop("__k", "__tie").withColumn("__numbered", F.lit(True)), "suffix-numbered")


def dedup_report(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): sizes, spans and the hash of what is kept."""
    plain = ordered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).withColumnRenamed("__doc", "doc")
    if "__numbered" not in plain.columns:
        # The id again from its number, so that every join takes the same two columns and shares one shuffle.
        plain = plain.select("doc", "text")
    spans = covered(plain.select("doc", "text"))
    own = F.col("doc_id") if "doc_id" in plain.columns else F.when(F.col("doc") != LAST_ID, F.col("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc_id, text, at in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                data = text.as_py().encode() if text.is_valid else b""
                gone = removed(at, len(data))
                out.append((doc_id, len(data), sum(y - x for x, y in gone), len(gone),
                            hashlib.sha256(kept_bytes(data, gone)).hexdigest()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)], names=names)

    return plain.join(spans, "doc", "left").select(own.alias("doc_id"), "text", "at").mapInArrow(
        tidied(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def apply_dedup(docs: DataFrame) -> DataFrame:
    """The documents with repeated spans cut out of their text (bytes of a cut
    character are dropped) and n_chars, where there is one, counted anew."""
    inner = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    plain = ordered(docs.select(*[F.col(f"`{c}`").alias(a) for c, a in inner.items()]), inner["doc_id"], inner["text"])
    spans = covered(plain.select(F.col("__doc").alias("doc"), F.col(inner["text"]).alias("text"))).select(
        F.col("doc").alias("__doc"), F.col("at").alias("__at"))
    text, names = inner["text"], list(inner.values())
    at_text = names.index(text)
    kinds = [f.dataType.simpleString() for f in docs.schema]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns[:-1])
            new = [None if not t.is_valid else t.as_py() if not at else kept_bytes(
                t.as_py().encode(), removed(at, 0)).decode("utf-8", "ignore")
                for t, at in zip(cols[at_text], b.column(b.num_columns - 1).to_pylist())]
            cols[at_text] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    out = plain.join(spans, "__doc", "left").select(*names, "__at").mapInArrow(tidied(run), schema)
    cols = [F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")
            if c == "n_chars" else F.col(a).alias(c) for c, a in inner.items()]
    return out.select(*cols)


def q_suffix_dedup(spark, sf_dir):
    return dedup_report(read(spark, sf_dir, "documents").select("doc_id", "text"))
