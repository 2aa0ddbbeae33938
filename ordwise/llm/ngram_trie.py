"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model is an interpolated trigram model over exact words and exact histories. With c
the training count and m(c) = k * c^b the weight of the lower order,

    P1(w)       = (c(w) + 0.1) / (N + 0.1 * (V + 1))
    P2(w | v)   = (c(v, w) + m2(c(v)) * P1(w)) / (c(v) + m2(c(v)))
    P3(w | u v) = (c(u, v, w) + m3(c(u, v)) * P2(w | v)) / (c(u, v) + m3(c(u, v)))

which sums to one in every context. Words are 64-bit hashes; no word or history shares
its counts with another.

Every place of a text is a path of three words in the trie, and the counts a token needs are
those of the paths that start at it and at the two words before it. Paths are sharded by their
first word. A frequent word's (at least one in ``HEAVY`` tokens, so at most ``HEAVY`` such words
exist) are sharded by the first two, and a frequent pair's (by the same measure) by all three,
so no word or pair fills a task; the counts of these words and pairs go to every task.

Pass 1 counts words, then the pairs of frequent words. Pass 2 sends one packed block per slice
of documents and shard: distinct paths and how often each occurs in training documents, and one
block per slice that tells which path starts where. Blocks name the ``COMMON`` most frequent words by
rank and list the hashes of their other words; this shortens them and changes no result. A shard merges its blocks' counts into a trie
of three levels, writes the levels to a file in the task's temporary folder, maps them, and looks
up every block's paths: a level's keys are the monotone sequence (parent position, child), kept in
Elias-Fano form, and a child is found by successor search relative to its parent. The counts go
back by slice, where each token's probability is put together.

Edge cases: null text is empty and scores its end token alone; with no training
documents every word is unknown (N = V = 0); repeated rows are documents of
their own; very long texts are slices of their own; other columns are not read.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.lang_id import with_fold
from ordwise.llm.store import read, saved
from ordwise.llm.words import LOWER, combine, mix, slices, split_words, text_buffer

HEAVY = 10_000
COMMON = 1 << 16
SHARD_TOKENS = 2_000_000
SLICE = 8 << 20
M2 = (2.0, 0.85)
M3 = (2.0, 0.8)
ADD = 0.1

END, BOS, PAD = (np.uint64(x) for x in (0x5E1D0000000000E1, 0x5E1D0000000000B0, 0x5E1D0000000000F0))


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(w, v, u, row) of every token of a slice: the word, the two before it
    (BOS before the text), its row; each row ends with END."""
    low = LOWER[buf]
    s = split_words(low, offsets)
    n_rows = len(offsets) - 1
    w = np.empty(len(s.hash) + n_rows, np.uint64)
    w[np.arange(len(s.hash)) + s.row] = s.hash
    ends = s.first[1:] + np.arange(n_rows)
    w[ends] = END
    row = np.repeat(np.arange(n_rows), s.per_row + 1)
    v = np.concatenate([[BOS], w[:-1]])
    v[v == END] = BOS
    u = np.concatenate([[BOS], v[:-1]])
    u[v == BOS] = BOS
    return w, v, u, row


def context(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The key of a history of two words."""
    return combine(u, v).view(np.int64)


def _each_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, training flags, bytes, offsets) of each slice of (doc_id, held_out, text)."""
    for b in batches:
        train = ~b.column(1).to_numpy(zero_copy_only=False).astype(bool)
        ids = b.column(0).cast(pa.int64())
        buf, offs = text_buffer(b.column(2))
        for i, j in slices(offs, SLICE):
            yield ids.slice(i, j - i), train[i:j], buf[offs[i]: offs[j]], offs[i: j + 1] - offs[i]


def count_pass(docs: DataFrame) -> DataFrame:
    """(kind, key, n) over training documents: kind 0 all words, kind 1 the frequent histories of two."""
    rows = docs.select("doc_id", "held_out", "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, train, buf, offs in _each_slice(batches):
            w, _, _, row = tokens(buf, offs)
            yield _counts(*np.unique(w[train[row]], return_counts=True))

    counted = saved(rows.mapInArrow(words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-words")
    n = int(counted.agg(F.sum("n")).first()[0] or 0)
    t = docs.sparkSession.sparkContext.broadcast(Tables(n, 0, 0, _frequent(counted, n), [], []))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, train, buf, offs in _each_slice(batches):
            w, v, u, row = tokens(buf, offs)
            mine = train[row]
            known = t.value.class_of(w, t.value.heavy_at(w)) >= 0
            at_v = np.concatenate([[True], known[:-1]]) | (v == BOS)
            at_u = np.concatenate([[True], at_v[:-1]]) | (u == BOS)
            mine &= at_v & at_u  # a frequent pair's words are frequent
            yield _counts(*np.unique(context(u[mine], v[mine]), return_counts=True))

    often = (rows.mapInArrow(pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .where(F.col("n") * HEAVY >= F.lit(max(n, 1))))
    return counted.select(F.lit(0).alias("kind"), "key", "n").union(often.select(F.lit(1).alias("kind"), "key", "n"))


def _counts(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


def _common(words: DataFrame) -> list[int]:
    return [r["key"] for r in words.orderBy(F.desc("n"), "key").limit(COMMON).select("key").collect()]


def _frequent(words: DataFrame, n: int) -> list[tuple[int, int]]:
    return [(r["key"], r["n"]) for r in words.where(F.col("n") * HEAVY >= F.lit(max(n, 1))).collect()]


class Counts:
    """Counts by key, 0 for any other key."""

    def __init__(self, counts: list[tuple[int, int]]):
        counts = sorted(counts)
        self.key = np.array([k for k, _ in counts], np.int64)
        self.n = np.array([n for _, n in counts], np.int64)

    def __iter__(self) -> Iterator[int]:
        return iter(self.n.tolist())

    def __getitem__(self, key) -> np.ndarray:
        if not len(self.key):
            return np.zeros(np.shape(key), np.int64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.n[at], 0)


class Tables:
    """What every task needs: totals, the frequent words and histories, at most ``HEAVY`` of
    each, and the most frequent words by rank, by which blocks name them."""

    def __init__(self, n_tokens: int, n_types: int, n_docs: int, heavy: list[tuple[int, int]],
                 contexts: list[tuple[int, int]], common: list[int]):
        self.n, self.v, self.docs = n_tokens, n_types, n_docs
        heavy = sorted((np.int64(k).astype(np.uint64), c) for k, c in heavy)
        self.heavy = np.array([k for k, _ in heavy], np.uint64)
        # Counts as a history: the start's, then the frequent words'; the end is followed by nothing.
        self.classes = np.array([n_docs, *(c if k != END else 0 for k, c in heavy)], np.int64)
        self.contexts = Counts(contexts)
        self.common = np.array(common, np.int64).view(np.uint64)
        self.by_hash = np.argsort(self.common)

    def heavy_at(self, w: np.ndarray) -> np.ndarray:
        """Place among the frequent words, or -1."""
        if not len(self.heavy):
            return np.full(len(w), -1)
        k = np.minimum(np.searchsorted(self.heavy, w), len(self.heavy) - 1)
        return np.where(self.heavy[k] == w, k, -1)

    def rank(self, w: np.ndarray) -> np.ndarray:
        """Rank among the most frequent words, or -1."""
        if not len(self.common):
            return np.full(len(w), -1)
        k = self.by_hash[np.minimum(np.searchsorted(self.common, w, sorter=self.by_hash), len(self.common) - 1)]
        return np.where(self.common[k] == w, k, -1)

    def class_of(self, v: np.ndarray, heavy: np.ndarray) -> np.ndarray:
        """Place in ``classes``: 0 for the start, then the frequent words; -1 for all others."""
        return np.where(v == BOS, 0, np.where(heavy >= 0, heavy + 1, -1))

    def p1(self, c: np.ndarray) -> np.ndarray:
        return (c + ADD) / (self.n + ADD * (self.v + 1))


def tables(counts: DataFrame) -> Tables:
    """Totals, and the bounded tables of frequent words and histories."""
    words = counts.where("kind = 0")
    n, v = words.agg(F.sum("n"), F.count("*")).first()
    n, v = int(n or 0), int(v)
    end = words.where(F.col("key") == F.lit(int(END.astype(np.int64)))).select("n").first()
    often = [(r["key"], r["n"]) for r in counts.where("kind = 1").collect()]
    return Tables(n, v, int(end["n"]) if end else 0, _frequent(words, n), often, _common(words))


# -- blocks -------------------------------------------------------------------------

def pack_arrays(arrays: list[np.ndarray]) -> tuple[bytes, int]:
    """Arrays as byte planes, compressed; sizes and types are known to the reader."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return pa.compress(raw, codec="zstd", asbytes=True), len(raw)


def unpack_arrays(data: bytes, raw: int, spec: list[tuple[str, int]]) -> list[np.ndarray]:
    flat = np.frombuffer(pa.decompress(data, raw, codec="zstd", asbytes=True) if raw else b"", np.uint8)
    out, at = [], 0
    for kind, n in spec:
        d = np.dtype(kind)
        size = d.itemsize * n
        out.append(flat[at: at + size].reshape(d.itemsize, n).T.copy().view(d).reshape(n))
        at += size
    return out


BLOCK = "shard int, chunk long, kind int, n int, m int, raw int, data binary"


def block_pass(docs: DataFrame, t, n_shards: int) -> DataFrame:
    """One block per slice and shard with its paths, and one per slice with where they start (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tab, chunk = t.value, TaskContext.get().partitionId() << 24
        for ids, train, buf, offs in _each_slice(batches):
            rows = _blocks(tab, ids, buf, offs, train, chunk, n_shards)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.int32(),
                                                             pa.int32(), pa.int32(), pa.binary()))],
                names=["shard", "chunk", "kind", "n", "m", "raw", "data"])
            chunk += 1

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, BLOCK)


def paths(w: np.ndarray, v: np.ndarray, u: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, second, third word, row) of the paths of a slice's tokens: a text's tokens with the
    two words before them, then the path from its last word, which ends behind the text."""
    own = np.arange(len(w)) + row
    last = np.flatnonzero(w == END)
    a, b, c = (np.empty(len(w) + len(last), np.uint64) for _ in range(3))
    a[own], b[own], c[own] = u, v, w
    a[own[last] + 1], b[own[last] + 1], c[own[last] + 1] = v[last], END, PAD
    at = np.zeros(len(a), np.int64)
    at[own], at[own[last] + 1] = row, row[last]
    return a, b, c, at


def shard_of(tab: Tables, a: np.ndarray, b: np.ndarray, c: np.ndarray, n_shards: int) -> np.ndarray:
    one = tab.class_of(a, tab.heavy_at(a)) >= 0
    two = tab.contexts[context(a, b)] > 0
    key = np.where(two, combine(combine(a, b), c), np.where(one, combine(a, b), a))
    return (mix(key) % np.uint64(n_shards)).astype(np.int32)


def _blocks(tab: Tables, ids: pa.Array, buf, offsets, train, chunk: int, n_shards: int) -> list[tuple]:
    a, b, c, row = paths(*tokens(buf, offsets))
    words, place = np.unique(np.concatenate([a, b, c]), return_inverse=True)
    a, b, c = place.reshape(3, -1)
    pair, at = np.unique(a * len(words) + b, return_inverse=True)
    path, at = np.unique(at * len(words) + c, return_inverse=True)
    n = np.bincount(at, weights=train[row], minlength=len(path)).astype(np.uint32)
    pair, c = pair[path // len(words)], path % len(words)
    a, b = pair // len(words), pair % len(words)
    shard = shard_of(tab, words[a], words[b], words[c], n_shards)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(path), np.uint32)
    place[order] = np.arange(len(path))
    abc, n = np.stack([a, b, c])[:, order], n[order]
    code = tab.rank(words)[abc]
    cut = np.searchsorted(shard[order], np.arange(n_shards + 1))
    null = np.asarray(ids.is_null())
    data, raw = pack_arrays([ids.fill_null(0).to_numpy(zero_copy_only=False), null, np.bincount(row, minlength=len(ids)).astype(np.uint32),
                             place[at]])
    out = [(chunk % n_shards, chunk, 1, len(at), len(ids), raw, data)]
    for s in range(n_shards):
        i, j = cut[s], cut[s + 1]
        if i == j:
            continue
        name = code[:, i:j]
        rare = name < 0
        here, at_rare = np.unique(abc[:, i:j][rare], return_inverse=True)
        name[rare] = len(tab.common) + at_rare
        name = name.astype(np.uint32)
        data, raw = pack_arrays([np.diff(words[here], prepend=np.uint64(0)), np.diff(name[0], prepend=np.uint32(0)),
                                 name[1], name[2], n[i:j]])
        out.append((s, chunk, 0, int(j - i), len(here), raw, data))
    return out


def _open_block(r) -> tuple[np.ndarray, ...]:
    """(hashes of the block's rarer words, names of its paths' three words, training counts)."""
    step, a, b, c, n = unpack_arrays(r.data, r.raw, [("u8", r.m), ("u4", r.n), ("u4", r.n), ("u4", r.n), ("u4", r.n)])
    return np.cumsum(step, dtype=np.uint64), np.stack([np.cumsum(a, dtype=np.uint32), b, c]), n


# -- the trie -----------------------------------------------------------------------

class Level:
    """A strictly increasing sequence in Elias-Fano form: whole low bytes, and
    the high parts in unary. Buckets of equal high part are found from the
    unary part's zeros; within a bucket the low bytes are searched."""

    def __init__(self, path: str, values: np.ndarray):
        n = len(values)
        top = int(values[-1]) if n else 0
        spare = max(top.bit_length() - max(n, 1).bit_length(), 0)
        self.n, self.low_bytes = n, min((spare + 7) // 8, 7)
        self.shift = np.uint64(8 * self.low_bytes)
        high = (values >> self.shift).astype(np.int64)
        bits = np.zeros((int(high[-1]) if n else 0) + n + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        with open(path, "wb") as f:
            f.write(np.packbits(bits).tobytes())
            f.write(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(n, 8)[:, : self.low_bytes]).tobytes())
        split = (len(bits) + 7) // 8
        whole = np.memmap(path, np.uint8, "r")
        zeros = np.flatnonzero(np.unpackbits(whole[:split], count=len(bits)) == 0)
        self.ends = zeros - np.arange(len(zeros))
        self.low = whole[split:].reshape(n, self.low_bytes) if n and self.low_bytes else None

    def lows(self, at: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(at), 8), np.uint8)
        if self.low is not None:
            wide[:, : self.low_bytes] = self.low[at]
        return wide.view("<u8").reshape(-1).astype(np.uint64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of each x, or -1: successor search within its bucket."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        high = (x >> self.shift).astype(np.int64)
        low = x & ((np.uint64(1) << self.shift) - np.uint64(1))
        ok = np.flatnonzero((high >= 0) & (high < len(self.ends)))
        hi = self.ends[high[ok]]
        lo = np.where(high[ok] > 0, self.ends[high[ok] - 1], 0)
        end, want = hi.copy(), low[ok]
        while True:
            open_ = lo < hi
            if not open_.any():
                break
            mid = (lo + hi) // 2
            less = np.zeros(len(lo), bool)
            less[open_] = self.lows(mid[open_]) < want[open_]
            lo = np.where(open_ & less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        inside = np.flatnonzero(lo < end)
        hit = inside[self.lows(lo[inside]) == want[inside]]
        out[ok[hit]] = lo[hit]
        return out


def _sum_runs(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted key and the sums of n."""
    if not len(key):
        return key, n
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[at], np.add.reduceat(n, at)


class Trie:
    """Words, then the words after each, then those after each pair. Paths are given as places among the words."""

    def __init__(self, folder: str, tab: Tables, words: np.ndarray):
        self.folder, self.tab, self.words = folder, tab, words
        self.bits = np.uint64(max(len(words).bit_length(), 1))
        self.level = [Level(os.path.join(folder, "1"), words)]
        self.common = self.level[0].find(tab.common)

    def places(self, rare: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Places of a block's words by their names: ranks, then numbers of its rarer words."""
        own = names >= len(self.common)
        out = np.empty(names.shape, np.uint32)
        out[own] = self.level[0].find(rare)[names[own] - np.uint32(len(self.common))]
        out[~own] = self.common[names[~own]]
        return out

    def fill(self, a, b, c, n) -> None:
        """Count the training paths."""
        first = a.astype(np.uint64) << self.bits | b.astype(np.uint64)
        pair, c2 = _total(first, n)
        path, c3 = _total(np.searchsorted(pair, first).astype(np.uint64) << self.bits | c.astype(np.uint64), n)
        top = (pair >> self.bits).astype(np.int64)
        c1 = np.bincount(top, weights=c2, minlength=len(self.words)).astype(np.int64)
        # A frequent word's count is the whole corpus's, not this shard's; so is a frequent pair's, see counts.
        known = self.tab.class_of(self.words, self.tab.heavy_at(self.words))
        self.count = np.where(known >= 0, self.tab.classes[known], c1), c2, c3
        self.level += [Level(os.path.join(self.folder, str(k)), x) for k, x in ((2, pair), (3, path))]

    def counts(self, a, b, c) -> list[np.ndarray]:
        """Counts of each path's first word, first two words, and all three."""
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        k1 = self._under(1, a[new].astype(np.int64), b[new])
        c2 = np.where(k1 >= 0, _pick(self.count[1], k1), 0)
        often = self.tab.contexts[context(self.words[a[new]], self.words[b[new]])]
        c2 = np.where(often > 0, often, c2)
        each = np.diff(np.append(new, len(a)))
        k2 = self._under(2, np.repeat(k1, each), c)
        return [self.count[0][a], np.repeat(c2, each), np.where(k2 >= 0, _pick(self.count[2], k2), 0)]

    def _under(self, level: int, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Position of each child below its parent, or -1."""
        out = np.full(len(parent), -1, np.int64)
        some = np.flatnonzero(parent >= 0)
        out[some] = self.level[level].find(parent[some].astype(np.uint64) << self.bits | child[some].astype(np.uint64))
        return out


def _pick(count: np.ndarray, at: np.ndarray) -> np.ndarray:
    return count[at] if len(count) else np.zeros(len(at), np.int64)


def _total(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a key, ascending, and the sums of n."""
    order = np.argsort(key, kind="stable")  # blocks are runs in order
    return _sum_runs(key[order], n[order])


def weight(c: np.ndarray, m: tuple[float, float]) -> np.ndarray:
    return np.where(c > 0, m[0] * np.maximum(c, 1).astype(float) ** m[1], 1.0)


def smooth(c, total, lower, m) -> np.ndarray:
    k = weight(total, m)
    return (c + k * lower) / (total + k)


PARTIAL = "chunk long, kind int, shard int, n int, m int, raw int, data binary"


def count_shards(blocks: DataFrame, t) -> DataFrame:
    """The counts of each slice's paths from each shard, in the order of its block."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(r.chunk, 1, 0, r.n, r.m, r.raw, r.data) for r in pdf.itertuples() if r.kind == 1]
        mine = [r for r in pdf.itertuples() if not r.kind]
        if mine:
            with tempfile.TemporaryDirectory() as folder:
                trie, blocks_ = _build(folder, t.value, mine)
                for r, path in zip(mine, blocks_):
                    out.append(_reply(trie, r, path))
                del trie
        return pd.DataFrame(out, columns=["chunk", "kind", "shard", "n", "m", "raw", "data"])

    return blocks.groupBy("shard").applyInPandas(run, PARTIAL)


def _build(folder: str, tab: Tables, blocks: list) -> tuple[Trie, list[np.ndarray]]:
    """The trie of a shard's training paths, and every block's paths as places in it."""
    opened = [_open_block(r) for r in blocks]
    trie = Trie(folder, tab, np.unique(np.concatenate([tab.common, *(rare for rare, _, _ in opened)])))
    placed = [trie.places(rare, names) for rare, names, _ in opened]
    n = [n for _, _, n in opened]
    del opened
    trie.fill(*[np.concatenate([x[m > 0] for x, m in zip((p[k] for p in placed), n)]) for k in range(3)],
              np.concatenate([m[m > 0] for m in n]).astype(np.int64))
    return trie, placed


def _reply(trie: Trie, r, path: np.ndarray) -> tuple:
    counts = trie.counts(*path)
    kind = np.uint32 if max(x.max() for x in counts) < 1 << 32 else np.uint64
    data, raw = pack_arrays([x.astype(kind) for x in counts])
    return r.chunk, 0, r.shard, r.n, 0, raw, data


def collect_scores(partials: DataFrame, t) -> DataFrame:
    """One row per document: its slice's counts put together to the probabilities of its tokens."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tab = t.value
        head = next(r for r in pdf.itertuples() if r.kind == 1)
        ids, null, per_row, at = unpack_arrays(head.data, head.raw, [("i8", head.m), ("?", head.m), ("u4", head.m), ("u4", head.n)])
        found = [[], [], []]
        for r in pdf[pdf["kind"] == 0].sort_values("shard").itertuples():
            for x, y in zip(found, unpack_arrays(r.data, r.raw, [(f"u{r.raw // (3 * r.n)}", r.n)] * 3)):
                x.append(y)
        c1, c2, c3 = (np.concatenate(x)[at].astype(np.int64) for x in found)
        last = np.cumsum(per_row.astype(np.int64)) - 1  # the path behind each text, which is no token's own
        own = np.delete(np.arange(len(at)), last)
        word = np.append(c1, [0, 0])[own + 2]
        word[last - np.arange(len(last)) - 1] = tab.docs  # each text's end
        p1 = tab.p1(word)
        p2 = smooth(c2[own + 1], c1[own + 1], p1, M2)
        p3 = smooth(c3[own], c2[own], p2, M3)
        first = np.cumsum(per_row.astype(np.int64) - 1) - (per_row.astype(np.int64) - 1)
        known, base, score = (np.add.reduceat(x, first) for x in ((word > 0).astype(np.int64), np.log10(p1), np.log10(p3)))
        return pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64").copy(), "n_tokens": per_row.astype(np.int64) - 1, "n_known": known,
                             "base_score": base, "score": score}).assign(doc_id=lambda d: d["doc_id"].mask(null))

    return partials.groupBy("chunk").applyInPandas(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame) -> DataFrame:
    """Scores of (doc_id, held_out, text); rows not held out are learned from."""
    tab = tables(count_pass(docs))
    t = docs.sparkSession.sparkContext.broadcast(tab)
    n_shards = max(8, -(-tab.n // SHARD_TOKENS))
    out = collect_scores(count_shards(block_pass(docs, t, n_shards), t), t)
    return out.withColumn("train_tokens", F.lit(tab.n).cast("long"))


def q_ngram_trie(spark, sf_dir):
    docs = with_fold(read(spark, sf_dir, "documents").select("doc_id", "text"), 10, 0)
    out = with_fold(score(docs), 10, 0)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
