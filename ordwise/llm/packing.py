"""Best-fit packing by patterns fitted with non-negative least squares.

Documents become pieces of at most ``limit`` tokens. Only the histogram of
piece lengths (``limit`` counters, whatever the corpus) is looked at as a whole:

1. few-document patterns that fill a sequence exactly (one, two or three
   lengths) are enumerated over the lengths that occur,
2. their repeat counts are fitted to the histogram by non-negative least
   squares and rounded down to what the histogram can supply,
3. the residual histogram is packed by best-fit decreasing, a whole count of
   equal pieces at a time.

The plan is a list of (lengths, repeats), turned into runs per length: piece
number i of a length finds its run by binary search. Numbers come from counts
per (part, length) and the row's place in its part, so no sort or window runs
over pieces.

Edge cases: null or empty text is the single closing id 0; repeated rows are
packed as documents of their own; an empty table packs to nothing; a text of
any length is cut, never dropped; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordwise.llm.store import read, saved, tidied

LIMIT = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
CACHE_WORDS, CACHE_PIECES = 150_000, 400_000
TRIPLES_OF = 48
ROUNDS = 300

# Words for which lower-casing and splitting are plain: letters of Latin-1, then
# at most one mark. All others go through the whole tokenizer.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:!?]?)\\Z")


class Recent:
    """A bounded cache of two generations: a full one becomes the old one, and
    what is asked for again moves on, so frequent keys stay."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def get(self, key):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value


class WordTokenizer:
    """Token ids of white-space separated words, as bytes, with bounded caches.

    The public tokenizer drops white space and never joins across it, so a
    text's ids are its words' ids end to end.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.words, self.pieces = Recent(CACHE_WORDS), Recent(CACHE_PIECES)
        self.byte_chars = self._byte_alphabet()

    @staticmethod
    def _byte_alphabet() -> list[str]:
        """Byte-level BPE's printable stand-in for each byte: printable Latin-1
        stands for itself, the other bytes follow from code point 256 on."""
        own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        rest = iter(range(256, 512))
        return [chr(b if b in own else next(rest)) for b in range(256)]

    def forget(self) -> None:
        """Drop the caches, so that a worker that Spark keeps does not keep them too."""
        self.words, self.pieces = Recent(CACHE_WORDS), Recent(CACHE_PIECES)

    def piece(self, s: str) -> bytes:
        got = self.pieces.get(s)
        if got is None:
            chars = self.byte_chars
            mapped = s if s.isascii() else "".join([chars[b] for b in s.encode()])
            got = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            self.pieces.put(s, got)
        return got

    def word(self, w: bytes) -> bytes:
        got = self.words.old.get(w)
        if got is None:
            s = w.decode("utf-8", "replace")
            m = _PLAIN.match(s)
            if m:
                got = self.piece(m[1].lower()) + (self.piece(m[2]) if m[2] else b"")
            else:
                got = array("I", self.full.encode(s, add_special_tokens=False).ids).tobytes()
        if len(w) <= 64:
            self.words.put(w, got)
        return got

    def text(self, data: bytes) -> bytes:
        word, out = self.word, []
        for part in _parts(data.split()):
            get = self.words.young.get
            out += [get(w) or word(w) for w in part]
        return b"".join(out)


def _parts(words: list[bytes], size: int = 4096) -> Iterator[list[bytes]]:
    """Pieces of a long list, so that a text never holds on to a dropped generation."""
    return (words[i: i + size] for i in range(0, len(words), size))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, idx long"


def pieces(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per piece; ``idx`` counts the pieces of equal length in ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part = tokenizer(path), TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        end = array("I", [END_ID]).tobytes()
        try:
            for b in batches:
                out: list[list] = [[], [], [], [], [], []]
                for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = tok.text(text.as_py().encode() if text.is_valid else b"") + end
                    for k, at in enumerate(range(0, len(ids), 4 * limit)):
                        cut = ids[at: at + 4 * limit]
                        n = len(cut) // 4
                        for c, v in zip(out, (doc, k, at // 4, n, zlib.crc32(cut), int(seen[n]))):
                            c.append(v)
                        seen[n] += 1
                n = len(out[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                     pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()),
                     pa.array(np.full(n, part, np.int32)), pa.array(out[5], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "idx"])
        finally:
            tok.forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), PIECES)


def enumerate_patterns(hist: np.ndarray, limit: int, top: int = TRIPLES_OF) -> list[tuple[int, ...]]:
    """Patterns of one to three lengths that occur and sum to ``limit``; triples
    hold at least one of the ``top`` most frequent lengths."""
    have = hist > 0
    out: list[tuple[int, ...]] = [(limit,)] if have[limit] else []
    for a in np.flatnonzero(have[: limit // 2 + 1]):
        if a and have[limit - a]:
            out.append((int(limit - a), int(a)))
    common = [int(x) for x in np.argsort(-hist[:limit], kind="stable")[:top] if hist[x] and x]
    seen = set()
    for a in common:
        for b in np.flatnonzero(have[: limit - a]):
            c = limit - a - int(b)
            if b and c > 0 and have[c]:
                seen.add(tuple(sorted((a, int(b), c), reverse=True)))
    return out + sorted(seen, reverse=True)


def fit_repeats(patterns: list[tuple[int, ...]], hist: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 that minimise |A x - hist|, where
    A counts each length in each pattern. Projected gradient steps scaled by the
    row and column sums of A'A, which bound its largest eigenvalue."""
    if not patterns:
        return np.zeros(0)
    col = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.array([x for p in patterns for x in p])
    per_row = np.bincount(row, minlength=len(hist)).astype(float)
    scale = np.bincount(col, weights=per_row[row], minlength=len(patterns))
    target = hist.astype(float)
    x = np.zeros(len(patterns))
    for _ in range(rounds):
        miss = np.bincount(row, weights=x[col], minlength=len(hist)) - target
        x = np.maximum(0, x - np.bincount(col, weights=miss[row], minlength=len(patterns)) / scale)
    return x


def best_fit(hist: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: equal pieces move in whole groups, so the
    work follows the number of distinct lengths and groups, not pieces."""
    room: dict[int, list[list]] = {}
    gaps: list[int] = []

    def add(left: int, lengths: tuple[int, ...], n: int) -> None:
        if left not in room:
            room[left] = []
            insort(gaps, left)
        room[left].append([lengths, n])

    for size in range(limit, 0, -1):
        n = int(hist[size])
        while n:
            k = bisect_left(gaps, size)
            if k == len(gaps):
                per = limit // size
                if n >= per:
                    add(limit - per * size, (size,) * per, n // per)
                if n % per:
                    add(limit - (n % per) * size, (size,) * (n % per), 1)
                break
            gap = gaps[k]
            lengths, m = room[gap][-1]
            t = min(n, m)
            if t == m:
                room[gap].pop()
                if not room[gap]:
                    del room[gap]
                    gaps.pop(k)
            else:
                room[gap][-1][1] -= t
            add(gap - size, (*lengths, size), t)
            n -= t
    return [(lengths, n) for g in sorted(room) for lengths, n in room[g]]


def plan(hist: np.ndarray, limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use up the histogram exactly."""
    left = hist.astype(np.int64).copy()
    patterns = enumerate_patterns(left, limit)
    x = fit_repeats(patterns, left)
    out = []
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 1:
            break
        p = patterns[k]
        n = min([int(x[k]), *(int(left[s]) // p.count(s) for s in set(p))])
        if n > 0:
            out.append((p, n))
            for s in p:
                left[s] -= n
    return out + best_fit(left, limit)


def runs_of(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first piece number, first sequence and offset of each run."""
    runs: dict[int, list] = {}
    used: dict[int, int] = {}
    base = 0
    for lengths, n in packed:
        at = 0
        for s in lengths:
            runs.setdefault(s, []).append((used.get(s, 0), base, at))
            used[s] = used.get(s, 0) + n
            at += s
        base += n
    return {s: tuple(np.array(c, np.int64) for c in zip(*r)) for s, r in runs.items()}


def pack(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Pieces with their sequence and offset."""
    cut = saved(pieces(docs, path, limit), "pack-pieces")
    counts = saved(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "pack-counts")
    hist = np.zeros(limit + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``limit`` rows
        hist[r["length"]] = r["n"]
    runs = runs_of(plan(hist, limit))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = cut.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("idx") + F.col("base")).alias("nr"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, nr = b.column("length").to_numpy(), b.column("nr").to_numpy()
            seq, off = np.zeros(len(nr), np.int64), np.zeros(len(nr), np.int64)
            for s in np.unique(size):
                first, base_seq, at = runs[int(s)]
                mine = np.flatnonzero(size == s)
                k = np.searchsorted(first, nr[mine], side="right") - 1
                seq[mine] = base_seq[k] + nr[mine] - first[k]
                off[mine] = at[k]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)],
                                             names=[*b.schema.names[:5], "sequence_id", "offset"])

    return numbered.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def q_packing(spark, sf_dir):
    import public_tokenizers
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
