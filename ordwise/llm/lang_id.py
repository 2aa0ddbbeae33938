"""Language identification by words first, backing off to character n-grams.

A known word scores by its log frequency in each language. An unseen word is
scored by the longest character n-grams of it that are known (orders five down
to one), as the mean of their log frequencies, so an unseen word weighs as much
as a known one. A text's language is the one with the highest sum; its score is
the posterior under equal priors.

The classifier is fitted on a bounded sample of the labelled rows: in each
language an expected ``SAMPLE_DOCS`` documents, chosen by a hash of id and text. Every
word and n-gram of the sample is kept, so the sample is the model's only bound.
Predictions read whole texts and nothing but the text.

Edge cases: null text or text without a letter is ``und`` with score 0; a table
without labelled rows predicts ``und`` for all; ties go to the smaller language
code; repeated rows are learned and predicted as rows of their own; very long
texts are scored in full; words of any length are kept and scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.store import read

SAMPLE_DOCS = 5_000
ORDERS = (5, 4, 3, 2, 1)
MEMO_WORDS = 300_000
MEMO_CHARS = 64

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> Iterator[str]:
    w = f"<{word}>" if n > 1 else word
    return (w[i: i + n] for i in range(len(w) - n + 1))


def counts(labelled: DataFrame) -> DataFrame:
    """(lang, kind, item, n): word counts (kind 0) and n-gram counts (kind = order),
    combined per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                words.setdefault(lang, Counter()).update(words_of(text.as_py() or ""))
            for lang, c in words.items():
                out = [(0, w, n) for w, n in c.items()]
                for k in ORDERS:
                    g: Counter = Counter()
                    for w, n in c.items():
                        for x in grams_of(w, k):
                            g[x] += n
                    out += [(k, x, n) for x, n in g.items()]
                kinds, items, ns = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(out), pa.string()), pa.array(kinds, pa.int32()),
                     pa.array(items, pa.string()), pa.array(ns, pa.int64())], names=["lang", "kind", "item", "n"])

    rows = labelled.select("lang", "text").mapInArrow(run, "lang string, kind int, item string, n long")
    return rows.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


def sample(labelled: DataFrame, per_lang: int = SAMPLE_DOCS) -> DataFrame:
    """An expected ``per_lang`` rows of each language, by a hash of id and text (copies of a text draw apart)."""
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in sizes.items():  # one row per language
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_lang / n))).otherwise(share)
    return labelled.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share * float(1 << 30))


class Model:
    """Log frequencies per language; plain data, bounded by the sample's items:
    for each kind the items' row numbers and one matrix (items, languages)."""

    def __init__(self, rows: pa.Table):
        lang = rows.column("lang").to_numpy()
        kind, item, n = (rows.column(c).to_numpy() for c in ("kind", "item", "n"))
        self.langs = sorted(set(lang))
        at = np.searchsorted(np.array(self.langs, object), lang) if self.langs else np.zeros(0, np.int64)
        self.tables: dict[int, tuple[dict[str, int], np.ndarray]] = {}
        for k in (0, *ORDERS):
            mine = kind == k
            total = np.bincount(at[mine], weights=n[mine], minlength=len(self.langs)) + 1.0
            index: dict[str, int] = {}
            rank = np.array([index.setdefault(x, len(index)) for x in item[mine]], np.int64)
            logs = np.tile(np.log(0.5 / total).astype(np.float32), (len(index), 1))
            logs[rank, at[mine]] = np.log(n[mine] / total[at[mine]])
            self.tables[k] = index, logs

    def word(self, w: str) -> np.ndarray:
        index, logs = self.tables[0]
        if (i := index.get(w)) is not None:
            return logs[i]
        for k in ORDERS:
            index, logs = self.tables[k]
            found = [i for g in grams_of(w, k) if (i := index.get(g)) is not None]
            if found:
                return logs[found].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)


class Scorer:
    """Sums word vectors of whole texts; word vectors are memoised, boundedly."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}
        self.rows = np.zeros((1024, len(model.langs)))

    def index(self, w: str) -> int:
        k = len(self.memo)
        if k >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[k] = self.model.word(w)
        self.memo[w] = k
        return k

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.langs:
            return "und", 0.0
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        words = words_of(text)
        if not words:
            return "und", 0.0
        get = self.memo.get
        ids = [i if (i := get(w)) is not None else self.index(w) for w in words if len(w) <= MEMO_CHARS]
        s = self.rows[ids].sum(axis=0)
        for w in words:
            if len(w) > MEMO_CHARS:  # not memoised: the memo's size is bounded by its number of words
                s = s + self.model.word(w)
        s = np.exp(s - s.max())
        best = int(s.argmax())
        return self.model.langs[best], float(s[best] / s.sum())


def fit(labelled: DataFrame, per_lang: int = SAMPLE_DOCS) -> Model:
    """Model from labelled (doc_id, lang, text) rows; lang must not be null."""
    return Model(counts(sample(labelled, per_lang)).select("lang", "kind", "item", "n").toArrow())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            got = [scorer.predict(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x for x, _ in got], pa.string()),
                 pa.array([y for _, y in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def with_fold(docs: DataFrame, mod: int, remainder: int) -> DataFrame:
    """held_out: crc32 of the id as text leaves ``remainder`` modulo ``mod``."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.withColumn("held_out", crc % mod == remainder)


def q_lang_id(spark, sf_dir):
    docs = with_fold(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), 4, 2)
    model = fit(docs.where("not held_out and lang is not null and text is not null"))
    return predict(docs, model)
