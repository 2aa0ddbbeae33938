"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a word target from its weight. Whole passes over a source
cover the largest multiple of its size within the target; the rest is a budget
of words that has to be met by a subset of its documents. The subset is chosen
by length alone: documents are counted by exact length, every length first
gives its proportional share, and a bounded-knapsack dynamic programme over the
remaining counts closes the gap, exactly wherever the lengths allow. Which
documents of a length go is decided by a seeded hash.

Edge cases: null text has size 0 and is never taken; a null source is a source
of its own, ordered last; repeated rows are documents of their own (ties on the
hash are broken by count, so reruns take the same multiset); an empty table
gives an empty result; other columns are ignored by :func:`mix_plan` and kept
by :func:`apply_mix`.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordwise.llm.store import saved

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 17
BIN_ROWS = 4096
BROADCAST_ROWS = 200_000
WORD = r"[^\\x20\\x09-\\x0D]+"


def n_words(text: str = "text"):
    return F.coalesce(F.expr(f"regexp_count(`{text}`, '{WORD}')"), F.lit(0)).cast("long")


def with_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """Add ``target`` to (src, src_null, source_size): shares of all words by
    weight, held at ``cap`` times the source, the excess shared again.

    A source stays free while weight * excess <= cap * size * (free weight).
    Every sum is an integer, so the result does not depend on summation order.
    The rank runs over one row per source (the mixture's list), not documents.
    """
    rank = F.row_number().over(Window.orderBy("src_null", "src"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    src = saved(sizes.withColumn("weight", w.cast("long")), "mix-sources")
    held, n_held = F.lit(False), 0
    while True:
        free_w, capped, total = src.agg(
            F.sum(F.when(~held, F.col("weight"))), F.sum(F.when(held, F.col("source_size") * cap)),
            F.sum("source_size")).first()
        excess, free_w = (total or 0) - (capped or 0), free_w or 0
        big = "decimal(38,0)"
        held = held | (F.col("weight").cast(big) * F.lit(excess).cast("decimal(20,0)")
                       > F.col("source_size").cast(big) * F.lit(cap * free_w).cast("decimal(20,0)"))
        n = src.where(held).count()
        if n == n_held:
            break
        n_held = n
    share = F.col("weight") * F.lit(float(excess)) / F.lit(float(max(free_w, 1)))
    return src.withColumn("held", held).withColumn(
        "target", F.when(F.col("held"), (F.col("source_size") * cap).cast("double")).otherwise(share))


def fit_budget(length: list[int], count: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that the words taken come
    as near to ``budget`` as the lengths allow.

    Proportional shares first, then single documents of the largest lengths
    until the gap is below twice the longest, then bounded-knapsack reachability
    over the gap (bit k of a Python integer: k words can be reached).
    """
    order = sorted(range(len(length)), key=lambda i: length[i])
    length, count = [length[i] for i in order], [count[i] for i in order]
    total = sum(a * b for a, b in zip(length, count))
    if budget <= 0 or total == 0:
        return [0] * len(order)
    take = [c * budget // total for c in count] if budget < total else list(count)
    gap = budget - sum(a * b for a, b in zip(length, take))
    wide = 2 * length[-1]
    for i in reversed(range(len(length))):
        if gap <= wide:
            break
        more = min(count[i] - take[i], (gap - wide) // length[i] + 1)
        take[i] += more
        gap -= more * length[i]
    width = max(gap, 0) + length[-1] + 1
    mask, reach, steps = (1 << width) - 1, 1, []
    for i in range(len(length)):
        left, size = min(count[i] - take[i], width // length[i]), 1
        while left > 0 and not reach >> max(gap, 0) & 1:
            n = min(size, left)
            steps.append((reach, i, n))
            reach |= reach << (n * length[i]) & mask
            left, size = left - n, size * 2
    gap = max(gap, 0)
    below = (reach & ((1 << (gap + 1)) - 1)).bit_length() - 1
    above = reach >> (gap + 1)
    at = below
    if above and gap != below:
        up = gap + 1 + (above & -above).bit_length() - 1
        at = up if up - gap < gap - below else below
    for before, i, n in reversed(steps):
        if not before >> at & 1:
            at -= n * length[i]
            take[i] += n
    out = [0] * len(order)
    for k, i in enumerate(order):
        out[i] = take[k]
    return out


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    first = pdf.iloc[0]
    size, target = int(first["source_size"]), float(first["target"])
    passes = int(target // size) if size else 0
    budget = int(round(target - passes * size))
    pdf = pdf.sort_values("size")
    k = fit_budget([int(x) for x in pdf["size"]], [int(x) for x in pdf["n"]], budget)
    return pdf[["src", "src_null", "size", "n"]].assign(passes=passes, k=k)


def mix_plan(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS, seed: int = SEED,
             id_col: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, targets, picks): one skinny row per document; one row per source;
    and per (source, size) the full passes, the last rank hash that is taken in
    the partial pass, and how many rows that share this hash are taken.

    Ranks are found without a window over a whole length: the hash range of a
    length is cut into bins of about BIN_ROWS documents, bins are counted, and
    only the bin in which the last taken document lies is sorted.
    """
    rows = saved(keyed(docs, seed, id_col).select(
        F.col(id_col).alias("doc_id"), "src", "src_null", "size", "pick"), "mix-rows")
    sizes = rows.groupBy("src", "src_null").agg(F.sum("size").alias("source_size"))
    targets = saved(with_targets(sizes, weights, cap), "mix-targets")
    hist = (rows.where("size > 0").groupBy("src", "src_null", "size").agg(F.count("*").alias("n"))
            .join(targets.select("src", "src_null", "source_size", "target"), ["src", "src_null"]))
    fit = saved(hist.groupBy("src", "src_null").applyInPandas(
        _fit_source, "src string, src_null boolean, size long, n long, passes long, k long"), "mix-fit")
    key = ["src", "src_null", "size"]
    part = fit.where("k > 0 and k < n").withColumn("bins", F.ceil(F.col("n") / BIN_ROWS).cast("long"))
    binned = rows.join(_small(part), key).withColumn(
        "bin", F.floor((F.col("pick").cast("double") / 2 ** 62) * F.col("bins")).cast("long"))
    per_bin = binned.groupBy(*key, "bin", "k").agg(F.count("*").alias("m"))
    run = Window.partitionBy(*key).orderBy("bin")
    edge = (per_bin.withColumn("upto", F.sum("m").over(run))
            .where("upto >= k and upto - m < k")
            .select(*key, "bin", (F.col("k") - F.col("upto") + F.col("m")).alias("need")))
    order = Window.partitionBy(*key).orderBy("pick")
    last = (binned.join(_small(edge), [*key, "bin"])
            .withColumn("rank", F.row_number().over(order)).withColumn("low", F.rank().over(order))
            .where("rank = need")
            .select(*key, F.col("pick").alias("last_pick"), (F.col("need") - F.col("low") + 1).alias("ties")))
    picks = fit.join(last, key, "left").select(
        *key, "passes",
        F.when(F.col("k") == 0, F.lit(-1)).when(F.col("k") == F.col("n"), F.lit(1 << 62))
        .otherwise(F.col("last_pick")).alias("last_pick"),
        F.coalesce("ties", F.lit(0)).cast("long").alias("ties"))
    return rows, targets, saved(picks, "mix-picks")


def keyed(docs: DataFrame, seed: int, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """All columns plus src, src_null, size and the 62-bit pick hash."""
    return (docs.withColumn("src", F.coalesce(F.col(source_col).cast("string"), F.lit("")))
            .withColumn("src_null", F.col(source_col).isNull())
            .withColumn("size", n_words(text_col))
            .withColumn("pick", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 2)))


def _small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted rows are within ``limit``; beyond
    it the join shuffles and AQE splits hot keys."""
    return F.broadcast(df) if df.count() <= limit else df


def with_taken(rows: DataFrame, picks: DataFrame) -> DataFrame:
    """Add ``times`` (how often a row is taken) to rows that carry src, src_null, size, pick."""
    key = ["src", "src_null", "size"]
    out = rows.join(_small(picks), key, "left")
    tied = Window.partitionBy(*key, "pick").orderBy(F.lit(1))
    at = out.where("pick = last_pick").withColumn("extra", (F.row_number().over(tied) <= F.col("ties")).cast("long"))
    rest = out.where("last_pick is null or pick <> last_pick").withColumn(
        "extra", F.coalesce(F.col("pick") < F.col("last_pick"), F.lit(False)).cast("long"))
    return rest.unionByName(at).withColumn("times", F.coalesce("passes", F.lit(0)) + F.col("extra")).drop(
        "passes", "last_pick", "ties", "extra")


def apply_mix(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mixed documents: the input's columns, each row as often as it is taken."""
    _, _, picks = mix_plan(docs, weights, cap, seed)
    inner = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in inner.items()])
    rows = keyed(plain, seed, inner["doc_id"], inner["text"], inner["source"])
    out = with_taken(rows, picks).where("times > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select(*[F.col(a).alias(c) for c, a in inner.items()])


def q_mixing(spark, sf_dir):
    from ordwise.llm.store import read
    rows, targets, picks = mix_plan(read(spark, sf_dir, "documents"))
    t = targets.select("src", "src_null", "source_size", "target")
    return (with_taken(rows, picks).join(_small(t), ["src", "src_null"])
            .select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken")))
