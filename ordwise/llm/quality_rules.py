"""Quality rules with host-level verdicts.

Every document is measured once. Base rules fail a document by themselves.
Soft rules (symbol density, repeated lines, mean word length) are judged with
the host: failures are counted per source, each source's rate is shrunk with a
beta prior fitted to all sources by the method of moments, and a source whose
shrunk rate exceeds ``host_rate`` is condemned for that rule. Its verdict goes
back to its documents: one that fails a rule its own host is condemned for is
rejected, while the same lone failure elsewhere is let pass, and a clean
document of a condemned host stays.

Edge cases: null text has no words and fails the base rule; a null source is a
host of its own; repeated rows are counted and judged as rows of their own; an
empty table gives an empty result; clashing extra columns are not read, and
:func:`apply_rules` keeps the input's columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordwise.llm.store import read, saved, tidied
from ordwise.llm.words import SPACE, combine, mix, slices, split_words, text_buffer

SHINGLE = 5
HOST_RATE = 0.02
HOST_ROWS_BROADCAST = 200_000
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = {
    "symbols": "10 * {n_symbols} > {n_words}",
    "dup_lines": "{n_dup_lines} >= 3 and 20 * {n_dup_lines} > {n_words}",
    "word_length": "{word_chars} < 2 * {n_words} or {word_chars} > 12 * {n_words}",
}


def _sum_by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _dup_lines(data: bytes) -> int:
    seen, n = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(b" \t\n\x0b\x0c\r"):
            seen.add(line)
    return n


def repeat_words(h: np.ndarray, row: np.ndarray, first: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row, the words inside five-word windows that occur twice or more in it."""
    n = len(h) - SHINGLE + 1
    out = np.zeros(n_rows, np.int64)
    if n <= 0:
        return out
    g = h[:n]
    for k in range(1, SHINGLE):
        g = combine(g, h[k: n + k])
    at = np.flatnonzero(row[:n] == row[SHINGLE - 1:])
    key = combine(g[at], mix(row[at].astype(np.uint64)))
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    dup = np.zeros(len(key), bool)
    dup[1:] |= same
    dup[:-1] |= same
    cover = np.zeros(len(h) + 1, np.int64)
    hit = at[order[dup]]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + SHINGLE, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return _sum_by_row(covered, first)


def measure(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The five measures of each row of a slice."""
    w = split_words(buf, offsets)
    raw = buf.tobytes()
    head = ((buf & 0xC0) != 0x80) & ~SPACE[buf]
    lines = np.array([_dup_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.int64)
    return [w.per_row, _sum_by_row(head, offsets), _sum_by_row(SYMBOL[buf], offsets), lines,
            repeat_words(w.hash, w.row, w.first, len(offsets) - 1)]


def measured(docs: DataFrame, text_col: str, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus the measures (names prefixed by ``prefix``)."""
    names = [prefix + m for m in MEASURES]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} long" for n in names])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offs = text_buffer(b.column(at))
            for i, j in slices(offs):
                m = measure(buf[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(x) for x in m]],
                                                 names=[*part.schema.names, *names])

    return docs.mapInArrow(tidied(run), schema)


def base_failed(p: str = "") -> Column:
    return F.expr(f"{p}n_words < 10 or 100 * {p}n_repeat_words > 20 * {p}n_words")


def rule(name: str, p: str = "") -> Column:
    return F.expr(RULES[name].format(**{m: p + m for m in MEASURES}))


def host_rates(rows: DataFrame, host: str, p: str = "") -> DataFrame:
    """Per host: documents, and per rule the failures, the shrunk rate and the verdict column bad_<rule>.

    The prior's mean and strength come from the mean and variance of the hosts'
    rates beyond binomial noise; without such spread the prior pools all hosts.
    """
    hosts = saved(rows.where(~base_failed(p)).groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(rule(r, p).cast("long")).alias(f"n_{r}") for r in RULES]), "hosts")
    return hosts


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Beta parameters (a, b) of each rule, from sums over all hosts."""
    aggs = [F.count("*").alias("hosts"), F.sum("n").alias("docs"), F.sum(1 / F.col("n")).alias("inv")]
    for r in RULES:
        rate = F.col(f"n_{r}") / F.col("n")
        aggs += [F.sum(f"n_{r}").alias(f"f_{r}"), F.sum(rate).alias(f"s_{r}"), F.sum(rate * rate).alias(f"q_{r}")]
    t = hosts.agg(*aggs).first()
    out = {}
    for r in RULES:
        if not t["docs"]:
            out[r] = (1.0, 1.0)
            continue
        k = t["hosts"]
        m = min(max((t[f"f_{r}"] + 0.5) / (t["docs"] + 1.0), 1e-6), 1 - 1e-6)
        spread = max(t[f"q_{r}"] / k - (t[f"s_{r}"] / k) ** 2 - m * (1 - m) * t["inv"] / k, 0.0)
        strength = min(max(m * (1 - m) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
        out[r] = (m * strength, (1 - m) * strength)
    return out


def verdicts(hosts: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """host and, per rule, the shrunk rate and whether the host is condemned for it."""
    cols = [F.col("host")]
    for r, (a, b) in priors(hosts).items():
        rate = (F.col(f"n_{r}") + F.lit(a)) / (F.col("n") + F.lit(a + b))
        cols += [F.round(rate, 9).alias(f"rate_{r}"), (F.round(rate, 9) > host_rate).alias(f"bad_{r}")]
    return hosts.select(*cols)


def judged(rows: DataFrame, hosts: DataFrame, host: str, host_rate: float = HOST_RATE, p: str = "") -> DataFrame:
    """Rows with __base and __kept: host verdicts joined back on the host. The
    verdicts are broadcast when their counted rows are within the bound;
    otherwise the join shuffles and AQE splits a hot host."""
    v = verdicts(hosts, host_rate).select(F.col("host").alias("__host"), *[f"bad_{r}" for r in RULES])
    if hosts.count() <= HOST_ROWS_BROADCAST:
        v = F.broadcast(v)
    out = rows.join(v, F.col(host).eqNullSafe(F.col("__host")), "left")
    condemned = F.lit(False)
    for r in RULES:
        condemned = condemned | (rule(r, p) & F.coalesce(F.col(f"bad_{r}"), F.lit(False)))
    out = out.withColumn("__base", base_failed(p)).withColumn("__kept", ~base_failed(p) & ~condemned)
    return out.drop("__host", *[f"bad_{r}" for r in RULES])


def apply_rules(docs: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """The documents that the rules keep, with the input's columns.

    Texts are measured twice rather than shuffled or stored: once for the host
    counts, once on the way out.
    """
    inner = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in inner.items()])
    host, text, p = inner["source"], inner["text"], "__m_"
    hosts = host_rates(measured(plain.select(host, text), text, p), host, p)
    out = judged(measured(plain, text, p), hosts, host, host_rate, p)
    return out.where("__kept").select(*[F.col(a).alias(c) for c, a in inner.items()])


def q_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = saved(measured(docs, "text").drop("text"), "quality-measures")
    return judged(rows, host_rates(rows, "source"), "source").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("__base").alias("base_failed"), F.col("__kept").alias("kept"))


def _oracle(documents: str = "documents") -> str:
    soft = {r: e.format(**{m: m for m in MEASURES}) for r, e in RULES.items()}
    sums = ", ".join(f"sum(({e})::int) AS n_{r}" for r, e in soft.items())
    prior, verdict = [], []
    for r in RULES:
        prior.append(f"""
  p_{r} AS (SELECT m * s AS a, (1 - m) * s AS b FROM (
    SELECT m, CASE WHEN spread > 0 THEN least(greatest(m * (1 - m) / spread - 1, 1.0), 1e6) ELSE 1e6 END AS s FROM (
      SELECT m, greatest(q / k - (t / k) * (t / k) - m * (1 - m) * inv / k, 0.0) AS spread FROM (
        SELECT least(greatest((sum(n_{r}) + 0.5::double) / (sum(n) + 1.0::double), 1e-6), 1 - 1e-6) AS m, count(*) AS k,
          sum(n_{r}::double / n) AS t, sum((n_{r}::double / n) * (n_{r}::double / n)) AS q, sum(1::double / n) AS inv
        FROM hosts))))""")
        verdict.append(f"round((n_{r} + p_{r}.a) / (n + p_{r}.a + p_{r}.b), 9) > {HOST_RATE} AS bad_{r}")
    out = " OR ".join(f"(({e}) AND coalesce(bad_{r}, false))" for r, e in soft.items())
    return rf"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS ws FROM {documents}),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, i + unnest(range(0, 5)) AS pos FROM twice) GROUP BY 1),
f AS (
  SELECT s.doc_id, source, len(ws)::bigint AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint AS n_dup_lines, coalesce(r.n, 0)::bigint AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS ls FROM split) s
  LEFT JOIN repeats r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
hosts AS (SELECT source, count(*) AS n, {sums} FROM b WHERE NOT base_failed GROUP BY source), {",".join(prior)},
v AS (SELECT source AS host, {", ".join(verdict)} FROM hosts{"".join(f", p_{r}" for r in RULES)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({out}) AS kept
FROM b LEFT JOIN v ON source IS NOT DISTINCT FROM host"""


ORACLE_SQL = _oracle()
