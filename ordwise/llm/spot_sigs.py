r"""Document fingerprints by spot signatures.

A word is a run of letters and digits, lower-cased. Anchors are the common words:
those that make up at least one in ``ANCHOR_SHARE`` of the words of a language
that itself holds at least one in ``LANG_SHARE`` of all words, counted over every
document, so there are at most ``ANCHOR_SHARE * LANG_SHARE`` of them. Behind every
anchor the next ``CHAIN`` content words (words that are no anchors; anchors in
between are stepped over) form a spot signature, kept as the first eight hex
digits of the MD5 of anchor and chain. The fingerprint is the set of a text's
signatures, ascending and joined by commas. A function of the text and the anchors alone:
equal texts have equal fingerprints.

Two fingerprints are compared by the Jaccard likeness of their sets
(:func:`likeness`). :func:`search` finds, for a stated query set, every document
of at least a given likeness: sets are partitioned by their length so that a
partner can only be in the same partition or a neighbouring one, candidates share
one of the rarest signatures of both sets (by the pruning bound one such
signature must be common), lengths too far apart are pruned, and the rest is
compared in full.

Everything is DataFrame code: no Python on the rows.

The neighbour of a document in descending order of ids (:func:`with_next`) is
found without a global window: narrow keys are dealt by ranges of the order,
followed inside each range, and the ranges' first keys (one row a range) are
followed in turn. Texts cross one shuffle, prefixes of the neighbours another.

Edge cases: null text counts as empty and has the empty fingerprint; a text without
anchors takes the chain at each of its words, one without words has a single signature, of
the whole text; two empty fingerprints have likeness 1. Rows of equal id and equal
text are one document with one next document; rows that share an id but not the
text follow each other by a hash of the text; null ids come last. The next of the last is
the first, so a lone document is its own next. An empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordwise.llm.store import read, saved

WORD_GAP = r"[^\p{L}\p{N}]+"
CHAIN = 3
ANCHOR_SHARE = 200
LANG_SHARE = 200
SIMILAR = (75, 100)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_GAP), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def find_anchors(docs: DataFrame, share: int = ANCHOR_SHARE, lang_share: int = LANG_SHARE) -> list[str]:
    """The common words of ``docs`` (lang, text), ascending; at most share * lang_share."""
    counts = saved(docs.select("lang", F.explode(words(F.col("text"))).alias("word"))
                   .groupBy("lang", "word").agg(F.count("*").alias("n")), "spot-words")
    langs = counts.groupBy("lang").agg(F.sum("n").alias("of_lang"))
    total = langs.agg(F.sum("of_lang")).first()[0] or 0
    large = langs.where(F.col("of_lang") * lang_share >= total)
    rows = counts.join(F.broadcast(large), counts["lang"].eqNullSafe(large["lang"])).where(
        F.col("n") * share >= F.col("of_lang")).select("word").distinct().collect()
    return sorted(r["word"] for r in rows)


def signatures(text: Column, anchors: list[str]) -> Column:
    """The set of spot signatures of a text, an ascending array of strings."""
    def common(w: Column) -> Column:
        return w.isin(anchors) if anchors else F.lit(False)

    def sign(*parts: Column) -> Column:
        return F.left(F.md5(F.concat_ws(" ", *parts)), F.lit(8))

    def at_anchors(s: Column) -> Column:
        # The j-th anchor stands at word p, so p - j content words precede it.
        return F.transform(s["at"], lambda p, j: sign(
            F.get(s["all"], p), *[F.get(s["content"], p - j + k) for k in range(CHAIN)]))

    def at_words(s: Column) -> Column:
        return F.transform(s["all"], lambda w, i: sign(*[F.get(s["all"], i + k) for k in range(CHAIN)]))

    def spots(s: Column) -> Column:
        return (F.when(F.size(s["at"]) > 0, at_anchors(s)).when(F.size(s["all"]) > 0, at_words(s))
                .when(text != "", F.array(F.left(F.md5(text), F.lit(8)))).otherwise(F.array().cast("array<string>")))

    def parts(w: Column) -> Column:
        places = F.filter(F.transform(w, lambda x, i: F.when(common(x), i)), lambda i: i.isNotNull())
        return F.struct(w.alias("all"), F.filter(w, lambda x: ~common(x)).alias("content"), places.alias("at"))

    return F.sort_array(F.array_distinct(_let(_let(words(text), parts), spots)))


def joined(sigs: Column) -> Column:
    """The fingerprint as text."""
    return F.array_join(sigs, ",")


def sets(fingerprint: Column) -> Column:
    """The signatures of a fingerprint."""
    return F.filter(F.split(fingerprint, ","), lambda s: s != "")


def packed(sigs: Column) -> Column:
    """The set in four bytes a signature, for shuffles."""
    return F.unhex(F.array_join(sigs, ""))


def unpacked(sigs: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.hex(sigs)), F.lit(".{8}"), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def fingerprints(docs: DataFrame, anchors: list[str] | None = None) -> DataFrame:
    """(doc_id, fingerprint) of every row; anchors are counted here unless given."""
    anchors = find_anchors(docs) if anchors is None else anchors
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", joined(signatures(text, anchors)).alias("fingerprint"))


# -- search ----------------------------------------------------------------------

def _length_part(n: Column, similar: tuple[int, int]) -> Column:
    """Partition of a set length; partners' lengths differ by a factor of at most
    1 / similarity, so their partitions by one at most."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(similar[1] / similar[0])) + 1e-9).cast("int")


def _rare_first(rows: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """One row for each of the rarest signatures of a set, as many as pruning needs:
    sets of n signatures that reach the similarity share at least one of the
    n - ceil(similarity * n) + 1 rarest of both."""
    order = Window.partitionBy("set").orderBy("df", "sig")
    need = F.col("n") - F.ceil(F.col("n") * similar[0] / similar[1] - 1e-9) + 1
    return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= need).drop("r", "df")


def search(queries: DataFrame, base: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(query_id, doc_id, likeness) of every row of ``base`` that reaches the likeness
    for a row of ``queries``; both have (doc_id, fingerprint). A row finds itself if it
    is in both; empty fingerprints find nothing. Equal fingerprints are compared once."""
    q = queries.where("fingerprint <> ''").select(F.col("doc_id").alias("query_id"), "fingerprint")
    b = base.where("fingerprint <> ''").select("doc_id", "fingerprint")
    distinct = saved(b.select("fingerprint").unionByName(q.select("fingerprint")).distinct().select(
        F.sha2("fingerprint", 256).alias("set"), sets(F.col("fingerprint")).alias("sigs")), "spot-sets")
    sized = distinct.select("set", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    df = sized.groupBy("sig").agg(F.count("*").alias("df"))
    rare = saved(_rare_first(sized.join(df, "sig"), similar).withColumn("part", _length_part(F.col("n"), similar)),
                 "spot-rare")
    asked = q.select(F.sha2("fingerprint", 256).alias("set")).distinct()
    left = rare.join(asked, "set", "left_semi").select(
        F.col("set").alias("q"), F.col("n").alias("qn"), "sig",
        F.explode(F.array(F.col("part") - 1, "part", F.col("part") + 1)).alias("part"))
    close = (F.col("n") * similar[1] >= F.col("qn") * similar[0]) & (F.col("qn") * similar[1] >= F.col("n") * similar[0])
    found = left.join(rare, ["part", "sig"]).where(close).select("q", "set").distinct()
    pairs = (found.join(distinct.select(F.col("set").alias("q"), F.col("sigs").alias("a")), "q")
             .join(distinct.select("set", F.col("sigs").alias("b")), "set")
             .select("q", "set", likeness(F.col("a"), F.col("b")).alias("likeness"))
             .where(F.col("likeness") >= similar[0] / similar[1]))
    return (q.select("query_id", F.sha2("fingerprint", 256).alias("q")).join(pairs, "q")
            .join(b.select("doc_id", F.sha2("fingerprint", 256).alias("set")), "set")
            .select("query_id", "doc_id", "likeness"))


# -- the next document -----------------------------------------------------------

ORDER = ["last", "down", "k1", "k2"]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 128-bit key (k1, k2) of id and text."""
    return docs.withColumn("k1", F.xxhash64(F.lit(11), "doc_id", F.lit(0), "text")).withColumn(
        "k2", F.xxhash64(F.lit(13), "doc_id", F.lit(0), "text"))


def next_keys(keys: DataFrame) -> DataFrame:
    """(k1, k2, n_chars, n1, n2): every distinct document and the key of the next one
    in descending order of ids."""
    rows = keys.select(F.col("doc_id").isNull().alias("last"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("down"),
                       "k1", "k2", "n_chars").distinct()
    dealt = saved(rows.repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()), "spot-order")
    inside = dealt.withColumn("next", F.lead(F.struct("k1", "k2")).over(Window.partitionBy("part").orderBy(*ORDER)))
    heads = dealt.groupBy("part").agg(F.min(F.struct(*ORDER)).alias("head"))
    every = Window.orderBy("part")
    turn = heads.select("part", F.coalesce(
        F.lead("head").over(every),
        F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("turn"))
    return inside.join(F.broadcast(turn), "part").select(
        "k1", "k2", "n_chars", F.coalesce("next.k1", "turn.k1").alias("n1"), F.coalesce("next.k2", "turn.k2").alias("n2"))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``docs`` (doc_id, text without nulls, and the columns ``carried``) with k1, k2,
    ``next_start``, the first floor(length / 3) code points of the next document or
    all of it, ``next_doc_id`` and ``next_<c>`` for each carried column."""
    docs = keyed(docs)
    follows = saved(next_keys(docs.select("doc_id", "k1", "k2", F.char_length("text").alias("n_chars"))), "spot-next")
    wants = follows.select(F.col("n1").alias("k1"), F.col("n2").alias("k2"), F.col("k1").alias("w1"),
                           F.col("k2").alias("w2"), F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"))
    # Both uses of the dealt rows take the same columns, so that one shuffle serves both.
    dealt = docs.select("k1", "k2", "doc_id", "text", *carried).repartition("k1", "k2")
    one = dealt.groupBy("k1", "k2").agg(*[F.first(c).alias(c) for c in ["doc_id", "text", *carried]])
    given = one.join(wants, ["k1", "k2"]).select(
        F.col("w1").alias("k1"), F.col("w2").alias("k2"), F.left("text", F.col("wanted")).alias("next_start"),
        F.col("doc_id").alias("next_doc_id"), *[F.col(c).alias(f"next_{c}") for c in carried])
    return dealt.join(given, ["k1", "k2"])


def compared(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint and that of its edited text, whose last third is
    replaced by the start of the next document, and the likeness of its fingerprint to
    the edited text's and to the next document's."""
    docs = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    anchors = find_anchors(docs)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                      packed(signatures(F.col("text"), anchors)).alias("sigs"))
    n = F.char_length("text").cast("long")
    edited = with_next(own, ["sigs"]).select(
        "doc_id", "next_doc_id", n.alias("n_chars"), "sigs", "next_sigs",
        F.concat(F.left("text", (n - F.floor(n / 3)).cast("int")), "next_start").alias("edited"))
    # Each set is computed once a row.
    sides = edited.select(
        "doc_id", "next_doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        _let(F.struct(unpacked(F.col("sigs")).alias("own"), signatures(F.col("edited"), anchors).alias("edited"),
                      unpacked(F.col("next_sigs")).alias("next")),
             lambda s: F.struct(joined(s["own"]).alias("fingerprint"), joined(s["edited"]).alias("edited_fingerprint"),
                                likeness(s["own"], s["edited"]).alias("near_edited"),
                                likeness(s["own"], s["next"]).alias("near_next"))).alias("s"))
    return sides.select("doc_id", "n_chars", "edited_sha256", "s.fingerprint", "s.edited_fingerprint", "s.near_edited",
                        "s.near_next", "next_doc_id")


def q_spot_sigs(spark, sf_dir):
    return compared(read(spark, sf_dir, "documents"))


_SIGS = r"""
    CASE WHEN len(places) > 0 THEN list_transform(range(1, len(places) + 1), lambda j:
           left(md5(concat_ws(' ', ws[places[j]], content[places[j] - j + 1], content[places[j] - j + 2], content[places[j] - j + 3])), 8))
         WHEN len(ws) > 0 THEN list_transform(range(1, len(ws) + 1), lambda i:
           left(md5(concat_ws(' ', ws[i], ws[i + 1], ws[i + 2])), 8))
         WHEN t <> '' THEN [left(md5(t), 8)] ELSE []::varchar[] END"""


def _sig_sql(source: str) -> str:
    """(doc_id, t, sigs) over a table (doc_id, t)."""
    return rf"""
  SELECT doc_id, t, list_sort(list_distinct({_SIGS})) AS sigs FROM (
    SELECT *, list_filter(ws, lambda w: NOT list_contains(a, w)) AS content,
      list_filter(range(1, len(ws) + 1), lambda i: list_contains(a, ws[i])) AS places FROM (
      SELECT doc_id, t, list_filter(string_split_regex(lower(t), '{WORD_GAP}'), lambda w: w <> '') AS ws,
        coalesce((SELECT list(word) FROM anchors), []) AS a FROM {source}))"""


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
counts AS (SELECT lang, word, count(*) AS n FROM (
  SELECT lang, unnest(list_filter(string_split_regex(lower(t), '{WORD_GAP}'), lambda w: w <> '')) AS word FROM d) GROUP BY 1, 2),
langs AS (SELECT lang, sum(n) AS of_lang FROM counts GROUP BY 1),
anchors AS (SELECT DISTINCT word FROM counts c JOIN langs l ON c.lang IS NOT DISTINCT FROM l.lang
  WHERE of_lang * {LANG_SHARE} >= (SELECT sum(of_lang) FROM langs) AND n * {ANCHOR_SHARE} >= of_lang),
own AS ({_sig_sql("d")}),
follow AS (SELECT doc_id, t, sigs, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_doc_id,
  coalesce(lead(t) OVER w, first_value(t) OVER w) AS next_t, coalesce(lead(sigs) OVER w, first_value(sigs) OVER w) AS next_sigs
  FROM own WINDOW w AS (ORDER BY doc_id DESC)),
changed AS (SELECT doc_id, left(t, length(t) - length(t) // 3) || left(next_t, length(t) // 3) AS t FROM follow),
edited AS ({_sig_sql("changed")}),
x AS (SELECT f.doc_id, next_doc_id, length(f.t)::bigint AS n_chars, sha256(e.t) AS edited_sha256, f.sigs, e.sigs AS esigs, next_sigs,
    len(list_intersect(f.sigs, e.sigs)) AS ie, len(list_intersect(f.sigs, next_sigs)) AS inx
  FROM follow f JOIN edited e USING (doc_id))
SELECT doc_id, n_chars, edited_sha256, array_to_string(sigs, ',') AS fingerprint,
  array_to_string(esigs, ',') AS edited_fingerprint,
  CASE WHEN len(sigs) + len(esigs) = 0 THEN 1.0::double ELSE ie::double / (len(sigs) + len(esigs) - ie) END AS near_edited,
  CASE WHEN len(sigs) + len(next_sigs) = 0 THEN 1.0::double ELSE inx::double / (len(sigs) + len(next_sigs) - inx) END AS near_next,
  next_doc_id
FROM x"""
