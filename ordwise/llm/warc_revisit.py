"""Resolution of WARC not-modified revisits.

A server-not-modified revisit record holds only the headers of a 304 answer. It
is resolved by an as-of join on the canonical URL to the latest earlier full
response. Its validators are checked: an ETag (weak comparison) that differs, or
with no ETag on either side a Last-Modified that differs, means the response is
not the one the server meant. When they agree, the response's headers are kept
and those that a 304 may update are taken from the revisit.

Everything is DataFrame code. The as-of join is a window over time; so that a
URL with a large share of all records is not one task, time is cut into spans:
the window runs within (URL, span), and the last response of each span is
carried to the following ones by a window over spans. Bodies are not shuffled:
the result names the response.

Edge cases: a record with a null URL or time resolves to nothing; among
responses of the same instant the largest id wins, and a response of the same
instant as the revisit is not earlier; repeated rows resolve alike; empty tables
give an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordwise.llm.store import read

SPAN = 1 << 16
# Header fields that a 304 answer may update (RFC 9110, 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Scheme-less canonical form: lower-case host without user, default port,
    www. or m.; no fragment; path without trailing slash; query parameters sorted
    without ref and utm_ ones."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^(?i)https?://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(ref|utm_[^=]*)(=|$)")))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def _tag(headers: str) -> Column:
    return F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")


def resolve(records: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per revisit of (record_id, url, at, kind, headers): canonical_url,
    resolved_id, status (resolved, mismatch, missing) and the merged headers."""
    rec = records.select("record_id", "url", F.col("at").cast("long").alias("at"), "kind", "headers").withColumn(
        "site", canonical_url(F.col("url"))).withColumn("cut", F.floor(F.col("at") / span))
    full = F.when(F.col("kind") == "response", F.struct("at", "record_id", "headers"))
    whole = rec.where("kind = 'response' and site is not null and at is not null")
    last = whole.groupBy("site", "cut").agg(F.max_by(full, F.struct("at", "record_id")).alias("end"))
    spans = rec.where("site is not null and at is not null").select("site", "cut").distinct().join(last, ["site", "cut"], "left")
    before = Window.partitionBy("site").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("carry", F.last("end", ignorenulls=True).over(before)).select("site", "cut", "carry")
    inside = Window.partitionBy("site", "cut").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    here = F.max(F.when(F.col("kind") == "response", F.struct("at", "record_id", "headers_json"))).over(inside)
    rows = rec.withColumn("headers_json", F.to_json("headers")).withColumn("here", here)
    asked = rows.where("kind = 'revisit'").join(carried, ["site", "cut"], "left")
    placed = F.col("site").isNotNull() & F.col("at").isNotNull()
    found_id = F.when(placed, F.coalesce("here.record_id", "carry.record_id"))
    found = F.coalesce(F.from_json("here.headers_json", "map<string,string>"), F.col("carry.headers"))
    asked = asked.withColumn("resolved_id", found_id).withColumn("full", found)
    mine, theirs = _tag("headers"), _tag("full")
    when_mine, when_theirs = (F.element_at(c, "last-modified") for c in ("headers", "full"))
    same = F.when(mine.isNotNull() & theirs.isNotNull(), mine == theirs).when(
        mine.isNull() & theirs.isNull() & when_mine.isNotNull() & when_theirs.isNotNull(),
        when_mine == when_theirs).otherwise(mine.isNull() & (when_mine.isNull() | when_theirs.isNull() | (when_mine == when_theirs)))
    status = F.when(F.col("resolved_id").isNull(), "missing").when(same, "resolved").otherwise("mismatch")
    news = F.map_filter("headers", lambda k, _: k.isin(PERMITTED))
    kept = F.map_filter("full", lambda k, _: ~F.array_contains(F.map_keys(news), k))
    merged = F.when(status == "resolved", F.map_concat(kept, news))
    return asked.select("record_id", "url", F.col("site").alias("canonical_url"), "resolved_id", status.alias("status"),
                        merged.alias("headers"))


def capture_records(pages: DataFrame) -> DataFrame:
    """Crawl records of the pages table: each page is a full response, then a
    revisit some time later; its validators are the page's own, changed for
    every fifth page and absent for every seventh."""
    page = pages.select(F.col("page_id").cast("long").alias("p"), "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"))
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 12), F.lit('"'))
    day = F.concat(F.lit("day "), F.floor(F.col("p") / 50).cast("string"))
    response = page.select((F.col("p") * 2).alias("record_id"), "url", (F.col("p") * 10).alias("at"),
                           F.lit("response").alias("kind"),
                           F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), day,
                                        F.lit("etag"), tag).alias("headers"))
    later = F.col("p") * 10 + 5 + F.pmod(F.col("p") * 7919, F.lit(100_000))
    date = F.create_map(F.lit("content-type"), F.lit("text/plain"), F.lit("date"), F.concat(F.lit("later than "), day))
    own = F.create_map(F.lit("etag"), F.when(F.col("p") % 5 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag)))
    revisit = page.select((F.col("p") * 2 + 1).alias("record_id"), "url", later.alias("at"), F.lit("revisit").alias("kind"),
                          F.when(F.col("p") % 7 == 0, date).otherwise(F.map_concat(date, own)).alias("headers"))
    return response.unionByName(revisit)


def q_warc_revisit(spark, sf_dir):
    out = resolve(capture_records(read(spark, sf_dir, "pages").select("page_id", "url", "html")))
    return out.select("record_id", "canonical_url", "resolved_id", "status",
                      *[F.element_at("headers", h).alias(h.replace("-", "_")) for h in ("content-type", "date", "etag")])


ORACLE_SQL = r"""
WITH page AS (SELECT page_id::bigint AS p, url, '"' || md5(coalesce(html, ''))[1:12] || '"' AS tag,
    'day ' || (page_id // 50) AS day,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^https?://', '', 'i') AS rest FROM pages),
site AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)),
      '^.*@', ''), ':(80|443)$', ''), '^(www|m)\.', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(ref|utm_[^=]*)(=|$)'))), '&'), ''), '') AS canonical_url FROM page),
full_ AS (SELECT canonical_url, p * 10 AS at_, max(p) AS p FROM site GROUP BY 1, 2),
asked AS (SELECT p, canonical_url, p * 10 + 5 + (p * 7919) % 100000 AS at_, day,
    CASE WHEN p % 7 = 0 THEN NULL WHEN p % 5 = 0 THEN '"changed"' ELSE tag END AS mine,
    CASE WHEN p % 7 = 0 THEN NULL WHEN p % 5 = 0 THEN '"changed"' ELSE 'W/' || tag END AS sent FROM site),
j AS (SELECT a.*, f.p AS fp FROM asked a ASOF LEFT JOIN full_ f ON a.canonical_url = f.canonical_url AND a.at_ > f.at_),
s AS (SELECT j.*, q.tag, CASE WHEN fp IS NULL THEN 'missing' WHEN mine IS NULL OR mine = q.tag THEN 'resolved'
    ELSE 'mismatch' END AS status FROM j LEFT JOIN page q ON j.fp = q.p)
SELECT p * 2 + 1 AS record_id, canonical_url, fp * 2 AS resolved_id, status,
  CASE WHEN status = 'resolved' THEN 'text/html' END AS content_type,
  CASE WHEN status = 'resolved' THEN 'later than ' || day END AS date,
  CASE WHEN status = 'resolved' THEN coalesce(sent, tag) END AS etag FROM s"""
