"""Resolution of not-modified revisits: an as-of join to the latest earlier full response.

A capture log holds full responses and revisits (status 304, headers only). A
revisit stands for the latest full response of its canonical URL captured before
it, if its validators agree: the entity tag by weak comparison if it has one,
otherwise the last-modified date. The resolved record has the full response's
headers, updated by those a 304 may carry (``PERMITTED``).

One URL may have any share of all captures. Captures are range-partitioned by
(URL, time) into slices, so such a URL spreads over many; inside a slice a window
finds the latest response, and what a slice inherits comes from one row for each
slice of the few URLs that reach over a slice border. The slices are settled in
the shared folder before they are used twice.

Defined results: a capture without URL, or a revisit without time, is
``no_response``; full responses without URL or time are never referred to. A
response at the revisit's own time is not earlier. Of several at one time the
largest record id counts. A revisit without validators, or with one the response
lacks, is ``not_validated``. Repeated revisits give one row each. Of header names
equal but for case the first counts; null headers are none. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, lower_ascii, settled

# The header fields of a 304 response that update a stored one (RFC 9110, 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
# Query parameters that do not name another resource.
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` or a default port, path without a last slash, sorted
    parameters without tracking ones; no scheme, no fragment. Null or empty stays null."""
    bare = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(lower_ascii(F.regexp_extract(bare, "^([^/?]*)", 1)), r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^/?]*([^?]*)", 1), "/$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"(?s)\?(.*)$", 1), "&"),
                                  lambda p: (p != "") & ~F.regexp_like(p, F.lit(TRACKING))))
    joined = F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(joined != "", joined)


def _named(headers: Column) -> Column:
    """Headers with names in lower case; of equal names the first."""
    names = F.array_distinct(F.transform(F.map_keys(headers), lambda k: F.lower(k)))
    value = lambda name: F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)[0]["value"]
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.map_from_arrays(names, F.transform(names, value)), empty)


def _merged(stored: Column, update: Column) -> Column:
    allowed = F.map_filter(update, lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def _agree(stored: Column, update: Column) -> Column:
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    return F.coalesce(F.when(update["etag"].isNotNull(), tag(stored) == tag(update)).otherwise(
        stored["last-modified"] == update["last-modified"]), F.lit(False))


def resolve(captures: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url_key, ts, outcome, refers_to, headers.

    ``captures`` has record_id, url, ts, status and headers (a map); status 304
    marks a revisit, 200 a full response, others are ignored.
    """
    order = ["key", "ts", "full", "record_id"]
    rows = (captures.where(F.col("status").isin(200, 304))
            .select("record_id", canonical_url(F.col("url")).alias("key"), "ts",
                    (F.col("status") == 200).alias("full"), _named(F.col("headers")).alias("headers"))
            .where(~F.col("full") | (F.col("key").isNotNull() & F.col("ts").isNotNull())))
    # a revisit at a response's time comes before it
    sliced = settled(rows.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()))
    response = F.when(F.col("full"), F.struct("record_id", "headers"))
    before = Window.partitionBy("slice", "key").orderBy("ts", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = sliced.withColumn("near", F.last(response, ignorenulls=True).over(before)).where(~F.col("full"))

    ends = settled(sliced.where(F.col("key").isNotNull()).groupBy("slice").agg(F.min("key").alias("lo"), F.max("key").alias("hi")))
    later = ends.select(F.col("lo").alias("key"), F.col("slice").alias("later"))
    reaching = ends.select(F.col("hi").alias("key"), "slice").join(later, "key").where("later > slice").select("key").distinct()
    latest = (sliced.join(broadcast_if_small(settled(reaching)), "key").groupBy("key", "slice")
              .agg(F.max_by(response, F.when(F.col("full"), F.struct("ts", "record_id"))).alias("latest")))
    inherits = F.last("latest", ignorenulls=True).over(
        Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    inherited = settled(latest.select(F.col("key").alias("_key"), F.col("slice").alias("_slice"), inherits.alias("far")))

    found = near.join(broadcast_if_small(inherited), (F.col("key") == F.col("_key")) & (F.col("slice") == F.col("_slice")), "left")
    base = F.when(F.col("key").isNotNull() & F.col("ts").isNotNull(), F.coalesce("near", "far"))
    judged = found.select("record_id", F.col("key").alias("url_key"), "ts", "headers", base.alias("base"))
    outcome = F.when(F.col("base").isNull(), "no_response").when(
        _agree(F.col("base.headers"), F.col("headers")), "resolved").otherwise("not_validated")
    resolved = F.col("outcome") == "resolved"
    return judged.withColumn("outcome", outcome).select(
        "record_id", "url_key", "ts", "outcome", F.when(resolved, F.col("base.record_id")).alias("refers_to"),
        F.when(resolved, _merged(F.col("base.headers"), F.col("headers"))).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """A capture log made of ``pages``: each page in full, a revisit of it, and a capture of its host's front page.

    Front pages are captured in full at every 25th page, so a host's front page
    has as many captures as the host has pages. A page without id or url has captures
    without time or address, of which the revisits come out as ``no_response``.
    """
    p = pages.selectExpr(
        "page_id", "url", "md5(coalesce(html, '')) AS sum", "length(coalesce(html, '')) AS size",
        "concat(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1), '/') AS front")
    full = p.selectExpr(
        "page_id * 4 AS record_id", "url", "page_id * 60 AS ts", "200 AS status",
        """map('ETag', concat('"', sum, '"'), 'Last-Modified', cast(page_id DIV 10 AS string), 'Content-Length',
               cast(size AS string), 'Date', cast(page_id * 60 AS string)) AS headers""")
    again = p.selectExpr(
        "page_id * 4 + 1 AS record_id", "url", "page_id * 60 + 30 AS ts", "304 AS status",
        """map('etag', CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('W/"', sum, '"') WHEN 2 THEN '"other"'
                       ELSE concat('"', sum, '"') END,
               'last-modified', cast(page_id DIV 10 AS string), 'Cache-Control', 'max-age=60',
               'Content-Length', '0', 'Date', cast(page_id * 60 + 30 AS string)) AS headers""")
    front = p.selectExpr(
        "page_id * 4 + 2 AS record_id", "front AS url", "page_id * 60 + 45 AS ts",
        "CASE WHEN page_id % 25 = 0 THEN 200 ELSE 304 END AS status",
        """map('ETag', concat('"v', cast(page_id DIV 1000 AS string), '"'), 'Content-Length',
               cast(CASE WHEN page_id % 25 = 0 THEN size ELSE 0 END AS string),
               'Date', cast(page_id * 60 + 45 AS string)) AS headers""")
    return full.unionByName(again).unionByName(front)


def digest(resolved: DataFrame) -> DataFrame:
    """Resolved revisits with the headers as one string, lines sorted by name."""
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return resolved.select("record_id", "url_key", "ts", "outcome", "refers_to", F.array_join(lines, "\n").alias("headers"))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS sum, length(coalesce(html, '')) AS size,
         regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/' AS front
  FROM pages),
log AS (
  SELECT page_id * 4 AS record_id, url, page_id * 60 AS ts, TRUE AS is_full, '"' || sum || '"' AS etag,
         CAST(page_id // 10 AS VARCHAR) AS lm, CAST(size AS VARCHAR) AS len, NULL AS cc FROM p
  UNION ALL
  SELECT page_id * 4 + 1, url, page_id * 60 + 30, FALSE,
         CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'W/"' || sum || '"' WHEN 2 THEN '"other"' ELSE '"' || sum || '"' END,
         CAST(page_id // 10 AS VARCHAR), '0', 'max-age=60' FROM p
  UNION ALL
  SELECT page_id * 4 + 2, front, page_id * 60 + 45, coalesce(page_id % 25 = 0, FALSE), '"v' || CAST(page_id // 1000 AS VARCHAR) || '"', NULL,
         CAST(CASE WHEN page_id % 25 = 0 THEN size ELSE 0 END AS VARCHAR), NULL FROM p),
bare AS (SELECT *, row_number() OVER () AS rid, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM log),
cut AS (
  SELECT *, regexp_replace(regexp_replace(translate(regexp_extract(b, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '^www\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(b, '(?s)^[^/?]*([^?]*)', 1), '/$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(b, '(?s)\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS q
  FROM bare),
keyed AS (SELECT *, nullif(host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END, '') AS key FROM cut),
paired AS (
  SELECT r.*, f.record_id AS base, f.etag AS f_etag, f.lm AS f_lm, f.len AS f_len
  FROM (SELECT * FROM keyed WHERE NOT is_full) r
  LEFT JOIN (SELECT * FROM keyed WHERE is_full) f ON f.key = r.key AND f.ts < r.ts
  QUALIFY row_number() OVER (PARTITION BY r.rid ORDER BY f.ts DESC NULLS LAST, f.record_id DESC) = 1),
judged AS (
  SELECT *, CASE WHEN base IS NULL THEN 'no_response'
                 WHEN coalesce(CASE WHEN etag IS NOT NULL THEN regexp_replace(f_etag, '^W/', '') = regexp_replace(etag, '^W/', '')
                               ELSE f_lm = lm END, FALSE) THEN 'resolved' ELSE 'not_validated' END AS outcome
  FROM paired)
SELECT record_id, key AS url_key, ts, outcome, CASE WHEN outcome = 'resolved' THEN base END AS refers_to,
       CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'cache-control: ' || cc, 'content-length: ' || f_len,
         'date: ' || CAST(ts AS VARCHAR), 'etag: ' || coalesce(etag, f_etag), 'last-modified: ' || f_lm) END AS headers
FROM judged
"""
