"""WARC: resolution of not-modified revisits.

A server answers a repeated request with 304 and no body; the crawler stores a
``revisit`` record. Each is joined as of its date to the latest earlier full
response with the same canonical URL. If the validators of both agree, it gets
that response's payload, and its headers with the fields that a 304 may
update.

Records are parsed once, into a table with a number for each row. The as-of
join works on the instants of that table at which a URL was visited, one narrow
row each however many records there are, and in two levels: by a window within
ranges of ``RANGE_SECONDS`` of one URL, and across ranges by the last response
of each. So a group is bounded by the seconds of a range. Payloads move once,
in the last join, by row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, table

RANGE_SECONDS = 86_400
#: Query parameters that don't name another resource.
TRACKING = "^(utm_[a-z]+|ref|gclid|fbclid)="
#: Fields of a stored response that a 304 never replaces: those of the body's form, and of one connection.
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"


def canonical_url(url: Column) -> Column:
    """Host and path that name a page: no scheme, ``www.``, default port, fragment, closing slashes or tracking parameters.

    The host is lower-cased, other parameters are sorted. Null stays null; a
    string without a scheme has no host.
    """
    u = F.regexp_replace(url, "#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, _SCHEME + "([^/?]*)", 1)), ":(80|443)$", ""), "^www\\.", "")
    rest = F.regexp_replace(u, _SCHEME + "[^/?]*", "")
    path = F.regexp_replace(F.split_part(rest, F.lit("?"), F.lit(1)), "/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, "^[^?]*\\?(.*)$", 1), "^$", "&")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


_HEADERS = "array<struct<name:string,value:string>>"


def _fields(head: Column) -> Column:
    """``name: value`` lines as structs, names in lower case."""
    lines = F.filter(F.split(head, "\r\n"), lambda x: F.instr(x, ":") > 0)
    return F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))


def field(headers: Column, name: str) -> Column:
    """A field's values, joined by ``, `` if repeated; null without one."""
    found = F.transform(F.filter(headers, lambda h: h["name"] == name), lambda h: h["value"])
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def parse_warc(records: DataFrame, raw: str = "raw") -> DataFrame:
    """WARC/1.1 records of HTTP responses and revisits, one per row, as columns.

    ``record_id, type, url, date (seconds), status, headers, payload``. A
    record whose head lacks a field has null there; null records give nulls.
    """
    blank = "\r\n\r\n"
    head = F.substring_index(F.col(raw), blank, 1)
    block = F.expr(f"substring({raw}, instr({raw}, '\\r\\n\\r\\n') + 4)")
    rows = records.select(head.alias("h"), block.alias("b"))
    rows = rows.select(_fields(F.col("h")).alias("w"), F.substring_index("b", blank, 1).alias("http"), F.expr("substring(b, instr(b, '\\r\\n\\r\\n') + 4)").alias("body"))
    rows = rows.withColumn("type", field(F.col("w"), "warc-type"))
    return rows.select(
        field(F.col("w"), "warc-record-id").alias("record_id"), "type", field(F.col("w"), "warc-target-uri").alias("url"),
        F.to_unix_timestamp(field(F.col("w"), "warc-date"), F.lit("yyyy-MM-dd'T'HH:mm:ssX")).alias("date"),
        F.regexp_extract("http", "^HTTP/[0-9.]+ ([0-9]+)", 1).try_cast("int").alias("status"), _fields(F.col("http")).alias("headers"),
        F.when(F.col("type") == "response", F.col("body")).alias("payload"),
    )


def _etag(headers: Column) -> Column:
    return F.regexp_replace(field(headers, "etag"), "^W/", "")


def validators_agree(new: Column, old: Column) -> Column:
    """Weak comparison of entity tags if the 304 has one, else of dates if it has one; without validators they agree."""
    tag, date = _etag(new), field(new, "last-modified")
    agree = F.when(tag.isNotNull(), tag.eqNullSafe(_etag(old))).when(date.isNotNull(), date.eqNullSafe(field(old, "last-modified")))
    return agree.otherwise(F.lit(True))


def merged_headers(new: Column, old: Column) -> Column:
    """The stored response's fields, those that the 304 may update replaced or added, by name."""
    names = F.transform(new, lambda h: h["name"])
    fixed = F.array(*[F.lit(x) for x in KEPT_FIELDS])
    stay = F.filter(old, lambda h: ~F.array_contains(names, h["name"]) | F.array_contains(fixed, h["name"]))
    return F.array_sort(F.concat(stay, F.filter(new, lambda h: ~F.array_contains(fixed, h["name"]))))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with ``canonical``, ``outcome``, ``base_id`` and the resolved ``status``, ``headers`` and ``payload``.

    ``records`` has the columns of ``parse_warc``; others are left out.
    Outcomes: ``full`` (a response), ``resolved``, ``validator_mismatch`` (the
    latest earlier response is named, but nothing is taken from it),
    ``no_earlier_response``. A response at the revisit's own second isn't
    earlier; of several at one second the one with the largest id counts, of
    several with that id the one with the largest payload digest, then the last
    of the table. Records without a URL or date, or of another type, find
    nothing; rows without an id resolve like others; repeated rows are each
    resolved. An empty table gives an empty one.
    """
    own = ["record_id", "type", "url", "date", "status", "headers", "payload"]
    rows = records.select(*own, canonical_url(F.col("url")).alias("canonical"), F.monotonically_increasing_id().alias("row"))
    is_full = F.coalesce((F.col("type") == "response") & (F.col("status") == 200), F.lit(False))
    rows = materialize(rows.withColumns({"full": is_full, "digest": F.when(is_full, F.md5("payload"))}), "warc-parsed")
    revisit = F.coalesce(F.col("type") == "revisit", F.lit(False))
    usable = F.col("canonical").isNotNull() & F.col("date").isNotNull()

    this = F.when(F.col("full"), F.struct("record_id", "digest", "row"))
    visits = rows.where(usable & (F.col("full") | revisit)).groupBy("canonical", "date").agg(F.max(this).alias("this"), F.bool_or(revisit).alias("asked"))
    visits = visits.withColumn("range", F.floor(F.col("date") / RANGE_SECONDS))
    last = visits.groupBy("canonical", "range").agg(F.max_by("this", F.when(F.col("this").isNotNull(), F.col("date"))).alias("last"))
    ahead = W.partitionBy("canonical").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select("canonical", "range", F.last("last", ignorenulls=True).over(ahead).alias("carried"))
    inside = W.partitionBy("canonical", "range").orderBy("date").rowsBetween(W.unboundedPreceding, -1)
    found = visits.withColumn("near", F.last("this", ignorenulls=True).over(inside)).where("asked").join(carried, ["canonical", "range"])
    found = found.select("canonical", "date", F.coalesce("near", "carried").alias("base")).where("base is not null")
    bases = materialize(found.select("canonical", "date", F.col("base.record_id").alias("base_id"), F.col("base.row").alias("base_row")), "warc-bases")

    cols = ["record_id", "type", "url", "date", "canonical"]
    asked = rows.where(revisit & usable).select(*cols, "status", "headers").join(bases, ["canonical", "date"], "left")
    base = rows.where("full").select(F.col("row").alias("base_row"), F.col("headers").alias("old"), F.col("payload").alias("body"))
    known = asked.where("base_row is not null").join(base, "base_row")
    ok = F.coalesce(validators_agree(F.col("headers"), F.col("old")), F.lit(False))
    resolved = known.select(
        *cols, F.when(ok, "resolved").otherwise("validator_mismatch").alias("outcome"), "base_id", F.when(ok, F.lit(200)).otherwise(F.col("status")).alias("status"),
        F.when(ok, merged_headers(F.col("headers"), F.col("old"))).otherwise(F.col("headers")).alias("headers"), F.when(ok, F.col("body")).alias("payload"),
    )
    nothing = [F.lit(None).cast(records.schema["record_id"].dataType).alias("base_id"), "status", "headers"]
    missing = F.lit("no_earlier_response").alias("outcome")
    unknown = asked.where("base_row is null").select(*cols, missing, *nothing, F.lit(None).cast("string").alias("payload"))
    others = rows.where(~(revisit & usable)).select(
        *cols, F.when(F.col("full"), "full").otherwise("no_earlier_response").alias("outcome"), *nothing, F.when(~revisit, F.col("payload")).alias("payload")
    )
    return others.unionByName(unknown).unionByName(resolved)


#: The crawl that the query derives from ``pages``: first visits a minute apart, some pages again after an hour, all after a month.
EPOCH, MINUTE, HOUR, MONTH = 1_700_000_000, 60, 3_600, 2_592_000


def crawl_records(pages: DataFrame) -> DataFrame:
    """``raw`` WARC records of visits to every page: a full response, and 304s under a variant of its URL.

    Every fourth page is visited again within the hour, all of them a month
    later. Every seventh has changed its entity tag by then, every fifth sends
    only a date.
    """
    iso = lambda t: F.date_format(F.to_utc_timestamp(F.timestamp_seconds(t), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    at = F.lit(EPOCH) + F.col("page_id") * MINUTE
    tag = F.md5(F.coalesce("html", F.lit("")))
    head = lambda kind, name, url, t: F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), F.concat(F.lit(name), F.col("page_id").cast("string")),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")), F.lit("\r\nWARC-Date: "), iso(t), F.lit("\r\n\r\n"),
    )
    first = F.concat(
        head("response", "full-", F.col("url"), at),
        F.lit('HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nCache-Control: max-age=60\r\nETag: "'), tag, F.lit('"\r\nLast-Modified: d'), F.col("page_id").cast("string"),
        F.lit("\r\nContent-Length: "), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("\r\n\r\n"), F.coalesce("html", F.lit("")),
    )
    variant = F.when(F.col("page_id") % 2 == 0, F.concat(F.col("url"), F.lit("#again"))).otherwise(F.regexp_replace("url", "^https?:", "http:"))
    changed = F.when(F.col("page_id") % 7 == 0, F.lit("x")).otherwise(F.lit(""))
    validator = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("Last-Modified: d"), changed, F.col("page_id").cast("string"))).otherwise(F.concat(F.lit('ETag: W/"'), changed, tag, F.lit('"')))
    again = lambda name, after: F.concat(
        head("revisit", name, variant, at + after), F.lit("HTTP/1.1 304 Not Modified\r\nCache-Control: max-age=3600\r\nContent-Length: 0\r\nConnection: close\r\n"), validator, F.lit("\r\nAge: 5\r\n\r\n"),
    )
    soon = F.when(F.col("page_id") % 4 == 0, again("soon-", HOUR))
    return pages.select(F.explode(F.array_compact(F.array(first, soon, again("again-", MONTH)))).alias("raw"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of the crawls of ``pages``, revisits resolved; payloads by length and digest."""
    records = parse_warc(crawl_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    out = resolve_revisits(records)
    said = F.array_join(F.transform(F.array_sort("headers"), lambda h: F.concat(h["name"], F.lit("="), h["value"])), "|")
    return out.select(
        "record_id", "canonical", "outcome", "base_id", F.col("status").cast("long").alias("status"), said.alias("headers"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.md5("payload").alias("payload_md5"),
    )


OP9_SQL = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body, 1700000000 + page_id * 60 AS t, md5(coalesce(html, '')) AS tag, strlen(coalesce(html, '')) AS n,
    CASE WHEN page_id % 7 = 0 THEN 'x' ELSE '' END AS x, regexp_replace(url, '#.*$', '') AS u
  FROM pages),
q AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '') AS host,
    regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest FROM p),
c AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
    lambda z: z <> '' AND NOT regexp_matches(z, '^(utm_[a-z]+|ref|gclid|fbclid)='))) AS ps FROM q),
k AS (
  SELECT *, host || regexp_replace(split_part(rest, '?', 1), '/+$', '') || CASE WHEN len(ps) > 0 THEN '?' || array_to_string(ps, '&') ELSE '' END AS canonical FROM c),
v AS (SELECT *, 'again-' AS kind, t + 2592000 AS at FROM k UNION ALL SELECT *, 'soon-', t + 3600 FROM k WHERE page_id % 4 = 0),
b AS (
  SELECT r.page_id, r.kind, arg_max(f.page_id, f.t) AS base FROM v r JOIN k f ON f.canonical = r.canonical AND f.t < r.at GROUP BY r.page_id, r.kind),
j AS (
  SELECT r.*, f.page_id AS bp, f.body AS bbody, f.tag AS btag, f.n AS bn,
    f.page_id IS NOT NULL AND CASE WHEN r.page_id % 5 = 0 THEN r.x || r.page_id = f.page_id::VARCHAR ELSE r.x || r.tag = f.tag END AS ok
  FROM v r LEFT JOIN b ON b.page_id = r.page_id AND b.kind = r.kind LEFT JOIN k f ON f.page_id = b.base)
SELECT 'full-' || page_id AS record_id, canonical, 'full' AS outcome, NULL::VARCHAR AS base_id, 200::BIGINT AS status,
  'cache-control=max-age=60|content-length=' || n || '|content-type=text/html|etag="' || tag || '"|last-modified=d' || page_id AS headers,
  n::BIGINT AS payload_bytes, tag AS payload_md5
FROM k
UNION ALL
SELECT kind || page_id, canonical, CASE WHEN ok THEN 'resolved' WHEN bp IS NOT NULL THEN 'validator_mismatch' ELSE 'no_earlier_response' END,
  'full-' || bp, CASE WHEN ok THEN 200 ELSE 304 END::BIGINT,
  CASE WHEN ok THEN 'age=5|cache-control=max-age=3600|content-length=' || bn || '|content-type=text/html|etag=' ||
      CASE WHEN page_id % 5 = 0 THEN '"' || btag || '"' ELSE 'W/"' || tag || '"' END || '|last-modified=d' || bp
    ELSE 'age=5|cache-control=max-age=3600|connection=close|content-length=0|' ||
      CASE WHEN page_id % 5 = 0 THEN 'last-modified=d' || x || page_id ELSE 'etag=W/"' || x || tag || '"' END END,
  CASE WHEN ok THEN bn END::BIGINT, CASE WHEN ok THEN md5(bbody) END
FROM j
"""
