"""Resolution of not-modified revisits in web archives.

A revisit record says that a server answered 304: the payload is that of an
earlier response.  Each revisit is joined, as of its time, to the latest
earlier full response of its canonical URL; the validators of both must agree;
then the headers that a 304 may update replace those of the response.

The as-of join never gathers the records of a URL.  Only distinct (URL, time)
points are ordered, an hour of a URL at a time, and the last response of each
hour is carried into the later ones.  Bodies move once, to the revisits that
need them.

Defined results: of several responses at one time the one with the largest id
counts; a response at the very time of the revisit isn't earlier.  A null URL or
time resolves to nothing (``no_earlier_response``); null headers are none.
Equal revisit rows are resolved one by one; equal response rows, and responses
with equal ids, count as one, that of the smallest (headers, body).  Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

#: Headers that a 304 response updates (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without a slash at
    its end, sorted query without tracking parameters; no scheme, no fragment."""
    scheme = "^(?:[A-Za-z][A-Za-z0-9+.-]*://)?"
    host = F.lower(F.regexp_extract(url, scheme + "(?:[^/?#@]*@)?([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]*[.]", ""), ":(80|443)?$", "")
    path = F.rtrim(F.regexp_extract(url, scheme + "[^/?#]*([^?#]*)", 1), F.lit("/"))
    query = F.regexp_extract(url, "[?]([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref|gclid|fbclid)(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def header(headers: Column, name: str) -> Column:
    """The first value of a header, by its name in any case; null if there is none."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def merged(old: Column, new: Column) -> Column:
    """The response's headers, those that are permitted replaced by the revisit's."""
    updates = F.filter(new, lambda h: F.lower(h["name"]).isin(*PERMITTED))
    names = F.transform(updates, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(old, lambda h: ~F.array_contains(names, F.lower(h["name"]))), updates)


def latest_earlier(points: DataFrame) -> DataFrame:
    """points: url, at (epoch seconds), response (id or null), unique by (url,
    at).  Returns url, at and the response of the latest earlier point with one."""
    hours = points.withColumn("hour", F.floor(F.col("at") / 3600))
    within = Window.partitionBy("url", "hour").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("url").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    of_hour = hours.groupBy("url", "hour").agg(F.max_by("response", F.when(F.col("response").isNotNull(), F.col("at"))).alias("last"))
    carried = of_hour.select("url", "hour", F.last("last", ignorenulls=True).over(before).alias("carried"))
    own = hours.select("url", "hour", "at", F.last("response", ignorenulls=True).over(within).alias("own"))
    return own.join(carried, ["url", "hour"]).select("url", "at", F.coalesce("own", "carried").alias("response"))


def resolve(records: DataFrame) -> DataFrame:
    """records: record_id, url, at (epoch seconds), kind ('response' or
    'revisit'), status, headers and body.  One row a revisit: record_id, url (canonical),
    outcome, response_id, headers and body; the last two are null unless the
    outcome is ``resolved``, else ``no_earlier_response``, ``no_validator`` or
    ``validator_mismatch``."""
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    keyed = records.select("record_id", canonical_url(F.col("url")).alias("url"), "at", "kind", "status", F.coalesce(F.col("headers"), F.array().cast(HEADERS)).alias("headers"), "body")
    narrow = keyed.filter("url is not null and at is not null").select("url", "at", F.when(full, F.col("record_id")).alias("response"))
    points = narrow.groupBy("url", "at").agg(F.max("response").alias("response"))
    as_of = written(latest_earlier(points).filter("response is not null"), "as-of")
    revisits = keyed.filter("kind = 'revisit'").select("record_id", "url", "at", F.col("headers").alias("new")).join(as_of, ["url", "at"], "left")
    # Only responses that some revisit goes back to move with their bodies.
    asked = written(as_of.select("response").distinct(), "asked-responses")
    old = keyed.filter(full).select(F.col("record_id").alias("response"), F.struct("headers", "body").alias("o")).join(asked, "response", "left_semi")
    old = old.groupBy("response").agg(F.min("o").alias("o")).select("response", F.col("o.headers").alias("old"), F.col("o.body").alias("old_body"))
    # Revisits without a response would all have one key.
    none = revisits.filter("response is null").select("*", F.lit(None).cast(HEADERS).alias("old"), F.lit(None).cast("string").alias("old_body"))
    both = revisits.filter("response is not null").join(old, "response").select(*none.columns).unionByName(none)
    tag, modified = header(F.col("new"), "etag"), header(F.col("new"), "last-modified")
    agrees = F.when(tag.isNotNull(), F.coalesce(_strong(tag) == _strong(header(F.col("old"), "etag")), F.lit(False))).otherwise(F.coalesce(modified == header(F.col("old"), "last-modified"), F.lit(False)))
    outcome = F.when(F.col("response").isNull(), "no_earlier_response").when(tag.isNull() & modified.isNull(), "no_validator").when(agrees, "resolved").otherwise("validator_mismatch")
    done = both.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    return done.select("record_id", "url", "outcome", F.col("response").alias("response_id"), F.when(resolved, merged(F.col("old"), F.col("new"))).alias("headers"), F.when(resolved, F.col("old_body")).alias("body"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Three archive records of each page: its response, a revisit five minutes
    and one a day later.  By the page's id some responses are errors, and some
    revisits bear another tag, only a date, or no validator."""
    id_, at = F.col("page_id"), F.lit(1_700_000_000) + F.col("page_id") * 60
    tag = F.concat(F.lit('"'), F.substring(F.sha2("html", 256), 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), (id_ % 28).cast("string"))
    h = lambda **named: F.array(*[F.struct(F.lit(k.replace("_", "-")).alias("name"), v.alias("value")) for k, v in named.items()])
    response = h(Content_Type=F.lit("text/html"), Content_Length=F.octet_length("html").cast("string"), ETag=tag, Last_Modified=modified, Cache_Control=F.lit("max-age=60"))
    early = F.when(id_ % 5 == 1, h(ETag=F.lit('"changed"'), Date=F.lit("early"))).otherwise(h(ETag=F.concat(F.lit("W/"), tag), Date=F.lit("early"), Cache_Control=F.lit("max-age=120"), Content_Length=F.lit("0")))
    late = F.when(id_ % 5 == 2, h(Date=F.lit("late"))).otherwise(h(last_modified=modified, Date=F.lit("late"), X_Cache=F.lit("HIT")))
    row = lambda k, kind, at, status, headers, body: F.struct((id_ * 3 + k).alias("record_id"), F.col("url").alias("url"), at.cast("long").alias("at"), F.lit(kind).alias("kind"), status.alias("status"), headers.alias("headers"), body.alias("body"))
    none = F.lit(None).cast("string")
    rows = [
        row(0, "response", at, F.when(id_ % 7 == 3, 503).otherwise(200), response, F.col("html")),
        row(1, "revisit", at + 300, F.lit(304), early, none),
        row(2, "revisit", at + 86_400, F.lit(304), late, none),
    ]
    return pages.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def op4_warc_revisits(spark, sf_dir: str) -> DataFrame:
    got = resolve(records_of_pages(table(spark, sf_dir, "pages")))
    text = F.array_join(F.array_sort(F.transform("headers", lambda h: F.concat(F.lower(h["name"]), F.lit(": "), h["value"]))), "\n")
    return got.select("record_id", "url", "outcome", "response_id", text.alias("headers"), F.sha2("body", 256).alias("body_sha256"))


ORACLE = """
WITH p AS (SELECT page_id AS i, url, html, '"' || substr(sha256(html), 1, 16) || '"' AS tag, 'day ' || (page_id % 28) AS modified,
  lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#]*)', 1)) AS host,
  rtrim(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1), '/') AS path,
  list_sort(list_filter(string_split(regexp_extract(url, '[?]([^#]*)', 1), '&'),
    lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS query FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(host, '^www[0-9]*[.]', ''), ':(80|443)?$', '') || path ||
  CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS u FROM p),
full_responses AS (SELECT u, 1700000000 + i * 60 AS at, max(i * 3) AS response_id FROM c WHERE i % 7 <> 3 GROUP BY ALL),
revisits AS (SELECT i, u, i * 3 + 1 AS record_id, 1700000000 + i * 60 + 300 AS at, CASE WHEN i % 5 = 1 THEN '"changed"' ELSE tag END AS new_tag, NULL AS new_modified FROM c
  UNION ALL SELECT i, u, i * 3 + 2, 1700000000 + i * 60 + 86400, NULL, CASE WHEN i % 5 = 2 THEN NULL ELSE modified END FROM c),
latest AS (SELECT r.record_id, max(f.at) AS at FROM revisits r JOIN full_responses f ON f.u = r.u AND f.at < r.at GROUP BY ALL),
joined AS (SELECT r.*, f.response_id, o.html, o.tag, o.modified FROM revisits r LEFT JOIN latest l USING (record_id)
  LEFT JOIN full_responses f ON f.u = r.u AND f.at = l.at LEFT JOIN c o ON o.i * 3 = f.response_id),
judged AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_earlier_response' WHEN new_tag IS NULL AND new_modified IS NULL THEN 'no_validator'
  WHEN new_tag IS NOT NULL AND new_tag = tag OR new_tag IS NULL AND new_modified = modified THEN 'resolved' ELSE 'validator_mismatch' END AS outcome FROM joined)
SELECT record_id, u AS url, outcome, response_id,
  CASE WHEN outcome = 'resolved' THEN array_to_string(list_sort(CASE WHEN record_id % 3 = 1
    THEN ['content-type: text/html', 'content-length: ' || strlen(html), 'last-modified: ' || modified, 'etag: W/' || new_tag, 'date: early', 'cache-control: max-age=120']
    ELSE ['content-type: text/html', 'content-length: ' || strlen(html), 'last-modified: ' || modified, 'etag: ' || tag, 'date: late', 'cache-control: max-age=60'] END), chr(10)) END AS headers,
  CASE WHEN outcome = 'resolved' THEN sha256(html) END AS body_sha256
FROM judged"""
