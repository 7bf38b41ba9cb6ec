"""WARC: resolution of not-modified revisits.

A revisit record with a 304 has no payload. It stands for the latest earlier full response of its canonical URL, if their
validators agree: the entity tags by weak comparison if both have one, else the modification dates if both
have one. The resolved record takes that response's payload, and its headers updated by those of the 304 that may
change a stored response (all but the ones that describe the payload or a single connection).

The as-of join is a scan of sorted records: they are range-partitioned by (canonical URL, time, kind, record id), so a URL
that a third of the records share spans many partitions. Each partition carries the last response forward per URL by a
window; the last response of each partition (one row) is carried on to the next ones. No task holds a URL whole, and
no pair of records of a URL is formed but the one wanted.

Order of records: time, then responses before revisits, then record id; null times and ids come first. So a response of the
same second counts as earlier. Null URLs and those without a host resolve to nothing (status no_url). Repeated records
are resolved each. Null headers count as none. An empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

HEADERS = "array<struct<name:string,value:string>>"
#: Header fields of a 304 that don't update a stored response (RFC 9110, RFC 9111 section 3.2).
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te",
    "trailer", "transfer-encoding", "upgrade",
)
#: Query keys that name a campaign or referrer and not a resource.
IGNORED_KEYS = ("ref", "utm_campaign", "utm_medium", "utm_source")


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path (at least /), sorted query without ignored keys; no scheme or fragment; empty without a host."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"(?s)#.*$", ""), r"^(?i)[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r":(80|443)$", "")
    path = F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1)
    pairs = F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?([\s\S]*)$", 1), "&"),
                     lambda x: (x != "") & ~F.substring_index(x, "=", 1).isin(*IGNORED_KEYS))
    query = F.array_join(F.array_sort(pairs), "&")
    whole = F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(host == "", "").otherwise(whole)


def _merged(stored_headers: Column, changed: Column) -> Column:
    """Headers of the stored response, each name that the 304 may change replaced by the 304's values."""
    empty = F.array().cast(HEADERS)
    stored_headers, changed = F.coalesce(stored_headers, empty), F.coalesce(changed, empty)
    new = F.filter(changed, lambda h: ~F.coalesce(F.lower(h["name"]), F.lit("")).isin(*NOT_MERGED))
    names = F.transform(new, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored_headers, lambda h: ~F.coalesce(F.array_contains(names, F.lower(h["name"])), F.lit(False))), new)


def resolve(records: DataFrame) -> DataFrame:
    """Each revisit of ``records`` (record_id, url, captured, kind, etag, last_modified, headers, payload_digest).

    Returns record_id, canonical, captured, status (resolved, mismatch, no_validator, no_response, no_url), response_id,
    payload_digest and merged headers; the last two only where resolved.
    """
    answer = F.struct("record_id", "etag", "last_modified", "headers", "payload_digest")
    rows = records.select("record_id", F.coalesce(canonical_url(F.col("url")), F.lit("")).alias("canonical"), "captured",
                          (F.col("kind") == "revisit").alias("revisit"), "etag", "last_modified", F.col("headers").cast(HEADERS).alias("headers"), "payload_digest")
    order = ["captured", "revisit", "record_id"]
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(rows.repartitionByRange(parts, "canonical", *order).withColumn("part", F.spark_partition_id()), "records")
    response = F.when(~F.col("revisit") & (F.col("canonical") != ""), answer)
    before = Window.partitionBy("part", "canonical").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = dealt.withColumn("here", F.last(response, ignorenulls=True).over(before)).where("revisit")
    # the last response of the last URL of each partition, and on through partitions that the URL fills
    ends = dealt.groupBy("part").agg(F.max("canonical").alias("last_url"), F.min("canonical").alias("first_url"))
    lasts = dealt.join(ends.select("part", F.col("last_url").alias("canonical")), ["part", "canonical"])
    lasts = lasts.where(response.isNotNull()).groupBy("part").agg(F.max_by(answer, F.struct(*order)).alias("carried"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    carry = (ends.join(lasts, "part", "left")
             .withColumn("given", F.last(F.when(F.col("carried").isNotNull(), F.struct("last_url", "carried")), ignorenulls=True).over(earlier))
             .where(F.col("given.last_url") == F.col("first_url")).select("part", F.col("first_url").alias("canonical"), F.col("given.carried").alias("carried")))
    found = scanned.join(carry, ["part", "canonical"], "left").withColumn("full", F.coalesce("here", "carried"))
    weak = lambda tag: F.regexp_replace(F.trim(tag), "^W/", "")
    full = F.col("full")
    both_tags = F.col("etag").isNotNull() & full["etag"].isNotNull()
    both_dates = F.col("last_modified").isNotNull() & full["last_modified"].isNotNull()
    agree = F.when(both_tags, weak(F.col("etag")) == weak(full["etag"])).when(both_dates, F.col("last_modified") == full["last_modified"])
    status = (F.when(F.col("canonical") == "", "no_url").when(full.isNull(), "no_response")
              .when(agree.isNull(), "no_validator").when(agree, "resolved").otherwise("mismatch"))
    return found.withColumn("status", status).select(
        "record_id", "canonical", "captured", "status", full["record_id"].alias("response_id"),
        F.when(F.col("status") == "resolved", full["payload_digest"]).alias("payload_digest"),
        F.when(F.col("status") == "resolved", _merged(full["headers"], F.col("headers"))).alias("headers"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Each page as a full response, and a revisit of its URL some hours later (or, for every 13th, earlier).

    Revisits repeat the entity tag, as a weak one at times; every 5th has another tag, every 7th only the date, every 11th no
    validator. They send a new date and, wrongly, a content length.
    """
    at = F.lit(1_700_000_000).cast("long") + F.col("page_id") * 60
    tag, date = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"')), (at - 86_400).cast("string")
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    common = ["url", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("payload_digest")]
    responses = pages.select(
        (F.col("page_id") * 2).alias("record_id"), at.alias("captured"), F.lit("response").alias("kind"), tag.alias("etag"), date.alias("last_modified"),
        F.array(pair("Content-Type", F.lit("text/html")), pair("Content-Length", F.octet_length(F.coalesce("html", F.lit("")))),
                pair("ETag", tag), pair("Date", at)).alias("headers"), *common)
    every = lambda n: F.col("page_id") % n == 0
    later = F.when(every(13), at - 30).otherwise(at + F.col("page_id") % 9 * 3600 + 30)
    sent = (F.when(every(11) | every(7), F.lit(None)).when(every(5), F.lit('"other"')).when(every(3), F.concat(F.lit("W/"), tag)).otherwise(tag))
    revisits = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), later.alias("captured"), F.lit("revisit").alias("kind"), sent.alias("etag"),
        F.when(~every(11), date).alias("last_modified"),
        F.array(pair("date", later), pair("Content-Length", F.lit(0)), pair("Cache-Control", F.lit("max-age=60"))).alias("headers"),
        "url", F.lit(None).cast("string").alias("payload_digest"))
    return responses.unionByName(revisits)
