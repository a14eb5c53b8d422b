"""Not-modified revisits of a web archive, resolved to the full response they stand for.

A revisit record says that a resource had not changed; its body is that of an earlier capture. Records are joined as of their time:
each revisit goes to the latest earlier full response of its canonical URL. The validators must agree: the entity tags weakly
compared if both records have one, else the modification times. The headers are the response's, updated by those that a
not-modified reply may change (RFC 9110, 15.4.5 and RFC 9111, 3.2); those that describe the stored body stay the response's.

A canonical URL has no scheme, user, default port, leading www, fragment, trailing slash or tracking parameter, a lower-case host,
and its parameters in order.

The join needs no task to hold a URL's whole history: the records are written in ranges of time of about equal row counts, numbered
in order; within a range and URL a window carries the last response on, and the last response of each range is carried to the
ranges after it. No plan grows with the number of ranges.

Defined results. Null URL: status ``no_url``. No earlier response: ``no_response``. A validator that is missing on either side:
``no_validator``, resolved all the same by URL and time; validators that differ: ``changed``, not resolved. Records of one time are
ordered by id. Repeated rows: each revisit row comes back. Null times come before all others. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.llm.common import Scratch

#: Records of one time range, about.
RANGE_ROWS = 50_000
#: Headers of a stored response that a not-modified reply may not change.
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-location", "content-range", "content-type", "keep-alive", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
#: Parameters that only track the visitor.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|msclkid|mc_cid|mc_eid|ref|sessionid|jsessionid|phpsessid)(=.*)?$"
HEAD = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def canonical_url(url: Column) -> Column:
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, HEAD, 1)), r"^[^@]*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    rest = F.regexp_replace(plain, HEAD, "")
    path, query = F.regexp_replace(F.regexp_replace(rest, r"\?.*$", ""), r"/+$", ""), F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: ~F.lower(p).rlike(TRACKING) & (p != "")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def merged_headers(stored: Column, reply: Column) -> Column:
    """Both are maps with lower-case names; null is empty."""
    stored, reply = (F.coalesce(m, F.create_map().cast("map<string,string>")) for m in (stored, reply))
    reply = F.map_filter(reply, lambda k, _: ~k.isin(*KEPT_HEADERS))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.map_contains_key(reply, k)), reply)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(id, canonical_url, refers_to, status, headers, digest, length) for each revisit.

    records: (id, kind 'response' or 'revisit', url, time long, headers map, digest, length). headers have lower-case names; digest and
    length describe a response's body."""
    scratch = Scratch(records.sparkSession, "warc")
    rows = records.select("id", "kind", canonical_url(F.col("url")).alias("url"), F.coalesce("time", F.lit(-(1 << 63))).alias("time"), "headers", "digest", "length").filter(F.col("kind").isin("response", "revisit"))
    rows = scratch.put("rows", rows)
    lost = rows.filter("url is null and kind = 'revisit'")
    parts = 1 + rows.count() // RANGE_ROWS
    rows = rows.filter("url is not null")
    # the number of a range is written down with its rows, so it stays what it is if a task runs again
    rows = scratch.put("ranges", rows.repartitionByRange(parts, "time", "id").withColumn("part", F.spark_partition_id())) if parts > 1 else rows.withColumn("part", F.lit(0))
    response = F.when(F.col("kind") == "response", F.struct(F.col("id"), F.col("headers"), F.col("digest"), F.col("length")))
    rows = rows.withColumn("own", response)
    # the last response of each range, carried to the ranges after it
    last = rows.filter("kind = 'response'").groupBy("url", "part").agg(F.max_by("own", F.struct("time", "id")).alias("own"))
    revisits = rows.filter("kind = 'revisit'").select("url", "part").distinct()
    ranges = last.join(revisits, ["url", "part"], "full")
    carried = ranges.select("url", "part", F.last("own", ignorenulls=True).over(W.partitionBy("url").orderBy("part").rowsBetween(W.unboundedPreceding, -1)).alias("carried")).filter("carried is not null")
    within = W.partitionBy("url", "part").orderBy("time", "id", "kind").rowsBetween(W.unboundedPreceding, -1)
    joined = rows.withColumn("near", F.last("own", ignorenulls=True).over(within)).filter("kind = 'revisit'").join(carried, ["url", "part"], "left").withColumn("found", F.coalesce("near", "carried"))
    found, reply = F.col("found"), F.col("headers")
    tag = [F.regexp_replace(F.element_at(h, "etag"), "^W/", "") for h in (found["headers"], reply)]
    when = [F.element_at(h, "last-modified") for h in (found["headers"], reply)]
    agree = F.coalesce(tag[0] == tag[1], when[0] == when[1])
    status = F.when(found.isNull(), "no_response").when(agree.isNull(), "no_validator").when(agree, "resolved").otherwise("changed")
    joined = joined.withColumn("status", status).withColumn("found", F.when(F.col("status").isin("resolved", "no_validator"), found))
    out = joined.select("id", F.col("url").alias("canonical_url"), F.col("found.id").alias("refers_to"), "status", F.when(F.col("found").isNotNull(), merged_headers(F.col("found.headers"), reply)).otherwise(reply).alias("headers"), F.col("found.digest").alias("digest"), F.col("found.length").alias("length"))
    kinds = {f.name: f.dataType for f in out.schema}
    none = lambda name: F.lit(None).cast(kinds[name]).alias(name)
    return out.union(lost.select("id", none("canonical_url"), none("refers_to"), F.lit("no_url").alias("status"), "headers", none("digest"), none("length")))


#: Pages that are captured between a page's response and its revisit.
LAG = 20


def page_records(pages: DataFrame) -> DataFrame:
    """Captures of a table of pages (page_id, url, html): each page's full response at time page_id, and a revisit of it at time
    page_id + LAG, which the URL's later captures may come before or after. Its entity tag is that of the page's own body, if it has one."""
    body = F.coalesce("html", F.lit(""))
    tag = F.when(body != "", F.concat(F.lit('"'), F.substring(F.md5(F.encode(body, "UTF-8")), 1, 16), F.lit('"')))
    common = [F.col("url"), F.md5(F.encode(body, "UTF-8")).alias("digest"), F.octet_length(body).cast("long").alias("length")]
    stamp = F.col("page_id").cast("string")

    def headers(**named: Column) -> Column:
        every = F.create_map(*(x for k, v in named.items() for x in (F.lit(k.replace("_", "-")), v)))
        return F.map_filter(every, lambda _, v: v.isNotNull()).alias("headers")

    full = pages.select(F.col("page_id").alias("id"), F.lit("response").alias("kind"), F.col("page_id").alias("time"), headers(content_type=F.lit("text/html"), content_length=F.octet_length(body).cast("string"), etag=tag, age=stamp), *common)
    again = pages.select(F.col("page_id").alias("id"), F.lit("revisit").alias("kind"), (F.col("page_id") + LAG).alias("time"), headers(content_length=F.lit("0"), etag=F.concat(F.lit("W/"), tag), age=F.lit("0"), cache_control=F.lit("max-age=60")), *common)
    return full.unionByName(again)
