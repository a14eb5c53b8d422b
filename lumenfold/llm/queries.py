"""The queries op1 to op10: each applies its operator to a whole table of a test directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm.decontam import find_leaks
from lumenfold.llm.gifmedia import encode_column, payload_digests
from lumenfold.llm.langid import identify_languages
from lumenfold.llm.mixing import mix_sources
from lumenfold.llm.neardup import near_duplicates
from lumenfold.llm.pii import pseudonymise
from lumenfold.llm.secretscan import find_secrets
from lumenfold.llm.sharding import shard_rows
from lumenfold.llm.toxicity import toxicity
from lumenfold.llm.warc import page_records, resolve_revisits

#: The key of the surrogates; production sets its own.
PII_KEY = "surrogates-1"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op4_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_digests(encode_column(_table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir, "documents"), shards=40)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_table(spark, sf_dir, "documents"), PII_KEY)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A revisit of each page, 20 pages after its capture, finds it not modified; headers is one line for each header, in order. What
    is not resolved has refers_to and length -1."""
    found = resolve_revisits(page_records(_table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n")).fillna({"refers_to": -1, "length": -1}).withColumnRenamed("id", "page_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_language_id, op2_mixing, op3_minhash_near_dedup, op4_gif_media, op5_toxicity, op6_sharding, op7_secret_scan, op8_pii_surrogates, op9_warc_revisits, op10_decontamination)}
#: The results that SQL can say; the others are tested against brute force, round trips and held-out labels.
ORACLE_SQL: dict[str, str] = {
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
d AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM d x JOIN d y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reach)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(reach) AS component_id, r.doc_id = min(reach) AS kept FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op9_warc_revisits": r"""
WITH u AS (SELECT page_id, coalesce(html, '') AS body, regexp_replace(trim(url), '#.*$', '') AS plain FROM pages),
h AS (SELECT page_id, body, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^[^@]*@', ''), ':(80|443)$', ''), '^www[0-9]*[.]', '') AS host, regexp_replace(plain, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', '') AS rest FROM u),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|gclid|fbclid|msclkid|mc_cid|mc_eid|ref|sessionid|jsessionid|phpsessid)(=.*)?$'))) AS kept FROM h),
c AS (SELECT page_id, body, md5(body) AS m, host || regexp_replace(regexp_replace(rest, '[?].*$', ''), '/+$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical_url FROM q),
o AS (SELECT *, max(page_id) OVER (PARTITION BY canonical_url ORDER BY page_id RANGE BETWEEN UNBOUNDED PRECEDING AND 19 FOLLOWING) AS last FROM c),
f AS (SELECT o.*, l.m AS last_m, l.body = '' AS last_empty, octet_length(encode(l.body)) AS last_n, CASE WHEN o.canonical_url IS NULL THEN 'no_url' WHEN o.body = '' OR l.body = '' THEN 'no_validator' WHEN o.m = l.m THEN 'resolved' ELSE 'changed' END AS status FROM o LEFT JOIN c l ON l.page_id = last AND l.canonical_url = o.canonical_url),
x AS (SELECT *, status IN ('resolved', 'no_validator') AS found FROM f)
SELECT page_id, canonical_url, CASE WHEN found THEN last ELSE -1 END AS refers_to, status,
'age: 0' || chr(10) || 'cache-control: max-age=60' || chr(10) || CASE WHEN found THEN 'content-length: ' || cast(last_n AS varchar) || chr(10) || 'content-type: text/html' ELSE 'content-length: 0' END || CASE WHEN body <> '' THEN chr(10) || 'etag: W/"' || substr(m, 1, 16) || '"' WHEN found AND NOT last_empty THEN chr(10) || 'etag: "' || substr(last_m, 1, 16) || '"' ELSE '' END AS headers,
CASE WHEN found THEN last_m END AS digest, CASE WHEN found THEN last_n ELSE -1 END AS length FROM x""",
}
