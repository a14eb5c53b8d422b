"""Queries over markdown documents, terms, files and event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import documents, quality
from lumenfold.plans.benchmarks import rounded
from lumenfold.plans.registry import query
from lumenfold.plans.texts import SOURCE, TARGET
from lumenfold.sources import stores
from lumenfold.sources.tables import logical, pairs, read, with_tables
from lumenfold.streaming import operators as streaming


@query()
def markdown_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{SOURCE} AS text")
    return documents.extract_units(docs)


@query("SELECT doc_id, md5(s) AS restored, 3 AS n FROM (SELECT doc_id, '{' || text || '} [[a]] and [[b]] or [[a]]' AS s FROM documents)")
def placeholder_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").selectExpr("doc_id", "'{' || text || '} [[a]] and [[b]] or [[a]]' AS s")
    masked = docs.select("doc_id", documents.protect(F.col("s"), r"\[\[\w+\]\]").alias("p")).select("doc_id", "p.*")
    return masked.select("doc_id", F.md5(documents.restore(F.col("masked"), F.col("values"))).alias("restored"), F.size("values").alias("n"))


@query()
def term_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word bounds are those of Unicode, which the oracle's patterns do not know."""
    return rounded(documents.mine_terms(read(spark, sf_dir, "documents"), "text").withColumn("confidence", F.col("confidence").cast("double")))


@query()
def term_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.detect_terms(read(spark, sf_dir, "documents"), "doc_id", "text", ("License", "GNU General Public License", "token"))


@query(f"WITH p AS (SELECT doc_id, {SOURCE} AS s, {TARGET} AS t FROM documents), h AS (SELECT regexp_extract_all(s, '(?m)^#{{1,6}} (.*)$', 1) AS a, regexp_extract_all(t, '(?m)^#{{1,6}} (.*)$', 1) AS b FROM p), z AS (SELECT unnest(list_zip(a, b)) AS z FROM h WHERE len(a) = len(b)) SELECT z[1] AS heading, z[2] AS rendering, count(*) AS votes FROM z GROUP BY ALL")
def heading_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").selectExpr("doc_id", f"{SOURCE} AS s", f"{TARGET} AS t")
    return documents.heading_votes(docs, "s", "t").drop("rank")


@query()
def corpus_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(documents.corpus_bleu(read(spark, sf_dir, "documents").selectExpr("lang", f"{TARGET} AS t", f"{SOURCE} AS s"), "t", "s", ("lang",)), 4)


@query("SELECT doc_id, lang AS src, l AS lang, 'content/en/' || source || '/' || cast(doc_id AS varchar) || '.md' AS path, 'content/' || l || '/' || source || '/' || cast(doc_id AS varchar) || '.md' AS target FROM documents, (SELECT unnest(['de', 'fr', 'ja']) AS l)")
def locale_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("src"), F.concat(F.lit("content/en/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"))
    return stores.locale_pairs(files, ("de", "fr", "ja"))


@query("SELECT path, CASE WHEN doc_id % 4 = 0 THEN 'blog' WHEN doc_id % 4 = 1 THEN 'api' WHEN doc_id % 4 = 2 THEN 'documentation' ELSE 'general' END AS category, CASE WHEN doc_id % 4 = 0 THEN 'blog' WHEN doc_id % 4 = 1 THEN 'api' WHEN doc_id % 4 = 2 THEN 'documentation' ELSE 'general' END || '_' || substr(md5(path), 1, 8) AS id FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'blog' WHEN doc_id % 4 = 1 THEN 'Reference' WHEN doc_id % 4 = 2 THEN 'docs' ELSE 'misc' END || '/' || cast(doc_id AS varchar) || '.md' AS path FROM documents)")
def path_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = read(spark, sf_dir, "documents").selectExpr("CASE WHEN doc_id % 4 = 0 THEN 'blog' WHEN doc_id % 4 = 1 THEN 'Reference' WHEN doc_id % 4 = 2 THEN 'docs' ELSE 'misc' END || '/' || cast(doc_id AS string) || '.md' AS path")
    category = stores.category_of(F.col("path"))
    return paths.select("path", category.alias("category"), stores.sample_id(F.col("path"), category).alias("id"))


@query(with_tables("SELECT count(*) AS n, count(*) * 200 AS csv_bytes, count(*) * 300 AS json_bytes FROM results WHERE run_id IN (SELECT run_id FROM runs WHERE model_id IN ('1-URGENT', '2-HIGH') AND ts >= TIMESTAMP '1995-01-01')"))
def export_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime

    rows = stores.export_filter(logical(spark, sf_dir, "results"), logical(spark, sf_dir, "runs"), datetime(1995, 1, 1), models=["1-URGENT", "2-HIGH"])
    return stores.export_estimate(rows)


@query(with_tables("SELECT run_id FROM runs WHERE ts < TIMESTAMP '1995-01-01' OR run_id % 2 = 0"))
def archive_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old runs are archived, every other of the rest is lost, the archive is restored twice."""
    old, live = stores.archive(logical(spark, sf_dir, "runs"), "1995-01-01")
    live = live.filter("run_id % 2 = 0")
    return stores.restore(stores.restore(live, old, "run_id"), old, "run_id").select("run_id")


@query(with_tables("SELECT 'duplicate run_id' AS problem, 0 AS n UNION ALL SELECT 'results without run', count(*) FROM results WHERE run_id NOT IN (SELECT run_id FROM runs WHERE run_id % 10 <> 0)"))
def store_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.integrity(logical(spark, sf_dir, "runs").filter("run_id % 10 <> 0"), {"results": logical(spark, sf_dir, "results")})


@query(with_tables("SELECT event_id, k FROM (SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM metrics) WHERE k IS NOT NULL"))
def json_schema_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logical(spark, sf_dir, "metrics")
    return rows.select("event_id", F.from_json("props", "k bigint, other string").alias("p")).select("event_id", "p.k").filter("k is not null")


@query(with_tables("SELECT user_id AS job_id, count(*) AS n, count(*) FILTER (WHERE site <> 'error') AS hits, min(ts) AS first, max(ts) AS last, arg_max(event_id, ts) AS model FROM metrics GROUP BY user_id"))
def job_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.job_summary(logical(spark, sf_dir, "metrics").selectExpr("user_id AS job_id", "ts", "CASE WHEN site = 'error' THEN 'miss' ELSE site END AS source", "event_id AS model"))


@query(with_tables("WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM metrics), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM g) SELECT user_id, min(ts) AS starts, max(ts) + INTERVAL 2 HOUR AS ends, arg_max(site, ts) AS site, count(*) AS n FROM i GROUP BY user_id, island"))
def session_debounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.debounce(logical(spark, sf_dir, "metrics"), "user_id", "site", gap="2 hours")


@query(with_tables("SELECT site, time_bucket(INTERVAL 1 HOUR, ts) AS starts, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS ends, count(*) AS n, round(avg(value), 6) AS mean FROM metrics GROUP BY ALL"))
def tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(streaming.tumbling(logical(spark, sf_dir, "metrics"), ("site",), "value", "1 hour"))


@query()
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.circuit_breaker(logical(spark, sf_dir, "metrics").selectExpr("lang", "ts", "site <> 'error' AND event_id % 3 <> 0 AS ok"), "lang", "ok")


@query(with_tables("SELECT pair_id, CASE WHEN length(trim(source)) > 0 AND trim(source) = trim(translation) THEN true ELSE false END AS untranslated FROM pairs"))
def untranslated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("pair_id", ((F.length(F.trim("source")) > 0) & (F.trim("source") == F.trim("translation"))).alias("untranslated"))


@query()
def unit_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of both sides paired by address, with the defects of each."""
    docs = read(spark, sf_dir, "documents")
    a, b = (documents.extract_units(docs.selectExpr("doc_id", f"{e} AS text")) for e in (SOURCE, TARGET))
    paired = a.select("doc_id", "addr", "kind", F.col("text").alias("s")).join(b.select("doc_id", "addr", F.col("text").alias("t")), ["doc_id", "addr"])
    return paired.select("doc_id", "addr", quality.unit_issues(F.col("kind"), F.col("s"), F.col("t"), F.lit(False)).alias("issues"))
