"""Queries over records: roll-ups, expiry, histories, scores, slots, verdicts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import records as rec
from lumenfold.plans.benchmarks import rounded
from lumenfold.plans.registry import query
from lumenfold.sources.tables import logical, read, with_tables

NOW, NOW_SQL = datetime(2024, 1, 20), "TIMESTAMP '2024-01-20'"


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logical(spark, sf_dir, "metrics")


@query(with_tables("SELECT site AS validator, count(*) FILTER (WHERE value < 50) AS errors, count(*) FILTER (WHERE value >= 50) AS warnings, count(DISTINCT user_id) AS affected FROM metrics GROUP BY site"))
def issue_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.issue_metrics(_metrics(spark, sf_dir).selectExpr("site AS validator", "CASE WHEN value < 50 THEN 'ERROR' ELSE 'WARNING' END AS severity", "user_id AS pair_id"))


@query(with_tables("SELECT count(*) AS n, round(avg(length(translation) / length(source)), 6) AS mean_ratio, round(max(length(translation) / length(source)), 6) AS max_ratio FROM pairs"))
def ratio_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lumenfold.sources.tables import pairs

    return rounded(rec.ratio_metrics(pairs(spark, sf_dir), F.length("translation") / F.length("source")))


_HALVES = "SELECT site, user_id % 5 AS fingerprint, avg(CASE WHEN value >= 50 THEN 1.0 ELSE 0.0 END) AS pass_rate FROM metrics WHERE ts {} TIMESTAMP '2024-01-15' GROUP BY ALL"


@query(with_tables(f"WITH a AS ({_HALVES.format('>=')}), b AS ({_HALVES.format('<')}) SELECT a.site || ':' || cast(a.fingerprint AS varchar) AS cell, round(a.pass_rate - b.pass_rate, 6) AS delta, a.pass_rate - b.pass_rate < -0.01 AND b.fingerprint <> 3 AS regressed FROM a JOIN b ON a.site = b.site AND a.fingerprint = b.fingerprint"))
def baseline_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the fingerprint 3 changed theirs since the baseline."""
    rows = _metrics(spark, sf_dir).selectExpr("ts >= TIMESTAMP_NTZ '2024-01-15' AS late", "concat(site, ':', user_id % 5) AS cell", "user_id % 5 AS fingerprint", "value")
    sums = rows.groupBy("late", "cell", "fingerprint").agg(F.avg(F.when(F.col("value") >= 50, 1.0).otherwise(0.0)).alias("pass_rate"))
    now, old = sums.filter("late"), sums.filter("not late").withColumn("fingerprint", F.when(F.col("fingerprint") == 3, -1).otherwise(F.col("fingerprint")))
    return rounded(rec.regressed(now, old, "cell", "pass_rate", "fingerprint", 0.01))


@query("SELECT coalesce(CASE WHEN lang = 'fr' THEN NULL ELSE lang END, 'unknown') AS backend, count(*) AS n, sum(n_chars) AS total FROM documents GROUP BY 1")
def usage_by_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.sums_by(read(spark, sf_dir, "documents").selectExpr("nullif(lang, 'fr') AS backend", "n_chars"), "backend", "n_chars")


@query(with_tables("SELECT site, CASE max(CASE WHEN value < 10 THEN 3 WHEN value < 50 THEN 2 ELSE 1 END) WHEN 3 THEN 'FAIL' WHEN 2 THEN 'WARN' ELSE 'PASS' END AS status, user_id FROM metrics GROUP BY site, user_id"))
def worst_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metrics(spark, sf_dir).selectExpr("site", "user_id", "CASE WHEN value < 10 THEN 'FAIL' WHEN value < 50 THEN 'WARN' ELSE 'PASS' END AS status")
    return rec.worst(rows, ("site", "user_id"), "status")


@query(with_tables("SELECT site, count(*) FILTER (WHERE lang < 5) AS completed, count(*) FILTER (WHERE lang = 5) AS failed, count(*) FILTER (WHERE lang > 5) AS pending, round(count(*) FILTER (WHERE lang < 5) / count(*), 6) AS rate, round(avg(value) FILTER (WHERE lang < 5) * count(*) FILTER (WHERE lang > 5), 4) AS eta_seconds FROM metrics GROUP BY site"))
def task_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metrics(spark, sf_dir).selectExpr("site", "value", "CASE WHEN lang < 5 THEN 'COMPLETED' WHEN lang = 5 THEN 'FAILED' ELSE 'PENDING' END AS status")
    out = rec.progress(rows, ("site",), "status", "value")
    return out.withColumns({"rate": F.round("rate", 6), "eta_seconds": F.round("eta_seconds", 4)})


@query(with_tables("SELECT least(lang, user_id % 6) AS a, greatest(lang, user_id % 6) AS b, count(*) AS samples, count(*) FILTER (WHERE value < 20) AS failures, round(count(*) FILTER (WHERE value < 20) / count(*), 6) AS share FROM metrics GROUP BY 1, 2"))
def similarity_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metrics(spark, sf_dir).selectExpr("lang AS a", "user_id % 6 AS b", "value")
    return rounded(rec.failure_shares(rows, ("a", "b"), F.col("value") < 20))


@query("SELECT count(DISTINCT lang || source) AS distinct_fingerprint, count(DISTINCT md5(text)) AS distinct_tm_key FROM documents")
def lineage_index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.distinct_sizes(read(spark, sf_dir, "documents").select(F.concat("lang", "source").alias("fingerprint"), F.md5("text").alias("tm_key")), "fingerprint", "tm_key")


@query(with_tables(f"SELECT event_id FROM metrics WHERE NOT (ts < {NOW_SQL} - INTERVAL 3 DAY AND site IN ('click', 'error'))"))
def cleared_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.live(_metrics(spark, sf_dir), "ts", NOW, 3 * 86_400, ("click", "error"), "site").select("event_id")


@query(with_tables(f"SELECT event_id, 'timeout' AS status FROM metrics WHERE site = 'click' AND ts < {NOW_SQL} - INTERVAL 1 HOUR AND user_id NOT IN (SELECT user_id FROM metrics WHERE site = 'purchase' AND value > 97)"))
def stale_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metrics(spark, sf_dir)
    ends = rows.filter("site = 'purchase' AND value > 97").select("user_id").distinct()
    return rec.stale_runs(rows.filter("site = 'click'"), ends, "user_id", "ts", NOW).select("event_id", "status")


@query(with_tables("SELECT event_id, site FROM metrics ORDER BY ts DESC, event_id DESC LIMIT 100"))
def feedback_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.newest(_metrics(spark, sf_dir), "ts", "event_id", 100).select("event_id", "site")


@query(with_tables("SELECT user_id, row_number() OVER (ORDER BY max(event_id) DESC, user_id) <= 50 AS kept FROM metrics GROUP BY user_id"))
def lru_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.kept_by_lru(_metrics(spark, sf_dir), "user_id", "event_id", 50)


@query("SELECT doc_id, 'trend:' || 'lang=' || lang || CASE WHEN n_chars >= 500 THEN ':size=' || cast(n_chars AS varchar) ELSE '' END || ':source=' || source AS cache_key FROM documents WHERE NOT starts_with(source, 'src1')")
def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rec.without_prefix(read(spark, sf_dir, "documents"), "source", "src1")
    return docs.select("doc_id", rec.cache_key("trend", source=F.col("source"), lang=F.col("lang"), size=F.when(F.col("n_chars") >= 500, F.col("n_chars"))).alias("cache_key"))


@query(with_tables("SELECT user_id, max(site) AS site, count(*) AS retry_count FROM metrics WHERE site IN ('error', 'click') GROUP BY user_id"))
def retranslate_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.retranslate_queue(_metrics(spark, sf_dir).filter("site in ('error', 'click')"), "user_id", "site")


@query(with_tables("SELECT DISTINCT user_id, lang, site AS model_id FROM metrics"))
def models_tried(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.models_tried(_metrics(spark, sf_dir).withColumnRenamed("site", "model_id"), ("user_id", "lang"))


@query("SELECT source AS file, list_sort(list(DISTINCT x)) AS issues FROM (SELECT source, 'L' || lang AS x FROM documents UNION ALL SELECT source, CASE WHEN n_chars > 1000 THEN 'long' ELSE 'short' END FROM documents) GROUP BY source")
def merged_issue_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return rec.merged_tiers(docs.select(F.col("source").alias("file"), F.array(F.concat(F.lit("L"), "lang")).alias("issues")), docs.select(F.col("source").alias("file"), F.array(F.when(F.col("n_chars") > 1000, "long").otherwise("short")).alias("issues")))


@query("SELECT doc_id, list_filter([CASE WHEN n_chars = 0 OR trim(text) = '' THEN 'missing:text' END, CASE WHEN lang NOT IN ('en', 'de') THEN 'value:lang' END, 'forbidden:n_chars'], lambda x: x IS NOT NULL) AS faults FROM documents")
def ledger_row_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", rec.row_faults(docs, ("text",), {"lang": ("en", "de")}, ("n_chars", "content")).alias("faults"))


@query(with_tables(f"SELECT count(*) FILTER (WHERE ts <= {NOW_SQL} AND ts + INTERVAL 2 MINUTE > {NOW_SQL}) AS held, greatest(0, 16 - count(*) FILTER (WHERE ts <= {NOW_SQL} AND ts + INTERVAL 2 MINUTE > {NOW_SQL})) AS free FROM metrics"))
def slots_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.slots_free(_metrics(spark, sf_dir).selectExpr("ts", "ts + interval 2 minutes AS until"), "ts", "until", NOW, 16)


@query(with_tables(f"SELECT event_id AS name, value, 'restart' AS action FROM metrics WHERE site = 'error' AND value > 80 AND ts <= {NOW_SQL} - INTERVAL 600 SECOND"))
def remediations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metrics(spark, sf_dir).selectExpr("site AS name", "value", "ts AS last_action", "event_id")
    hit = rec.remediations(rows.drop("event_id"), (("error", 80.0, 600, "restart"),), NOW).select("name", "value", "action")
    # the report names the event, by its value and name
    return rows.join(hit.distinct(), ["name", "value"]).filter(F.col("last_action") <= F.lit(NOW) - F.expr("INTERVAL 600 SECONDS")).select(F.col("event_id").alias("name"), "value", "action")


@query("SELECT doc_id, round(CASE WHEN lang = 'en' THEN 10.0 ELSE 0.0 END + n_chars / 1000.0 * -2.0 + CASE WHEN source = 'src1' THEN 5.0 WHEN source = 'src2' THEN 3.0 ELSE 0.0 END - (doc_id % 7000) / 1000.0, 6) AS score, CASE WHEN lang = 'en' AND source = 'src1' THEN 'pair' WHEN source = 'src2' THEN 'multilingual' ELSE 'global' END AS rule FROM documents")
def model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    kinds = F.when(F.col("source") == "src1", "ctranslate2").when(F.col("source") == "src2", "huggingface").otherwise("mock")
    score = rec.model_score(F.when(F.col("lang") == "en", "cuda").otherwise("cpu"), F.lit("cuda"), F.col("n_chars") * 1_000_000, kinds, F.col("doc_id") % 7000, False)
    settings = spark.sql("SELECT * FROM VALUES ('en', 'src1', 'm1'), (NULL, 'src2', 'm2'), (NULL, NULL, 'm3') AS t(src, tgt, model)")
    return rec.preferred(docs.select("doc_id", F.col("lang").alias("src"), F.col("source").alias("tgt"), F.round(score, 6).alias("score")), settings).select("doc_id", "score", "rule")


_SIZE, _EMA, _STREAK = "(10 + doc_id % 45)", "((doc_id % 10) / 20.0)", "(doc_id % 8)"


@query(f"SELECT doc_id, cast(CASE WHEN doc_id % 5 < 3 THEN {_SIZE} WHEN {_EMA} > 0.15 AND greatest(4, floor({_SIZE} * 0.75)) <> {_SIZE} THEN greatest(4, floor({_SIZE} * 0.75)) WHEN {_STREAK} >= 5 AND {_SIZE} < 50 THEN least(50, greatest({_SIZE} + 1, ceil({_SIZE} * 1.1))) ELSE {_SIZE} END AS int) AS next_size, cast(greatest(1, floor({_SIZE} / 2)) AS int) AS halved, round(greatest(0.1, least(2.0, CASE WHEN doc_id % 2 = 0 AND {_EMA} < 0.2 THEN 1.2 * 1.01 WHEN {_EMA} > 0.5 THEN 1.2 * 0.98 ELSE 1.2 END)), 6) AS weight FROM documents")
def adaptive_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    size, ema = (10 + i % 45).cast("int"), (i % 10) / 20.0
    return read(spark, sf_dir, "documents").select("doc_id", rec.next_batch_size(size, i % 5, ema, i % 8).alias("next_size"), rec.halved(size).alias("halved"), F.round(rec.updated_weight(F.lit(1.2), i % 2 == 0, ema), 6).alias("weight"))


@query("SELECT doc_id, verdict IN ('REJECT_SYSTEMIC', 'REJECT_ISOLATED') AS stop, CASE verdict WHEN 'REJECT_SYSTEMIC' THEN 'portfolio' WHEN 'REJECT_ISOLATED' THEN 'shard' ELSE 'none' END AS scope, verdict <> 'APPROVE' AS mark_rows, list_filter([CASE WHEN n_chars > 1000 THEN 'long' END, CASE WHEN lang = 'fr' THEN 'retried' END], lambda x: x IS NOT NULL) AS flags FROM (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'APPROVE' WHEN 1 THEN 'REJECT_SYSTEMIC' WHEN 2 THEN 'REJECT_ISOLATED' ELSE 'BLOCKED_EXTERNAL' END AS verdict FROM documents)")
def stop_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = F.element_at(F.array(*map(F.lit, ("APPROVE", "REJECT_SYSTEMIC", "REJECT_ISOLATED", "BLOCKED_EXTERNAL"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "documents").select("doc_id", rec.stop_scope(verdict).alias("s"), rec.risk_flags({"long": F.col("n_chars") > 1000, "retried": F.col("lang") == "fr"}).alias("flags")).select("doc_id", "s.*", "flags")


@query("SELECT doc_id, CASE WHEN lang = 'fr' THEN 'fra_Latn' WHEN lang = 'de' THEN 'deu_Latn' ELSE lang END AS code, CASE WHEN source LIKE 'src1%' THEN source END AS family, left(regexp_replace(text, '[^\\x00-\\x7F]+', '[non-ascii]', 'g'), 200) AS log_text, regexp_matches(text, '[0-9]{3}') AND NOT regexp_matches(text, '@') AND lang IN ('en', 'de') AS matches FROM documents")
def record_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    families = tuple(f"src1{i}" for i in ("", *range(10)))
    return read(spark, sf_dir, "documents").select(
        "doc_id",
        rec.mapped_language(F.col("lang"), {"fr": "fra_Latn", "de": "deu_Latn"}).alias("code"),
        rec.family_of(F.concat(F.lit("content/"), "source", F.lit("/page.md")), families).alias("family"),
        rec.masked_for_log(F.col("text")).alias("log_text"),
        rec.matches_filters(F.col("text"), F.col("lang"), "[0-9]{3}", "@", ("en", "de")).alias("matches"),
    )
