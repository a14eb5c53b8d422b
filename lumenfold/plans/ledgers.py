"""Queries over run outcomes, verdicts, work cells, queues and samples."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import ledger, sets, windows
from lumenfold.plans.benchmarks import rounded
from lumenfold.plans.registry import query
from lumenfold.sources.tables import logical, read, with_tables

ORDER, KEYS = ("ts", "event_id"), ("site", "lang")
_RATE, _OUTCOME = "(event_id % 7) / 6e0", "CASE WHEN site = 'error' OR event_id % 11 = 0 THEN 'REJECT' ELSE 'APPROVE' END"
_O = f"WITH o AS (SELECT *, {_RATE} AS rate, {_OUTCOME} AS verdict FROM metrics) "
_W = "PARTITION BY site, lang ORDER BY ts, event_id ROWS BETWEEN"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logical(spark, sf_dir, "metrics").selectExpr("*", f"cast({_RATE} as double) AS rate", f"{_OUTCOME} AS verdict")


@query(with_tables(_O + "SELECT event_id, site, lang FROM (SELECT *, row_number() OVER (PARTITION BY site, lang ORDER BY ts DESC, event_id DESC) AS rn FROM o) WHERE rn <= 20"))
def recent_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.newest(_outcomes(spark, sf_dir), KEYS, ORDER, 20).select("event_id", "site", "lang")


@query(with_tables(_O + f"SELECT event_id, round(avg(rate) OVER ({_W} 4 PRECEDING AND CURRENT ROW), 6) AS moving FROM o"))
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(windows.moving_average(_outcomes(spark, sf_dir), "rate", KEYS, ORDER).select("event_id", "moving"))


@query(with_tables(_O + f"SELECT event_id, round(before, 6) AS before, round(before - rate, 6) AS drop FROM (SELECT *, avg(rate) OVER ({_W} 5 PRECEDING AND 1 PRECEDING) AS before FROM o) WHERE before - rate >= 0.15"))
def regression_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(windows.regressions(_outcomes(spark, sf_dir), "rate", KEYS, ORDER).select("event_id", "before", "drop"))


@query(with_tables(_O + "SELECT site, lang, cast(CASE WHEN n < 5 THEN 2 ELSE greatest(1, least(5, CASE WHEN m < 0.461 THEN 1 WHEN m >= 0.537 THEN 3 ELSE 2 END)) END AS bigint) AS threshold FROM (SELECT site, lang, avg(rate) AS m, count(rate) AS n FROM (SELECT *, row_number() OVER (PARTITION BY site, lang ORDER BY ts DESC, event_id DESC) AS rn FROM o) WHERE rn <= 20 GROUP BY site, lang)"))
def adaptive_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.adaptive_threshold(_outcomes(spark, sf_dir), "rate", KEYS, ORDER, 2, 0.461, 0.537)


@query(with_tables(_O + f"SELECT event_id, round(rate20, 6) AS rate, n = 20 AND rate20 > 0.2 AS flips FROM (SELECT event_id, avg(CASE WHEN verdict = 'REJECT' THEN 1.0 ELSE 0.0 END) OVER ({_W} 19 PRECEDING AND CURRENT ROW) AS rate20, count(*) OVER ({_W} 19 PRECEDING AND CURRENT ROW) AS n FROM o)"))
def rolling_reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(windows.rolling_rate(_outcomes(spark, sf_dir).drop("rate"), F.col("verdict") == "REJECT", KEYS, ORDER).select("event_id", "rate", "flips"))


@query(with_tables(_O + "SELECT site, lang, streak, streak >= 15 AS qualifies FROM (SELECT site, lang, count(*) FILTER (WHERE last IS NULL OR (ts, event_id) > (last.ts, last.event_id)) AS streak FROM o LEFT JOIN (SELECT site, lang, max({'ts': ts, 'event_id': event_id}) AS last FROM o WHERE verdict = 'REJECT' GROUP BY site, lang) USING (site, lang) GROUP BY site, lang)"))
def clean_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.trailing_streak(_outcomes(spark, sf_dir), F.col("verdict") == "REJECT", KEYS, ORDER)
    return out.withColumn("qualifies", F.col("streak") >= 15)


@query("SELECT doc_id, cast(least(9, floor((row_number() OVER (ORDER BY n_chars, doc_id) - 1) / greatest(1.0, count(*) OVER () / 10.0))) AS bigint) AS wave FROM documents")
def quantile_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.quantile_waves(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id").select("doc_id", "wave")


@query("WITH b AS (SELECT min(n_chars) AS low, max(n_chars) AS high FROM documents) SELECT doc_id, round(CASE WHEN high <= low THEN 0 ELSE greatest(0, least(1, (n_chars - low) / (high - low))) END + (CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END) / 3.0 + (doc_id % 10) / 9.0 - (doc_id % 4) / 3.0, 6) AS score FROM documents, b")
def wave_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lumenfold.functions.stats import min_max

    docs = read(spark, sf_dir, "documents")
    low, high = docs.agg(F.min("n_chars"), F.max("n_chars")).first()
    tier = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).when(F.col("lang") == "fr", 2).otherwise(3)
    score = windows.wave_score(min_max(F.col("n_chars"), F.lit(low), F.lit(high)), tier, F.col("doc_id") % 10 / 9, F.col("doc_id") % 4 / 3)
    return docs.select("doc_id", F.round(score, 6).alias("score"))


@query("SELECT doc_id, lang, cast(shard AS bigint) AS shard, substr(sha256(lang || '|' || cast(shard AS varchar)), 1, 16) AS shard_id FROM (SELECT doc_id, lang, cast(floor((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) / 250) AS bigint) AS shard FROM documents) WHERE doc_id % 5 <> 0")
def shards_250(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    return windows.shards(docs, docs.filter("doc_id % 5 = 0"), ("lang",), "doc_id")


@query("SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS round, turn FROM documents JOIN (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) AS turn FROM documents GROUP BY lang) USING (lang)")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.round_robin(read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "round", "turn")


@query(with_tables("WITH RECURSIVE v AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn, avg(value) OVER w AS m, stddev_pop(value) OVER w AS s, count(*) OVER w AS n FROM metrics WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)), a AS (SELECT *, CASE WHEN n < 3 THEN 0.3 WHEN m <> 0 AND s / m > 0.3 THEN 0.7 ELSE 0.3 END AS alpha FROM v), f AS (SELECT user_id, rn, value AS ema, alpha FROM a WHERE rn = 1 UNION ALL SELECT a.user_id, a.rn, a.alpha * a.value + (1 - a.alpha) * f.ema, a.alpha FROM f JOIN a ON a.user_id = f.user_id AND a.rn = f.rn + 1) SELECT user_id, round(arg_max(ema, rn), 6) AS ema, cast(arg_max(alpha, rn) AS double) AS alpha FROM f GROUP BY user_id"))
def ema_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(windows.adaptive_ema(logical(spark, sf_dir, "metrics"), "value", ("user_id",), "event_id"))


@query(with_tables("SELECT event_id, round(cv, 6) AS cv, coalesce(cv > 0.3, false) AS volatile FROM (SELECT event_id, stddev_pop(value) OVER w / nullif(avg(value) OVER w, 0) AS cv FROM metrics WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"))
def volatility_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(windows.volatility(logical(spark, sf_dir, "metrics"), "value", ("user_id",), ("event_id",)).select("event_id", "cv", "volatile"))


@query("WITH RECURSIVE d AS (SELECT source, doc_id, n_chars // 4 AS cost, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents), f AS (SELECT source, doc_id, rn, 0 AS batch, 1 AS n, cost FROM d WHERE rn = 1 UNION ALL SELECT d.source, d.doc_id, d.rn, CASE WHEN f.n + 1 > 8 OR f.cost + d.cost > 4000 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.n + 1 > 8 OR f.cost + d.cost > 4000 THEN 1 ELSE f.n + 1 END, CASE WHEN f.n + 1 > 8 OR f.cost + d.cost > 4000 THEN d.cost ELSE f.cost + d.cost END FROM f JOIN d ON d.source = f.source AND d.rn = f.rn + 1) SELECT source, doc_id, cast(batch AS bigint) AS batch FROM f")
def greedy_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").selectExpr("source", "doc_id", "n_chars div 4 AS cost")
    return windows.greedy_batches(docs, ("source",), "doc_id", "cost", 8, 4000)


@query("SELECT doc_id, cast(floor((row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) - 1) / 32) AS bigint) AS chunk FROM documents")
def length_sorted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.fixed_chunks(read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), ("lang",), ("n_chars", "doc_id"), 32).select("doc_id", "chunk")


@query("SELECT source, round(mean, 6) AS mean, round(variance, 3) AS variance, round(sqrt(variance) / mean, 6) AS cv, CASE WHEN sqrt(variance) / mean > 0.5 THEN 0.6 ELSE 1.0 END AS factor FROM (SELECT source, avg(length(text)) AS mean, var_pop(length(text)) AS variance FROM documents GROUP BY source)")
def segment_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.length_variance(read(spark, sf_dir, "documents"), "text", ("source",))
    return out.select("source", F.round("mean", 6).alias("mean"), F.round("variance", 3).alias("variance"), F.round("cv", 6).alias("cv"), "factor")


_CELLS = {"supported": "lang <> 'es' OR doc_id % 7 <> 0", "excluded": "doc_id % 13 = 0", "source_empty": "n_chars < 20", "licence_blocked": "doc_id % 17 = 0", "on_hold": "source = 'src3'", "rejected": "doc_id % 5 = 0", "source_unchanged": "doc_id % 2 = 0", "attempts": "doc_id % 6", "target_exists": "doc_id % 4 <> 0", "trusted": "doc_id % 9 <> 0", "source_hash_changed": "doc_id % 8 = 1", "profile_changed": "doc_id % 8 = 2", "lineage_denied": "doc_id % 8 = 3"}
_STATE, _REASON = ledger.classify_sql(_CELLS)


@query(f"SELECT doc_id, {_STATE} AS state, {_REASON} AS reason FROM documents")
def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = read(spark, sf_dir, "documents").selectExpr("doc_id", *(f"{e} AS {c}" for c, e in _CELLS.items()))
    return ledger.classify(cells).select("doc_id", "state", "reason")


@query(f"SELECT state, count(*) AS n FROM (SELECT {_STATE} AS state FROM documents) GROUP BY state")
def counts_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.counts(eligibility(spark, sf_dir), "state")


@query("SELECT coalesce(source, 'total') AS source, coalesce(lang, 'total') AS lang, count(*) AS n FROM documents GROUP BY ROLLUP (source, lang)")
def counts_by_site_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.counts_with_totals(read(spark, sf_dir, "documents"), "source", "lang")


@query(with_tables("SELECT user_id, event_id, site, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM metrics) WHERE rn = 1"))
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logical(spark, sf_dir, "metrics").select("user_id", "event_id", "site", "value", "ts")
    return sets.latest(rows, ("user_id",), ORDER).select("user_id", "event_id", "site", "value")


@query("SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN n.doc_id IS NULL THEN o.version ELSE n.version END AS version, CASE WHEN o.doc_id IS NULL THEN n.created ELSE o.created END AS created FROM (SELECT doc_id, 1 AS version, n_chars AS created FROM documents WHERE lang <> 'en') o FULL JOIN (SELECT doc_id, 2 AS version, -n_chars AS created FROM documents WHERE n_chars >= 1000 OR lang = 'en') n ON o.doc_id = n.doc_id")
def upsert_keep_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    old, new = docs.filter("lang <> 'en'").selectExpr("doc_id", "1 AS version", "n_chars AS created"), docs.filter("n_chars >= 1000 OR lang = 'en'").selectExpr("doc_id", "2 AS version", "-n_chars AS created")
    return sets.upsert(old, new, ("doc_id",), kept=("created",))


@query("SELECT min(doc_id) AS doc_id, substr(sha256(source || ':' || lang || ':' || text), 1, 16) AS hash FROM documents GROUP BY source, lang, text")
def seen_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.substring(F.sha2(F.concat_ws(":", "source", "lang", "text"), 256), 1, 16).alias("hash"))
    return sets.insert_new(docs.limit(0).select("hash"), docs, ("hash",), ("doc_id",)).select("doc_id", "hash")


@query(with_tables("SELECT user_id, site, last AS event_id FROM (SELECT user_id, site, max(event_id) AS last FROM metrics WHERE value < 50 GROUP BY user_id, site) LEFT JOIN (SELECT user_id, site, max(event_id) AS fixed FROM metrics WHERE value >= 50 GROUP BY user_id, site) USING (user_id, site) WHERE fixed IS NULL OR fixed < last"))
def unresolved_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logical(spark, sf_dir, "metrics").select("user_id", "site", "event_id", "value")
    return sets.unresolved(rows.filter("value < 50"), rows.filter("value >= 50"), ("user_id", "site"), "event_id").drop("value")


@query("SELECT md5(text) AS hash, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) >= 2")
def content_hash_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.duplicates(read(spark, sf_dir, "documents").select(F.md5("text").alias("hash")), ("hash",))


@query("SELECT line, list_sort(list(DISTINCT source)) AS owners FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(line) >= 8 GROUP BY line HAVING count(DISTINCT source) >= 2")
def cross_source_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "documents").select("source", F.explode(F.split("text", "\n")).alias("line"))
    return sets.shared_values(lines, "line", "source")


@query("WITH k AS (SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS k FROM documents) SELECT doc_id FROM k WHERE length(k) >= 5 AND k IN (SELECT k FROM k GROUP BY k HAVING min(doc_id) <> max(doc_id))")
def cross_unit_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.same_rendering(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(cast(doc_id AS varchar) || '|42'), doc_id) AS rn, greatest(1, floor(200.0 * count(*) OVER (PARTITION BY lang) / count(*) OVER ())) AS quota FROM documents) WHERE rn <= quota")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.stratified_sample(read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 200)


@query("SELECT doc_id FROM (SELECT *, CASE WHEN doc_id % 97 = 0 THEN 0 ELSE 1 END AS f, sha256('0:' || cast(doc_id AS varchar)) AS h FROM documents) QUALIFY true ORDER BY f, row_number() OVER (PARTITION BY source, lang ORDER BY f, h), source, lang, h LIMIT 25")
def accepted_sample_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return sets.interleaved_sample(docs, ("source", "lang"), "doc_id", 25, F.col("doc_id") % 97 == 0).select("doc_id")


@query("WITH s AS (SELECT lang, count(*) AS n FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY md5(cast(doc_id AS varchar) || '|42'), doc_id) AS rn, greatest(1, floor(200.0 * count(*) OVER (PARTITION BY lang) / count(*) OVER ())) AS quota FROM documents) WHERE rn <= quota GROUP BY lang) SELECT round(0.6 * count(*) / (SELECT count(DISTINCT lang) FROM documents) + 0.4 * greatest(0, 1 - stddev_pop(n) / avg(n)), 6) AS score FROM s")
def sample_representativeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    return rounded(sets.representativeness(docs, sets.stratified_sample(docs, "lang", "doc_id", 200), "lang"))


@query("SELECT substr(sha256(string_agg(id, ',' ORDER BY id)), 1, 12) AS version FROM (SELECT cast(doc_id AS varchar) AS id FROM documents)")
def corpus_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.corpus_version(read(spark, sf_dir, "documents"), "doc_id")


@query(with_tables("SELECT event_id, round(greatest(0, least(1, 0.4 * (lang / 8.0) + 0.3 * (1 - coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE (event_id % 10) / 10.0 END, 0.5)) + CASE WHEN site = 'error' THEN 0.3 ELSE 0 END)), 6) AS uncertainty FROM metrics ORDER BY 2 DESC, event_id LIMIT 50"))
def priority_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = sets.uncertainty(F.col("lang") / 8, F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("event_id") % 10 / 10), F.when(F.col("site") == "error", 1).otherwise(0))
    return logical(spark, sf_dir, "metrics").select("event_id", F.round(u, 6).alias("uncertainty")).orderBy(F.desc("uncertainty"), "event_id").limit(50)


_TASKS = "SELECT doc_id AS task_id, CASE WHEN doc_id % 3 = 0 THEN 'COMPLETED' WHEN doc_id % 3 = 1 THEN 'PENDING' ELSE 'FAILED' END AS status, 'P' || cast(doc_id % 4 AS varchar) AS priority, n_chars AS created, [doc_id - 1, doc_id - 4] AS depends_on FROM documents"


@query(f"WITH t AS ({_TASKS}) SELECT task_id FROM t WHERE status = 'PENDING' AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(t.depends_on) AS d) x WHERE d NOT IN (SELECT task_id FROM t WHERE status = 'COMPLETED')) ORDER BY priority, created, task_id LIMIT 20")
def next_ready_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = read(spark, sf_dir, "documents").selectExpr("doc_id AS task_id", "CASE WHEN doc_id % 3 = 0 THEN 'COMPLETED' WHEN doc_id % 3 = 1 THEN 'PENDING' ELSE 'FAILED' END AS status", "concat('P', doc_id % 4) AS priority", "n_chars AS created", "array(doc_id - 1, doc_id - 4) AS depends_on")
    return sets.next_tasks(tasks, 20).select("task_id")


_QUEUE = "event_id AS id, CASE WHEN event_id % 4 = 0 THEN 'CLAIMED' WHEN event_id % 4 = 1 THEN 'APPLIED' ELSE 'PENDING' END AS state, ts AS created, ts AS claim_until, site AS owner, 0 AS attempts"


@query(with_tables(f"WITH q AS (SELECT {_QUEUE} FROM metrics) SELECT id, 'me' AS owner, 1 AS attempts FROM q WHERE state = 'PENDING' OR (state = 'CLAIMED' AND claim_until < TIMESTAMP '2024-01-15') ORDER BY created, id LIMIT 50"))
def lease_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = logical(spark, sf_dir, "metrics").selectExpr(*(x.strip() for x in _QUEUE.split(", ")))
    return sets.claim(queue, "me", datetime(2024, 1, 15), 300, 50).filter("owner = 'me'").select("id", "owner", "attempts")


@query(with_tables(f"WITH q AS (SELECT {_QUEUE} FROM metrics) SELECT CASE WHEN state = 'CLAIMED' AND claim_until < TIMESTAMP '2024-01-15' THEN 'PENDING' ELSE state END AS state, count(*) AS n FROM q GROUP BY 1"))
def requeued_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = logical(spark, sf_dir, "metrics").selectExpr(*(x.strip() for x in _QUEUE.split(", ")))
    return ledger.counts(sets.requeue_expired(queue, datetime(2024, 1, 15)), "state")


@query(with_tables("WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM metrics) SELECT user_id, event_id FROM l WHERE rn = 1 AND site <> 'purchase' AND ts + INTERVAL 2 DAY > TIMESTAMP '2024-01-30'"))
def active_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logical(spark, sf_dir, "metrics").selectExpr("user_id", "event_id", "ts", "ts + interval 2 days AS expires", "site = 'purchase' AS released")
    return sets.active(rows, ("user_id",), ORDER, datetime(2024, 1, 30)).select("user_id", "event_id")


@query(with_tables("SELECT DISTINCT user_id, lang FROM metrics WHERE site = 'error' AND (user_id, lang) NOT IN (SELECT (user_id, lang) FROM (SELECT user_id, lang, site, row_number() OVER (PARTITION BY user_id, lang ORDER BY ts DESC) AS rn FROM metrics WHERE site <> 'error') WHERE rn = 1 AND site = 'click')"))
def missing_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logical(spark, sf_dir, "metrics")
    return sets.missing_receipts(rows.filter("site = 'error'"), rows.filter("site <> 'error'").selectExpr("user_id", "lang", "ts", "site = 'click' AS passed"), ("user_id", "lang"))


@query(with_tables("SELECT cast(cast(ts AS date) AS varchar(10)) AS day, site, count(DISTINCT lang) AS n FROM metrics GROUP BY ALL HAVING count(DISTINCT lang) >= 3"))
def quarantined_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logical(spark, sf_dir, "metrics").selectExpr("cast(cast(ts AS date) AS string) AS day", "site", "lang")
    return ledger.quarantined(rows, ("day", "site"), "lang")


@query(with_tables(_O + "SELECT user_id, CASE WHEN p = 0 THEN 'BLOCKED' WHEN r > 0 AND a = 0 THEN 'FAILED' WHEN r > 0 OR t > 0 THEN 'DEGRADED' ELSE 'CLEAN' END AS verdict, round(greatest(0, least(1, 1 - r / p)), 6) AS autonomy FROM (SELECT user_id, count(*) AS p, count(*) FILTER (WHERE verdict = 'APPROVE') AS a, count(*) FILTER (WHERE verdict = 'REJECT') AS r, count(*) FILTER (WHERE rate = 0) AS t FROM o GROUP BY user_id)"))
def run_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _outcomes(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("p"), F.count_if(F.col("verdict") == "APPROVE").alias("a"), F.count_if(F.col("verdict") == "REJECT").alias("r"), F.count_if(F.col("rate") == 0).alias("t"))
    return rounded(sums.select("user_id", ledger.run_verdict(F.col("p"), F.col("a"), F.col("r"), F.col("t")).alias("verdict"), ledger.autonomy(F.col("r"), F.col("p")).alias("autonomy")))


@query(with_tables(_O + "SELECT site, count(*) FILTER (WHERE verdict = 'APPROVE') AS approve, count(*) FILTER (WHERE verdict = 'REJECT') AS reject FROM o GROUP BY site"))
def model_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.model_outcomes(_outcomes(spark, sf_dir), "site", "verdict", ("APPROVE", "REJECT"))


@query(with_tables(_O + "SELECT user_id, count(*) AS attempted, CASE WHEN count(*) >= 70 THEN 'stop' ELSE 'warn' END AS advice FROM o GROUP BY user_id HAVING count(*) FILTER (WHERE verdict = 'APPROVE' AND rate > 0.9 AND site = 'click') = 0 AND count(*) >= 30"))
def zero_acceptance_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = (F.col("verdict") == "APPROVE") & (F.col("rate") > 0.9) & (F.col("site") == "click")
    return ledger.stop_advice(_outcomes(spark, sf_dir), "user_id", good, 30, 70)


@query(with_tables(_O + "SELECT site, round(rate, 6) AS rate, total, least(1.0, total / 10.0) AS confidence FROM (SELECT site, avg(CASE WHEN verdict = 'APPROVE' THEN 1.0 ELSE 0.0 END) AS rate, count(*) AS total FROM o GROUP BY site) WHERE total >= 5 ORDER BY 2 DESC, total DESC, site DESC LIMIT 1"))
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ledger.select_model(_outcomes(spark, sf_dir), "site", F.col("verdict") == "APPROVE"))


@query(with_tables("SELECT 'events{label=\"' || site || '\"} ' || cast(count(*) AS varchar) AS line FROM metrics GROUP BY site"))
def prometheus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = logical(spark, sf_dir, "metrics").groupBy(F.col("site").alias("label")).agg(F.count("*").alias("value")).withColumn("name", F.lit("events"))
    return ledger.prometheus(n)
