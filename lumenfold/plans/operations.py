"""Queries over operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import operations as ops
from lumenfold.plans.benchmarks import rounded
from lumenfold.plans.registry import query
from lumenfold.sources.tables import logical, read, system_info, with_tables


@query(with_tables("SELECT site, count(*) AS lookups, count(*) FILTER (WHERE lang = 1) AS l1, count(*) FILTER (WHERE lang = 2) AS l2, count(*) FILTER (WHERE lang = 3) AS l3, round(count(*) FILTER (WHERE lang IN (1, 2, 3)) / count(*), 6) AS hit_rate FROM metrics GROUP BY site"))
def tm_hit_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = logical(spark, sf_dir, "metrics").selectExpr("site", "CASE WHEN lang BETWEEN 1 AND 3 THEN 'l' || lang ELSE 'miss' END AS source")
    return rounded(ops.hit_rates(events, ("site",), "source"))


@query(with_tables("SELECT site, count(*) AS n, count(*) FILTER (WHERE lang < 6) AS succeeded, round(sum(value), 4) AS total, round(avg(value), 4) AS mean, round(max(value), 4) AS longest, round(count(*) FILTER (WHERE lang < 6) / count(*), 4) AS success_rate FROM metrics GROUP BY site"))
def command_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.command_stats(logical(spark, sf_dir, "metrics"), "site", "value", F.col("lang") < 6), 4)


@query(with_tables("SELECT count(*) FILTER (WHERE event_id % 4 <> 1) AS open, cast(epoch(TIMESTAMP '2024-01-31') - floor(epoch(min(ts) FILTER (WHERE event_id % 4 <> 1))) AS bigint) AS oldest_open_seconds, count(*) FILTER (WHERE event_id % 4 = 0) AS expired_leases FROM metrics"))
def queue_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = logical(spark, sf_dir, "metrics").selectExpr("CASE WHEN event_id % 4 = 0 THEN 'CLAIMED' WHEN event_id % 4 = 1 THEN 'APPLIED' ELSE 'PENDING' END AS state", "ts AS created", "ts AS claim_until")
    return ops.queue_health(queue, datetime(2024, 1, 31))


@query(with_tables("SELECT n.run_id FROM (SELECT * FROM runs ORDER BY ts DESC, run_id LIMIT 500) n JOIN system_info USING (run_id) WHERE abs(cores - 12) <= 2 AND abs(ram_gb - 5000) <= 1000"))
def similar_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.similar_machines(logical(spark, sf_dir, "runs"), system_info(spark, sf_dir), 12, 5000.0, 500, 2, 1000.0).select("run_id")


@query(with_tables("SELECT DISTINCT user_id, cast(cast(ts AS date) AS varchar(10)) AS day, 'click' AS retry_with FROM metrics WHERE site = 'error' AND (user_id, cast(ts AS date)) NOT IN (SELECT (user_id, cast(ts AS date)) FROM metrics WHERE site = 'click')"))
def untried_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logical(spark, sf_dir, "metrics").withColumnRenamed("site", "model_id").withColumn("day", F.to_date("ts").cast("string"))
    return ops.untried_model(rows.filter("model_id = 'error'"), rows, ("user_id", "day"), "click")


@query("SELECT doc_id, CASE WHEN lang = 'de' THEN 'pair' WHEN regexp_matches(text, '[0-9]{4}') THEN 'careful' ELSE 'general' END AS backend, round((CASE least(doc_id % 5 + 1, 3) WHEN 1 THEN 2.0 WHEN 2 THEN 4.0 ELSE 8.0 END) * (0.8 + 0.4 * (doc_id % 10) / 10.0), 6) AS delay, round((CASE doc_id % 4 WHEN 0 THEN 500 WHEN 1 THEN 1500 WHEN 2 THEN 5000 ELSE 10000 END) * (1 + 0.3 * (doc_id % 8)), 6) AS memory_mb, NOT (doc_id % 1440 >= 360 AND doc_id % 1440 < 1320) AS at_night, CASE WHEN doc_id % 7 = 0 THEN 'SKIP' WHEN doc_id % 5 >= 3 THEN 'CIRCUIT_BREAK' WHEN doc_id % 2 = 0 THEN 'RESUME' ELSE 'PROCEED' END AS action FROM documents")
def routing_and_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    size = F.when(i % 4 == 0, "small").when(i % 4 == 1, "medium").when(i % 4 == 2, "large").otherwise("huge")
    out = read(spark, sf_dir, "documents").select(
        "doc_id",
        ops.route(F.col("lang"), F.col("text"), (("de", None, "pair"), (None, "[0-9]{4}", "careful")), "general").alias("backend"),
        ops.retry_delay(i % 5, i % 10 / 10).alias("delay"),
        ops.memory_estimate(size, i % 8 + 1).cast("double").alias("memory_mb"),
        ops.within_window(i % 1440, 1320, 360).alias("at_night"),
        ops.stop_action(i % 5, i % 7 == 0, i % 2 == 0).alias("action"),
    )
    return rounded(out)
