"""A session with the settings that the library expects: UTC, adaptive plans, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session; the cluster's own settings stay unless named here."""
    builder = SparkSession.builder.appName("lumenfold")
    if master:
        builder = builder.master(master)
    for name, value in (SETTINGS | settings).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
