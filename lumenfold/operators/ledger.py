"""Work ledger: eligibility of cells, counts, rates, quarantine, verdicts, and model outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ordered outcomes of a cell as (condition, state, reason); the first that holds decides. Names are columns.
OUTCOMES = (
    ("not supported", "UNSUPPORTED", "unsupported_locale"),
    ("excluded", "EXCLUDED", "excluded_path"),
    ("not source_exists", "BLOCKED", "source_missing"),
    ("not source_readable", "BLOCKED", "source_unreadable"),
    ("not source_yaml_ok", "BLOCKED", "source_yaml_invalid"),
    ("source_empty", "BLOCKED", "source_empty"),
    ("licence_blocked", "BLOCKED", "licence"),
    ("on_hold", "BLOCKED", "hold"),
    ("rejected and source_unchanged", "REJECTED", "rejected_unchanged"),
    ("attempts >= 5", "EXHAUSTED", "attempts_exhausted"),
    ("not target_exists", "ACTIONABLE", "target_missing"),
    ("not trusted", "ACTIONABLE", "provenance_untrusted"),
    ("source_hash_changed", "ACTIONABLE", "source_changed"),
    ("profile_changed", "ACTIONABLE", "profile_changed"),
    ("protection_changed", "ACTIONABLE", "protection_changed"),
    ("lineage_denied", "ACTIONABLE", "lineage_denied"),
)
#: What each fact is where it is not known.
HEALTHY = {"supported": True, "excluded": False, "source_exists": True, "source_readable": True, "source_yaml_ok": True, "source_empty": False, "licence_blocked": False, "on_hold": False, "rejected": False, "source_unchanged": False, "attempts": 0, "target_exists": True, "trusted": True, "source_hash_changed": False, "profile_changed": False, "protection_changed": False, "lineage_denied": False}


def classify(cells: DataFrame) -> DataFrame:
    """state and reason of each cell; facts that are null or not there are healthy."""
    facts = cells.select("*", *(F.lit(v).alias(c) for c, v in HEALTHY.items() if c not in cells.columns)).fillna({c: v for c, v in HEALTHY.items() if c in cells.columns})
    state, reason = F, F
    for condition, s, r in OUTCOMES:
        state, reason = state.when(F.expr(condition), s), reason.when(F.expr(condition), r)
    return facts.withColumn("state", state.otherwise("CURRENT")).withColumn("reason", reason.otherwise("up_to_date"))


def classify_sql(columns: dict[str, str]) -> tuple[str, str]:
    """``classify`` as two SQL expressions; columns: the SQL of facts, the others are healthy."""
    import re

    def put(condition: str) -> str:
        return re.sub(r"\b(?!not\b|and\b)([a-z_]+)\b", lambda m: f"({columns.get(m[1], str(HEALTHY[m[1]]).lower())})", condition)

    cases = [(put(c), s, r) for c, s, r in OUTCOMES]
    return tuple("CASE " + " ".join(f"WHEN {x[0]} THEN '{x[k]}'" for x in cases) + f" ELSE '{other}' END" for k, other in ((1, "CURRENT"), (2, "up_to_date")))


def counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def counts_with_totals(rows: DataFrame, *by: str) -> DataFrame:
    """Counts by all the columns, and of each prefix of them, whose other columns are 'total'."""
    named = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in by})
    return named.rollup(*by).agg(F.count("*").alias("n")).fillna("total", list(by))


def quarantined(tickets: DataFrame, keys: tuple[str, ...], distinct: str | None = None, least: int = 3) -> DataFrame:
    """Keys with at least that many open tickets, or distinct values of a column among them."""
    n = F.count("*") if distinct is None else F.countDistinct(distinct)
    return tickets.groupBy(*keys).agg(n.alias("n")).filter(F.col("n") >= least)


def run_verdict(processed: Column, accepted: Column, rejected: Column, retried: Column) -> Column:
    return F.when(processed == 0, "BLOCKED").when((rejected > 0) & (accepted == 0), "FAILED").when((rejected > 0) | (retried > 0), "DEGRADED").otherwise("CLEAN")


def run_status(succeeded: Column, failed: Column, discovered: Column) -> Column:
    return F.when(discovered == 0, "empty").when(failed == 0, "success").when(succeeded == 0, "failure").otherwise("partial")


def autonomy(manual: Column, total: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.coalesce(F.try_divide(manual, total), F.lit(0.0))))


def model_outcomes(rows: DataFrame, model: str, outcome: str, outcomes: tuple[str, ...]) -> DataFrame:
    """A column of counts for each outcome, 0 where there are none."""
    return rows.groupBy(model).agg(*(F.count_if(F.col(outcome) == o).alias(o.lower()) for o in outcomes))


def stop_advice(rows: DataFrame, model: str, accepted: Column, warn: int, stop: int) -> DataFrame:
    """Models that were tried often and never accepted: (model, attempted, advice)."""
    out = rows.groupBy(model).agg(F.count("*").alias("attempted"), F.count_if(accepted).alias("__good")).filter((F.col("__good") == 0) & (F.col("attempted") >= warn))
    return out.select(model, "attempted", F.when(F.col("attempted") >= stop, "stop").otherwise("warn").alias("advice"))


def select_model(rows: DataFrame, model: str, accepted: Column, least: int = 5) -> DataFrame:
    """(model, rate, total, confidence) of the best acceptance rate, then the most rows; from 5 rows on."""
    sums = rows.groupBy(model).agg(F.avg(F.when(accepted, 1.0).otherwise(0.0)).alias("rate"), F.count("*").alias("total")).filter(F.col("total") >= least)
    best = sums.agg(F.max(F.struct("rate", "total", model)).alias("b")).filter("b is not null").select(f"b.{model}", "b.rate", "b.total")
    return best.withColumn("confidence", F.least(F.lit(1.0), F.col("total") / 10))


def prometheus(metrics: DataFrame) -> DataFrame:
    """(line) of (name, label, value): name{label="…"} value, sorted by the reader."""
    return metrics.select(F.concat("name", F.lit('{label="'), F.coalesce("label", F.lit("")), F.lit('"} '), F.col("value").cast("string")).alias("line"))
