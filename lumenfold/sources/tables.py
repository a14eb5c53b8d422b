"""Logical tables over the supplied ones: pure projections, each also as SQL text for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Logical tables as (table, {column: expression}); the expressions mean the same in Spark SQL and in ANSI SQL.
PROJECTIONS: dict[str, tuple[str, dict[str, str]]] = {
    "runs": ("orders", {"run_id": "o_orderkey", "model_id": "o_orderpriority", "device": "o_orderstatus", "custkey": "o_custkey", "ts": "o_orderdate", "total_seconds": "o_totalprice"}),
    "results": ("lineitem", {"run_id": "l_orderkey", "sample_id": "l_linenumber", "part_id": "l_partkey", "batch_size": "l_linenumber", "throughput": "l_extendedprice / l_quantity", "duration": "l_quantity", "memory": "l_extendedprice", "failed": "l_returnflag = 'R'"}),
    "metrics": ("events", {"event_id": "event_id", "ts": "ts", "site": "event_type", "lang": "cast(user_id % 8 as bigint)", "user_id": "user_id", "value": "value", "props": "props"}),
    "units": ("documents", {"doc_id": "doc_id", "text": "text", "lang": "lang", "site": "source", "n_chars": "n_chars"}),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table, as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def logical(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A logical table."""
    table, columns = PROJECTIONS[name]
    return read(spark, sf_dir, table).selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def system_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, cores, ram_gb, gpu_model) of each run: the customer's nation and balance."""
    orders, customers, nations = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(nations, customers.c_nationkey == nations.n_nationkey)
    return joined.selectExpr("o_orderkey AS run_id", "cast(c_nationkey as bigint) AS cores", "c_acctbal AS ram_gb", "n_name AS gpu_model")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair_id, source, translation): each user turn with the assistant turn that follows it."""
    turns = read(spark, sf_dir, "conversations")
    return turns.selectExpr("conv_id", "turn", "role", "text", "lead(role) over (partition by conv_id order by turn) AS next_role", "lead(text) over (partition by conv_id order by turn) AS next_text").filter("role = 'user' and next_role = 'assistant'").selectExpr("conv_id * 1000 + turn AS pair_id", "text AS source", "next_text AS translation")


def with_tables(sql: str) -> str:
    """SQL over logical tables, as SQL over the supplied ones."""
    parts = [f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table})" for name, (table, columns) in PROJECTIONS.items()]
    parts.append("system_info AS (SELECT o_orderkey AS run_id, cast(c_nationkey as bigint) AS cores, c_acctbal AS ram_gb, n_name AS gpu_model FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)")
    parts.append("turns AS (SELECT *, lead(role) over (partition by conv_id order by turn) AS next_role, lead(text) over (partition by conv_id order by turn) AS next_text FROM conversations)")
    parts.append("pairs AS (SELECT conv_id * 1000 + turn AS pair_id, text AS source, next_text AS translation FROM turns WHERE role = 'user' AND next_role = 'assistant')")
    own = sql.strip()
    if own.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(parts)}, {own[15:]}"
    return f"WITH {', '.join(parts)}, {own[5:]}" if own.upper().startswith("WITH ") else f"WITH {', '.join(parts)} {own}"
