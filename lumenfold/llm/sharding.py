"""Shards by jump consistent hashing, with gapless slots.

A key's shard follows from the key and the number of shards alone, without a ring or table: a generator seeded by the key jumps
ahead to the next number of shards at which the key would move, until that exceeds the number asked for. One more shard so moves
only the rows that land in it, 1/(n+1) of all on average.

Slots number the rows of a shard from 0 without gaps. Equal rows are counted before the shuffle; the rows of a shard are ordered
by a hash's range (a chunk), then by key, checksum and size, so that no task orders a whole shard: chunks are numbered within, and
the chunks' row counts are summed over the shard.

Defined results. Null key: a key like any other. Null text: size 16, null checksum. Repeated rows: each has its own slot. An empty
table gives an empty one. Other columns are not carried; join them by key, or use ``shard_of`` on the rows themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.llm.common import Scratch

#: Rows of a shard that one window orders, about; repeats of one row that one array holds.
CHUNK_ROWS, REPEATS = 20_000, 4096


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key of any type, null included.

    The draws are hashes of the key and the step. The steps a key needs are the records among ``shards`` draws: ``shards`` at most, and
    about ln(shards); beyond 64 + 16 log2(shards) with a probability under 1e-40."""
    name, steps = key.cast("string"), min(shards, 64 + 16 * math.ceil(math.log2(max(2, shards))))

    def step(state: Column, i: Column) -> Column:
        draw = (F.shiftrightunsigned(F.xxhash64(name, i), 11) + 1) / float(1 << 53)
        ahead = F.least(F.floor((state["ahead"] + 1) / draw), F.lit(shards)).cast("long")
        return F.when(state["ahead"] < shards, F.struct(state["ahead"].alias("at"), ahead.alias("ahead"))).otherwise(state)

    zero = F.lit(0).cast("long")
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(zero.alias("at"), zero.alias("ahead")), step)["at"].cast("int")


def shard_rows(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: (key, size, text_crc32, law, shard, slot, grown_shard)."""
    scratch = Scratch(docs.sparkSession, "shards")
    rows = docs.select(F.col(key).alias("key"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc"))
    rows = rows.groupBy("key", "size", "crc").agg(F.count("*").alias("n"))
    rows = scratch.put("rows", rows.select("*", shard_of(F.col("key"), shards).alias("shard"), shard_of(F.col("key"), shards + 1).alias("grown")))
    chunks = 1 + rows.count() // (shards * CHUNK_ROWS)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "crc", "size", F.lit("chunk")), F.lit(chunks)))
    before = (W.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "chunk").agg(F.sum("n").alias("rows"))
    starts = starts.select("shard", "chunk", F.coalesce(F.sum("rows").over(W.partitionBy("shard").orderBy("chunk").rowsBetween(*before)), F.lit(0)).alias("start"))
    inner = F.coalesce(F.sum("n").over(W.partitionBy("shard", "chunk").orderBy("key", "crc", "size").rowsBetween(*before)), F.lit(0))
    placed = rows.withColumn("inner", inner).join(starts, ["shard", "chunk"]).withColumn("first", F.col("start") + F.col("inner"))
    placed = placed.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(REPEATS).cast("long"))))
    placed = placed.withColumn("slot", F.explode(F.sequence(F.col("first") + F.col("from"), F.col("first") + F.least(F.col("from") + REPEATS, "n") - 1)))
    return placed.select(F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", F.col("grown").alias("grown_shard"))
