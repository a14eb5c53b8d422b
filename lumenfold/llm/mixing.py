"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks, with DataFrame functions only.

1. Each source's target is its weight's share of all words; none exceeds ``most`` times what the source holds, and what that frees
   goes to the others by weight, until no source is above its limit.
2. The schedule has 2**m slots, each for an equal block of the mix's words, ``block`` words at most; m is ``LEAST_BITS`` or more, so
   that small tables are not cut too coarsely. Slot t has the t-th van der Corput point and belongs to the source whose stretch of
   the cumulative targets holds the point. All 2**m points lie evenly, so a source gets its target to less than one block; and any run
   of slots has nearly every source's share. Nothing corrects what the points give; another point set gives another mix.
3. Slots are ranked within their source: by run of slots, then within the run, so that no task ranks a whole source.
4. A source's documents lie in a hashed order, as one stream of words, read again from its start when it is used up. Block k of the
   stream joins the slot of rank k; a document takes the words of it that joined blocks hold, and has these blocks' slots.

Sources are numbered in a sorted table, part by part, and points find theirs by a sorted as-of join in cells of the unit interval,
so neither the sources nor the slots need pass through one task.

Defined results. Null or blank text: size 0, takes 0, no slot. Null source: a source of its own, last. A source without words has
target 0. Repeated rows: each is a document of its own. All tables empty or without words: targets and taken are 0. Other columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.llm.common import BROADCAST_ROWS, WORD, Scratch, fresh, spread_join

#: The golden ratio's fractional part.
PHI = 0.6180339887498949
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK, MOST, LEAST_BITS = 256, 3, 18
#: Slots of one run and of one cell, and documents of one stretch of a source's stream, that a window numbers.
RUN, STRETCH = 1 << 14, 2000
#: Bytes of a word and of a partition of the mix, about; a mix of less than 200 partitions has smaller ones.
WORD_BYTES, PART_BITS, SMALL_PART_BITS = 7, 27, 24

Points = Callable[[Column, int], Column]


def van_der_corput(slot: Column, bits: int) -> Column:
    """The slot's bits reversed, as a point in the unit interval: all 2**bits points lie evenly, half a step from its ends."""
    x = slot.cast("long")
    for shift, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        x = F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(mask)).bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(mask)), shift))
    x = F.shiftrightunsigned(x, 32).bitwiseOR(F.shiftleft(x, 32))
    return (F.shiftrightunsigned(x, 64 - bits) + 0.5) / float(1 << bits) if bits else F.lit(0.5)


def golden(slot: Column, bits: int) -> Column:
    """Multiples of the golden ratio, without their whole part."""
    return F.pmod((slot + 0.5) * PHI, F.lit(1.0))


def _numbered(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, source_size, part, at, number), written in order of source: number counts from 0. One row for each part is windowed."""
    at = F.monotonically_increasing_id()
    table = scratch.put("sources", sizes.orderBy(F.col("source").asc_nulls_last()).select("source", "source_size", at.alias("at")))
    table = table.withColumn("part", F.shiftright("at", 33))
    starts = table.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("start"))
    return table.join(F.broadcast(starts), "part").withColumn("number", F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("start")


def _targets(sizes: DataFrame, weights: tuple[float, ...], most: int, scratch: Scratch) -> DataFrame:
    """(source, source_size, number, part, weight, target), written.

    The level at which the sources below their limit share by weight rises until no more of them reach it."""
    n = len(weights)
    table = _numbered(sizes, scratch).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % n + 1).cast("int")))
    table = scratch.put("weighted", table)
    limit, level, known = F.col("source_size") * most, 0.0, -1
    while True:
        full = limit < F.col("weight") * level if known >= 0 else F.lit(False)
        total, held, rest, count = table.agg(F.sum("source_size"), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if count == known:
            break
        known, level = count, ((total or 0) - (held or 0)) / rest if rest else float("inf")
    target = F.least(limit.cast("double"), F.col("weight") * level)
    return scratch.put("targets", table.select("source", "source_size", "number", "part", "weight", target.alias("target")))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row for each source."""
    return _targets(sizes, weights, most, Scratch(sizes.sparkSession, "targets")).select("source", "source_size", "weight", "target")


def schedule(targets: DataFrame, slots: int, block: float = BLOCK, points: Points = van_der_corput) -> DataFrame:
    """(number, rank, slot) of the first ``slots`` slots: number is a source's, rank the slot's within it.

    targets: (number, goal) in words, one row for each source, and optionally part, which grows with number."""
    spark, bits = targets.sparkSession, max(0, slots - 1).bit_length()
    if "part" not in targets.columns:
        targets = targets.withColumn("part", F.lit(0))
    goals = targets.filter("goal > 0").select("number", "part", F.col("goal").cast("double").alias("goal"))
    parts = goals.groupBy("part").agg(F.sum("goal").alias("words"))
    parts = parts.select("part", (F.sum("words").over(W.orderBy("part")) - F.col("words")).alias("start"), F.sum("words").over(W.partitionBy()).alias("all"))
    own = F.col("start") + F.sum("goal").over(W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, W.currentRow))
    edges = goals.join(F.broadcast(parts), "part").withColumn("end", own).select("number", F.least((F.col("end") - F.col("goal")) / F.col("all"), F.lit(1.0)).alias("begin"), F.least(F.col("end") / F.col("all"), F.lit(1.0)).alias("end"))
    # a source's stretch begins anew in each cell that it reaches into; each point belongs to the last beginning before it
    cells = max(1, slots // RUN)
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1))
    begins = edges.withColumn("cell", F.explode(F.sequence(cell(F.col("begin")), cell(F.col("end"))))).select("cell", F.greatest("begin", F.col("cell") / float(cells)).alias("point"), "number", F.lit(None).cast("long").alias("slot"))
    point = points(F.col("id"), bits)
    drawn = spark.range(slots).select(cell(point).alias("cell"), point.alias("point"), F.lit(None).cast(goals.schema["number"].dataType).alias("number"), F.col("id").alias("slot"))
    order = W.partitionBy("cell").orderBy("point", F.col("slot").asc_nulls_first(), "number").rowsBetween(W.unboundedPreceding, W.currentRow)
    owned = begins.unionByName(drawn).withColumn("number", F.last("number", ignorenulls=True).over(order)).filter("slot is not null").select("slot", "number", (F.col("slot") / RUN).cast("long").alias("run"))
    starts = owned.groupBy("number", "run").agg(F.count("*").alias("n"))
    starts = starts.select("number", "run", (F.sum("n").over(W.partitionBy("number").orderBy("run")) - F.col("n")).alias("start"))
    return owned.withColumn("within", F.row_number().over(W.partitionBy("number", "run").orderBy("slot")) - 1).join(starts, ["number", "run"]).select("number", (F.col("start") + F.col("within")).alias("rank"), "slot")


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK, points: Points = van_der_corput) -> DataFrame:
    """One row for each row of docs: (key, size, source_size, target, taken, first_slot, slots).

    first_slot is the first of the schedule's slots that hold words of the document, null for none, slots is their number."""
    taken = _taken(docs, key, text, source, weights, most, block, F.lit(None).cast("string"), points)
    return taken.withColumnRenamed("key", key).drop("mark")


def _taken(docs: DataFrame, key: str, text: str, source: str, weights: tuple[float, ...], most: int, block: int, mark: Column, points: Points = van_der_corput) -> DataFrame:
    """(key, size, source_size, target, taken, first_slot, slots, mark): mark tells rows of one key apart."""
    rows, held, _ = _held(docs, key, text, source, weights, most, block, mark, points)
    taken = held.groupBy("number", "begin").agg(F.sum("held").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("slots"))
    worded = rows.filter("size > 0").join(taken, ["number", "begin"], "left")
    none = rows.filter("size = 0").select("*", *(F.lit(None).cast("long").alias(c) for c in ("taken", "first_slot", "slots")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return worded.select(none.columns).union(none).select("key", "size", "source_size", "target", zero("taken"), "first_slot", zero("slots"), "mark")


def _held(docs: DataFrame, key: str, text: str, source: str, weights: tuple[float, ...], most: int, block: int, mark: Column, points: Points) -> tuple[DataFrame, DataFrame, tuple[int, int]]:
    """(key, mark, size, source_size, target, number, begin) of each row, where (number, begin) names a row with words; (number, begin,
    pass, slot, held) of each slot and pass over the source that holds words of it; and the numbers of slots and of words."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "mix")
    name = F.when(F.col(source).isNotNull(), F.concat(F.lit("s"), F.col(source).cast("string"))).otherwise("n")  # null is a name as well
    rows = scratch.put("rows", docs.select(F.col(key).alias("key"), F.col(source).alias("source"), name.alias("name"), mark.alias("mark"), words_of(F.col(text)).alias("size"), F.xxhash64(F.col(key).cast("string"), F.lit("order")).alias("hash")))
    targets = _targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most, scratch)
    count, (words, sources) = rows.count(), targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count("*")).first()
    bits = max(LEAST_BITS, (-(-words // block) - 1).bit_length()) if words else 0
    # the stream: documents of a source by hash, in stretches
    stretches = 1 + count // STRETCH
    named = targets.select(F.when(F.col("source").isNotNull(), F.concat(F.lit("s"), F.col("source").cast("string"))).otherwise("n").alias("name"), "source_size", "target", "number")
    placed = rows.join(F.broadcast(named), "name") if sources <= BROADCAST_ROWS else spread_join(rows, named, "name", "hash", count)
    placed = placed.select("key", "mark", "size", "source_size", "target", "number", F.pmod("hash", F.lit(stretches)).alias("stretch"), "hash")
    before = (W.unboundedPreceding, -1)
    starts = placed.groupBy("number", "stretch").agg(F.sum("size").alias("words"))
    starts = starts.select("number", "stretch", F.coalesce(F.sum("words").over(W.partitionBy("number").orderBy("stretch").rowsBetween(*before)), F.lit(0)).alias("start"))
    inner = F.coalesce(F.sum("size").over(W.partitionBy("number", "stretch").orderBy("hash", "key", "size", "mark").rowsBetween(*before)), F.lit(0))
    stream = placed.withColumn("inner", inner).join(starts, ["number", "stretch"]).withColumn("begin", F.col("start") + F.col("inner"))
    stream = scratch.put("stream", stream.select("key", "mark", "size", "source_size", "target", "number", "begin"))
    scratch.drop("rows")
    if not words:
        return stream, spark.createDataFrame([], "number long, begin long, pass int, slot long, held long"), (0, 0)
    # block k holds the words from edge(k) to edge(k + 1) of a source's stream; no stream is longer than ``most`` passes
    step = words / (1 << bits)
    limit = F.col("source_size") * most
    edge = lambda k: F.least(F.floor(k * step + 0.5), limit)
    passes = stream.filter("size > 0").select("number", "begin", "size", "source_size", "target", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda p: F.col("begin") + p * F.col("source_size"))).alias("pass", "at"))
    passes = passes.filter(F.col("at") < F.col("target") + 2 * step + 1)
    share = lambda k: F.least(F.col("at") + F.col("size"), edge(k + 1)) - F.greatest(F.col("at"), edge(k))
    ranks = F.sequence(F.greatest(F.floor(F.col("at") / step) - 1, F.lit(0)), F.ceil((F.col("at") + F.col("size")) / step) + 1)
    parts = passes.select("number", "begin", "pass", F.explode(F.filter(F.transform(ranks, lambda k: F.struct(k.alias("rank"), share(k).alias("held"))), lambda x: x["held"] > 0)).alias("x")).select("number", "begin", "pass", "x.*")
    plan = schedule(targets.select("number", "part", F.col("target").alias("goal")), 1 << bits, step, points)
    return stream, parts.join(plan, ["number", "rank"]).select("number", "begin", "pass", "slot", "held"), (1 << bits, words)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """The mix itself, with the columns of docs, in the order of the schedule: a document stands once for each pass over its source in
    which the mix takes half of it or more, at the first slot that holds words of it.

    Rows are told apart by key, source and text, whatever their keys; of rows that repeat all three, the n-th has the n-th place."""
    scratch = Scratch(docs.sparkSession, "copies")
    mark = F.md5(F.concat_ws("|", F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")), F.coalesce(F.length(source), F.lit(-1)).cast("string"), source))
    rows, held, (slots, words) = _held(docs, key, text, source, weights, most, block, mark, van_der_corput)
    copies = held.groupBy("number", "begin", "pass").agg(F.sum("held").alias("held"), F.min("slot").alias("slot"))
    copies = copies.join(rows.filter("size > 0").select("number", "begin", "key", "mark", "size"), ["number", "begin"]).filter("2 * held >= size")
    own = {c: fresh(docs, f"mix_{c}") for c in ("key", "mark", "nth", "slot", "to")}
    repeats = not rows.filter("size > 0").groupBy("key", "mark").count().filter("count > 1").isEmpty()
    nth = F.dense_rank().over(W.partitionBy("key", "mark").orderBy("begin")) if repeats else F.lit(1)
    if repeats:  # the n-th place is that of the n-th row, whether the mix takes it or not
        copies = copies.join(rows.filter("size > 0").select("number", "begin", nth.alias("nth"), F.col("key").alias("k")), ["number", "begin"])
        nth = F.col("nth")
    copies = scratch.put("copies", copies.select(F.col("key").alias(own["key"]), F.col("mark").alias(own["mark"]), nth.alias(own["nth"]), F.col("slot").alias(own["slot"])))
    marked, mine, turn = docs, fresh(docs, "own_mark"), fresh(docs, "own_nth")
    marked = docs.withColumn(mine, mark)
    marked = marked.withColumn(turn, F.row_number().over(W.partitionBy(key, mine).orderBy(mine)) if repeats else F.lit(1))
    out = marked.join(copies, F.col(key).eqNullSafe(F.col(own["key"])) & (F.col(mine) == F.col(own["mark"])) & (F.col(turn) == F.col(own["nth"])))
    size = words * WORD_BYTES
    parts = max(1 + (size >> PART_BITS), min(1 + (size >> SMALL_PART_BITS), 200))
    out = out.withColumn(own["to"], F.floor(F.col(own["slot"]) * (parts / max(1, slots))).cast("int"))
    return out.repartitionById(parts, own["to"]).sortWithinPartitions(own["slot"], key).select(*docs.columns)
