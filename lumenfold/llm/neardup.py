"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union-find.

1. Each text becomes the set of its distinct word shingles; equal sets are one class, whatever their number.
2. Each class gets a SuperMinHash signature: an element's j-th random rank goes to the j-th slot of that element's own random
   permutation, so slots are correlated and estimates vary less than with independent hashes. A text is done when all its slots
   hold a rank no later one can undercut.
3. Classes with an equal band of the signature meet in a bucket. A bucket never gives all its pairs: its members are first held
   against its hub, the member that meets most others over all its bands (in a family of edited copies that is the original, which
   shares every band). Members that then lie in one group need no more: more links cannot change the result. Of the others, those
   of a bucket of ``SMALL`` at most are held against each other if their sizes allow the similarity; in larger buckets, only those
   are that share enough of what sets them apart from the hub (see ``_by_difference``), which loses no link either.
4. Every link is confirmed on the full sets. Union-find within partitions, then star contraction between them, gives the groups.

With 32 bands of 6 slots a pair of similarity 0.85 fails to meet with a probability of 3e-7, one of 0.8 with 6e-5. Sets hold 64-bit
hashes of shingles. A bucket, hub, class or group may hold any share of all rows: whatever joins on one deals its rows out into
shares of about ``SPREAD`` rows, and sends the one row they join with to each share (``spread_join``, ``_with_sets``).

Defined results. Null, empty or blank text: no shingles, linked with nothing, its own group. A text shorter than a shingle: its
whole word sequence is the one shingle. Repeated rows: each comes back, with equal values. A null id takes part in linking but
cannot name a group; a group of null ids only has a null id. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from lumenfold.llm.common import BROADCAST_ROWS, WORD, Scratch, fresh, lean, mix, pieces, salt, shingle_sets, small, spread_join, text_arrays

BANDS, ROWS, WIDTH = 32, 6, 5
#: Members of a bucket whose pairs may be held against each other directly; larger buckets go by their difference from the hub.
SMALL = 32
#: Steps from hub to heavier hub; more would only join more groups of members into one.
JUMPS = 3
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Shingles whose permutations, and nodes whose trees, are held in memory at a time.
_ELEMENTS, _LINKS = 1 << 17, 1 << 18


def superminhash(elements: np.ndarray, offsets: np.ndarray, slots: int = BANDS * ROWS) -> np.ndarray:
    """The signatures, one row for each set: rank << 32 | random part; sets without elements keep the maximum."""
    n = len(offsets) - 1
    sig = np.full((n, slots), np.iinfo(np.uint64).max, np.uint64)
    flat, owner = sig.reshape(-1), np.repeat(np.arange(n), np.diff(offsets))
    state, perms, low = elements, None, np.uint64(0xFFFFFFFF)
    for rank in range(slots):
        if not len(state):
            break
        draw = mix(state + np.uint64((rank + 1) * int(_STEP) & (1 << 64) - 1))
        value, pick = (np.uint64(rank) << np.uint64(32)) | (draw >> np.uint64(32)), rank + (((draw & low) * np.uint64(slots - rank)) >> np.uint64(32)).astype(np.int64)
        if perms is None:
            slot = pick
        else:
            row = np.arange(len(state))
            slot = perms[row, pick].astype(np.int64)
            perms[row, pick] = perms[row, rank]
        np.minimum.at(flat, owner * slots + slot, value)
        # a set is done when no slot can fall below what the next rank would bring
        live = (sig.max(axis=1) >= np.uint64(rank + 1) << np.uint64(32))[owner]
        if perms is None:
            state, owner, pick = state[live], owner[live], pick[live]
            perms = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(state), 1))
            perms[np.arange(len(state)), pick] = 0
        elif not live.all():
            state, owner, perms = state[live], owner[live], perms[live]
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each signature, distinct between bands."""
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _STEP), (len(sig), bands)).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + sig[:, k : bands * rows : rows])
    return key


def _profiles(batches: Iterator, width: int) -> Iterator:
    import hashlib

    import pyarrow as pa

    for batch in batches:
        raw, offsets, _ = text_arrays(batch.column(1))
        for first, end in pieces(offsets):
            part = offsets[first : end + 1]
            sets, at = shingle_sets(raw[part[0] : part[-1]], part - part[0], width)
            keys = np.concatenate([band_keys(superminhash(sets[at[a] : at[b]], at[a : b + 1] - at[a])) for a, b in pieces(at, _ELEMENTS)])
            names = [hashlib.blake2b(sets[at[i] : at[i + 1]].tobytes(), digest_size=16).digest() for i in range(end - first)]
            where = pa.array(np.arange(0, (end - first + 1) * BANDS, BANDS, dtype=np.int32))
            bands = pa.ListArray.from_arrays(where, pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0)[first:end], pa.array(np.diff(at)), pa.array(names, pa.binary()), bands], ["id", "n", "node", "bands"])


def _sets(batches: Iterator, width: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        raw, offsets, _ = text_arrays(batch.column(1))
        for first, end in pieces(offsets):
            part = offsets[first : end + 1]
            sets, at = shingle_sets(raw[part[0] : part[-1]], part - part[0], width)
            yield pa.RecordBatch.from_arrays([batch.column(0)[first:end], pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))], ["node", "elements"])


def _forest(batches: Iterator) -> Iterator:
    """Union-find over the links of one partition, ``_LINKS`` nodes at a time: a star for each tree, its least node in the middle."""
    import pyarrow as pa

    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def stars():
        found = [(x, r) for x in root if (r := find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        if len(root) > _LINKS:
            yield stars()
            root.clear()
    yield stars()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of all nodes in links (a, b): the root is the component's least node.

    Stars of each partition's own union-find, then alternating large-star and small-star steps until nothing changes; each step
    keeps at most as many rows as there are links, and sends a node's links only to their least node."""
    edges = scratch.put(f"{name}-0", links.select("a", "b").mapInArrow(lean(_forest), "a binary, b binary"))
    step, seen, count = 0, None, edges.count()
    while True:
        # large star: a node's larger neighbours move to its least neighbour
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = spread_join(both.filter(F.col("b") > F.col("a")), least, "a", "b", 2 * count).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the least of them; now a > b in every row
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small_ = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").filter("a <> b").distinct()
        step += 1
        edges = scratch.put(f"{name}-{step}", small_)
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == seen:
            scratch.drop(f"{name}-{step - 1}")
            break
        seen, count = now, now[0]
        if step > 1:
            scratch.drop(f"{name}-{step - 2}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _same(a: Column, b: Column, percent: float) -> Column:
    return 100 * a >= percent * b


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, width: int = WIDTH) -> DataFrame:
    """One row for each row of docs: (key, n_shingles, component_id, kept).

    Texts are linked if 100 * |A and B| >= percent * |A or B| for their shingle sets."""
    found = _classes(docs, key, text, percent, width)[1]
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def _ids_name_rows(profiles: DataFrame) -> bool:
    """No id is null or repeats."""
    return profiles.filter("id is null").isEmpty() and profiles.groupBy("id").count().filter("count > 1").isEmpty()


def _classes(docs: DataFrame, key: str, text: str, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, node, bands) of each row, and (id, n, component_id, node, root): a row without shingles has no root."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "neardup")
    profiles = scratch.put("profiles", docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(lean(lambda b: _profiles(b, width)), f"id {docs.schema[key].dataType.simpleString()}, n long, node binary, bands array<long>"))
    worded = profiles.filter("n > 0")
    classes = scratch.put("classes", worded.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    # the buckets that several classes meet in; a bucket is counted by shares of its members, and each share is told the whole count
    slots = classes.select("node", F.explode("bands").alias("bucket")).withColumn("share", salt("node", BANDS * classes.count()).cast("int")).repartition("bucket", "share")
    # counting the nodes, not the rows, reads the same shuffle as the join
    shares = slots.groupBy("bucket", "share").agg(F.count("node").alias("met")).withColumn("met", F.sum("met").over(W.partitionBy("bucket"))).filter("met > 1")
    met = slots.join(shares, ["bucket", "share"]).select("bucket", "node", "met")
    met = scratch.put("met", met.join(classes.select("node", "id", "n"), "node"))
    roots = None
    if not met.isEmpty():
        roots = _grouped(docs, profiles, met, scratch, key, text, percent, width)
    if roots is None:
        roots = spark.createDataFrame([], "node binary, root binary")
    named = classes.select("node", F.col("id").alias("least")).join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    group = spread_join(named, least, "root", "node", classes.count()).select("node", "component_id", "root")
    found = spread_join(worded, group, "node", "id", profiles.count()).select("id", "n", "component_id", "node", "root")
    return profiles, found.union(profiles.filter("n = 0").select("id", "n", F.col("id").alias("component_id"), "node", F.lit(None).cast("binary").alias("root")))


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (hub, node, ...), a written table, with the hub's elements h and the node's elements x.

    A hub may have any number of nodes: they are dealt out into shares, each of which gets the hub's set once."""
    each = spread_join(pairs, pairs.groupBy("hub").agg(F.count("*").alias("nodes")), "hub", "node", pairs.count())
    dealt = each.withColumn("share", salt("node", F.col("nodes"))).drop("nodes")
    few = pairs.count() <= BROADCAST_ROWS  # then the names go to the sets, else both are shuffled
    names, shares = dealt, dealt.select("hub", "share").distinct()
    if few:
        names, shares = F.broadcast(names), F.broadcast(shares)
    hubs = sets.select(F.col("node").alias("hub"), F.col("elements").alias("h")).join(shares, "hub")
    return sets.select("node", F.col("elements").alias("x")).join(names, "node").join(hubs, ["hub", "share"]).drop("share")


def _grouped(docs: DataFrame, profiles: DataFrame, met: DataFrame, scratch: Scratch, key: str, text: str, percent: int, width: int) -> DataFrame:
    """The roots of all classes that are linked with another."""
    # the text of one row for each class that meets another; ids name rows here, the class of what is read is computed anew
    nodes = met.groupBy("node").agg(F.first("id").alias("id"))
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    if _ids_name_rows(profiles):
        texts = texts.join(small(scratch.put("nodes", nodes)), "id").select("node", "text")
        sets = texts.mapInArrow(lean(lambda b: _sets(b, width)), "node binary, elements array<long>")
    else:  # ids that repeat or are null do not name a text: compute the sets of all rows, with their class
        sets = texts.select("id", "text").mapInArrow(lean(lambda b: _named_sets(b, width)), "node binary, elements array<long>").join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.first("elements").alias("elements"))
    sets = scratch.put("sets", sets)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among pairs (hub, node), as (a, b)."""
        both = F.size(F.array_intersect("x", "h"))
        return _with_sets(pairs, sets).filter(_same(both, F.size("x") + F.size("h") - both, percent)).select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))

    def fits(n: Column, m: Column) -> Column:
        return _same(F.least(n, m), F.greatest(n, m), percent)

    # every member against the one of its bucket that meets most others
    count = met.count()
    weight = met.groupBy("node").agg(F.sum("met").alias("weight"))
    lead = met.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("lead"))
    lead = scratch.put("lead", lead.select("bucket", F.col("lead.node").alias("hub"), F.col("lead.n").alias("m"), F.col("lead.weight").alias("weight")))
    held = spread_join(met.select("bucket", "node", "n"), lead.select("bucket", "hub", "m"), "bucket", "node", count).filter("node <> hub")
    tried = held.filter(fits(F.col("n"), F.col("m"))).groupBy(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).agg(F.max("hub").alias("hub"))
    tried = scratch.put("tried", tried.select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("node"), "a", "b"))
    links = scratch.put("links-hub", confirmed(tried.select("hub", "node")))
    roots = components(links, scratch, "roots-hub")
    rest = _open(met, roots, count)
    if not rest.isEmpty():
        rest = scratch.put("open", rest)
        few = rest.filter(F.col("met") <= SMALL)
        left, right = few.select("bucket", F.col("node").alias("a"), "n", "root"), few.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"))
        pairs = left.join(right, "bucket").filter((F.col("a") < F.col("b")) & (F.col("root") != F.col("other")) & fits(F.col("n"), F.col("m"))).select("a", "b")
        many = rest.filter(F.col("met") > SMALL)
        if not many.isEmpty():
            large = spread_join(many, lead.select("bucket", "hub", "weight"), "bucket", "node", count)
            # a member's top is the heaviest hub that it meets, or that this hub meets; a bucket whose members have one top is covered there
            top = large.groupBy("node").agg(F.max(F.struct("weight", "hub")).alias("top")).select("node", F.col("top.hub").alias("top"))
            for jump in range(JUMPS):
                top = scratch.put(f"top-{jump}", top)
                above = top.select(F.col("node").alias("top"), F.col("top").alias("above"))
                top = top.join(spread_join(top, above, "top", "node", count).select("node", "above"), "node", "left").select("node", F.coalesce("above", "top").alias("top"))
            top = scratch.put("top", top)
            covered = many.select("bucket", "node").join(top, "node").groupBy("bucket").agg(F.min("top").alias("p"), F.max("top").alias("q")).select("bucket", F.when(F.col("p") == F.col("q"), F.col("p")).alias("top"))
            hubs = lead.select("bucket", "hub").join(covered, "bucket").select("bucket", F.coalesce("top", "hub").alias("hub"))
            members = spread_join(many, hubs, "bucket", "node", count).filter("node <> hub").select("hub", "node", "root").distinct()
            pairs = pairs.union(_by_difference(scratch.put("members", members), sets, scratch, percent / 100))
        pairs = scratch.put("pairs", pairs.distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti").select(F.col("a").alias("hub"), F.col("b").alias("node")))
        links = links.union(scratch.put("links-rest", confirmed(pairs)))
        roots = components(links, scratch, "roots-rest")
    for name in ("met", "sets", "lead", "tried", "open", "each", "links-hub", "links-rest", "members", "pairs", "nodes", "top", *(f"top-{jump}" for jump in range(JUMPS))):
        scratch.drop(name)
    return roots


def _open(met: DataFrame, roots: DataFrame, count: int) -> DataFrame:
    """Members of the buckets that still hold more than one group, with their roots."""
    known = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = known.groupBy("bucket").agg(F.min("root").alias("p"), F.max("root").alias("q")).filter("p <> q").select("bucket")
    return spread_join(known, split, "bucket", "node", count).select("bucket", "node", "n", "root", "met")


def _by_difference(members: DataFrame, sets: DataFrame, scratch: Scratch, share: float) -> DataFrame:
    """Pairs (a, b) of members of one hub and of two groups that may be linked, from what sets them apart from the hub.

    Let X be x's symmetric difference with the hub, Y y's. Linked sets differ in q * (|x| + |y|) elements at most, where
    q = (1 - share) / (1 + share), and x and y differ in |X| + |Y| - 2 |X and Y| elements. So X and Y share at least
    t = (|X| + |Y| - q * (|x| + |y|)) / 2 elements; of those of X, in any common order, one is among the first |X| - t + 1, likewise
    for Y. In the order used, what a member has and the hub has not comes first. In a family of edited copies that is each copy's own,
    shared with none, and for members of about one size the prefix is no longer than that, so copies that are not linked do not meet.
    A pair of which both are linked with the hub is in one group already; of other pairs, t is at least 1. As t depends on both sizes,
    what the hub has and a member has not is only met under equal classes of both sizes, as far as the prefix for these reaches."""
    q = (1 - share) / (1 + share)
    apart = _with_sets(members, sets).select("hub", "node", "root", F.size("x").alias("n"), F.size("h").alias("m"), F.array_sort(F.array_except("x", "h")).alias("more"), F.array_sort(F.array_except("h", "x")).alias("less"))
    apart = apart.withColumn("own", F.size("more")).withColumn("size", F.col("own") + F.size("less")).filter("size > 0")
    apart = apart.withColumn("linked", F.col("size") <= q * (F.col("n") + F.col("m")) + 1e-6)

    def class_of(size: Column) -> Column:
        return F.floor(2 * F.log2(size) + 1e-9).cast("int")

    def keep(c: Column) -> Column:
        """The length of the prefix for members of a class of sizes."""
        lower, upper = F.floor(F.pow(F.lit(2.0), c / 2) + 1e-9), F.ceil(F.pow(F.lit(2.0), (c + 1) / 2))
        t = F.ceil((F.col("size") + lower - q * (F.col("n") + F.least(F.col("m") + upper, F.col("n") / share))) / 2 - 1e-6)
        return F.least(F.col("size") - F.greatest(t, F.lit(1)) + 1, F.col("size")).cast("int")

    def cells(part: str, length: Column, first: Column, own: Column, other: Column) -> Column:
        return F.transform(F.slice(part, 1, F.greatest(length, F.lit(0))), lambda e, i: F.struct(e.alias("e"), (i + 1 + first).alias("place"), own.alias("own_class"), other.alias("other_class")))

    most = q * (F.col("n") + F.col("n") / share)  # the most elements in which a linked set differs from one of n
    low, high, none = class_of(F.greatest(F.col("size") - most, F.lit(1.0))), class_of(F.col("size") + most), F.lit(-1)
    met = F.flatten(F.transform(F.sequence(low, high), lambda c: cells("less", keep(c) - F.col("own"), F.col("own"), class_of(F.col("size")), c)))
    met = F.concat(cells("more", keep(low), F.lit(0), none, none), met)
    each = apart.select("hub", "node", "root", "n", "size", "linked", F.explode(met).alias("c")).select("hub", "node", "root", "n", "size", "linked", "c.*")
    each = scratch.put("each", each)
    right = each.select("hub", "e", F.col("own_class").alias("other_class"), F.col("other_class").alias("own_class"), F.col("node").alias("y"), F.col("root").alias("other"), F.col("n").alias("m"), F.col("size").alias("other_size"), F.col("place").alias("other_place"))
    t = F.greatest(F.ceil((F.col("size") + F.col("other_size") - q * (F.col("n") + F.col("m"))) / 2 - 1e-6), F.lit(1))
    both = each.filter("not linked").join(right, ["hub", "e", "own_class", "other_class"])
    both = both.filter((F.col("node") != F.col("y")) & (F.col("root") != F.col("other")) & (F.col("place") <= F.col("size") - t + 1) & (F.col("other_place") <= F.col("other_size") - t + 1))
    return both.select(F.least("node", "y").alias("a"), F.greatest("node", "y").alias("b")).distinct()


def _named_sets(batches: Iterator, width: int) -> Iterator:
    import hashlib

    import pyarrow as pa

    for got in _sets(batches, width):
        at, raw = got.column(1).offsets.to_numpy(), got.column(1).values.to_numpy()
        names = [hashlib.blake2b(raw[at[i] : at[i + 1]].tobytes(), digest_size=16).digest() for i in range(len(got))]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), got.column(1)], ["node", "elements"])


def _with_class(batches: Iterator, place: int, width: int, name: str) -> Iterator:
    """The rows as they are, and the name of each one's class."""
    import pyarrow as pa

    for batch in batches:
        pair = pa.RecordBatch.from_arrays([batch.column(place), batch.column(place)], ["id", "text"])
        nodes = [got.column(0) for got in _named_sets([pair], width)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.concat_arrays(nodes) if nodes else pa.array([], pa.binary())], [*batch.schema.names, name])


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, width: int = WIDTH) -> DataFrame:
    """The rows of docs without all but one of each group: a row of the least id stays, null the last. A row without shingles is a
    group of its own. Ids may be null or repeat: rows then are told apart by id and class."""
    profiles, found = _classes(docs, key, text, percent, width)
    scratch, id_, node, own = Scratch(docs.sparkSession, "kept"), fresh(docs, "kept_id"), fresh(docs, "kept_class"), fresh(docs, "class")
    if _ids_name_rows(profiles):
        gone = scratch.put("gone", found.filter("id <> component_id").select(F.col("id").alias(id_)))
        return docs.join(small(gone), F.col(key) == F.col(id_), "left_anti")
    least = found.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("x"))
    kept = scratch.put("kept", least.select(F.col("x.id").alias(id_), F.col("x.node").alias(node)))
    worded, place = F.coalesce(F.col(text).rlike(WORD), F.lit(False)), docs.columns.index(text)
    classed = docs.filter(worded).mapInArrow(lean(lambda b: _with_class(b, place, width, own)), StructType([*docs.schema.fields, StructField(own, BinaryType())]))
    one = classed.join(kept, (F.col(own) == F.col(node)) & F.col(key).eqNullSafe(F.col(id_)), "left_semi").dropDuplicates([own])
    return docs.filter(~worded).union(one.drop(own))
