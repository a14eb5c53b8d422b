"""Translation memory: entries by key, lookups in tiers, vectors, consistency, integrity and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumenfold.functions.text import collapse, edit_distance, memory_key

#: Languages that a detector takes for one another.
SIMILAR = ({"ms", "id"}, {"cs", "sk"}, {"hr", "sr", "bs"}, {"nb", "da", "no"})


def with_key(entries: DataFrame, composed: bool = True) -> DataFrame:
    """tm_key of (site, src, tgt, text, field, context)."""
    return entries.withColumn("tm_key", memory_key(F.col("site"), F.col("src"), F.col("tgt"), F.col("text"), F.col("field"), F.col("context"), composed))


def exact_lookup(requests: DataFrame, entries: DataFrame, denied: DataFrame | None = None, composed: bool = True) -> DataFrame:
    """Each request with tier and translation of the first key that is there: field and context, field, context, neither.

    requests: (request_id, site, src, tgt, text, field, context); entries: (tm_key, translation, model_id). An entry whose model is
    denied or whose translation is empty is no hit, and no further tier is tried."""
    empty = F.lit("")

    def key(field: Column, context: Column) -> Column:
        return memory_key(F.col("site"), F.col("src"), F.col("tgt"), F.col("text"), field, context, composed)

    field, context = F.coalesce("field", empty), F.coalesce("context", empty)
    tiers = F.array(key(field, context), F.when(context != "", key(field, empty)), F.when(field != "", key(empty, context)), key(empty, empty))
    asked = requests.select("request_id", F.posexplode(tiers).alias("tier", "tm_key")).filter("tm_key is not null")
    held = asked.join(entries.select("tm_key", "translation", "model_id"), "tm_key")
    first = held.groupBy("request_id").agg(F.min_by(F.struct("tier", "translation", "model_id"), "tier").alias("hit")).select("request_id", "hit.*")
    if denied is not None:
        first = first.join(denied.select("model_id"), "model_id", "left_anti")
    first = first.filter(F.trim("translation") != "").select("request_id", "tier", "translation")
    return requests.join(first, "request_id", "left").withColumn("source", F.when(F.col("tier").isNotNull(), "exact").otherwise("miss"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double")), F.lit(0.0), lambda s, v: s + v * v)


def cosine(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def semantic_search(queries: DataFrame, vectors: DataFrame, keys: tuple[str, ...], k: int = 10, threshold: float = 0.75, block: int = 2048) -> DataFrame:
    """(query_id, entry_id, similarity): the k entries of a query's keys with the highest 1 / (1 + squared distance), from the threshold on.

    queries: (query_id, keys…, embedding), a stated set; vectors: (entry_id, keys…, embedding), any number. Vectors stay where they
    lie: blocks of queries go to the tasks with the code, each task keeps its k best of a block, and only those are shuffled."""
    import numpy as np

    kind_q, kind_e = dict(queries.dtypes)["query_id"], dict(vectors.dtypes)["entry_id"]
    names = [*keys, "entry_id", "embedding"]
    out, part = None, []

    def best_of(asked: list):
        groups: dict[tuple, tuple[list, np.ndarray]] = {}
        for row in asked:
            groups.setdefault(tuple(row[1:-1]), ([], []))[0].append(row[0])
            groups[tuple(row[1:-1])][1].append(row[-1])
        groups = {g: (ids, np.array(v, np.float64)) for g, (ids, v) in groups.items()}

        def best(frames):
            import pandas as pd

            kept: dict = {}
            for frame in frames:
                for g, rows in frame.groupby(list(keys), dropna=False) if keys else [((), frame)]:
                    g = g if isinstance(g, tuple) else (g,)
                    if g not in groups:
                        continue
                    ids, q = groups[g]
                    v = np.array(rows["embedding"].tolist(), np.float64)
                    d = (q**2).sum(1)[:, None] + (v**2).sum(1)[None] - 2 * q @ v.T
                    s, entries = 1 / (1 + np.maximum(d, 0)), rows["entry_id"].to_numpy()
                    for i, query in enumerate(ids):
                        at = np.flatnonzero(s[i] >= threshold)
                        near = [*kept.get(query, ()), *zip((-s[i][at]).tolist(), entries[at].tolist(), strict=True)]
                        kept[query] = sorted(near)[:k]
            rows = [(query, e, -s) for query, near in kept.items() for s, e in near]
            yield pd.DataFrame(rows, columns=["query_id", "entry_id", "similarity"])

        return best

    def search(asked: list) -> DataFrame:
        return vectors.select(*names).mapInPandas(best_of(asked), f"query_id {kind_q}, entry_id {kind_e}, similarity double")

    for row in queries.select("query_id", *keys, "embedding").toLocalIterator():
        part.append(tuple(row))
        if len(part) == block:
            out, part = search(part) if out is None else out.union(search(part)), []
    if part or out is None:
        out = search(part) if out is None else out.union(search(part))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("similarity"), "entry_id"))
    return out.withColumn("rank", place).filter(F.col("rank") <= k)


def tiered_lookup(requests: DataFrame, entries: DataFrame, vectors: DataFrame, keys: tuple[str, ...], threshold: float = 0.8) -> DataFrame:
    """Exact hits, and for the rest the nearest vector: (request_id, source, confidence, translation, miss_reason).

    requests also have an embedding; vectors: (entry_id, keys…, embedding, translation)."""
    exact = exact_lookup(requests, entries)
    rest = exact.filter("source = 'miss'").select(F.col("request_id").alias("query_id"), *keys, "embedding")
    near = semantic_search(rest, vectors, keys, 1, threshold).join(vectors.select("entry_id", F.col("translation").alias("near")), "entry_id").select(F.col("query_id").alias("request_id"), "similarity", "near")
    out = exact.join(near, "request_id", "left")
    source = F.when(F.col("source") == "exact", "exact").when(F.col("near").isNotNull(), "semantic").otherwise("miss")
    return out.select("request_id", source.alias("source"), F.when(F.col("source") == "exact", 1.0).otherwise(F.coalesce("similarity", F.lit(0.0))).alias("confidence"), F.coalesce("translation", "near").alias("translation"), F.when(source == "miss", "no_entry").alias("miss_reason"))


def inconsistent(pairs: DataFrame, keys: tuple[str, ...] = (), least: int = 30, most: int = 500) -> DataFrame:
    """(keys…, source, n, first, second, distance): source texts of some length with more than one translation, a report of ``most``.

    Only the two least translations and a count are kept of each, so no group is gathered."""
    rows = pairs.filter(F.length("source") >= least).groupBy(*keys, "source", "translation").agg(F.lit(1).alias("one"))
    out = rows.groupBy(*keys, "source").agg(F.count("*").alias("n"), F.min("translation").alias("first")).filter("n > 1")
    second = rows.join(out, [*keys, "source"]).filter("translation > first").groupBy(*keys, "source", "n", "first").agg(F.min("translation").alias("second"))
    return second.withColumn("distance", edit_distance(F.col("first"), F.col("second"))).orderBy("source", *keys).limit(most)


def valid_entry(required: tuple[str, ...]) -> Column:
    """Every required field is a non-empty string."""
    out = F.lit(True)
    for name in required:
        out = out & (F.coalesce(F.trim(name), F.lit("")) != "")
    return out


def integrity(entries: DataFrame, required: tuple[str, ...], languages: tuple[str, ...]) -> DataFrame:
    """One row: total, missing fields, unknown languages, healthy, health percent."""
    known = F.col("tgt").isin(*languages)
    good = valid_entry(required) & known
    out = entries.agg(F.count("*").alias("total"), F.count_if(~valid_entry(required)).alias("incomplete"), F.count_if(~F.coalesce(known, F.lit(False))).alias("unknown_language"), F.count_if(F.coalesce(good, F.lit(False))).alias("healthy"))
    return out.withColumn("health", F.coalesce(F.try_divide(F.col("healthy") * 100.0, "total"), F.lit(100.0)))


def without_lineage(entries: DataFrame, fingerprints: DataFrame, models: DataFrame) -> DataFrame:
    """Entries of neither a denied configuration nor a denied model."""
    return entries.join(fingerprints.select("config_fingerprint"), "config_fingerprint", "left_anti").join(models.select("model_id"), "model_id", "left_anti")


def shared_paragraphs(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, ratio): the share of a document's paragraphs that another document has too.

    Paragraph hashes are counted over distinct documents, and joined back by hash: a common paragraph is one row in the counts."""
    from lumenfold.functions.text import paragraph_hashes

    each = docs.select(key, F.explode(F.array_distinct(paragraph_hashes(text))).alias("h"))
    common = each.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h", F.lit(1).alias("shared"))
    out = each.join(common, "h", "left").groupBy(key).agg(F.avg(F.coalesce("shared", F.lit(0)).cast("double")).alias("ratio"))
    return docs.select(key).join(out, key, "left").fillna({"ratio": 0.0})


def similar_languages(a: Column, b: Column) -> Column:
    """Equal, or of one group."""
    out = a == b
    for group in SIMILAR:
        out = out | (a.isin(*group) & b.isin(*group))
    return out


def normal_text(text: Column) -> Column:
    return collapse(text)
