"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is the logistic of a fixed bias and the weights of its words and their beginnings; a document's is the
noisy-or of its sentences, 1 - prod(1 - p). The bias keeps thousands of clean sentences below the threshold. Weights are trained from
document labels by adaptive gradient steps with an L1 penalty on at most ``sample`` rows of either label, the first by a hash of
their id, weighted back to the labels' own shares. A word or beginning counts if it occurs in ``WORDS_IN`` sampled texts at least, and
in toxic ones by ``EXCESS`` standard deviations more than chance; words that speak for a clean text are not learned, as a clean
sentence takes nothing away in a noisy-or. Equal texts are learned from once. The driver gets counts of the ``DIM`` features and
where those that count stand, no texts. The trained sentence scores then locate offending sentences: those at or above the threshold
in texts at or above it, the highest one if there is none.

A word is a run of ASCII letters in lower case and of bytes outside ASCII; a sentence ends at a full stop, an exclamation or question
mark or a line break. Defined results. Null text, or one without words: the score of one empty sentence. No labels: all scores are
0. One label only: scores follow the bias. Ids with several labels: toxic if any says so. Null ids and labels are not learned from.
Repeated rows: equal values. Whole texts are read. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import _FOLD, Scratch, crc_of_id, lean, pieces, release, text_arrays, word_hashes, word_spans

DIM_BITS, SAMPLE, THRESHOLD, WORDS_IN, EXCESS, BIAS = 18, 4000, 0.3, 8, 5.0, -8.0
#: Lengths in bytes of the words' beginnings that are features besides the words.
PREFIXES = (4, 5, 6, 7)
DIM = 1 << DIM_BITS
_GAP = np.ones(256, bool)
_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 46, 63]] = True


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, sentence, the sentences' texts): the features of texts; sentences are numbered over all texts."""
    if not len(raw):
        return (np.zeros(0, np.int64),) * 3
    raw = _FOLD[raw]
    begin, end, text = word_spans(raw, offsets, _GAP)
    if not len(begin):
        return (np.zeros(0, np.int64),) * 3
    stops = np.cumsum(_STOP[raw], dtype=np.int64)[begin]
    new = np.ones(len(begin), bool)
    new[1:] = (stops[1:] != stops[:-1]) | (text[1:] != text[:-1])
    sentence = np.cumsum(new, dtype=np.int32) - 1
    buckets, owners = [_bucket(word_hashes(raw, begin, end))], [sentence]
    for k in PREFIXES:
        long = np.flatnonzero(end - begin > k)
        buckets.append(_bucket(word_hashes(raw, begin[long], begin[long] + k) ^ np.uint64(k << 56)))
        owners.append(sentence[long])
    return np.concatenate(buckets), np.concatenate(owners), text[new]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DIM_BITS)).astype(np.int32)


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    trained: bool = True

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The score of each text."""
        n = len(offsets) - 1
        if not self.trained:
            return np.zeros(n)
        bucket, sentence, owner = words(raw, offsets)
        quiet = np.full(n, _softplus(np.float64(self.bias)))
        if len(owner):
            x = self.bias + np.bincount(sentence, self.weights[bucket], len(owner))
            quiet = np.where(np.bincount(owner, minlength=n) > 0, np.bincount(owner, _softplus(x), n), quiet)
        return -np.expm1(-quiet)

    def offending(self, raw: np.ndarray, least: float = THRESHOLD) -> list[tuple[int, int, float]]:
        """(begin, end, score) in bytes of a text's sentences that score at least that much, or of the highest one."""
        bucket, sentence, owner = words(raw, np.array([0, len(raw)]))
        if not self.trained or not len(owner):
            return []
        score = -np.expm1(-_softplus(self.bias + np.bincount(sentence, self.weights[bucket], len(owner))))
        chosen = np.flatnonzero(score >= least)
        chosen = chosen if len(chosen) else [int(score.argmax())]
        stops = np.flatnonzero(_STOP[raw])
        # a sentence with words lies between two stops, of which it includes the second
        begin, _, _ = word_spans(raw, np.array([0, len(raw)]), _GAP)
        before = np.unique(np.searchsorted(stops, begin))[chosen]
        return [(int(stops[k - 1]) + 1 if k else 0, int(stops[k]) + 1 if k < len(stops) else len(raw), float(score[i])) for i, k in zip(chosen, before, strict=True)]

    def locate(self, text: str, least: float = THRESHOLD) -> list[tuple[int, int, float]]:
        """(begin, end, score) in code points of the sentences that score at least that much."""
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        return [(int(points[a]), int(points[b]), x) for a, b, x in self.offending(raw, least) if x >= least]


def fit(docs: list[tuple[np.ndarray, np.ndarray, int]], labels: np.ndarray, share: float, epochs: int = 12, batch: int = 64, rate: float = 0.3, l1: float = 2e-3, bias: float = BIAS, seed: int = 7) -> Model:
    """Weights from texts labelled 0 or 1, where ``share`` of all such rows have label 1. docs: (bucket, sentence, number of sentences)
    of each text, with the features that count only."""
    if not len(labels):
        return Model(np.zeros(DIM, np.float32), 0.0, False)
    positive = float(labels.mean())
    scale = np.where(labels == 1, share / max(positive, 1e-9), (1 - share) / max(1 - positive, 1e-9))
    weights, squares = np.zeros(DIM), np.full(DIM, 1e-8)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        shuffled = order.permutation(len(docs))
        for first in range(0, len(docs), batch):
            chosen = [i for i in shuffled[first : first + batch] if docs[i][2]]
            if not chosen:
                continue
            bucket = np.concatenate([docs[i][0] for i in chosen])
            tops = np.cumsum([0, *(docs[i][2] for i in chosen)])
            sentence = np.concatenate([docs[i][1] + t for i, t in zip(chosen, tops[:-1], strict=True)])
            owner = np.repeat(np.arange(len(chosen)), np.diff(tops))
            x = bias + np.bincount(sentence, weights[bucket], tops[-1])
            quiet = np.bincount(owner, _softplus(x), len(chosen))
            p = 1.0 / (1.0 + np.exp(-x))
            # the loss of a label 1 is -log(1 - exp(-quiet)), of a label 0 quiet
            slope = np.where(labels[chosen] == 1, -1.0 / np.maximum(np.expm1(quiet), 1e-6), 1.0) * scale[chosen] / len(chosen)
            g = slope[owner] * p
            steps = np.bincount(bucket, g[sentence], DIM)
            at = np.flatnonzero(steps)
            squares[at] += steps[at] ** 2
            pace = rate / np.sqrt(squares[at])
            moved = weights[at] - pace * steps[at]
            weights[at] = np.sign(moved) * np.maximum(np.abs(moved) - pace * l1 / np.sqrt(len(docs)), 0.0)
    return Model(weights.astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", learnable: Column | None = None, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows of docs; learnable: a condition on ``key``. At most 2 * ``sample`` different texts are learned
    from, also if ids repeat."""
    import pyarrow as pa

    scratch = Scratch(docs.sparkSession, "toxicity")
    marked = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    marked = (marked if learnable is None else marked.filter(learnable)).groupBy(F.col(key).alias("key")).agg(F.max(F.when(F.col(label) >= 1, 1).otherwise(0)).alias("label"))
    draw = F.crc32(F.concat(F.col("key").cast("string"), F.lit("|sample")))
    ids = None
    for value in (0, 1):
        part = marked.filter(F.col("label") == value).orderBy(draw, "key").limit(sample)
        ids = part if ids is None else ids.union(part)
    count = dict(marked.groupBy("label").agg(F.count("*")).collect())  # two rows
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null").join(F.broadcast(ids), "key")  # 2 * sample ids at most
    rows = scratch.put("drawn", rows.groupBy("text").agg(F.max("label").alias("label"), F.min(draw).alias("draw")).withColumn("hash", F.md5(F.encode("text", "UTF-8"))))
    if rows.count() > 2 * sample:  # ids that repeat bring more texts
        rows = rows.join(F.broadcast(rows.select("hash", "draw").orderBy("draw", "hash").limit(2 * sample).select("hash")), "hash", "left_semi")

    def counted(batches: Iterator) -> Iterator:
        seen, toxic, texts = np.zeros(DIM, np.int64), np.zeros(DIM, np.int64), [0, 0]
        for batch in batches:
            raw, offsets, _ = text_arrays(batch.column(0))
            for k, is_toxic in enumerate(batch.column(1).to_pylist()):
                own = np.unique(words(raw[offsets[k] : offsets[k + 1]], offsets[k : k + 2] - offsets[k])[0])
                seen[own] += 1
                toxic[own] += is_toxic
                texts[is_toxic] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [DIM, DIM + 1]).astype(np.int32)), pa.array(np.append(seen[at], texts)), pa.array(np.append(toxic[at], [0, 0]))], ["bucket", "seen", "toxic"])

    seen, toxic = np.zeros(DIM + 2), np.zeros(DIM + 2)
    sums = rows.select("text", "label").mapInArrow(lean(counted), "bucket int, seen long, toxic long").groupBy("bucket").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic"))
    for bucket, n, m in zip(*(c.to_numpy() for c in sums.toArrow().columns), strict=True):  # DIM + 2 rows at most
        seen[bucket], toxic[bucket] = n, m
    positive = seen[DIM + 1] / max(1.0, seen[DIM] + seen[DIM + 1])
    seen, toxic = seen[:DIM], toxic[:DIM]
    usable = (seen >= WORDS_IN) & (toxic - seen * positive >= EXCESS * np.sqrt(np.maximum(seen * positive * (1 - positive), 1e-9)))

    def places(batches: Iterator) -> Iterator:
        for batch in batches:
            raw, offsets, _ = text_arrays(batch.column(0))
            found = []
            for k in range(batch.num_rows):
                bucket, sentence, owner = words(raw[offsets[k] : offsets[k + 1]], offsets[k : k + 2] - offsets[k])
                counts = usable[bucket]
                found.append((bucket[counts].astype(np.int32).tobytes(), sentence[counts].astype(np.int32).tobytes(), len(owner)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array([x[i] for x in found], t) for i, t in enumerate((pa.binary(), pa.binary(), pa.int64())))], ["label", "draw", "hash", "bucket", "sentence", "sentences"])

    got = rows.select("text", "label", "draw", "hash").mapInArrow(lean(places), "label int, draw long, hash string, bucket binary, sentence binary, sentences long").toArrow().to_pylist()
    got.sort(key=lambda r: (r["draw"], r["hash"]))
    share = count.get(1, 0) / max(1, count.get(0, 0) + count.get(1, 0))
    features = [(np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["sentence"], np.int32).astype(np.int64), r["sentences"]) for r in got]
    model = fit(features, np.array([r["label"] for r in got], np.int64), share)
    scratch.drop()
    release()
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for each row."""
    import pyarrow as pa

    kind = docs.schema[key].dataType.simpleString()

    def scored(batches: Iterator) -> Iterator:
        for batch in batches:
            raw, offsets, _ = text_arrays(batch.column(1))
            got = [model.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in pieces(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(got) if got else np.zeros(0))], ["key", "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(lean(scored), f"key {kind}, score double").withColumnRenamed("key", key)


def locate(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = THRESHOLD) -> DataFrame:
    """(key, begin, end, score, sentence): the offending sentences of each row."""
    import pyarrow as pa

    kind = docs.schema[key].dataType.simpleString()

    def located(batches: Iterator) -> Iterator:
        for batch in batches:
            for k in range(batch.num_rows):
                t = batch.column(1)[k].as_py()
                if t and (got := model.locate(t, least)):
                    a, b, s = zip(*got, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k] * len(got))), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(s, pa.float64()), pa.array([t[x:y] for x, y in zip(a, b, strict=True)], pa.string())], ["key", "begin", "end", "score", "sentence"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(lean(located), f"key {kind}, begin int, end int, score double, sentence string").withColumnRenamed("key", key)


def _held_out(key: str, folds: int, fold: int) -> Column:
    return F.coalesce(crc_of_id(key) % folds == fold, F.lit(True))


def assess(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, score, offending) for each row: offending is an array of (begin, end, score) of sentences, in code points."""
    import pyarrow as pa

    kind = docs.schema[key].dataType.simpleString()
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def assessed(batches: Iterator) -> Iterator:
        for batch in batches:
            raw, offsets, _ = text_arrays(batch.column(1))
            for a, b in pieces(offsets):
                scores = model.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                spans = [[] for _ in range(a, b)]
                for k in np.flatnonzero(scores >= threshold):
                    own = raw[offsets[a + k] : offsets[a + k + 1]]
                    points = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
                    spans[k] = [{"begin": int(points[x]), "end": int(points[y]), "score": z} for x, y, z in model.offending(own, threshold)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(scores), pa.array(spans, pa.list_(span))], ["key", "score", "offending"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(lean(assessed), f"key {kind}, score double, offending array<struct<begin:int,end:int,score:double>>").withColumnRenamed("key", key)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 4, fold: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted, offending): learned from the labels of the rows outside the fold, given for all."""
    held = _held_out(key, folds, fold)
    model = train(docs, labels, key, text, learnable=~held)
    return assess(docs, model, key, text, threshold).select(key, held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "offending")


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold, scored where they lie, without a join."""
    import pyarrow as pa

    model = train(docs, labels, key, text, learnable=~_held_out(key, 4, 2))
    place = docs.columns.index(text)

    def kept(batches: Iterator) -> Iterator:
        for batch in batches:
            raw, offsets, _ = text_arrays(batch.column(place))
            got = [model.scores(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in pieces(offsets)]
            yield batch.filter(pa.array((np.concatenate(got) if got else np.zeros(0)) < threshold))

    return docs.mapInArrow(lean(kept), docs.schema)
