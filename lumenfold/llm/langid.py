"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are runs of one to three letters, with a blank at each end of a word, hashed to ``DIM`` buckets; their weight in a text is
(1 + ln count) * idf, scaled to length 1. Document frequencies are counted over all rows that may be learned from. The weights are
trained by follow-the-regularised-leader with an L1 and an L2 penalty on at most ``sample`` of those rows, the first by a hash of
their id; a fifth of the sample is held back to fit the temperature that divides the scores before the softmax.

Defined results. Null text, or one without a letter: ``und``, score 0. No row to learn from: all texts are ``und``. One language only:
that one, score 1. Null ids are never learned from. Repeated rows: equal values. Whole texts are read. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import crc_of_id, lean

DIM_BITS, SAMPLE = 15, 4000
DIM = 1 << DIM_BITS
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter, or 0."""
    if not _LETTERS:
        _LETTERS.append(np.array([ord(x.lower()[0]) if (x := chr(c)).isalpha() else 0 for c in range(1 << 16)], np.uint32))
    return _LETTERS[0]


def ngrams(text: str) -> np.ndarray:
    """The buckets of all n-grams of a text; none if it has no letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    wide = codes >= 1 << 16
    if wide.any():
        astral = np.array([c if chr(c).isalpha() else 0 for c in codes[wide].tolist()], np.uint32)
        codes = _letters()[np.where(wide, 0, codes)]
        codes[wide] = astral
    else:
        codes = _letters()[codes]
    full = codes > 0
    if not full.any():
        return np.zeros(0, np.int64)
    keep = full.copy()
    keep[1:] |= full[:-1]
    c = np.concatenate((np.zeros(1, np.uint32), codes[keep], np.zeros(1, np.uint32)))
    shift = np.uint32(32 - DIM_BITS)
    one = (c * np.uint32(0x9E3779B1)) ^ np.uint32(0x85EBCA6B)
    two = one[:-1] * np.uint32(0x27D4EB2F) + c[1:] * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * np.uint32(0x165667B1) + c[2:] * np.uint32(0x9E3779B1)
    solid = c > 0
    parts = [one[solid], two[solid[:-1] | solid[1:]], three[solid[1:-1]]]
    h = np.concatenate(parts)
    h ^= h >> np.uint32(16)
    return ((h * np.uint32(0x7FEB352D)) >> shift).astype(np.int64)


def _weights(buckets: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of a text: its TF-IDF vector of length 1."""
    counts = np.bincount(buckets, minlength=DIM)
    at = np.flatnonzero(counts)
    value = (1.0 + np.log(counts[at])) * idf[at]
    return at, value / max(1e-12, float(np.sqrt(value @ value)))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not len(buckets := ngrams(text)):
            return "und", 0.0
        at, value = _weights(buckets, self.idf)
        scores = (value @ self.weights[at] + self.bias) / self.temperature
        shares = np.exp(scores - scores.max())
        best = int(shares.argmax())
        return self.languages[best], float(shares[best] / shares.sum())


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 4, batch: int = 32, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias): per-coordinate follow-the-regularised-leader over batches of sparse rows."""
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))
    penalty = np.full((DIM + 1, 1), l1)
    penalty[DIM] = 0  # the bias

    def leader() -> np.ndarray:
        return np.where(np.abs(z) <= penalty, 0.0, (np.sign(z) * penalty - z) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        shuffled = order.permutation(len(rows))
        for first in range(0, len(rows), batch):
            chosen = shuffled[first : first + batch]
            sizes = np.array([len(rows[i][0]) + 1 for i in chosen])
            at = np.concatenate([np.append(rows[i][0], DIM) for i in chosen])
            value = np.concatenate([np.append(rows[i][1], 1.0) for i in chosen])
            weights = leader()
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            scores = np.add.reduceat(weights[at] * value[:, None], starts)
            shares = np.exp(scores - scores.max(axis=1, keepdims=True))
            shares /= shares.sum(axis=1, keepdims=True)
            shares[np.arange(len(chosen)), labels[chosen]] -= 1.0
            steps = np.repeat(shares, sizes, axis=0) * value[:, None]
            gradient = np.stack([np.bincount(at, steps[:, c], DIM + 1) for c in range(classes)], axis=1)
            sigma = (np.sqrt(n + gradient**2) - np.sqrt(n)) / alpha
            z += gradient - sigma * weights
            n += gradient**2
    weights = leader()
    return weights[:DIM], weights[DIM]


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0
    unsure = 1.0 / (len(labels) + 2)  # no finite sample shows that there are no errors

    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        s = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        return float(-(1 - unsure) * s[np.arange(len(s)), labels].mean() - unsure * s.mean())

    low, high, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, learnable: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the rows of docs that ``learnable`` marks and whose text and language are not null."""
    import pyarrow as pa

    rows = docs.filter(learnable & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))

    def frequencies(batches: Iterator) -> Iterator:
        total, rows = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for x in batch.column(0):
                seen = np.zeros(DIM, bool)
                seen[ngrams(x.as_py())] = True
                total += seen
                rows += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, DIM).astype(np.int32)), pa.array(np.append(total[at], rows))], ["bucket", "n"])

    df = np.zeros(DIM + 1, np.int64)
    for bucket, n in rows.select("text").mapInArrow(lean(frequencies), "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():  # DIM + 1 rows at most
        df[bucket] = n
    idf = np.log((1.0 + df[DIM]) / (1.0 + df[:DIM])) + 1.0
    ids = rows.select("key", F.crc32(F.concat(F.col("key").cast("string"), F.lit("|sample"))).alias("draw")).distinct().orderBy("draw", "key").limit(sample).select("key")
    drawn = rows.join(F.broadcast(ids), "key")  # at most `sample` ids

    def vectors(batches: Iterator) -> Iterator:
        for batch in batches:
            got = [np.bincount(ngrams(x.as_py()), minlength=DIM) for x in batch.column(1)]
            at = [np.flatnonzero(c) for c in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()), pa.array([c[a].astype(np.uint32).tobytes() for c, a in zip(got, at, strict=True)], pa.binary())], ["key", "lang", "at", "n"])

    kind = docs.schema[key].dataType.simpleString()
    # ids that repeat bring more rows: the first `sample` of them
    first = drawn.mapInArrow(lean(vectors), f"key {kind}, lang string, at binary, n binary").orderBy(F.col("key").cast("string"), "at", "n", "lang").limit(sample)
    got = first.toArrow().to_pydict()
    order = range(len(got["key"]))
    languages = sorted({got["lang"][i] for i in order})
    if not languages:
        return Model([], idf, np.zeros((DIM, 0)), np.zeros(0), 1.0)
    vectors_, labels = [], []
    for i in order:
        at, n = np.frombuffer(got["at"][i], np.uint16).astype(np.int64), np.frombuffer(got["n"][i], np.uint32)
        if len(at):
            value = (1.0 + np.log(n)) * idf[at]
            vectors_.append((at, value / np.sqrt(value @ value)))
            labels.append(languages.index(got["lang"][i]))
    labels = np.array(labels, np.int64)
    held = np.arange(len(labels)) % 5 == 4
    fit = np.flatnonzero(~held)
    weights, bias = ftrl([vectors_[i] for i in fit], labels[fit], len(languages)) if len(fit) else (np.zeros((DIM, len(languages))), np.zeros(len(languages)))
    scores = np.array([vectors_[i][1] @ weights[vectors_[i][0]] + bias for i in np.flatnonzero(held)]).reshape(-1, len(languages))
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32), bias.astype(np.float32), temperature(scores, labels[held]))


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for each row."""
    import pyarrow as pa

    kind = docs.schema[key].dataType.simpleString()

    def predicted(batches: Iterator) -> Iterator:
        for batch in batches:
            got = [model.predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], ["key", "lang_pred", "score"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(lean(predicted), f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def identify_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, sample: int = SAMPLE) -> DataFrame:
    """(key, held_out, lang_pred, score): learned from the rows whose crc32 of the id is not 0 modulo ``folds``, predicted for all."""
    held = F.coalesce(crc_of_id(key) % folds == 0, F.lit(True))
    model = train(docs, ~held, key, text, lang, sample)
    return predict(docs, model, key, text).select(key, held.alias("held_out"), "lang_pred", "score")
