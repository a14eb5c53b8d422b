"""What the operators share: the shared scratch folder, and words and code points of Arrow text columns as numpy arrays."""

from __future__ import annotations

import atexit
import hashlib
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as a character class: space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that the numpy code works on at a time; a longer text is a piece of its own.
PIECE_BYTES = 1 << 18


class Scratch:
    """Tables in the folder that all executors share, one folder for each call of an operator.

    A table written here cuts the lineage as a checkpoint does, but is compressed and columnar. ``drop`` deletes one that is no
    longer read, what remains goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{checkpoint_dir(spark)}/lumenfold-{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(name))
        return self.spark.read.schema(df.schema).parquet(self._path(name))

    def drop(self, name: str = "") -> None:
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the JVM has ended
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; only a local session without one gets a folder here."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints"


def release() -> None:
    """Gives freed memory back to the system, which allocators else keep for a process that may live long."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(work):
    """A function over batches that leaves no freed memory behind in a worker, which other stages' tasks then use."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            release()

    return run


#: Rows of one key that a task joins, about; rows of a table that may be sent to all tasks.
SPREAD, BROADCAST_ROWS = 4096, 200_000


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked to be sent to all tasks if it has few rows; its rows must be narrow, and reading it twice cheap."""
    return F.broadcast(df) if df.count() <= limit else df


def salt(by: str | Column, rows: int | Column) -> Column:
    """The share of its key that a row belongs to, where one key may hold all ``rows``."""
    return F.pmod(F.xxhash64(by), F.lit(1) + F.floor((F.lit(rows) if isinstance(rows, int) else rows) / SPREAD))


def spread_join(rows: DataFrame, few: DataFrame, on: str, by: str, count: int) -> DataFrame:
    """rows joined with few, which has one row for each value of ``on``; one value may hold all ``count`` rows.

    Rows of a value are dealt out by a hash of ``by``, and few's row goes to those shares that the value has."""
    if count <= SPREAD:
        return rows.join(few, on)
    name = fresh(rows, "share")
    dealt = rows.withColumn(name, salt(by, count))
    return dealt.join(dealt.select(on, name).distinct().join(few, on), [on, name]).drop(name)


def crc_of_id(key: str | Column = "doc_id") -> Column:
    """crc32 of an id as text; null for a null id."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"))


def text_arrays(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An Arrow string column as (bytes, offsets from 0, valid); null texts have no bytes."""
    import pyarrow as pa

    column = column.cast(pa.large_string()).combine_chunks() if isinstance(column, pa.ChunkedArray) else column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    valid = np.asarray(column.is_valid())
    return raw, offsets - offsets[0], valid


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES):
    """Runs (first, end) of texts of about limit bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, end
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Longer words are hashed one by one.
_LONG = 64


def word_spans(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text number) of all words; no word spans two texts."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~space[raw]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    heads, tails = offsets[full], offsets[full + 1] - 1
    begins[heads], ends[tails] = solid[heads], solid[tails]
    at = np.flatnonzero(begins)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(offsets, at, side="right") - 1


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the word stands."""
    size = end - begin
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    live, short = np.flatnonzero((size > 0) & (size <= _LONG)), size <= _LONG
    j = 0
    while len(live):
        h = (out[live] ^ raw[begin[live] + j]) * np.uint64(0x9FB21C651E98DF25)
        out[live] = h ^ (h >> np.uint64(29))
        j += 1
        live = live[size[live] > j]
    for i in np.flatnonzero(~short):
        out[i] = int.from_bytes(hashlib.blake2b(raw[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(out)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's word shingles after lower-casing A-Z: (hashes, offsets).

    A text of 1 to width-1 words has its whole sequence as its one shingle, one without words has none."""
    raw = _FOLD[raw]
    begin, end, text = word_spans(raw, offsets)
    words = word_hashes(raw, begin, end)
    n = len(offsets) - 1
    counts = np.bincount(text, minlength=n) if len(text) else np.zeros(n, np.int64)
    firsts = np.concatenate(([0], np.cumsum(counts)))
    m = max(0, len(words) - width + 1)
    rolled = np.full(m, width, np.uint64)
    for k in range(width):
        rolled = mix(rolled * np.uint64(0xD6E8FEB86659FD93) + words[k : k + m])
    out, sizes = [], np.zeros(n, np.int64)
    for i in range(n):
        c, a = int(counts[i]), int(firsts[i])
        if c >= width:
            got = np.sort(rolled[a : a + c - width + 1])
            if len(got) > 1:
                got = got[np.concatenate(([True], got[1:] != got[:-1]))]
        elif c:
            h = np.full(1, c, np.uint64)
            for k in range(c):
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[a + k])
            got = h
        else:
            continue
        out.append(got)
        sizes[i] = len(got)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))
