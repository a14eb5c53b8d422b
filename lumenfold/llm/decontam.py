"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as lower-case letters and digits with single spaces between. An item of m characters may occur with up
to k = floor(rate * m) edits. Cut into k + 1 pieces, it then has a piece that occurs without any, so an Aho-Corasick automaton of all
pieces finds where items may be; hits on near diagonals make one window, and Myers' bit-parallel algorithm gives the least distance
of the item to any part of the window. Nothing is sampled: every text is read whole, every hit is verified.

The items are a stated query set: they are read in blocks of ``block`` characters of pieces, one after the other. Each block's
automaton goes to the tasks with the code and passes over the texts once; what it finds (or leaves) is written before the next block
is read, so neither the driver nor a task holds more than one block. A benchmark of one block needs no table in between.

Defined results. Null or blank texts match nothing; blank items are not looked for. An item too short to bear an edit must occur
exactly, as whole words. Repeated texts and items: each row has its own matches. Null keys stay null keys. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import Scratch, lean

RATE, BLOCK = 0.08, 4_000_000
_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter or digit, or a space."""
    if not _TABLE:
        _TABLE.append(np.array([ord(x.lower()[0]) if (x := chr(c)).isalnum() else 32 for c in range(1 << 16)], np.uint32))
    return _TABLE[0]


def normal(text: str) -> str:
    """Lower-case letters and digits, single spaces between and around."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    wide = codes >= 1 << 16
    codes = np.where(wide, codes, _table()[np.where(wide, 0, codes)]) if wide.any() else _table()[codes]
    blank = codes == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return f" {codes[keep].tobytes().decode('utf-32-le').strip()} "


class Item:
    """An item's pattern, edit budget and pieces."""

    def __init__(self, text: str, rate: float):
        self.pattern = normal(text).strip()
        self.size = len(self.pattern)
        self.budget = int(rate * self.size)
        if self.budget:
            edges = [self.size * i // (self.budget + 1) for i in range(self.budget + 2)]
            self.pieces = [(self.pattern[a:b], a) for a, b in zip(edges, edges[1:], strict=False)]
        else:
            self.pieces = [(f" {self.pattern} ", -1)]
        self.bits: dict[str, int] = {}
        for i, c in enumerate(self.pattern):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def nearest(self, window: str) -> tuple[int, int]:
        """(distance, end) of the part of window that is nearest to the pattern, the first of equals."""
        at = window.find(self.pattern)
        if at >= 0:
            return 0, at + self.size
        return myers(self.bits, self.size, window)


def myers(bits: dict[str, int], size: int, window: str) -> tuple[int, int]:
    """(least distance, end of the first part with it) of a pattern of that size, given as positions of each character."""
    mask, top = (1 << size) - 1, 1 << size - 1
    up, down, score = mask, 0, size
    best, end = size, 0
    for at, c in enumerate(window, 1):
        equal = bits.get(c, 0)
        vertical = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(diagonal | up) & mask, up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            if score < best:
                best, end = score, at
        rise, fall = rise << 1 & mask, fall << 1 & mask
        up, down = fall | ~(vertical | rise) & mask, rise & vertical
    return best, end


class Matcher:
    """An automaton over the pieces of items, and the search of a text for them."""

    def __init__(self, items: list[tuple[object, str]], rate: float = RATE):
        import ahocorasick

        self.keys, self.items = [k for k, _ in items], [Item(t, rate) for _, t in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(self.items):
            for piece, at in item.pieces if item.size else ():
                places.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, begin, end) of each item within its budget: its nearest place in the normal form, the first of equals."""
        text, hits, found = normal(text), {}, []
        if not len(self.automaton):
            return found
        for end, (size, where) in self.automaton.iter(text):
            for i, at in where:
                hits.setdefault(i, set()).add(end + 1 - size - at)
        for i in sorted(hits):
            item = self.items[i]
            if not item.budget:
                at = min(hits[i])
                found.append((i, 0, at - 1, at - 1 + item.size))
                continue
            best, run = None, []
            for place in [*sorted(hits[i]), None]:
                if run and (place is None or place - run[-1] > 2 * item.budget):
                    low = max(0, run[0] - item.budget)
                    distance, stop = item.nearest(text[low : run[-1] + item.size + item.budget])
                    if distance <= item.budget and (best is None or distance < best[0]):
                        best = distance, low + stop
                    run = []
                    if best and not best[0]:
                        break
                run.append(place)
            if best:
                distance, stop = best
                low = max(0, stop - item.size - distance)
                back = {c: int(f"{b:0{item.size}b}"[::-1], 2) for c, b in item.bits.items()}
                begin = stop - myers(back, item.size, text[low:stop][::-1])[1] if distance else stop - item.size
                found.append((i, distance, begin - 1, stop - 1))
        return found


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", rate: float = RATE, block: int = BLOCK) -> DataFrame:
    """(key, item_key, distance, begin, end, budget): a row for each text and item that it holds within the item's budget.

    begin and end are places in the text's normal form."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"key {kind}, item {item_kind}, distance int, begin int, end int, budget int"
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
    scratch, written, waiting = Scratch(spark, "leaks"), [], None
    search = lambda part: texts.mapInArrow(_searched(part, rate, docs.schema[key].dataType, items.schema[item_key].dataType), schema)
    for part in _blocks(items.select(F.col(item_key), F.col(item_text)), block):
        if waiting is not None:
            written.append(scratch.put(f"block-{len(written)}", search(waiting)))
        waiting = part
    out = spark.createDataFrame([], schema) if waiting is None else search(waiting)
    for found in written:
        out = out.union(found)
    return out.withColumnsRenamed({"key": key, "item": item_key})


def _blocks(items: DataFrame, block: int) -> Iterator[list[tuple[object, str]]]:
    part, size = [], 0
    for k, t in items.toLocalIterator():
        if t is None:
            continue
        part.append((k, t))
        size += len(t)
        if size >= block:
            yield part
            part, size = [], 0
    if part:
        yield part


def _searched(part: list[tuple[object, str]], rate: float, kind, item_kind):
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(kind), to_arrow_type(item_kind)]

    def searched(batches: Iterator) -> Iterator:
        import pyarrow as pa

        matcher = Matcher(part, rate)
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                for i, distance, begin, end in matcher(batch.column(1)[k].as_py()):
                    rows.append((k, i, distance, begin, end, matcher.items[i].budget))
            if rows:
                at, which, *rest = zip(*rows, strict=True)
                keys = batch.column(0).take(pa.array(at)).cast(kinds[0])
                yield pa.RecordBatch.from_arrays([keys, pa.array([matcher.keys[i] for i in which], kinds[1]), *(pa.array(x, pa.int32()) for x in rest)], ["key", "item", "distance", "begin", "end", "budget"])

    return lean(searched)


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", rate: float = RATE, block: int = BLOCK) -> DataFrame:
    """The rows of docs that hold no item within its budget, judged where they lie, whatever their keys."""
    place, scratch, count, waiting = docs.columns.index(text), Scratch(docs.sparkSession, "clean"), 0, None
    for part in _blocks(items.select("item_id", "text"), block):
        if waiting is not None:
            docs = scratch.put(f"block-{count}", docs.mapInArrow(_clean(waiting, rate, place), docs.schema))
            if count:
                scratch.drop(f"block-{count - 1}")
            count += 1
        waiting = part
    return docs if waiting is None else docs.mapInArrow(_clean(waiting, rate, place), docs.schema)


def _clean(part: list[tuple[object, str]], rate: float, place: int):
    def clean(batches: Iterator) -> Iterator:
        import pyarrow as pa

        matcher = Matcher(part, rate)
        for batch in batches:
            texts = batch.column(place)
            yield batch.filter(pa.array([not (texts[k].is_valid and matcher(texts[k].as_py())) for k in range(batch.num_rows)], pa.bool_()))

    return lean(clean)
