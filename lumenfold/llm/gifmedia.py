"""GIF columns: encode samples, decode LZW code streams, compose frames by palette, disposal and transparency.

``decode`` reads any GIF87a or GIF89a: global and local palettes, interlacing, transparency, the four disposal methods, delays and
loop count. A code stream is cut at its clear codes; between two of them a code's width follows from how many codes came before it,
so all codes of a stretch are read at once; a code's string is an earlier one and the byte that followed it.

``encode`` stores bytes as grey 8-bit samples, 64 to a line, lossless, in dictionary codes, a frame for each 65,535 lines at most.

Defined results. Null text: an empty payload, padded to 64 bytes. Bytes that are not a GIF, or break off: what was complete before is
kept, ``error`` says what broke. Null bytes: no frames, error 'null'. Equal texts give equal files. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import lean

LINE, LINES = 64, 65_535
_GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()
#: Codes between two clear codes of an encoded stream: as many as leave the table one entry short of full.
_RUN = 4096 - 258


@dataclass
class Frame:
    """One frame as stored, and the canvas after it was drawn."""

    number: int
    left: int
    top: int
    width: int
    height: int
    delay_ms: int
    disposal: int
    transparent: int | None
    indices: np.ndarray
    canvas: np.ndarray | None
    histogram: np.ndarray | None


# -- encoding


def _code_stream(samples: bytes) -> bytes:
    """The samples as LZW codes of initial size 8, a clear code before each table, an end code, in sub-blocks."""
    # codes are held shifted by 8 bits: or-ed with the next byte they are the key of the entry that goes on with it
    codes: list[int] = [256 << 8]
    sizes, table, free, last = [], {}, 258 << 8, 258 + _RUN - 1 << 8  # sizes: of the tables, in codes with the one that ends it
    put, find = codes.append, table.get
    rest = iter(samples)
    at = next(rest, 0) << 8
    for b in rest:
        more = find(at | b)
        if more is not None:
            at = more
        else:
            put(at)
            if free == last:
                put(256 << 8)
                sizes.append(_RUN + 1)
                table.clear()
                free = 258 << 8
            else:
                table[at | b] = free
                free += 256
            at = b << 8
    if samples:
        put(at)
    put(257 << 8)
    sizes.append(len(codes) - 1 - sum(sizes))
    widths = _widths(8)[1]
    width = np.concatenate([np.full(1, 9), *(widths[:n] for n in sizes)])
    ends = np.cumsum(width)
    begins = ends - width
    code = np.array(codes, np.uint32) >> np.uint32(8) << (begins & 7).astype(np.uint32)  # 19 bits at most: what of them falls into each of three bytes
    out = np.zeros(int(ends[-1] + 7) // 8 + 2, np.uint8)
    for k in range(3):
        np.add.at(out, (begins >> 3) + k, (code >> np.uint32(8 * k) & np.uint32(255)).astype(np.uint8))
    return _blocks(out[:-2])


def _blocks(data: np.ndarray) -> bytes:
    full, rest = divmod(len(data), 255)
    framed = np.empty((full, 256), np.uint8)
    framed[:, 0] = 255
    framed[:, 1:] = data[: full * 255].reshape(full, 255)
    return framed.tobytes() + (bytes([rest]) + data[full * 255 :].tobytes() if rest else b"") + b"\0"


def pad(raw: bytes) -> bytes:
    """raw with zeros up to a positive multiple of a line."""
    return raw + bytes(-len(raw) % LINE if raw else LINE)


def encode(payload: bytes, delay_ms: int = 100) -> bytes:
    """A GIF of payload's bytes, whose number is a positive multiple of 64, as grey samples."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, LINE)
    out = [b"GIF89a", struct.pack("<HHBBB", LINE, min(len(samples), LINES), 0xF7, 0, 0), _GREY]
    for at in range(0, len(samples), LINES):
        part = samples[at : at + LINES]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay_ms // 10, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, LINE, len(part), 0), b"\x08", _code_stream(part.tobytes())]
    return b"".join([*out, b"\x3b"])


# -- decoding


def _sub_blocks(data: np.ndarray, at: int) -> tuple[np.ndarray, int]:
    """The joined sub-blocks that begin at a place, and the place after them."""
    parts, n = [], len(data)
    while True:
        if at >= n:
            raise ValueError("ends in a sub-block")
        size = int(data[at])
        if not size:
            return np.concatenate(parts) if parts else data[:0], at + 1
        if size == 255:  # a run of full blocks at once
            sizes = data[at::256]
            run = len(sizes) if (sizes == 255).all() else int(np.argmax(sizes != 255))
            run = min(run, (n - at) // 256)
            if run > 1:
                parts.append(data[at : at + run * 256].reshape(run, 256)[:, 1:].reshape(-1))
                at += run * 256
                continue
        parts.append(data[at + 1 : at + 1 + size])
        at += 1 + size


@cache
def _widths(root: int) -> tuple[np.ndarray, np.ndarray]:
    """(bit offset, width) of the codes that follow a clear code, as many as fill the table, then 12 bits each."""
    first = (1 << root) + 2
    k = np.arange(4096 - first + 2)
    known = first + np.maximum(k - 1, 0)
    width = np.minimum(12, np.maximum(root + 1, np.floor(np.log2(known)).astype(np.int64) + 1))
    return np.concatenate(([0], np.cumsum(width)[:-1])), width


def lzw(data: np.ndarray, root: int, size: int) -> np.ndarray:
    """The samples of a code stream of initial code size root, at most size of them."""
    clear, end = 1 << root, (1 << root) + 1
    total = len(data) * 8
    raw = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint32)
    raw = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)  # the 24 bits from each byte on
    start, width = _widths(root)
    masks = (1 << width) - 1
    span = int(start[-1] + width[-1])
    out, at, done = [], 0, 0
    while done < size:
        keep = len(start) if at + span <= total else int(np.searchsorted(start + width, total - at, side="right"))
        if not keep:
            break
        place = at + start[:keep]
        codes = (raw[place >> 3] >> (place & 7).astype(np.uint32)).astype(np.int64) & masks[:keep]
        stop = np.flatnonzero((codes == clear) | (codes == end))
        if len(stop):
            final = int(codes[stop[0]])
            at += int(start[stop[0]] + width[stop[0]])
            codes = codes[: stop[0]]
        else:  # the table is full, or the stream breaks off: 12-bit codes go on until a clear code
            at, final, more = at + int(start[keep - 1] + width[keep - 1]), -1, []
            while at + 12 <= total:
                code = int(raw[at >> 3]) >> (at & 7) & 4095
                at += 12
                if code in (clear, end):
                    final = code
                    break
                more.append(code)
            codes = np.concatenate((codes, np.array(more, np.int64)))
        part = _strings(codes, clear)[: size - done]
        out.append(part)
        done += len(part)
        if final != clear:
            break
    return np.concatenate(out)[:size] if out else np.zeros(0, np.uint8)


def _strings(codes: np.ndarray, clear: int) -> np.ndarray:
    """The output of the codes between two clear codes: entry clear + 2 + k is the k-th code's output and the next byte after it.

    All codes walk up their chains of earlier codes together: once to their first byte and length, once to write their bytes."""
    if (codes < clear).all():
        return codes.astype(np.uint8)
    before = codes - clear - 2  # the code whose output an entry begins with
    if (before >= np.arange(len(codes))).any():
        raise ValueError("a code that is not in the table")
    first, length, live = codes.copy(), np.ones(len(codes), np.int64), np.flatnonzero(before >= 0)
    at = before[live]
    while len(live):
        length[live] += 1
        on = before[at] >= 0
        first[live[~on]] = codes[at[~on]]
        live, at = live[on], before[at[on]]
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]), np.uint8)
    out[ends - length] = first
    live = np.flatnonzero(before >= 0)
    at, place = before[live], ends[live] - 1
    while len(live):
        out[place] = first[at + 1]
        on = before[at] >= 0
        live, at, place = live[on], before[at[on]], place[on] - 1
    return out


def _rows(height: int) -> np.ndarray:
    """The line that each stored line of an interlaced frame is."""
    return np.concatenate([np.arange(a, height, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])


def _palette(data: np.ndarray, at: int, bits: int) -> tuple[np.ndarray, int]:
    """A palette as RGBA words, padded to 256 colours."""
    n = 2 << bits
    rgb = data[at : at + 3 * n]
    if len(rgb) < 3 * n:
        raise ValueError("ends in a palette")
    rgba = np.full((256, 4), 255, np.uint8)
    rgba[n:, :3] = 0
    rgba[:n, :3] = rgb.reshape(n, 3)
    return rgba.view(np.uint32).reshape(-1), at + 3 * n


def decode(raw: bytes, compose: bool = True) -> Iterator[Frame]:
    """The frames of a GIF in order; ValueError where it breaks. compose: also draw the canvas (RGBA words) and count its colours."""
    data = np.frombuffer(raw, np.uint8)
    if raw[:6] not in (b"GIF87a", b"GIF89a") or len(raw) < 13:
        raise ValueError("not a GIF")
    wide, high, flags, _, _ = struct.unpack_from("<HHBBB", raw, 6)
    at, common = 13, None
    if flags & 0x80:
        common, at = _palette(data, at, flags & 7)
    canvas = np.zeros((high, wide), np.uint32) if compose else None
    control, number = (0, 0, None), 0
    while True:
        if at >= len(raw):
            raise ValueError("ends without a trailer")
        kind = raw[at]
        if kind == 0x3B:
            return
        if kind == 0x21:
            body, after = _sub_blocks(data, at + 2)
            if raw[at + 1] == 0xF9 and len(body) >= 4:
                packed, delay, index = struct.unpack_from("<BHB", body.tobytes())
                control = ((packed >> 2) & 7, delay * 10, index if packed & 1 else None)
            at = after
            continue
        if kind != 0x2C or at + 11 > len(raw):
            raise ValueError("an unknown block")
        left, top, width, height, packed = struct.unpack_from("<HHHHB", raw, at + 1)
        at += 10
        palette = common
        if packed & 0x80:
            palette, at = _palette(data, at, packed & 7)
        root = raw[at]
        if not 1 <= root <= 8:
            raise ValueError("a code size out of range")
        body, at = _sub_blocks(data, at + 1)
        stored = lzw(body, root, width * height)
        if len(stored) < width * height:
            raise ValueError("a code stream that ends early")
        stored = stored.reshape(height, width)
        if packed & 0x40:
            indices = np.empty_like(stored)
            indices[_rows(height)] = stored
        else:
            indices = stored
        disposal, delay, transparent = control
        control = (0, 0, None)
        shown = histogram = None
        if compose:
            if palette is None:
                raise ValueError("a frame without a palette")
            before = canvas.copy() if disposal == 3 else None
            window = canvas[top : top + height, left : left + width]
            part = indices[: window.shape[0], : window.shape[1]]
            if transparent is None:
                window[...] = palette[part]
            else:
                np.copyto(window, palette[part], where=part != transparent)
            shown = canvas
            histogram = colour_histogram(canvas)
        yield Frame(number, left, top, width, height, delay, disposal, transparent, indices, shown.copy() if compose else None, histogram)
        number += 1
        if compose and disposal == 2:
            canvas[top : top + height, left : left + width] = 0
        elif compose and disposal == 3:
            canvas = before


def colour_histogram(canvas: np.ndarray, bits: int = 2) -> np.ndarray:
    """Opaque pixels by the upper bits of red, green and blue."""
    pixels = canvas.reshape(-1)
    down = np.uint32(8 - bits)
    red, green, blue = ((pixels >> np.uint32(s)) & np.uint32(255) for s in (0, 8, 16))
    bins = ((red >> down) << np.uint32(2 * bits)) | ((green >> down) << np.uint32(bits)) | (blue >> down)
    solid = pixels >> np.uint32(24) > 0
    return np.bincount(bins if solid.all() else bins[solid], minlength=1 << 3 * bits)


# -- columns


def encode_column(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media) for each row: the text's UTF-8 bytes, padded, as a GIF."""
    import pyarrow as pa

    def encoded(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raws = [x.as_py().encode() if x.is_valid else b"" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, raws), pa.int64()), pa.array([encode(pad(x)) for x in raws], pa.binary())], ["key", "n_bytes", "media"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(lean(encoded), f"key {kind}, n_bytes long, media binary").withColumnRenamed("key", key)


def decode_frames(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """A row for each frame of each GIF: place, size, times, disposal, the composed canvas as RGBA bytes and its colour histogram.

    A GIF that breaks has a last row without a frame, whose error says why."""
    import pyarrow as pa

    kind = media.schema[key].dataType.simpleString()
    names = ("frame", "starts_ms", "delay_ms", "left", "top", "width", "height", "disposal")
    schema = f"key {kind}, {', '.join(f'{n} int' for n in names)}, canvas binary, histogram array<long>, error string"

    def frames(batches: Iterator) -> Iterator:
        for batch in batches:
            for k in range(batch.num_rows):
                rows, error, clock = [], None, 0
                try:
                    if not batch.column(1)[k].is_valid:
                        raise ValueError("null")
                    for f in decode(batch.column(1)[k].as_py()):
                        rows.append((f.number, clock, f.delay_ms, f.left, f.top, f.width, f.height, f.disposal, f.canvas.tobytes(), f.histogram.tolist(), None))
                        clock += f.delay_ms
                        if len(rows) == 8:
                            yield batch_of(batch.column(0), k, rows)
                            rows = []
                except ValueError as e:
                    error = str(e)
                if error:
                    rows.append((*[None] * 10, error))
                if rows:
                    yield batch_of(batch.column(0), k, rows)

    def batch_of(keys, k: int, rows: list[tuple]):
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int32()] * 8 + [pa.binary(), pa.list_(pa.int64()), pa.string()]
        own = keys.take(pa.array([k] * len(rows)))
        return pa.RecordBatch.from_arrays([own, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["key", *names, "canvas", "histogram", "error"])

    return media.select(key, column).mapInArrow(lean(frames), schema).withColumnRenamed("key", key)


def payload_digests(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """One row for each GIF of ``encode_column``: what is read back from its composed frames, and features of these.

    A sample is what its pixel of the canvas shows, whose colour the grey palette makes of it. feature: frames, milliseconds, and the
    shares of the pixels in eight ranges of grey levels, in thousandths. frames is an array of (starts_ms, delay_ms, width, height),
    histogram counts the frames' colours by the upper two bits of red, green and blue."""
    import pyarrow as pa

    kind = media.schema[key].dataType.simpleString()
    times = pa.struct([(n, pa.int32()) for n in ("starts_ms", "delay_ms", "width", "height")])

    def digests(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for x, n in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = x.as_py()
                digest, levels, colours, size, tail, clock, frames = hashlib.sha256(), np.zeros(8, np.int64), np.zeros(64, np.int64), 0, b"", 0, []
                for f in decode(raw):
                    shown = f.canvas[f.top : f.top + f.height, f.left : f.left + f.width]
                    samples = (shown & np.uint32(255)).astype(np.uint8)
                    levels += np.bincount(samples.reshape(-1) >> 5, minlength=8)
                    colours += f.histogram if shown.size == f.canvas.size else colour_histogram(shown)
                    samples = samples.tobytes()
                    digest.update(samples)
                    frames.append((clock, f.delay_ms, f.width, f.height))
                    size, tail, clock = size + len(samples), samples[-LINE:], clock + f.delay_ms
                feature = f"frames={len(frames)};ms={clock};grey={'-'.join(str(1000 * int(v) // size) for v in levels)}"
                rows.append((n, size, digest.hexdigest(), zlib.crc32(tail), len(raw), hashlib.sha256(raw).hexdigest(), feature, [dict(zip(("starts_ms", "delay_ms", "width", "height"), t, strict=True)) for t in frames], colours.tolist()))
            columns = list(zip(*rows, strict=True)) or [[]] * 9
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(times), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["key", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "histogram"])

    schema = f"key {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames array<struct<starts_ms:int,delay_ms:int,width:int,height:int>>, histogram array<long>"
    return media.select(key, column, F.col("n_bytes")).mapInArrow(lean(digests), schema).withColumnRenamed("key", key)
