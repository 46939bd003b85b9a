"""GIF media columns: an encoder for byte payloads and a decoder for timed, composited frames with colour histograms.

The decoder follows the public GIF89a format: LZW code streams with growing code width, clear and end codes and deferred
clears; global and local palettes; interlaced rows; graphic-control delay, transparency and disposal (keep, background,
previous). Code positions depend only on how many codes follow a clear code, so a whole run of codes is cut out of the bit
stream with numpy and only the string table is walked code by code.

Media are worked off frame by frame, so a row of any number of frames holds one canvas at a time. A canvas or a frame of more than
``MAX_PIXELS`` pixels is refused, and a code stream is cut out and expanded only as far as its frame has pixels.

Edge cases: null media gives no frames and the error ``null``; broken, truncated or oversized media gives the frames before the
fault and a text in ``error``. A canvas or frame of no pixels has an empty frame. Repeated rows give equal results, a null id is
kept, other columns pass through (:func:`media_digest`: unless they bear a result's name) and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scratch import sliced, small_batches

#: A payload becomes frames of WIDTH samples by at most FRAME_ROWS rows, shown for DELAY_CS hundredths of a second each.
WIDTH, FRAME_ROWS, DELAY_CS = 64, 256, 4
PAD = 64
MAX_CODE_BITS = 12
#: Most pixels of a canvas or a frame (64 MB of RGBA), and bytes of frames that leave a task at once.
MAX_PIXELS, FLUSH_BYTES = 1 << 24, 1 << 24
_GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()


def _code_widths(min_size: int, n: int) -> np.ndarray:
    """Bits of the 1st, 2nd, ... n-th code after a clear code."""
    size, first, out = min_size + 1, (1 << min_size) + 2, np.empty(n, np.int64)
    for i in range(n):
        out[i] = size
        if first + i == 1 << size and size < MAX_CODE_BITS:
            size += 1
    return out


_RUN = 4096
_WIDTHS = {m: _code_widths(m, _RUN) for m in range(1, 12)}
_STARTS = {m: np.concatenate([[0], np.cumsum(w)]) for m, w in _WIDTHS.items()}


def lzw_encode(samples: bytes, min_size: int = 8) -> bytes:
    """GIF LZW code stream of ``samples`` (not empty): one string table until it is full, then a clear code.

    Codes are held shifted left by eight bits, so that code and next byte add up to the table's key.
    """
    clear = 1 << min_size
    full = 1 << MAX_CODE_BITS + 8
    runs, codes, table, following = [], [], {}, clear + 2 << 8
    find, emit = table.get, codes.append
    prefix = samples[0] << 8
    for byte in memoryview(samples)[1:]:
        key = prefix + byte
        prefix = find(key)
        if prefix is None:
            emit(key)
            prefix = byte << 8
            if following < full:
                table[key] = following
                following += 256
            else:
                runs.append(codes)
                codes, table, following = [], {}, clear + 2 << 8
                find, emit = table.get, codes.append
    emit(prefix)
    runs.append(codes)
    widths = _WIDTHS[min_size]
    values, sizes = [np.array([clear])], [np.array([min_size + 1])]
    for i, run in enumerate(runs):
        values += [np.array(run) >> 8, np.array([clear + 1 if i == len(runs) - 1 else clear])]
        sizes.append(widths[: len(run) + 1])
    values, sizes = np.concatenate(values), np.concatenate(sizes)
    # Codes that start in the same 32-bit word are joined with "or"; what runs over goes to the next word.
    starts = np.cumsum(sizes) - sizes
    total, word = int(starts[-1] + sizes[-1]), starts >> 5
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    joined = np.bitwise_or.reduceat(values.astype(np.uint64) << (starts & 31).astype(np.uint64), first)
    out = np.zeros((total >> 5) + 2, np.uint64)
    out[word[first]] = joined & np.uint64(0xFFFFFFFF)
    out[word[first] + 1] |= joined >> np.uint64(32)
    return out.astype("<u4").tobytes()[: total + 7 >> 3]


def _expand(codes: np.ndarray, clear: int, limit: int) -> bytes:
    """The samples of the codes between two clear codes, up to the code that reaches ``limit``, without a loop over codes.

    Entry k of the string table is the string of code k and the first sample of the next one, which stand side by side in
    the output; so a compound code copies from where its entry's code was written. Lengths and copies are chains of such
    references, followed by pointer doubling.
    """
    own = np.arange(len(codes), dtype=np.int32)
    entry = codes.astype(np.int32) - (clear + 2)
    if (entry >= own).any():
        raise ValueError("LZW code out of range")
    compound = entry >= 0
    origin = np.where(compound, entry, own)
    length, parent = compound.astype(np.int32), origin
    while (ahead := length[parent]).any():
        length, parent = length + ahead, parent[parent]
    length += 1
    ends = np.cumsum(length, dtype=np.int64)
    n = int(np.searchsorted(ends, limit)) + 1  # no code refers to a later one
    codes, compound, origin, length, ends = codes[:n], compound[:n], origin[:n], length[:n], ends[:n].astype(np.int32)
    begins = ends - length
    source = np.arange(ends[-1], dtype=np.int32) - np.repeat(begins - begins[origin], length)
    while ((following := source[source]) != source).any():
        source = following
    values = np.zeros(len(source), np.uint8)
    values[begins[~compound]] = codes[~compound]
    return values[source].tobytes()


def lzw_decode(stream: bytes, min_size: int, limit: int) -> bytes:
    """The samples of a code stream, at most ``limit``; raises ValueError on a code that no table entry explains."""
    if not 1 <= min_size <= 8:
        raise ValueError("LZW code size")
    if not limit:
        return b""
    clear, end = 1 << min_size, (1 << min_size) + 1
    data = np.frombuffer(stream + b"\0\0\0", np.uint8)
    total, at, made, out = 8 * len(stream), 0, 0, []
    held: list[np.ndarray] = []  # codes since the last clear code
    since = 0  # how many they are
    while True:
        if since < _RUN:
            most = min(_RUN, since + (total - at) // (min_size + 1) + 1)  # codes that the rest of the stream can hold
            starts, widths = _STARTS[min_size][since:most] - _STARTS[min_size][since], _WIDTHS[min_size][since:most]
        else:  # the table is full: twelve bits each until a clear code comes
            starts, widths = np.arange(_RUN) * MAX_CODE_BITS, np.full(_RUN, MAX_CODE_BITS)
        room = len(starts)
        fit = int(np.searchsorted(at + starts + widths, total, "right"))
        starts, widths = at + starts[:fit], widths[:fit]
        byte = starts >> 3
        codes = (data[byte].astype(np.int64) | data[byte + 1].astype(np.int64) << 8 | data[byte + 2].astype(np.int64) << 16) >> (starts & 7) & ((1 << widths) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        n = int(stops[0]) if len(stops) else fit
        held.append(codes[:n])
        since += n
        ended = codes[n] == end if len(stops) else fit < room or made + since >= limit  # every code gives a sample or more
        if len(stops) or ended:
            run, held, since = np.concatenate(held), [], 0
            if len(run):
                out.append(_expand(run, clear, limit - made))
                made += len(out[-1])
            if ended or made >= limit:
                return b"".join(out)[:limit]
            at = int(starts[n] + widths[n])
        else:
            at = int(starts[-1] + widths[-1])


def encode_gif(payload: bytes) -> bytes:
    """``payload`` (a positive multiple of 64 bytes) as the palette indices of a grey animated GIF."""
    step = WIDTH * FRAME_ROWS
    rows = min(len(payload) // WIDTH, FRAME_ROWS)
    parts = [b"GIF89a", struct.pack("<HHBBB", WIDTH, rows, 0xF7, 0, 0), _GREY]
    for lo in range(0, len(payload), step):
        frame = payload[lo : lo + step]
        parts.append(b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, DELAY_CS, 0) + b"\0")
        parts.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, WIDTH, len(frame) // WIDTH, 0) + b"\x08")
        codes = lzw_encode(frame)
        parts.extend(bytes([len(block)]) + block for block in (codes[i : i + 255] for i in range(0, len(codes), 255)))
        parts.append(b"\0")
    return b"".join([*parts, b"\x3b"])


@dataclass
class GifFrame:
    """One shown frame: where it was drawn, its timing and the whole canvas after drawing it."""

    number: int
    start_ms: int
    delay_ms: int
    left: int
    top: int
    width: int
    height: int
    disposal: int
    transparent: int | None
    indices: bytes
    canvas: np.ndarray  # height x width x RGBA

    def histogram(self) -> np.ndarray:
        """Pixels of the canvas by colour, two bits a channel (64 bins); fully transparent pixels are left out."""
        r, g, b, opaque = (self.canvas[:, :, i].ravel() for i in range(4))
        bins = (r >> 6) * 16 + (g >> 6) * 4 + (b >> 6)
        return np.bincount(bins if opaque.all() else bins[opaque > 0], minlength=64)

    def grey_histogram(self) -> np.ndarray:
        """Pixels of the frame's rectangle by brightness (0.30 red, 0.59 green, 0.11 blue), 16 bins."""
        drawn = self.canvas[self.top : self.top + self.height, self.left : self.left + self.width].astype(np.uint16)
        bright = drawn[:, :, 0] * np.uint16(77) + drawn[:, :, 1] * np.uint16(150) + drawn[:, :, 2] * np.uint16(29)
        return np.bincount((bright >> 12).ravel(), minlength=16)


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while True:
        n = data[at]
        at += 1
        if not n:
            return b"".join(parts), at
        if at + n > len(data):
            raise ValueError("truncated block")
        parts.append(data[at : at + n])
        at += n


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    n = 2 << (flags & 7)
    raw = np.frombuffer(data[at : at + 3 * n], np.uint8)
    if len(raw) < 3 * n:
        raise ValueError("truncated palette")
    colours = np.zeros((256, 4), np.uint8)
    colours[:n, :3] = raw.reshape(n, 3)
    colours[:, 3] = 255
    return colours, at + 3 * n


def decode_gif(data: bytes) -> Iterator[GifFrame]:
    """Frames in order, each composited over what the earlier ones left; raises ValueError where the bytes make no sense."""
    try:
        yield from _decode(data)
    except (IndexError, struct.error) as e:
        raise ValueError("truncated") from e


def _decode(data: bytes) -> Iterator[GifFrame]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, shared = 13, None
    if flags & 0x80:
        shared, at = _palette(data, at, flags)
    if width * height > MAX_PIXELS:
        raise ValueError("canvas too large")
    canvas = np.zeros((height, width, 4), np.uint8)
    disposal, delay, transparent, number, clock = 0, 0, None, 0, 0
    while data[at] != 0x3B:
        kind = data[at]
        at += 1
        if kind == 0x21:
            label = data[at]
            body, at = _blocks(data, at + 1)
            if label == 0xF9:
                packed, delay, index = struct.unpack_from("<BHB", body)
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
            continue
        if kind != 0x2C:
            raise ValueError("unknown block")
        left, top, w, h, flags = struct.unpack_from("<HHHHB", data, at)
        at += 9
        if w * h > MAX_PIXELS:
            raise ValueError("frame too large")
        colours = shared
        if flags & 0x80:
            colours, at = _palette(data, at, flags)
        if colours is None:
            raise ValueError("no palette")
        code_size = data[at]
        stream, at = _blocks(data, at + 1)
        raw = lzw_decode(stream, code_size, w * h)
        indices = np.zeros(w * h, np.uint8)
        indices[: len(raw)] = np.frombuffer(raw, np.uint8)
        grid = indices.reshape(h, w)
        if flags & 0x40:
            order = [*range(0, h, 8), *range(4, h, 8), *range(2, h, 4), *range(1, h, 2)]
            rows = np.empty_like(grid)
            rows[order] = grid
            grid = rows
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        seen = grid[: area.shape[0], : area.shape[1]]
        drawn = colours[seen]
        if transparent is None:
            area[:] = drawn
        else:
            np.copyto(area, drawn, where=(seen != transparent)[:, :, None])
        yield GifFrame(number, clock, delay * 10, left, top, w, h, disposal, transparent, grid.tobytes(), canvas.copy())
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            canvas = before
        number, clock = number + 1, clock + delay * 10
        disposal, delay, transparent = 0, 0, None
        if len(raw) < w * h:
            raise ValueError("short frame")


def _frames(data: bytes | None) -> Iterator[GifFrame | str]:
    """The frames of a media value, one after the other, and at last the error's text if there is one."""
    if data is None:
        yield "null"
        return
    try:
        yield from decode_gif(data)
    except ValueError as e:
        yield str(e)


_TIMED = "frame int, start_ms long, delay_ms long, left int, top int, width int, height int, disposal int, transparent int"
FRAME_SCHEMA = f"{_TIMED}, canvas_width int, canvas_height int, rgba binary, histogram array<long>, error string"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def _arrow_fields(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(name, _ARROW[kind]) for name, kind in (x.split() for x in schema.split(", "))]


def _timed(f: GifFrame) -> tuple:
    return f.number, f.start_ms, f.delay_ms, f.left, f.top, f.width, f.height, f.disposal, f.transparent


def gif_frames(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """One row for each frame: id, timing, geometry, composited RGBA pixels and the 64-bin colour histogram.

    Media with a fault have one more row, with a null frame and the error.
    """
    fields = _arrow_fields(FRAME_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            kind, ids, rows, size = batch.schema.field(0).type, [], [], 0

            def out() -> pa.RecordBatch:
                columns = [pa.array(ids, kind), *(pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True))]
                return pa.RecordBatch.from_arrays(columns, ["id", *(n for n, _ in fields)])

            for ident, media in zip(batch.column(0), batch.column(1), strict=True):
                for f in _frames(media.as_py()):
                    if isinstance(f, str):
                        rows.append((*[None] * 13, f))
                    else:
                        rows.append((*_timed(f), f.canvas.shape[1], f.canvas.shape[0], f.canvas.tobytes(), f.histogram().tolist(), None))
                        size += f.canvas.size
                    ids.append(ident.as_py())
                    if size > FLUSH_BYTES:
                        yield out()
                        ids, rows, size = [], [], 0
            if rows:
                yield out()

    kind = dict(df.dtypes)[id_col]
    narrow = small_batches(df).select(F.col(id_col).alias("id"), F.col(media_col).cast("binary").alias("media"))
    return narrow.mapInArrow(run, f"id {kind}, {FRAME_SCHEMA}").withColumnRenamed("id", id_col)


def payload_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (UTF-8 length, null text: 0) and media: the text, zero-padded to a positive multiple of 64, as a GIF."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, media = [], []
            for text in batch.column(1):
                raw = text.as_py() or b""
                sizes.append(len(raw))
                media.append(encode_gif(raw + bytes(max(PAD, -(-len(raw) // PAD) * PAD) - len(raw))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    narrow = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, "id long, n_bytes long, media binary").withColumnRenamed("id", id_col)


_SUMS = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_frames int, duration_ms long, histogram array<long>, feature string, error string"
_FRAME_TYPE = pa.list_(pa.struct([*_arrow_fields(_TIMED), ("histogram", pa.list_(pa.int64()))]))


def _digest(data: bytes | None) -> tuple:
    """What one stored media value decodes to, from its frames one by one."""
    whole, tail, n_bytes, error = hashlib.sha256(), b"", 0, None
    grey, colours, timed, size = np.zeros(16, np.int64), np.zeros(64, np.int64), [], "0x0"
    for f in _frames(data):
        if isinstance(f, str):
            error = f
            continue
        samples = f.canvas[f.top : f.top + f.height, f.left : f.left + f.width, 0].tobytes()
        whole.update(samples)
        n_bytes += len(samples)
        tail = (tail + samples[-PAD:])[-PAD:]
        histogram = f.histogram()
        grey += f.grey_histogram()
        colours += histogram
        timed.append((*_timed(f), histogram.tolist()))
        size = f"{f.canvas.shape[1]}x{f.canvas.shape[0]}"
    feature = f"{len(timed)}@{size}:" + ",".join(map(str, grey.tolist()))
    media = data or b""
    sums = (n_bytes, whole.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), len(timed), sum(t[2] for t in timed), colours.tolist(), feature, error)
    return *sums, [dict(zip(_FRAME_NAMES, t, strict=True)) for t in timed]


_FRAME_NAMES = [n for n, _ in _arrow_fields(_TIMED)] + ["histogram"]


def media_digest(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Adds to each row what its stored media decodes to: the samples' digests, the feature, and ``frames``, the timed frames with
    their geometry and colour histograms (:func:`gif_frames` has their pixels).

    The samples are the red channel of every frame's rectangle, read from the composited canvas. Input columns that bear the name of a
    result are replaced.
    """
    fields = [*_arrow_fields(_SUMS), ("frames", _FRAME_TYPE)]
    taken = {n for n, _ in fields}
    media = media.select([F.col(f"`{c}`") for c in media.columns if c == media_col or c not in taken])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            where = batch.schema.get_field_index(media_col)
            rows = [_digest(x.as_py()) for x in batch.column(where)]
            kept = [i for i in range(batch.num_columns) if i != where]
            found = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)] if rows else [pa.array([], t) for _, t in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *found], [*(batch.schema.names[i] for i in kept), *(n for n, _ in fields)])

    others = [f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema if f.name != media_col]
    timed = ", ".join(f"{n}: {k}" for n, k in (x.split() for x in _TIMED.split(", ")))
    return small_batches(media).mapInArrow(run, ", ".join([*others, _SUMS, f"frames array<struct<{timed}, histogram: array<long>>>"]))
