"""GIF operator: round trips, hand-made streams for every drawing rule, and defined results for broken input."""

import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import gif


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=3000), st.integers(1, 8))
def test_lzw_round_trip(data, size):
    samples = bytes(b & (1 << size) - 1 for b in data)
    assert gif.lzw_decode(gif.lzw_encode(samples, size), size, len(samples)) == samples


@pytest.mark.parametrize("make", [bytes, lambda n: bytes(i * i * 7 % 251 for i in range(n)), lambda n: b"ab" * (n // 2)])
@pytest.mark.parametrize("n", [64, 64 * 256, 64 * 257, 64 * 3000])
def test_payload_round_trip(make, n):
    payload = make(n)
    frames = list(gif.decode_gif(gif.encode_gif(payload)))
    assert b"".join(f.indices for f in frames) == payload
    assert b"".join(f.canvas[f.top : f.top + f.height, :, 0].tobytes() for f in frames) == payload
    assert [f.start_ms for f in frames] == [40 * i for i in range(len(frames))]


def literal_stream(samples, size):
    """Codes by the book, written bit by bit: a clear code before every sample, so no table entry is ever used."""
    bits = ""
    for s in samples:
        bits = f"{1 << size:0{size + 1}b}" + bits
        bits = f"{s:0{size + 1}b}" + bits
    bits = f"{(1 << size) + 1:0{size + 1}b}" + bits
    n = -(-len(bits) // 8)
    return int(bits, 2).to_bytes(n, "little")


def plain_decode(stream, size):
    """LZW by the book: bit after bit, one table entry after the other."""
    bits = "".join(f"{b:08b}"[::-1] for b in stream)
    clear, end, at, width = 1 << size, (1 << size) + 1, 0, size + 1
    table, before, out = {}, None, bytearray()
    while at + width <= len(bits):
        code = int(bits[at : at + width][::-1], 2)
        at += width
        if code == end:
            break
        if code == clear:
            table, before, width = {i: bytes([i]) for i in range(clear)}, None, size + 1
            continue
        if before is None:
            entry = table[code]
        else:
            entry = table[code] if code in table else before + before[:1]
            if len(table) + 2 < 4096:
                table[len(table) + 2] = before + entry[:1]
                if len(table) + 2 == 1 << width and width < 12:
                    width += 1
        out += entry
        before = entry
    return bytes(out)


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=1, max_size=2000), st.integers(2, 8), st.integers(1, 4))
def test_streams_against_a_plain_decoder(data, size, repeat):
    samples = bytes(b & (1 << size) - 1 for b in data) * repeat
    stream = gif.lzw_encode(samples, size)
    assert plain_decode(stream, size) == samples
    for limit in (1, len(samples) // 2, len(samples), len(samples) + 9):
        assert gif.lzw_decode(stream, size, limit) == samples[:limit]


def deferred_stream(n):
    """A full string table and then ``n`` codes of twelve bits without a clear code."""
    codes = [256, 0, *range(258, 4096), *[4095] * n]
    widths = [9, *gif._WIDTHS[8][: len(codes) - 1].tolist()]
    widths += [12] * (len(codes) - len(widths))
    bits, at = 0, 0
    for c, w in zip(codes, widths, strict=True):
        bits |= c << at
        at += w
    return bits.to_bytes(-(-at // 8), "little")


def test_full_tables_without_clear_codes():
    stream = deferred_stream(50)
    want = plain_decode(stream, 8)
    assert len(want) > 50 * 3000 and gif.lzw_decode(stream, 8, len(want)) == want
    assert gif.lzw_decode(deferred_stream(60_000), 8, 16) == bytes(16)  # would expand to 230 MB


@pytest.mark.parametrize("data", [struct.pack("<6sHHBBB", b"GIF89a", 65535, 65535, 0x80, 0, 0) + bytes(29), struct.pack("<6sHHBBB", b"GIF89a", 4, 4, 0x80, 0, 0) + bytes(6) + b"\x2c" + struct.pack("<HHHHB", 0, 0, 65535, 65535, 0) + b"\x02\0"])
def test_oversized_media_are_an_error(spark, data):
    df = spark.createDataFrame([(1, data), (2, gif.encode_gif(bytes(64)))], "doc_id long, media binary")
    out = {r.doc_id: r for r in gif.media_digest(df).collect()}
    assert "too large" in out[1].error and out[1].n_frames == 0 and out[2].error is None
    assert {(r.doc_id, r.error) for r in gif.gif_frames(df, "doc_id", "media").collect()} == {(1, out[1].error), (2, None)}


def frame(left, top, w, h, samples, disposal=0, transparent=None, delay=10, palette=None, interlaced=False):
    packed = disposal << 2 | (transparent is not None)
    out = b"\x21\xf9\x04" + struct.pack("<BHB", packed, delay, transparent or 0) + b"\0"
    flags = 0x40 * interlaced | (0x80 | 1 if palette else 0)
    out += b"\x2c" + struct.pack("<HHHHB", left, top, w, h, flags) + (palette or b"")
    codes = literal_stream(samples, 2)
    return out + b"\x02" + bytes([len(codes)]) + codes + b"\0"


RED, GREEN, BLUE, WHITE = b"\xff\0\0", b"\0\xff\0", b"\0\0\xff", b"\xff\xff\xff"


def image(*frames, w=2, h=2):
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0x81, 0, 0) + RED + GREEN + BLUE + WHITE + b"".join(frames) + b"\x3b"


def colours(f):
    names = {(255, 0, 0, 255): "R", (0, 255, 0, 255): "G", (0, 0, 255, 255): "B", (255, 255, 255, 255): "W", (0, 0, 0, 0): "."}
    return "".join(names[tuple(int(v) for v in p)] for p in f.canvas.reshape(-1, 4))


@pytest.mark.parametrize(("disposal", "second"), [(0, "GRRR"), (1, "GRRR"), (2, "G..."), (3, "G...")])
def test_disposal(disposal, second):
    data = image(frame(0, 0, 2, 2, [0, 0, 0, 0], disposal), frame(0, 0, 1, 1, [1]))
    a, b = gif.decode_gif(data)
    assert colours(a) == "RRRR" and colours(b) == second
    assert (a.delay_ms, b.start_ms) == (100, 100)


def test_transparency_local_palette_and_position():
    data = image(frame(0, 0, 2, 2, [0, 1, 2, 3]), frame(1, 0, 1, 2, [1, 0], transparent=0, palette=WHITE + BLUE + RED + GREEN))
    a, b = gif.decode_gif(data)
    assert colours(a) == "RGBW" and colours(b) == "RBBW"
    assert b.histogram().sum() == 4 and b.histogram()[3] == 2  # blue: 0, 0, 3
    assert b.grey_histogram().sum() == 2


def test_interlaced_rows():
    data = image(frame(0, 0, 1, 9, [0, 1, 2, 3, 0, 1, 2, 3, 0], interlaced=True), w=1, h=9)
    order = [0, 8, 4, 2, 6, 1, 3, 5, 7]
    want = [""] * 9
    for row, name in zip(order, "RGBWRGBWR", strict=True):
        want[row] = name
    assert colours(next(gif.decode_gif(data))) == "".join(want)


@pytest.mark.parametrize("data", [b"", b"GIF89a", b"PNG", image(frame(0, 0, 2, 2, [0, 0, 0, 0]))[:-8], gif.encode_gif(bytes(64))[:800]])
def test_broken_media(data):
    with pytest.raises(ValueError):
        list(gif.decode_gif(data))


def test_frame_table(spark):
    rows = [(1, image(frame(0, 0, 2, 2, [0, 0, 0, 0]), frame(0, 0, 1, 1, [1]))), (2, None), (None, b"x"), (1, image(frame(0, 0, 2, 2, [0, 0, 0, 0]))[:-8])]
    out = gif.gif_frames(spark.createDataFrame(rows, "doc_id long, media binary"), "doc_id", "media").collect()
    assert sorted((r.doc_id or 0, -1 if r.frame is None else r.frame) for r in out) == [(0, -1), (1, -1), (1, 0), (1, 1), (2, -1)]
    assert {r.error for r in out if r.frame is None} >= {"null", "not a GIF"}
    assert all(len(r.rgba) == 16 and sum(r.histogram) == 4 for r in out if r.frame is not None)


def test_documents_round_trip(spark):
    texts = [(1, ""), (2, None), (None, "a"), (4, "x" * 64), (5, "é" * 40_000), (5, "é" * 40_000)]
    df = spark.createDataFrame([(i, t, 3, "z") for i, t in texts], "doc_id long, text string, n_bytes int, media string")
    out = gif.media_digest(gif.payload_media(df)).collect()
    assert len(out) == 6
    seen = {}
    for r in out:
        text = dict((i, t) for i, t in texts)[r.doc_id] or ""
        raw = text.encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert seen.setdefault(text, r.media_sha256) == r.media_sha256 and r.error is None
    assert gif.media_digest(gif.payload_media(df.limit(0))).count() == 0


def test_query_on_all_documents(spark, small_dir):
    from larkspur.llm import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    out = queries.op1_gif_media(spark, small_dir).collect()
    assert len(out) == len(docs)
    for r in out:
        raw = docs[r.doc_id].encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest()
        assert sum(map(int, r.feature.split(":")[1].split(","))) == len(payload)
        assert r.n_frames == len(r.frames) == -(-r.payload_bytes // (gif.WIDTH * gif.FRAME_ROWS))
        assert [f.start_ms for f in r.frames] == [40 * i for i in range(r.n_frames)]
        assert sum(f.height for f in r.frames) * gif.WIDTH == len(payload)
        assert [sum(c) for c in zip(*(f.histogram for f in r.frames), strict=True)] == list(r.histogram)
    assert np.sum([r.n_frames for r in out]) >= len(out)


def test_clashing_columns_and_many_frames(spark, monkeypatch):
    monkeypatch.setattr(gif, "FLUSH_BYTES", 50)
    data = image(*[frame(0, 0, 2, 2, [i % 4] * 4) for i in range(30)])
    df = spark.createDataFrame([(1, data, "x", 7)], "doc_id long, media binary, feature string, other int")
    row = gif.media_digest(df).first()
    assert row.other == 7 and row.n_frames == 30 and row.feature != "x" and row.duration_ms == 3000
    assert [r.frame for r in gif.gif_frames(df, "doc_id", "media").orderBy("frame").collect()] == list(range(30))
