"""Whole-batch numpy views of UTF-8 text columns: words, word hashes and n-gram sums without a Python loop over words.

Arrow hands a text column over as one byte buffer plus offsets. Every helper here works on that buffer; memory is
bounded by :func:`row_slices`, which cuts a batch into pieces of about ``PIECE_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z hash as a-z
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first n bytes of eight
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0x80:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (length rows + 1) of a binary or string column; null rows are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, piece: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together hold about ``piece`` bytes; one longer row is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + piece, "right")) - 1)
        yield lo, hi
        lo = hi


def _spans(member: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``member`` that do not cross ``bounds`` (positions where a row begins)."""
    first = member.copy()
    first[1:] &= ~member[:-1]
    last = member.copy()
    last[:-1] &= ~member[1:]
    inner = bounds[(bounds > 0) & (bounds < len(member))]
    first[inner] |= member[inner]
    last[inner - 1] |= member[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _eights(data: np.ndarray) -> np.ndarray:
    """For every position the eight bytes from there on as one integer, letters A-Z as a-z, zeros past the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data]
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def _hashes(eights: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs: every block of eight bytes is mixed with its place in the run before blocks are summed.

    Mixing ahead of the sum matters: a polynomial of the bytes modulo 2**64 has texts that collide whatever its base is.
    """
    blocks = (sizes + 7) >> 3
    begins = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(begins, blocks)
    left = np.minimum(np.repeat(sizes, blocks) - 8 * place, 8)
    value = mix64(eights[np.repeat(starts, blocks) + 8 * place] & _FIRST[left])
    value += (place.astype(np.uint64) + np.uint64(1)) * _GOLDEN
    return mix64(np.add.reduceat(mix64(value), begins) + sizes.astype(np.uint64) * _GOLDEN)


def words(data: np.ndarray, offsets: np.ndarray, letters_only: bool = False, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of all rows, in order.

    Words are runs of non-space bytes (space is 0x20 and 0x09-0x0D), or of letters and non-ASCII bytes if ``letters_only``.
    A long buffer is worked off in pieces that end between words, so the tables stay small. With ``prefixes`` (lengths in
    bytes, 8 at most) the hashes are a matrix: the word, then its start of each length, 0 where the word is shorter.
    """
    member = _LETTER[data] if letters_only else ~_SPACE[data]
    starts, ends = _spans(member, offsets)
    out = np.zeros((len(starts), 1 + len(prefixes)), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + PIECE_BYTES, "right")))
        a, b = starts[lo], ends[hi - 1]
        first, sizes = starts[lo:hi] - a, ends[lo:hi] - starts[lo:hi]
        eights = _eights(data[a:b])
        out[lo:hi, 0] = _hashes(eights, first, sizes)
        for k, length in enumerate(prefixes, 1):
            long = np.flatnonzero(sizes >= length)
            out[lo + long, k] = mix64(mix64(eights[first[long]] & _FIRST[length]) + np.uint64(length))  # no word's own hash
        lo = hi
    return out if prefixes else out[:, 0], starts, ends


def segment_sums(values: np.ndarray, starts: np.ndarray, total: int | None = None) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i+1]]`` (the last runs to ``total`` or the end), 0 for an empty segment."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    edges = np.append(starts, len(values) if total is None else total)
    return sums[edges[1:]] - sums[edges[:-1]]
