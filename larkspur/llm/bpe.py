"""BPE encoding and decoding with a public tokenizer file; long text is encoded by tree concatenation.

A text of over ``LONG`` bytes is halved, anywhere, down to leaves of ``LEAF`` characters. All leaves of a batch are encoded
together, and neighbours are joined by re-encoding a window around the join. The window grows until both of its ends agree exactly
with what stands there already: from its first token on it repeats the tokens of the left half up to a guard before the cut, and
from some token behind the cut on it repeats those of the right half up to a guard before its own end. Two neighbouring BPE
tokens that are valid together stay valid in any text, so the joined sequence is the encoding of the whole.

ASCII white space separates tokens whatever stands around it, so leaves and shorter texts are encoded chunk by chunk and the
encodings of short chunks are kept for reuse (a bounded table in each worker). Windows are always encoded by the library alone.
That needs a tokenizer that lower-cases and drops white space; one of another kind is refused.

Edge cases: a null or empty text, or one of white space only, has no tokens, and both digests are those of the empty string.
Special-token strings in a text get their ids, as the library does by default. Equal texts have equal ids and repeated rows each
get a row; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larkspur.llm.scratch import sliced, small_batches

#: Texts above LONG bytes go through the tree; characters of a leaf.
LONG, LEAF = 8192, 4096
#: First window (characters on each side of a join), and how far from a cut a token must end to be trusted: more than the
#: longest special token or contraction.
WINDOW, GUARD = 96, 20
#: Chunk encodings a worker keeps (about 200 bytes each), in two generations of half as many, and the longest chunk kept (bytes).
CACHE_CHUNKS, CACHE_BYTES = 500_000, 64

@dataclass
class Encoded:
    """Token ids of ``text[lo:hi]`` and where tokens start and end.

    Inside a chunk of several tokens only the first start may be known (``known``); the others repeat it, and all ends are the
    chunk's.
    """

    lo: int
    hi: int
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    known: np.ndarray

    def spliced(self, upto: int, window: Encoded, from_: int, until: int, right: Encoded | None, at: int) -> Encoded:
        """Own tokens before ``upto``, the window's in [from_, until), then those of ``right`` from ``at`` on."""
        names = ("ids", "starts", "ends", "known")
        parts = [[getattr(self, n)[:upto], getattr(window, n)[from_:until], *([getattr(right, n)[at:]] if right else [])] for n in names]
        return Encoded(self.lo, (right or window).hi, *map(np.concatenate, parts))


def _exact(encoding, lo: int, hi: int) -> Encoded:
    """The library's encoding of a text from ``lo`` on; a token that shares a character with the one before has no start of its own."""
    offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2) + lo
    known = np.ones(len(offsets), bool)
    known[1:] = offsets[1:, 0] >= offsets[:-1, 1]
    return Encoded(lo, hi, np.array(encoding.ids, np.int64), offsets[:, 0], offsets[:, 1], known)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _chunk_spans(raw: bytes, lo: int) -> np.ndarray:
    """Start and end, in characters after ``lo``, of the runs without ASCII white space."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not raw.isascii():  # bytes to characters: continuation bytes do not count
        edges = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])[edges]
    return edges.reshape(-1, 2) + lo


@cache
def _seconds() -> frozenset[str]:
    """Characters that may merge with the one before them in NFC: marks, and the second parts of canonical compositions."""
    found = {chr(c) for r in (range(0x1161, 0x1176), range(0x11A8, 0x11C3)) for c in r}  # Hangul vowels and finals
    for c in map(chr, range(0x300, 0x20000)):
        if unicodedata.combining(c):
            found.add(c)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and parts[0][0] != "<":
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


def _starts_anew(c: str) -> bool:
    """Whether normalization never merges the character with the one before it."""
    return c < "\u0300" or c not in _seconds()


def _cut(text: str, lo: int, hi: int) -> int:
    """A middle position whose next character does not compose with the one before."""
    middle = (lo + hi) // 2
    return next((at for at in range(middle, min(middle + 64, hi)) if _starts_anew(text[at])), middle)


class TreeEncoder:
    """Encodes long texts by halves, with leaves from the codec's chunks and windows from the library."""

    def __init__(self, codec: Codec, leaf: int = LEAF) -> None:
        self.codec, self.leaf = codec, leaf
        self.joins = self.rejoined = 0  # joins made, and characters encoded again for them

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        leaves: list[tuple[str, int, int]] = []
        shapes = [self._split(text, 0, len(text), leaves) for text in texts]
        made = self.codec.leaves(leaves)
        return [self._joined(text, shape, made).ids for text, shape in zip(texts, shapes, strict=True)]

    def _split(self, text: str, lo: int, hi: int, leaves: list):
        at = _cut(text, lo, hi) if hi - lo > self.leaf else lo
        if not lo < at < hi:
            leaves.append((text, lo, hi))
            return len(leaves) - 1
        return self._split(text, lo, at, leaves), self._split(text, at, hi, leaves)

    def _joined(self, text: str, shape, made: list[Encoded]) -> Encoded:
        if isinstance(shape, int):
            return made[shape]
        return self.join(text, self._joined(text, shape[0], made), self._joined(text, shape[1], made))

    def join(self, text: str, a: Encoded, b: Encoded) -> Encoded:
        """The encoding of ``text[a.lo:b.hi]`` from those of its two parts."""
        width = WINDOW
        self.joins += 1
        while True:
            i = int(np.searchsorted(a.starts, a.hi - width))
            while i < len(a.ids) and not (a.known[i] and _starts_anew(text[a.starts[i]])):
                i += 1
            whole = a.hi - width <= a.lo
            i = 0 if whole else i
            start = a.lo if whole else int(a.starts[i]) if i < len(a.ids) else a.hi
            end = min(b.lo + width, b.hi)
            self.rejoined += end - start
            w = _exact(self.codec.tokenizer.encode(text[start:end], add_special_tokens=False), start, end)
            if whole or self._repeats(a, i, w):
                if end == b.hi:
                    return a.spliced(i, w, 0, len(w.ids), None, 0)
                where = self._common(text, w, b, end)
                if where:
                    return a.spliced(i, w, 0, where[0], b, where[1])
            width *= 2

    @staticmethod
    def _repeats(a: Encoded, i: int, w: Encoded) -> bool:
        """Whether the window begins with all tokens that the left half has from ``i`` up to the guard before its end."""
        n = int(np.searchsorted(a.ends, a.hi - GUARD, "right")) - i
        return n > 0 and len(w.ids) >= n and w.starts[0] == a.starts[i] and bool((w.ids[:n] == a.ids[i : i + n]).all())

    @staticmethod
    def _common(text: str, w: Encoded, b: Encoded, end: int) -> tuple[int, int] | None:
        """The first place behind the cut from which the window repeats the right half up to the guard before the window's end."""
        stop = int(np.searchsorted(w.ends, end - GUARD, "right"))
        for y in range(int(np.searchsorted(w.starts, b.lo + GUARD)), stop):
            if not (w.known[y] and _starts_anew(text[w.starts[y]])):
                continue
            z = int(np.searchsorted(b.starts, w.starts[y]))
            n = stop - y
            if z + n <= len(b.ids) and b.starts[z] == w.starts[y] and b.known[z] and (b.ids[z : z + n] == w.ids[y:stop]).all():
                return y, z
        return None


def check_kind(tokenizer: Tokenizer) -> None:
    """ValueError unless the tokenizer is a BPE that lower-cases, drops white space, and changes text by NFC only besides."""
    spec = json.loads(tokenizer.to_str())

    def flat(step: dict | None) -> list[dict]:
        if step is None:
            return []
        inner = step.get("normalizers") or step.get("pretokenizers")
        return [x for s in inner for x in flat(s)] if inner else [step]

    normal, cuts = flat(spec["normalizer"]), flat(spec["pre_tokenizer"])
    spaces = [s for s in normal if s["type"] == "Replace"]
    fine = spec["model"]["type"] == "BPE" and {s["type"] for s in normal} <= {"NFC", "Replace", "Lowercase"} and "Lowercase" in {s["type"] for s in normal}
    fine &= all(s["pattern"].get("Regex") == r"\s+" and not s["content"].strip() for s in spaces)
    fine &= bool(cuts) and cuts[0]["type"] == "Split" and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and not cuts[0].get("add_prefix_space")
    fine &= all(c["type"] == "ByteLevel" and not c["add_prefix_space"] and not c["use_regex"] for c in cuts[1:])
    if fine:
        pattern = regex.compile(cuts[0]["pattern"]["Regex"])
        fine = not any(regex.search(r"\s", m.group()) for gap in " \t\n\v\f\r" for m in pattern.finditer(gap.join(["a", "'", "s", "1", "2", "!", "?", "é", "", "z"])))
    fine &= not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"]) >= GUARD or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    if not fine:
        raise ValueError("not a lower-casing BPE tokenizer that drops white space")


class Codec:
    """Encodes whole texts to ids and decodes ids, reusing the packed ids of chunks."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        check_kind(self.tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tree = TreeEncoder(self)
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.code = "H" if n <= 1 << 16 else "I"
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.digits = [str(i) for i in range(n)]
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(n)]
        self.plain = self.tokenizer.decoder is None

    def _learned(self, chunks: Iterable[bytes]) -> dict[bytes, bytes]:
        chunks = list(chunks)
        done = self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)
        return {c: array(self.code, e.ids).tobytes() for c, e in zip(chunks, done, strict=True)}

    def known(self, used: set[bytes]) -> dict[bytes, bytes]:
        """A table that holds the packed ids of all ``used`` chunks; long ones are in it for this once."""
        if len(self.ids) + len(used) > CACHE_CHUNKS // 2:
            self.older, self.ids = self.ids, {}
        missing = used.difference(self.ids)
        old = missing & self.older.keys()
        self.ids.update((c, self.older[c]) for c in old)
        missing -= old
        if not missing:
            return self.ids
        long = {c for c in missing if len(c) > CACHE_BYTES}
        if missing - long:
            self.ids.update(self._learned(missing - long))
        return self.ids | self._learned(long) if long else self.ids

    @staticmethod
    def lowered(text: bytes) -> bytes:
        """ASCII letters are lower-cased ahead of the library, which does the same, unless a special token may be meant."""
        return text if b"<|" in text else text.lower()

    def leaves(self, pieces: list[tuple[str, int, int]]) -> list[Encoded]:
        """Encodings of ``text[lo:hi]`` for each (text, lo, hi), from chunks; a long chunk has the library's offsets."""
        raws = [text[lo:hi].encode("utf-8", "replace") for text, lo, hi in pieces]
        spans = [_chunk_spans(raw, lo) for raw, (_, lo, _) in zip(raws, pieces, strict=True)]
        keys = [self.lowered(raw).split() for raw in raws]
        long = [(p, k) for p, found in enumerate(keys) for k, key in enumerate(found) if len(key) > CACHE_BYTES]
        done = self.tokenizer.encode_batch([pieces[p][0][slice(*spans[p][k])] for p, k in long], add_special_tokens=False)
        exact = {place: _exact(e, *spans[place[0]][place[1]].tolist()) for place, e in zip(long, done, strict=True)}
        table = self.known({key for found in keys for key in found if len(key) <= CACHE_BYTES})
        width, out = array(self.code).itemsize, []
        for p, (_, lo, hi) in enumerate(pieces):
            packed = list(map(table.get, keys[p]))
            mine = [k for q, k in long if q == p] if exact else []
            for k in mine:
                packed[k] = array(self.code, exact[p, k].ids.tolist()).tobytes()
            counts = np.fromiter(map(len, packed), np.int64, len(packed)) // width
            ids = np.frombuffer(b"".join(packed), self.code).astype(np.int64)
            begins = np.cumsum(counts) - counts
            starts, ends = np.repeat(spans[p][:, 0], counts), np.repeat(spans[p][:, 1], counts)
            known = np.zeros(len(ids), bool)
            known[begins[counts > 0]] = True
            for k in mine:
                e, at = exact[p, k], slice(begins[k], begins[k] + counts[k])
                starts[at], ends[at], known[at] = e.starts, e.ends, e.known
            out.append(Encoded(lo, hi, ids, starts, ends, known))
        return out

    def encode(self, texts: list[bytes | None]) -> Iterator[list[int]]:
        """Ids of each UTF-8 text."""
        long = {i: t.decode("utf-8", "replace") for i, t in enumerate(texts) if t and len(t) > LONG}
        trees = dict(zip(long, self.tree.encode(list(long.values())), strict=True)) if long else {}
        split = [self.lowered(t).split() if t and i not in long else [] for i, t in enumerate(texts)]
        table = self.known(set().union(*split))
        for i, chunks in enumerate(split):
            yield trees[i].tolist() if i in trees else memoryview(b"".join(map(table.__getitem__, chunks))).cast(self.code).tolist()

    def decimal(self, ids: list[int]) -> str:
        """Decimal ids joined by one space."""
        return " ".join(map(self.digits.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The library's decoded text, special tokens included; without a decoder that is the tokens joined by one space."""
        return " ".join(map(self.names.__getitem__, ids)) if self.plain else self.tokenizer.decode(ids, skip_special_tokens=False)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a tokenizer file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


_GROUP = 1 << 21


def _groups(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"")
        if held >= _GROUP:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, token ids (array) and the decoded text of every row; no shuffle. ``path`` is readable on every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            for lo, hi in _groups(texts):
                ids = list(codec(path).encode(texts[lo:hi]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(map(codec(path).decode, ids), pa.string())],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    narrow = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_tokens long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def encode_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by one space) and decoded_sha256 of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            for lo, hi in _groups(texts):
                own = codec(path)
                rows = [(len(ids), _sha256(own.decimal(ids)), _sha256(own.decode(ids))) for ids in own.encode(texts[lo:hi])]
                n, a, b = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
