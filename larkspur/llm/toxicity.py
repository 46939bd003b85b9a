"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored, noisy-or joins them.

A sentence's score is the logistic of the weights of its words; a document is toxic with probability
``1 - (1 - leak) * prod(1 - sentence score)``. Weights, bias and leak are fitted to document labels only, by full-batch
gradient steps on a sample of at most ``MAX_TRAIN`` labelled documents and ``MAX_TRAIN_BYTES`` of their text (whole documents:
one that does not fit any more is left out of the sample); sentence scores then say where the offence is.

Sentences end at ``.``, ``!``, ``?`` and line ends; words are runs of letters, ASCII case ignored. Features are the words
and their starts of ``PREFIXES`` bytes, so endings that occur once still count by their stem. The vocabulary holds those found in
at least ``MIN_DOCS`` sample documents, by 64-bit hash. Scoring is one pass without a shuffle.

Edge cases: null, empty or wordless texts have no sentence and get the leak as their score, with null positions. A null
doc_id counts as held out. Labels that are null are ignored; of repeated labels the largest counts, and of several rows of one
id the fit reads the smallest text. Without any usable label every score is 0. Of equally scored sentences the first is the
worst. Repeated rows get equal scores; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables, sliced, small_batches
from larkspur.llm.textbytes import buffer_of, row_slices, segment_sums, words

#: The documented bounds of the training sample (documents, bytes of text), and the least number of documents a vocabulary entry
#: occurs in.
MAX_TRAIN, MAX_TRAIN_BYTES, MIN_DOCS = 6000, 32 << 20, 3
#: Lengths (bytes) of the word starts that count as features besides the word; occurrences worked off at once in a step. Lengths were
#: chosen by log loss over four folds inside the training rows (crc32 mod FOLDS of 1 to 4), never by the held-out fold.
PREFIXES, PART = (5,), 1 << 20
#: Gradient steps and their size; a word keeps a weight only if the unexplained labels of about PENALTY documents ask for it.
STEPS, RATE, PENALTY = 200, 0.1, 0.5
FOLDS = 5

_STOPS = np.zeros(256, bool)
_STOPS[[0x21, 0x2E, 0x3F, 0x0A, 0x0D]] = True


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text is a multiple of FOLDS (null id: true)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass
class MilModel:
    """Word hashes (sorted) with weights, the sentence bias and the document leak."""

    vocabulary: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float

    def word_weights(self, hashes: np.ndarray) -> np.ndarray:
        """For each word the summed weights of its hashes (a row of them a word)."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes))
        out = np.zeros(len(hashes))
        for column in hashes.T if hashes.ndim > 1 else [hashes]:
            at = np.minimum(np.searchsorted(self.vocabulary, column), len(self.vocabulary) - 1)
            out += np.where(self.vocabulary[at] == column, self.weights[at], 0.0)
        return out


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes (a row a word: itself and its ``PREFIXES``); index of each sentence's first word; each sentence's row; byte span (start, end) of each sentence."""
    hashes, starts, ends = words(data, offsets, letters_only=True, prefixes=PREFIXES)
    stops = np.flatnonzero(_STOPS[data])
    group = np.searchsorted(stops, starts) + np.searchsorted(offsets[1:-1], starts, "right")
    first = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else np.empty(0, np.int64)
    rows = np.searchsorted(offsets, starts[first], "right") - 1
    last = np.append(first[1:], len(starts)) - 1
    spans = np.stack([starts[first], ends[last] if len(first) else starts[first]]) if len(first) else np.empty((2, 0), np.int64)
    return hashes, first, rows, spans


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


class Bags:
    """Sample documents as bags of sentences: which vocabulary entries each sentence holds, and which sentences a document has."""

    def __init__(self, documents: list, size: int) -> None:
        """From (label, vocabulary entry of each occurrence, its sentence in the document, number of sentences) of each document."""
        self.labels, self.size = np.array([d[0] for d in documents], bool), size
        self.owner = np.repeat(np.arange(len(documents)), [d[3] for d in documents])
        self.first = np.searchsorted(self.owner, np.arange(len(documents)))
        # Occurrences in parts, so a step's tables stay small.
        self.parts, open_, n_open = [], [], 0
        for i, first in enumerate(self.first.tolist()):
            _, at, place, _ = documents[i]
            documents[i] = None  # the driver holds each document in one form
            open_.append((at, place + np.int32(first)))
            n_open += len(at)
            if n_open >= PART or i == len(documents) - 1:
                self.parts.append(tuple(map(np.concatenate, zip(*open_, strict=True))))
                open_, n_open = [], 0
        self.spans = [(int(s.min()), int(s.max()) + 1) if len(s) else (0, 0) for _, s in self.parts]

    def loss_and_gradient(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean log loss of the labels under noisy-or, and its gradient; ``w`` is the weights, the sentence bias and the raw leak."""
        z = np.full(len(self.owner), w[-2])
        for (at, sentence), (lo, hi) in zip(self.parts, self.spans, strict=True):
            z[lo:hi] += np.bincount(sentence - lo, w[at], hi - lo)
        quiet = np.clip(segment_sums(_softplus(z), self.first) + _softplus(w[-1]), 1e-9, 500.0)  # -log P(not toxic)
        n = len(self.labels)
        loss = float(np.where(self.labels, -np.log(-np.expm1(-quiet)), quiet).sum() / n)
        pull = np.where(self.labels, -1.0 / np.expm1(quiet), 1.0) / n
        slope = pull[self.owner] / (1.0 + np.exp(-z))
        gradient = np.zeros_like(w)
        for at, sentence in self.parts:
            gradient[:-2] += np.bincount(at, slope[sentence], self.size)
        gradient[-2] = slope.sum()
        gradient[-1] = (pull / (1.0 + np.exp(-w[-1]))).sum()
        return loss, gradient


def located(hashes: np.ndarray, first: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary entry and sentence of every occurrence in one document, from word hashes and the index of each sentence's first word."""
    place = np.searchsorted(first, np.arange(len(hashes)), "right") - 1
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[at] == hashes
    return at[known].astype(np.int32), np.broadcast_to(place.reshape(-1, *[1] * (hashes.ndim - 1)), hashes.shape)[known].astype(np.int32)


def fit(documents: list[tuple[int, np.ndarray, np.ndarray, int]], vocabulary: np.ndarray) -> MilModel:
    """Fit on what :class:`Bags` takes; the list is used up."""
    labels = np.array([d[0] for d in documents], bool)
    if not len(vocabulary) or not labels.any() or labels.all():
        rate = float(labels.mean()) if len(labels) else 0.0
        return MilModel(np.empty(0, np.uint64), np.empty(0), -np.inf, min(rate, 0.999))
    bags = Bags(documents, len(vocabulary))
    w = np.zeros(len(vocabulary) + 2)
    w[-2], w[-1] = -6.0, -3.0  # sentence bias; leak on the scale of softplus
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        _, grad = bags.loss_and_gradient(w)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        scale = RATE / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w -= scale * m / (1 - 0.9**step)
        w[:-2] = np.maximum(w[:-2] - scale[:-2] * PENALTY / len(labels), 0.0)  # words only ever add to a score
    kept = w[:-2] > 1e-3
    return MilModel(vocabulary[kept], w[:-2][kept], float(w[-2]), float(-np.expm1(-_softplus(w[-1]))))


def training_rows(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", limit: int = MAX_TRAIN) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fold, by a hash order that every run repeats."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    return rows.orderBy(F.xxhash64("id"), "id").limit(limit)


def sample_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = MAX_TRAIN, limit_bytes: int = MAX_TRAIN_BYTES, tables: Tables | None = None) -> DataFrame:
    """y and text of the sample: the documents of :func:`training_rows`, in its order, as far as their texts fit ``limit_bytes``.

    A text that does not fit any more is passed over, so near the bound the sample leans to shorter texts.
    """
    tables = tables or Tables(docs.sparkSession, "toxicity")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    # Labels of a larger corpus must not use up the limit.
    known = labels.join(texts.select(F.col("id").alias("_id")), F.col(id_col).cast("long") == F.col("_id"), "left_semi")
    sample = training_rows(known, id_col, label_col, limit)
    picked = texts.join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.min("text").alias("text"))  # at most ``limit`` pairs of numbers
    picked = tables.written(picked.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")), "sample")
    fitting, held = [], 0
    for r in picked.select("id", "bytes").orderBy(F.xxhash64("id"), "id").collect():  # at most ``limit`` rows
        if held + r.bytes <= limit_bytes:
            fitting.append(r.id)
            held += r.bytes
    chosen = docs.sparkSession.createDataFrame([(i,) for i in fitting], "id long")  # ``limit`` numbers at most
    return picked.join(F.broadcast(chosen), "id").select("y", "text")


def _sentences_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and sentence starts of each text in column 1."""
    data, offsets = buffer_of(batch.column(1))
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        hashes, first, _, _ = sentences(data[lo:hi], np.array([0, hi - lo]))
        yield hashes, first


def vocabulary_of(texts: DataFrame) -> np.ndarray:
    """Sorted hashes of the words and word starts that are in ``MIN_DOCS`` texts or more (fewer in a small sample), counted by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for hashes, _ in _sentences_of(batch):
                if len(hashes):
                    mine = np.unique(np.append(hashes.ravel(), np.uint64(0)))  # 0, which no word has, counts the texts with words
                    yield pa.RecordBatch.from_arrays([pa.array(mine.view(np.int64))], ["h"])

    counted = texts.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n"))
    n_texts = counted.where("h = 0").collect()
    need = min(MIN_DOCS, max(1, n_texts[0].n // 50)) if n_texts else 1
    often = counted.where((F.col("n") >= need) & (F.col("h") != 0)).select("h").collect()
    return np.sort(np.array([r.h for r in often], np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = MAX_TRAIN, limit_bytes: int = MAX_TRAIN_BYTES) -> MilModel:
    """Fit on :func:`sample_texts`; the driver gets the vocabulary, and eight bytes for each occurrence of an entry."""
    tables = Tables(docs.sparkSession, "toxicity")
    picked = sample_texts(docs, labels, id_col, text_col, label_col, limit, limit_bytes, tables)
    vocabulary = vocabulary_of(picked)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for y, (hashes, first) in zip(batch.column(0).to_pylist(), _sentences_of(batch), strict=True):
                if len(hashes) and len(shared.value):
                    at, place = located(hashes, first, shared.value)
                    out.append((y, at.tobytes(), place.tobytes(), len(first)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.int64()), strict=True)], ["y", "at", "place", "n"])

    rows = iter(picked.mapInArrow(run, "y int, at binary, place binary, n long").collect())  # used up, the iterator lets its list go
    documents = [(r.y, np.frombuffer(r["at"], np.int32), np.frombuffer(r.place, np.int32), r.n) for r in rows]
    tables.clear()
    return fit(documents, vocabulary)


def _scored(docs: DataFrame, model: MilModel, id_col: str, text_col: str, schema: str, emit) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in sliced(batches):
            data, offsets = buffer_of(batch.column(1))
            for lo, hi in row_slices(offsets):
                part, inner = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                hashes, first, rows, spans = sentences(part, inner)
                z = fitted.bias + segment_sums(fitted.word_weights(hashes), first)
                yield emit(batch.column(0).slice(lo, hi - lo), part, inner, rows, spans, z, fitted.leak)

    narrow = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, schema)


def _noisy_or(z: np.ndarray, rows: np.ndarray, n: int, leak: float) -> np.ndarray:
    """Scores of n documents from the logits of their sentences; ``rows`` names each sentence's document, ascending."""
    first = np.searchsorted(rows, np.arange(n))
    return np.clip(1.0 - (1.0 - leak) * np.exp(-segment_sums(_softplus(z), first)), 0.0, 1.0)


def score(docs: DataFrame, model: MilModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, n_sentences and the byte span of the highest-scored sentence of every row."""

    def emit(ids, part, inner, rows, spans, z, leak):
        n = len(ids)
        first = np.searchsorted(rows, np.arange(n))
        count = np.bincount(rows, minlength=n)
        scores = _noisy_or(z, rows, n, leak)
        best = np.zeros(n, np.int64)
        if len(z):
            order = np.lexsort((spans[0], -z, rows))
            some = count > 0
            best[some] = order[first[some]]
        begins = spans[0][best] - inner[:-1] if len(z) else best
        ends = spans[1][best] - inner[:-1] if len(z) else best
        none = count == 0
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(count.astype(np.int64)), pa.array(begins.astype(np.int64), mask=none), pa.array(ends.astype(np.int64), mask=none)],
            ["doc_id", "score", "predicted", "n_sentences", "worst_start", "worst_end"],
        )

    return _scored(docs, model, id_col, text_col, "doc_id long, score double, predicted int, n_sentences long, worst_start long, worst_end long", emit)


def kept(docs: DataFrame, model: MilModel, below: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is under ``below``, with all their columns; a filter that neither joins nor adds a name."""
    where = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in sliced(batches):
            data, offsets = buffer_of(batch.column(where))
            scores = np.empty(batch.num_rows)
            for lo, hi in row_slices(offsets):
                hashes, first, rows, _ = sentences(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                z = fitted.bias + segment_sums(fitted.word_weights(hashes), first)
                scores[lo:hi] = _noisy_or(z, rows, hi - lo, fitted.leak)
            yield batch.filter(pa.array(scores < below))

    return small_batches(docs).mapInArrow(run, docs.schema)


def locate(docs: DataFrame, model: MilModel, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, byte span, score and text of every sentence whose own score reaches ``threshold``."""

    def emit(ids, part, inner, rows, spans, z, leak):
        scores = 1.0 / (1.0 + np.exp(-z))
        hit = np.flatnonzero(scores >= threshold)
        texts = [part[a:b].tobytes().decode("utf-8", "replace") for a, b in spans[:, hit].T]
        start, end = spans[:, hit] - inner[rows[hit]]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(rows[hit])), pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64)), pa.array(scores[hit]), pa.array(texts, pa.string())], ["doc_id", "start", "end", "score", "sentence"])

    return _scored(docs, model, id_col, text_col, "doc_id long, start long, end long, score double, sentence string", emit)
