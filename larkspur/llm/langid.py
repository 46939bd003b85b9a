"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every labelled training text is counted whole, on the executors: a task adds up one count vector of ``BUCKETS`` hashed 1- to
``MAX_N``-grams for each language it meets, and Spark sums the vectors. The model (buckets x languages of log-probabilities,
a size that does not grow with the rows) is broadcast, and each batch is scored with numpy: gather and segment sums.

A broadcast matrix holds ``BLOCK`` languages at most (64 MB). More languages make several blocks, which are scored one after
the other; best score and sum of likelihoods go from block to block, so the result is that of one matrix. Counts stay in a table, from which
the driver reads one block at a time, so its memory does not grow with the number of languages; each block but the last costs a
written table of the rows, of which the last one stays.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so is everything if no language was learned.
Rows without lang are not learned from; a null doc_id counts as held out. Long texts are scored in overlapping pieces whose
sums are exact. Equal scores go to the language that sorts first. Repeated rows get equal results, other columns are
ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables, sliced, small_batches
from larkspur.llm.toxicity import held_out

BUCKETS, MAX_N = 1 << 15, 3
SMOOTHING = 0.5
UNKNOWN = "und"
_PIECE = 1 << 18  # characters worked on at once
_MANY = 64  # languages a task holds vectors for before it passes them on, or the driver collects at once
BLOCK = 512
_LETTER = re.compile(r"[^\W\d_]")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _buckets(codes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each position."""
    h = codes[: len(codes) - n + 1] + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
    for j in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[j : len(codes) - n + 1 + j]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35)
    return (h >> np.uint32(32 - 15)).astype(np.int32)


def _pieces(codes: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Pieces with the n-gram starts that belong to them: each overlaps the next by MAX_N - 1 characters."""
    for lo in range(0, max(len(codes), 1), _PIECE):
        own = min(_PIECE, len(codes) - lo)
        yield codes[lo : lo + _PIECE + MAX_N - 1], own


def ngram_counts(texts: list[np.ndarray]) -> np.ndarray:
    """Counts of the 1- to MAX_N-grams of texts by bucket; no n-gram reaches from one text into the next."""
    total = np.zeros(BUCKETS, np.int64)
    if len(texts) == 1:
        for piece, own in _pieces(texts[0]):
            for n in range(1, MAX_N + 1):
                if len(piece) >= n:
                    total += np.bincount(_buckets(piece, n)[:own], minlength=BUCKETS)
        return total
    codes = np.concatenate(texts)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    for n in range(1, MAX_N + 1):
        if len(codes) >= n:
            at = _buckets(codes, n)
            whole = np.ones(len(codes), bool)
            for j in range(1, n):
                whole[(ends - j)[ends - j >= starts]] = False
            total += np.bincount(at[whole[: len(at)]], minlength=BUCKETS)
    return total


@dataclass
class NaiveBayes:
    """One block of a model: its languages in order of name, and their log-probabilities of buckets and of themselves."""

    languages: list[str]
    log_prob: np.ndarray  # languages x buckets, float32
    log_prior: np.ndarray

    def score(self, texts: list[str | None], before: list[tuple] | None = None) -> list[tuple[str | None, float, float]]:
        """For each text the likeliest language, its log-likelihood, and the log of the sum of all likelihoods.

        ``before`` holds the same of earlier blocks (languages that sort first). A text without a letter has (None, 0, 0).
        """
        out: list[tuple] = [(None, 0.0, 0.0)] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        batch: list[tuple[int, np.ndarray]] = []
        held = 0

        def settle() -> None:
            if not batch:
                return
            totals = self._totals([c for _, c in batch])
            best = totals.argmax(axis=0)
            top = totals[best, np.arange(len(batch))]
            every = top + np.log(np.exp(totals - top).sum(axis=0))
            for (i, _), b, t, e in zip(batch, best.tolist(), top.tolist(), every.tolist(), strict=True):
                out[i] = (self.languages[b], t, e)
                if before is not None and before[i][0] is not None:
                    lang, high, total = before[i]
                    out[i] = ((lang, high) if high >= t else out[i][:2]) + (float(np.logaddexp(total, e)),)
            batch.clear()

        for i in rows:
            codes = _codes(texts[i])
            batch.append((i, codes))
            held += len(codes)
            if held >= _PIECE:
                settle()
                held = 0
        settle()
        return out

    def _totals(self, texts: list[np.ndarray]) -> np.ndarray:
        totals = np.repeat(self.log_prior[:, None], len(texts), axis=1)
        if len(texts) == 1 and len(texts[0]) > _PIECE:
            for piece, own in _pieces(texts[0]):
                for n in range(1, MAX_N + 1):
                    if len(piece) >= n:
                        totals[:, 0] += self.log_prob[:, _buckets(piece, n)[:own]].sum(axis=1, dtype=np.float64)
            return totals
        codes = np.concatenate(texts)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        for n in range(1, MAX_N + 1):
            if len(codes) < n:
                continue
            at = _buckets(codes, n)
            begin = np.minimum(starts, len(at))
            stop = np.maximum(np.minimum(ends - n + 1, len(at)), begin)  # n-grams do not cross texts
            edges = np.stack([begin, stop], axis=1).ravel()
            for k in range(len(self.languages)):
                sums = np.concatenate([[0.0], np.cumsum(self.log_prob[k][at], dtype=np.float64)])
                totals[k] += sums[edges[1::2]] - sums[edges[::2]]
        return totals


class Blocks:
    """A model of any number of languages: a sequence of blocks in order of name, each read from the table of counts when it is asked for.

    The table has lang, bucket, n and slice; ``width`` languages are a slice, a folder of its own. Bucket -1 has a language's documents.
    """

    def __init__(self, counted: DataFrame, languages: int, documents: int, width: int) -> None:
        self.counted, self.documents, self.width = counted, documents, width
        self.slices, self.together = -(-languages // width), max(BLOCK // width, 1)

    def __len__(self) -> int:
        return -(-self.slices // self.together)

    def __getitem__(self, k: int) -> NaiveBayes:
        if not 0 <= k < len(self):
            raise IndexError(k)
        names, seen, rows = [], [], []
        for at in range(k * self.together, min((k + 1) * self.together, self.slices)):
            grouped = self.counted.where(F.col("slice") == at).groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
            for r in sorted(grouped.collect()):  # at most ``width`` languages, with at most BUCKETS + 1 pairs each
                counts = np.zeros(BUCKETS + 1)
                counts[r["at"]] = r["n"]  # -1: the last
                names.append(r.lang)
                seen.append(counts[-1])
                rows.append(np.log((counts[:-1] + SMOOTHING) / (counts[:-1].sum() + SMOOTHING * BUCKETS)).astype(np.float32))
        return NaiveBayes(names, np.stack(rows), np.log(np.array(seen) / self.documents))


def _in_slices(counted: DataFrame, tables: Tables, width: int) -> Blocks:
    """The counts in a folder for each ``width`` languages, which are numbered in order of name: inside ranges, then by the ranges before."""
    spark = counted.sparkSession
    ranged = counted.where("bucket < 0").select("lang", "n").repartitionByRange("lang").withColumn("part", F.spark_partition_id())
    names = tables.written(ranged, "names")
    offsets, total, documents = [], 0, 0
    for r in sorted(names.groupBy("part").agg(F.count("*").alias("languages"), F.sum("n").alias("documents")).collect()):  # a row for each range
        offsets.append((r.part, total))
        total, documents = total + r.languages, documents + r.documents
    before = F.broadcast(spark.createDataFrame(offsets, "part int, before long"))
    number = F.row_number().over(Window.partitionBy("part").orderBy("lang")) - 1 + F.col("before")
    numbered = names.join(before, "part").select("lang", F.floor(number / width).cast("int").alias("slice"))
    path = f"{tables.base}/slices"
    counted.join(numbered, "lang").repartition("slice").write.partitionBy("slice").parquet(path)
    tables.drop(names)
    return Blocks(spark.read.schema("lang string, bucket int, n long, slice int").parquet(path), total, documents, width)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Sequence[NaiveBayes]:
    """Count all labelled texts outside the held-out fold; the model in blocks of languages, the only one of which is held already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs_seen: dict[str, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in sums.items():
                at = np.flatnonzero(counts)
                buckets = np.append(at, -1)
                values = np.append(counts[at], docs_seen[lang])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(buckets), pa.string()), pa.array(buckets.astype(np.int32)), pa.array(values)], ["lang", "bucket", "n"])
            sums.clear()
            docs_seen.clear()

        for batch in sliced(batches):
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in sums:
                    if len(sums) >= _MANY:
                        yield from out()
                    sums[lang], docs_seen[lang] = np.zeros(BUCKETS, np.int64), 0
                docs_seen[lang] += 1
                held.setdefault(lang, []).append(_codes(text))
                if len(held[lang][-1]) > _PIECE or len(held[lang]) >= 64:
                    sums[lang] += ngram_counts(held.pop(lang))
            for lang, rest in held.items():
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                docs_seen.setdefault(lang, 0)
                sums[lang] += ngram_counts(rest)
        yield from out()

    labelled = small_batches(docs).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    labelled = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counted = labelled.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    tables = Tables(docs.sparkSession, "langid")
    counted = tables.written(counted, "counts")
    model = _in_slices(counted, tables, min(_MANY, BLOCK))
    tables.drop(counted)
    if len(model) > 1:
        return model
    held = list(model)
    tables.clear()
    return held


_FOUND = "lang string, top double, total double"
_EMPTY = NaiveBayes([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))


def _with_best(docs: DataFrame, model: Sequence[NaiveBayes], text_col: str, shown: str | None) -> DataFrame:
    """doc (a struct of all columns of ``docs``, or only column ``shown``) with lang, top and total over all blocks.

    Each block but the last is a written table, which goes once the next one is there.
    """
    rows = small_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    where, out = docs.columns.index(text_col), None if shown is None else docs.columns.index(shown)
    whole = docs.schema.simpleString()
    tables, earlier, shared = Tables(docs.sparkSession, "langid-blocks"), None, None
    for k, block in enumerate(model or [_EMPTY]):
        if k:
            rows = tables.written(rows, "block")
            shared.destroy()
            if earlier is not None:
                tables.drop(earlier)
            earlier = rows
        shared = rows.sparkSession.sparkContext.broadcast(block)
        last = k == max(len(model), 1) - 1
        part = out if last else None

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first: bool = k == 0, part: int | None = part) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                doc = batch.column(0)
                before = None if first else list(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True))
                found = shared.value.score(pc.struct_field(doc, [where]).to_pylist(), before)
                lang, top, total = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([doc if part is None else pc.struct_field(doc, [part]), pa.array(lang, pa.string()), pa.array(top, pa.float64()), pa.array(total, pa.float64())], ["doc", "lang", "top", "total"])

        kind = whole if part is None else docs.schema.fields[part].dataType.simpleString()
        rows = rows.mapInArrow(run, f"doc {kind}, {_FOUND}")
    return rows


def identify(docs: DataFrame, model: Sequence[NaiveBayes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (posterior of that language) of every row; no shuffle."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _with_best(narrow, model, "text", "doc_id")
    score = F.when(F.col("lang").isNull(), 0.0).otherwise(F.least(F.exp(F.col("top") - F.col("total")), F.lit(1.0)))
    return found.select(F.col("doc").alias("doc_id"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def kept(docs: DataFrame, model: Sequence[NaiveBayes], least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a language of posterior ``least`` or more, with all their columns (one struct on the way)."""
    found = _with_best(docs, model, text_col, None)
    return found.where(F.col("lang").isNotNull() & (F.exp(F.col("top") - F.col("total")) >= least)).select("doc.*")
