"""Source divergence audit: how far the sources of a language differ in their terms, and which terms set a source apart.

Tasks count terms and documents of their texts by (lang, source) and flush bounded tables of counts; Spark adds them up by (lang, term),
so every kept term of a language is one row with its counts by source. Probabilities are integers (parts of 10^9), smoothed by ``SMOOTH``.

*Terms*: a term's value grows with its count in the group and falls with its count in the language, and ties go to the earlier term in
UTF-8. So a term that ``top`` others dominate (count in the group no lower, count in the language no higher, earlier in UTF-8) cannot be
among the first ``top``. Every partition retains its ``top``-skyband, the terms dominated by fewer than ``top`` others; retained terms are
dealt out by group and salt, their skybands merged, and only what is left is ranked, exactly. All dominators of an eligible term are
eligible, so terms at or below the language's probability go first.

*Pairs*: tasks hold a term's probabilities for up to ``BLOCK`` sources as a dense row and add up absolute differences for blocks of
sources; terms that neither source of a pair has are one product. The result has a row for each ordered pair of sources of a language, by
its contract.

Edge cases: null text, lang and source count as empty. Groups without kept terms take part with count 0; a language without kept terms has
pair values 0 and no terms. Repeated rows are documents of their own. Other columns are ignored; an empty table gives an empty result. A
term's row holds one entry for each source of the language, so a language's sources must fit a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables, sliced

UNIT, SMOOTH, LEAST_DOCS, TOP = 1_000_000_000, 5, 30, 50
#: Counted terms a task holds, sources of a dense row, matrices a task holds, salts of a group, rows of a chunk.
HELD, BLOCK, MATRICES, SALTS, CHUNK = 400_000, 512, 64, 64, 1024

_TERMS = bytearray(b" " * 128) + bytearray(range(128, 256))
_TERMS[65:91] = _TERMS[97:123] = bytes(range(97, 123))
_TERMS = bytes(_TERMS)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters of a UTF-8 text, A-Z in lower case."""
    return text.translate(_TERMS).split()


def _counts(docs: DataFrame, lang: Column, source: Column, text: Column) -> DataFrame:
    """lang, source, term, n (occurrences) and docs of whole texts, in parts; a null term with 0 stands for the group itself."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang_, source_), (seen, in_docs) in held.items():
            terms = [None, *seen]
            columns = [[lang_] * len(terms), [source_] * len(terms), terms, [0, *seen.values()], [0, *map(in_docs.__getitem__, seen)]]
            yield from pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema).to_batches(max_chunksize=10_000)
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in sliced(batches, 256):
            for key_lang, key_source, body in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), strict=True):
                seen, in_docs = held.setdefault((key_lang, key_source), (Counter(), Counter()))
                found = terms_of(body.as_py())
                seen.update(found)
                in_docs.update(set(found))
            if sum(len(s) for s, _ in held.values()) > HELD:
                yield from flush(held)
        yield from flush(held)

    none = F.lit("")
    rows = docs.select(F.coalesce(lang, none).alias("lang"), F.coalesce(source, none).alias("source"), F.coalesce(text, none).cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def kept_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term and cells (source, n) of terms in at least ``least_docs`` documents; the null term of a language has its sources."""
    parts = _counts(docs, F.col(lang_col), F.col(source_col), F.col(text_col)).repartition("lang", "term")
    by_source = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells"))
    return whole.where((F.col("docs") >= least_docs) | F.col("term").isNull()).select("lang", F.col("term").cast("string").alias("term"), "cells")


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * kept)); 0 if nothing is kept."""
    above = (n + SMOOTH).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + SMOOTH * kept).cast("decimal(20,0)")
    return F.when(kept > 0, 1 + F.call_function("div", above, below)).otherwise(F.lit(0).cast("long"))


def groups_of(kept: DataFrame) -> DataFrame:
    """lang, source, no (0, 1, ... by source), total (of the group), lang_total, kept (terms of the language) and none (share of an
    absent term) of every group."""
    terms = kept.where("term is not null")
    size = terms.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum(F.aggregate("cells", F.lit(0).cast("long"), lambda a, x: a + x["n"])).alias("lang_total"))
    every = kept.where("term is null").select("lang", F.inline("cells")).drop("n")
    found = every.join(size, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    numbered = found.withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    return numbered.withColumn("none", _share(F.lit(0).cast("long"), F.col("total"), F.col("kept")))


# Terms: dominance skyband.


def skyband(mine: np.ndarray, whole: np.ndarray, terms: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate: higher or equal in ``mine``, lower or equal in ``whole``, earlier in ``terms``.

    Rows come in chunks, sorted so that dominators stand before what they dominate. A row with k dominators has k dominators that are
    retained (the first k in that order), so retained rows are all that later chunks are compared with.
    """
    earlier = np.argsort(np.argsort(terms, kind="stable"), kind="stable")
    order = np.lexsort((earlier, whole, -mine))
    kept = np.empty(0, np.int64)
    for lo in range(0, len(order), CHUNK):
        new = order[lo : lo + CHUNK]
        both = np.concatenate([kept, new])
        above = (mine[both][:, None] >= mine[new]) & (whole[both][:, None] <= whole[new]) & (earlier[both][:, None] < earlier[new])
        kept = np.concatenate([kept, new[above.sum(axis=0) < k]])
    return kept


def _retained(rows: DataFrame, top: int) -> DataFrame:
    """The skyband of every group among the rows of each partition; columns stay."""

    def reduced(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.iloc[skyband(frame["n"].to_numpy(), frame["whole"].to_numpy(), np.array([t.encode() for t in frame["term"]], object), top)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list[pd.DataFrame]] = {}
        size: Counter = Counter()
        for frame in frames:
            for key, mine in frame.groupby(["lang", "source"], sort=False):
                held.setdefault(key, []).append(mine)
                size[key] += len(mine)
                if size[key] > 8 * CHUNK:  # retained rows and some chunks of new ones
                    held[key] = [reduced(pd.concat(held[key]))]
                    size[key] = max(0, 2 * len(held[key][0]) - 8 * CHUNK)  # a wide skyband waits for as many new rows
        for parts in held.values():
            yield reduced(pd.concat(parts))

    return rows.mapInPandas(run, rows.schema)


def _distinctive(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value and rank of the terms most above their language."""
    cells = kept.where("term is not null").select("lang", "term", F.aggregate("cells", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("whole"), F.inline("cells")).where("n > 0")
    shared = cells.join(groups, ["lang", "source"])
    value = _share(F.col("n"), F.col("total"), F.col("kept")) - _share(F.col("whole"), F.col("lang_total"), F.col("kept"))
    rows = shared.select("lang", "source", "term", "n", "whole", value.alias("value")).where("value > 0")
    merged = _retained(_retained(rows, top).repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS))), top)
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return merged.withColumn("rank", place).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


# Pairs of sources: sums of absolute differences over blocks.


def _dense(none: list, cells: list) -> np.ndarray:
    """Rows of shares by source of a block; ``none`` holds the share of an absent term."""
    out = np.tile(np.asarray(none, np.int64), (len(cells), 1))
    for row, some in zip(out, cells, strict=True):
        for c in some or ():
            row[c["k"]] = c["p"]
    return out


def _differences(rows: DataFrame) -> DataFrame:
    """lang, g, h, total and seen: differences of the sources (by number) of two blocks, added up over the rows of a partition."""
    shape = pa.schema([("lang", pa.string()), ("g", pa.int64()), ("h", pa.int64()), ("total", pa.int64()), ("seen", pa.int64())])

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, i, j), (total, seen) in held.items():
            g, h = (x.ravel() for x in np.indices(total.shape))
            g, h, total = g + i * BLOCK, h + j * BLOCK, total.ravel()
            use = g < h
            yield pa.RecordBatch.from_arrays([pa.array([lang] * int(use.sum()), pa.string()), pa.array(g[use]), pa.array(h[use]), pa.array(total[use]), pa.array(np.full(int(use.sum()), seen))], schema=shape)
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in sliced(batches, 256):
            by: dict = {}
            for r in batch.to_pylist():
                by.setdefault((r["lang"], r["i"], r["j"]), []).append(r)
            for key, rs in by.items():
                a, b = (_dense(rs[0][f"none_{s}"], [r[f"cells_{s}"] for r in rs]) for s in "ij")
                if key not in held and len(held) == MATRICES:
                    yield from flush(held)
                total, seen = held.get(key, (np.zeros((a.shape[1], b.shape[1]), np.int64), 0))
                for g in range(a.shape[1]):
                    total[g] += np.abs(b - a[:, g : g + 1]).sum(axis=0)
                held[key] = (total, seen + len(rs))
        yield from flush(held)

    return rows.mapInArrow(run, "lang string, g long, h long, total long, seen long").groupBy("lang", "g", "h").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen"))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value and rank of every ordered pair of a language's sources."""
    placed = groups.withColumns({"b": F.floor(F.col("no") / BLOCK).cast("int"), "k": (F.col("no") % BLOCK).cast("int")})
    cells = kept.where("term is not null").select("lang", "term", F.inline("cells")).where("n > 0").join(placed, ["lang", "source"])
    cells = cells.select("lang", "term", "b", F.struct("k", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p")).alias("cell"))
    blocks = cells.groupBy("lang", "term", "b").agg(F.collect_list("cell").alias("cells")).groupBy("lang", "term").agg(F.map_from_entries(F.collect_list(F.struct("b", "cells"))).alias("by"))
    absent = placed.groupBy("lang", "b").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "none"))), lambda x: x["none"]).alias("none"))
    last = placed.groupBy("lang").agg(F.max("b").alias("last"))
    one = blocks.join(last, "lang").select("lang", "by", F.explode(F.map_keys("by")).alias("x"), F.sequence(F.lit(0), "last").alias("others"))
    two = one.select("lang", "by", "x", F.explode("others").alias("y")).where(~(F.map_contains_key("by", F.col("y")) & (F.col("y") < F.col("x"))))
    two = two.select("lang", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "by")
    two = two.select("lang", "i", "j", F.try_element_at("by", F.col("i")).alias("cells_i"), F.try_element_at("by", F.col("j")).alias("cells_j"))
    for side in "ij":
        two = two.join(absent.select("lang", F.col("b").alias(side), F.col("none").alias(f"none_{side}")), ["lang", side])
    found = _differences(two)
    both = found.unionByName(found.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "total", "seen"))
    a = groups.select("lang", "source", F.col("no").cast("long").alias("g"), F.col("none").alias("none_g"), "kept")
    b = groups.select("lang", F.col("source").alias("item"), F.col("no").cast("long").alias("h"), F.col("none").alias("none_h"))
    every = a.join(b, "lang").where("g != h").join(both, ["lang", "g", "h"], "left").na.fill(0, ["total", "seen"])
    value = F.col("total") + (F.col("kept") - F.col("seen")) * F.abs(F.col("none_g") - F.col("none_h"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return every.withColumn("value", value).withColumn("rank", place).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank."""
    tables = Tables(docs.sparkSession, "divergence")
    kept = tables.written(kept_terms(docs, lang_col, source_col, text_col, least_docs), "kept")
    groups = tables.written(groups_of(kept), "groups")
    return _pairs(kept, groups).unionByName(_distinctive(kept, groups, top))
