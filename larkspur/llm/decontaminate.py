"""Benchmark decontamination with a distributed positional inverted index, in DataFrame functions only.

The index has one row (term, row, pos) for every word of the corpus, written once: each task keeps the documents it has read as a
shard, sorted by term, so the build shuffles nothing and a list of postings is a run of each shard. Term -1 carries the documents
themselves (their id, and their length as pos). ``terms`` restricts the stored words to a vocabulary; postings of words that no
test item holds cannot be part of an answer.

A test item matches along *alignments*: word j of the item at word ``delta + j`` of a document. Each window of the item starts from
the list of its rarest term; the adjusted list ``pos - j`` gives alignments, which are intersected with the adjusted list of its second
rarest term, and those still left with the lists of all its other terms. Windows that overlap share their terms' positions, so an
alignment probes a position once and not once a window. Runs of matched positions that are as long as a window are occurrences.

No key is a document or a term alone: lists meet by (term, row, pos) or (row, item, delta). The only tables that may be sent whole are
those of the test items; Spark does so while they are below its broadcast threshold, by their stored size, and merges beyond it.

Edge cases: null and empty texts have no words and no hits; items without words never occur; an item of fewer than ``WIDTH`` words is one
window of all its words. Repeated documents get a row each, repeated item ids count once, a null item id counts as the empty text.
Items of equal words are searched once. Other columns are ignored; empty tables give empty results or no hits.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables

WIDTH = 10
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCUMENT = -1  # term of the rows that stand for documents


@dataclass
class Index:
    """postings (term, row, pos), documents (row, id, n_words) and dictionary (word, term)."""

    postings: DataFrame
    documents: DataFrame
    dictionary: DataFrame


def _split(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(text, _SEPARATORS), ""), F.array().cast("array<string>"))


def _lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Words of a text in lower case; none for null."""
    return F.transform(_split(text), _lowered)


def build(tables: Tables, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: DataFrame | None = None) -> Index:
    """The index of whole ``docs``; ``terms`` (word) names the words to store, all if it is None."""
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), _split(F.col(text_col)).alias("w"))
    if terms is None:
        terms = found.select(F.explode("w").alias("word")).select(_lowered(F.col("word")).alias("word"))
    dictionary = tables.written(terms.select("word").where("word is not null").distinct().select("word", F.monotonically_increasing_id().alias("term")), "dictionary")
    # Place 0 is the document itself, a null word; the words follow.
    placed = found.select("row", "id", F.size("w").alias("n"), F.posexplode(F.concat(F.array(F.lit(None).cast("string")), "w")).alias("at", "raw"))
    known = placed.select("row", "id", "n", "at", _lowered(F.col("raw")).alias("word")).join(dictionary, "word", "left").where("at = 0 or term is not null")
    head = F.col("at") == 0
    rows = known.select(F.coalesce("term", F.lit(DOCUMENT).cast("long")).alias("term"), "row", F.when(head, F.col("n")).otherwise(F.col("at") - 1).alias("pos"), F.when(head, F.col("id")).alias("id"))
    stored = tables.written(rows.sortWithinPartitions("term", "row", "pos"), "postings")
    heads = stored.where(F.col("term") == DOCUMENT)
    return Index(stored.where(F.col("term") != DOCUMENT).select("term", "row", "pos"), heads.select("row", "id", F.col("pos").cast("long").alias("n_words")), dictionary)


def _frequencies(index: Index, wanted: DataFrame) -> DataFrame:
    """term and n (postings) of the terms in ``wanted``."""
    return index.postings.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def _plan(tables: Tables, index: Index, items: DataFrame, width: int) -> DataFrame:
    """What to look up for ``items`` (item, words): for each pair of an item's places that are rarest and second rarest of some window,
    their terms and all places (with terms) of those windows."""
    placed = items.select("item", F.posexplode("words").alias("j", "word")).join(index.dictionary, "word", "left")
    placed = tables.written(placed.select("item", "j", "term"), "item-terms")
    counted = placed.join(_frequencies(index, placed), "term", "left")
    whole = counted.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("j", "term", F.coalesce("n", F.lit(0)).alias("n")))).alias("ts"))
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("ts") - width, F.lit(0)))).alias("i")
    windows = whole.select("item", "ts", starts).select("item", F.slice("ts", F.col("i") + 1, width).alias("part"))
    ranked = windows.withColumn("by", F.array_sort(F.transform("part", lambda x: F.struct(x["n"].alias("n"), x["j"].alias("j"), x["term"].alias("term")))))
    pairs = ranked.where(F.col("by")[0]["n"] > 0).select("item", F.get("by", 0).alias("a"), F.get("by", 1).alias("b"), F.transform("part", lambda x: F.struct(x["j"].alias("j"), x["term"].alias("term"))).alias("part"))
    pairs = pairs.groupBy("item", F.col("a.j").alias("j1"), F.col("a.term").alias("t1"), F.col("b.j").alias("j2"), F.col("b.term").alias("t2"))
    return tables.written(pairs.agg(F.array_distinct(F.flatten(F.collect_list("part"))).alias("need")).withColumn("pair", F.monotonically_increasing_id()), "plan")


def alignments(tables: Tables, index: Index, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """item, row, delta and matched (places of the item that agree, ascending) of the alignments on which some window's two rarest
    terms agree; every occurring window of ``items`` (item, words) lies in one of them."""
    plan = _plan(tables, index, items, width)
    first = index.postings.join(plan.select("t1", "j1", "t2", "j2", "item", "pair"), F.col("term") == F.col("t1"))
    first = first.select("item", "row", (F.col("pos") - F.col("j1")).alias("delta"), "t2", "j2", "pair")
    seconds = index.postings.join(plan.select(F.col("t2").alias("term")).distinct(), "term", "left_semi").select(F.col("term").alias("t2"), "row", (F.col("pos")).alias("at"))
    both = first.where("t2 is not null").withColumn("at", F.col("delta") + F.col("j2")).join(seconds, ["row", "at", "t2"]).select("item", "row", "delta", "pair")
    both = both.unionByName(first.where("t2 is null").select("item", "row", "delta", "pair"))
    met = tables.written(both.join(plan.select("pair", "need"), "pair").groupBy("item", "row", "delta").agg(F.array_distinct(F.flatten(F.collect_list("need"))).alias("need")), "met")
    asked = met.select("item", "row", "delta", F.inline("need")).withColumn("pos", F.col("delta") + F.col("j"))
    near = index.postings.join(met.select("row").distinct(), "row", "left_semi")
    found = asked.join(near, ["row", "pos", "term"])
    return found.groupBy("item", "row", "delta").agg(F.sort_array(F.collect_set("j")).alias("matched"))


def occurrences(aligned: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """item, row, first and end (exclusive): maximal stretches of a document that windows of the item cover along one alignment."""
    sized = aligned.join(items.select("item", F.least(F.size("words"), F.lit(width)).alias("len")), "item")
    full = lambda k: (F.get("matched", k + F.col("len") - 1) - F.get("matched", k)) == F.col("len") - 1
    last = F.size("matched") - F.col("len")
    starts = F.when(last >= 0, F.transform(F.filter(F.sequence(F.lit(0), last), full), lambda k: F.get("matched", k)))
    held = sized.where(last >= 0).select("item", "row", "delta", "len", starts.alias("s")).where(F.size("s") > 0)
    begins = F.filter("s", lambda x, i: (i == 0) | (F.get("s", i - 1) != x - 1))
    ends = F.filter("s", lambda x, i: (i == F.size("s") - 1) | (F.get("s", i + 1) != x + 1))
    runs = held.select("item", "row", "delta", "len", F.inline(F.arrays_zip(begins.alias("b"), ends.alias("e"))).alias("b", "e"))
    return runs.select("item", "row", (F.col("delta") + F.col("b")).alias("first"), (F.col("delta") + F.col("e") + F.col("len")).alias("end"))


def _covered(stretches: Column) -> Column:
    """Words in the union of sorted (first, end)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, x: F.struct(F.greatest(acc["end"], x["end"]).alias("end"), (acc["n"] + F.greatest(x["end"] - F.greatest(acc["end"], x["first"]), F.lit(0))).alias("n"))
    return F.aggregate(stretches, zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of ``docs``."""
    tables = Tables(docs.sparkSession, "decontaminate")
    held = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), words(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    items = tables.written(held.groupBy("words").agg(F.collect_set("id").alias("ids")).withColumn("item", F.monotonically_increasing_id()), "items")
    index = build(tables, docs, id_col, text_col, items.select(F.explode("words").alias("word")))
    hits = tables.written(occurrences(alignments(tables, index, items, width), items, width), "hits")
    covered = hits.groupBy("row").agg(_covered(F.sort_array(F.collect_set(F.struct("first", "end")))).alias("n_hit"))
    named = hits.select("row", "item").distinct().join(items.select("item", "ids"), "item").groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))
    found = index.documents.join(covered.join(named, "row"), "row", "left")
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def proximity(index: Index, queries: DataFrame, span: int) -> DataFrame:
    """query, row and start: every place of one of the query's words from which all its (distinct) words occur within ``span`` words.

    ``queries`` has query and words. The rarest term's places name blocks of ``span`` words; postings of the other terms meet them by
    (query, row, block), so a window holds the postings of two blocks. A query with a word that the index lacks matches nothing.
    """
    asked = queries.select("query", F.explode(F.array_distinct("words")).alias("word")).join(index.dictionary, "word", "left")
    asked = asked.join(_frequencies(index, asked), "term", "left")
    size = asked.groupBy("query").agg(F.count("*").alias("k"), F.min(F.coalesce("n", F.lit(0))).alias("least"), F.min_by("term", F.struct("n", "term")).alias("rarest")).where("least > 0")
    anchors = index.postings.join(size.select("query", F.col("rarest").alias("term")), "term").select("query", "row", F.floor(F.col("pos") / span).alias("b"))
    zones = anchors.select("query", "row", F.explode(F.array(F.col("b") - 1, F.col("b"))).alias("zone")).distinct()
    terms = index.postings.join(asked.join(size.select("query", "k"), "query").select("query", "k", "term"), "term").withColumn("b", F.floor(F.col("pos") / span))
    spread = terms.select("query", "k", "term", "row", "pos", "b", F.explode(F.array(F.col("b"), F.col("b") - 1)).alias("zone")).join(zones, ["query", "row", "zone"])
    ahead = Window.partitionBy("query", "row", "zone").orderBy("pos").rangeBetween(0, span - 1)
    seen = spread.withColumn("all", F.size(F.collect_set("term").over(ahead)) == F.col("k")).where("all and b = zone")
    return seen.select("query", "row", F.col("pos").alias("start")).distinct()
