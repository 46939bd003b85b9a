"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document gets the exponential key ``-ln(u) / quality`` with u from the md5 of its id, so runs repeat each other.
A source's target becomes complete epochs of all its documents and a rest. The rest goes to the documents with the smallest
keys, whose sizes are prefix-summed up to the budget; the document that crosses the budget gives the words still missing.

The prefix sum needs no sort of a source: keys are cut into ``SLICES`` ordered slices, slice totals are summed (partial
aggregation) and prefix-summed, and only the one slice in which a source's budget ends is sorted. A source that holds a
third of all rows is so spread over thousands of slices.

Targets: sources in code-point order, null last, have the weights 5, 2, 1, 5, ... of all words. No target passes
``MAX_REPEATS`` times its source's size; the excess is shared by weight among the others until none is above. In order of
size per weight the first sources are the capped ones, so one prefix sum over the source table finds the level.

Targets and cuts are windows over the table of sources, one short row each; the rows of documents meet in no window but a source's
one slice.

Edge cases: a null or empty text has size 0, takes 0 words and is copied with the complete epochs. A null doc_id hashes like
the empty string. Equal keys go by doc_id, then size; fully equal rows are interchangeable. A null quality counts as 1. Without any
word all targets are 0. An empty table gives an empty result; columns of the input named like results are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.scratch import written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SLICES = 4096
#: Up to so many sources (one short row each) the cuts go to every task and no document is shuffled; beyond it they are joined.
MAX_BROADCAST = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def sampling_key(id_col: str, quality: Column) -> Column:
    """Exponential key: small for documents drawn early."""
    digits = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((digits + 1) / F.lit(float(2**52 + 2))) / F.coalesce(quality, F.lit(1.0))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size and target from one row for each source (source, source_size)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    by_room = Window.orderBy(F.col("room"), F.col("source").asc_nulls_last())
    before, onward = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(repeats)).withColumn("room", F.col("cap") / F.col("weight"))
    levelled = weighed.withColumn("level", (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward))
    # The level at the first source that is not capped holds for it and all later ones; of equal rooms the first has the highest level.
    first = F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", (-F.col("level")).alias("minus")))).over(Window.partitionBy())
    out = levelled.withColumn("final", F.coalesce(-first["minus"], F.lit(float("inf"))))
    return out.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str | None = "text", size_col: str | None = None, quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target and taken (words the mix takes, repeats counted).

    Sizes come from ``size_col`` if given, else from the words of ``text_col``. ``docs`` is read twice: pass a table.
    """
    quality = F.lit(1.0) if quality is None else quality
    size = F.col(size_col).cast("long") if size_col else word_count(text_col)
    # The row travels as one struct, so no column of the input meets a name used here.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), sampling_key(id_col, quality).alias("key"))
    keyed = keyed.withColumn("slice", F.floor((1 - F.exp(-F.col("key"))) * SLICES).cast("int"))
    slices = keyed.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    targets = source_targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights, repeats)
    whole = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.select(F.col("source").alias("t_source"), "source_size", "target", epochs.alias("epochs"), (whole - epochs * F.col("source_size")).alias("budget"))
    prefix = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # at most SLICES rows
    summed = slices.withColumn("before", F.coalesce(F.sum("words").over(prefix), F.lit(0)))
    summed = summed.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
    # One row a source: the slice in which its budget ends, and the words before that slice.
    ends = F.min(F.when(F.col("before") + F.col("words") > F.col("budget"), F.struct("slice", "before"))).alias("end")
    cuts = summed.groupBy("t_source", "source_size", "target", "epochs", "budget").agg(ends)
    cuts = written(cuts, "mix-cuts")
    few = cuts.count() <= MAX_BROADCAST
    joined = keyed.join(F.broadcast(cuts) if few else cuts, F.col("source").eqNullSafe(F.col("t_source")))
    split = F.coalesce(F.col("slice") == F.col("end.slice"), F.lit(False))
    clear = joined.where(~split).withColumn("rest", F.when(F.coalesce(F.col("slice") > F.col("end.slice"), F.lit(False)), 0).otherwise(F.col("size")))
    # Inside the split slice, rows of one key, id and size are one group: groups before the budget's end are taken whole, and only the
    # rows of the one group in which a budget ends are numbered. So an id (or null) that very many rows share is no single task.
    same = ["source", "key", "id", "size"]
    groups = joined.where(split).groupBy(*same).agg(F.count("*").alias("n"), F.min("end.before").alias("before"))
    inside = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)  # groups of one slice
    groups = groups.withColumn("prior", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
    groups = groups.select(*[F.col(c).alias(f"g_{c}") for c in same], "n", "prior")
    placed = joined.where(split).join(groups, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in same])).drop(*[f"g_{c}" for c in same])
    last = (F.col("prior") < F.col("budget")) & (F.col("prior") + F.col("size") * F.col("n") > F.col("budget"))
    ready = placed.where(~last).withColumn("rest", F.when(F.col("prior") < F.col("budget"), F.col("size")).otherwise(F.lit(0).cast("long")))
    number = F.row_number().over(Window.partitionBy("source").orderBy("key")) - 1  # of equal rows
    left = F.col("budget") - F.col("prior") - F.col("size") * number
    crossed = ready.unionByName(placed.where(last).withColumn("rest", F.greatest(F.lit(0), F.least(F.col("size"), left)))).drop("n", "prior")
    # Copies for a table of documents: complete epochs, and the drawn ones once more (the crossing one if half of it is taken).
    copies = F.col("epochs") + (2 * F.col("rest") >= F.greatest(F.col("size"), F.lit(1))).cast("long")
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("size", "source_size", "target", "taken", "copies")]
    return clear.unionByName(crossed).select(*kept, "size", "source_size", "target", (F.col("size") * F.col("epochs") + F.col("rest")).alias("taken"), copies.alias("copies"))


def quality_of(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """doc_id and quality weight: 2 for labelled good, 0.5 for labelled bad, nothing for the rest; one row a document."""
    best = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("q_id")).agg(F.max(F.col(label_col).cast("int")).alias("q"))
    return best.select("q_id", F.when(F.col("q") > 0, 2.0).when(F.col("q") == 0, 0.5).alias("quality_weight"))


def mixed_copies(docs: DataFrame, quality: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; ``quality`` is what :func:`quality_of` returns.

    A row travels as one struct, so its columns may have any names. Rows meet their weights in a merge join at every size; there may be
    as many weights as rows, so neither side is broadcast.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("words"))
    weighed = written(rows.join(quality.hint("merge"), F.col("id") == F.col("q_id"), "left").drop("q_id"), "mix-weighed")
    mixed = mix(weighed, "id", "source", size_col="words", quality=F.col("quality_weight"))
    return mixed.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
