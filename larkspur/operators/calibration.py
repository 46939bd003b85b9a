"""Isotonic calibration: scores become the rates of the best non-decreasing step function, found by pooling adjacent violators.

Counts by (key, score) are pooled where they lie, range by range of score, and once more over what the ranges leave, as pooling in
parts and then over the pooled blocks gives the same blocks as pooling at once. Blocks of one key have increasing rates, so N rows
leave at most about N^(2/3) of them, and a task holds no more than the blocks of one key.

A null key is a key. Rows of a null or NaN score, or of a null outcome, are not learned from; they get no rate. A key without counts
has no blocks, and its scores get a null rate.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.sources.workdir import new_dir


def score_counts(df: DataFrame, key: str, score: str, positive: Column) -> DataFrame:
    """key, score, p and n (positive and other rows) of every distinct score of a key."""
    value = F.nanvl(F.col(score).cast("double"), F.lit(None)) + F.lit(0.0)  # -0.0 is 0.0
    rows = df.select(F.col(key).alias("key"), value.alias("score"), positive.alias("hit")).where("score is not null and hit is not null")
    return rows.groupBy("key", "score").agg(F.count_if("hit").alias("p"), F.count_if(~F.col("hit")).alias("n"))


def _pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, low, high, p, n) sorted by key and low, with adjacent violators of a key made one row."""
    key, blocks = None, []

    def out() -> pd.DataFrame:
        return pd.DataFrame([(key, *b) for b in blocks], columns=["key", "low", "high", "p", "n"])

    for batch in batches:
        for k, low, high, p, n in zip(*(batch[c].tolist() for c in ("key", "low", "high", "p", "n")), strict=True):
            if k != key:
                if blocks:
                    yield out()
                key, blocks = k, []
            # whole numbers, so equal rates are found to be equal: p / (p + n) of the block before >= that of this one
            while blocks and blocks[-1][2] * n >= p * blocks[-1][3]:
                before = blocks.pop()
                low, p, n = before[0], p + before[2], n + before[3]
            blocks.append((low, high, p, n))
    if blocks:
        yield out()


def isotonic_blocks(counts: DataFrame, parts: int | None = None) -> DataFrame:
    """key, low, high (least and greatest score), p, n and rate of the blocks of every key, from :func:`score_counts`.

    Equal rates are one block. ``parts`` are the ranges of score pooled at first (else the session's shuffle partitions).
    """
    ranges = parts or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Keys are pooled as text; null is told apart by a prefix.
    kind = counts.schema["key"].dataType
    keyed = counts.select(F.coalesce(F.concat(F.lit("="), F.col("key").cast("string")), F.lit("")).alias("key"), F.col("score").alias("low"), F.col("score").alias("high"), "p", "n")
    schema = "key string, low double, high double, p long, n long"
    first = keyed.repartitionByRange(ranges, "key", "low").sortWithinPartitions("key", "low").mapInPandas(_pooled, schema)
    whole = first.repartition("key").sortWithinPartitions("key", "low").mapInPandas(_pooled, schema)
    key = F.when(F.col("key") != "", F.expr("substring(key, 2)")).cast(kind).alias("key")
    return whole.select(key, "low", "high", "p", "n", (F.col("p") / (F.col("p") + F.col("n"))).alias("rate"))


def with_rate(counts: DataFrame, blocks: DataFrame, parts: int | None = None) -> DataFrame:
    """``counts`` (key, score and more) with rate: that of the last block that starts at or below the score, else of the first one.

    Both are stored in ranges of (key, score). The last block is looked up inside a range; what a range must know of those before it
    is one row for each range and key in it.
    """
    spark = counts.sparkSession
    ranges = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    extra = [c for c in counts.columns if c not in ("key", "score")]
    packed = F.struct(*[F.col(c) for c in extra]) if extra else F.struct(F.lit(0).alias("_"))
    rows = counts.select("key", "score", F.lit(1).alias("side"), F.lit(None).cast("double").alias("_rate"), packed.alias("_more"))
    marks = blocks.select("key", F.col("low").alias("score"), F.lit(0).alias("side"), F.col("rate").alias("_rate"), F.lit(None).cast(rows.schema["_more"].dataType).alias("_more"))
    both = rows.unionByName(marks).repartitionByRange(ranges, "key", "score").withColumn("part", F.spark_partition_id())
    path = new_dir(spark, "isotonic")
    schema = both.schema
    both.write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    ends = stored.groupBy("key", "part").agg(F.max_by("_rate", F.when(F.col("side") == 0, F.col("score"))).alias("_last"), F.min_by("_rate", F.when(F.col("side") == 0, F.col("score"))).alias("_least"))
    by_part = Window.partitionBy("key").orderBy("part")
    carried = ends.select(
        F.col("key").alias("_k"), F.col("part").alias("_part"),
        F.last("_last", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("_in"),
        F.first("_least", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_first"),
    )
    inside = Window.partitionBy("key", "part").orderBy("score", "side").rowsBetween(Window.unboundedPreceding, 0)
    found = stored.withColumn("_now", F.last("_rate", ignorenulls=True).over(inside)).where("side = 1")
    joined = found.join(carried, found["key"].eqNullSafe(carried["_k"]) & (found["part"] == carried["_part"]))
    return joined.select("key", "score", *[F.col(f"_more.`{c}`").alias(c) for c in extra], F.coalesce("_now", "_in", "_first").alias("rate"))
