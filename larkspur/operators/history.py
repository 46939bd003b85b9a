"""Validity intervals of versioned rows: which version of a key held when.

A version table keeps every observation of a key, with ``row_hash`` (of the values), ``is_change`` (the values differ from the key's
observation before), ``valid_from`` and ``valid_to`` (exclusive, null while open; null in observations that change nothing). Observations that
change nothing stay, because a late one between two equal ones splits their interval. Time is cut into spans, so no window is a whole
key: what a span must know of its neighbours is carried as one row for each key and span.

Edge cases: a null key or time is no observation. Observations of equal time are one: the one whose values sort last. Null values are
values. An empty table gives an empty history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.operators.temporal import SPAN_SECONDS, as_of_join, span_of
from larkspur.sources.readers import read_if_there

HASH, CHANGE, FROM, TO, BUCKET = "row_hash", "is_change", "valid_from", "valid_to", "bucket"
_OWN = (HASH, CHANGE, FROM, TO, BUCKET)


def build_history(versions: DataFrame, key: str, time_col: str, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """The version table of ``versions``; columns this module adds are computed anew."""
    values = [c for c in versions.columns if c not in (key, time_col, *_OWN)]
    rows = versions.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    rows = rows.groupBy(key, time_col).agg(F.max(F.struct(*values) if values else F.struct(F.lit(0).alias("_none"))).alias("_v"))
    rows = rows.withColumns({"_s": span_of(time_col, span_seconds), HASH: F.sha2(F.to_json("_v", {"ignoreNullFields": "false"}), 256)})
    inside, spans = Window.partitionBy(key, "_s").orderBy(time_col), Window.partitionBy(key).orderBy("_s")
    ends = rows.groupBy(key, "_s").agg(F.max_by(HASH, time_col).alias("_last"))
    ends = ends.select(key, "_s", F.lag("_last").over(spans).alias("_before"))
    marked = rows.join(ends, [key, "_s"]).withColumn("_prior", F.coalesce(F.lag(HASH).over(inside), "_before"))
    marked = marked.withColumn(CHANGE, ~F.col(HASH).eqNullSafe(F.col("_prior"))).drop("_before", "_prior")
    # The next change of a span, else the first change of the next span that has one.
    heads = marked.groupBy(key, "_s").agg(F.min(F.when(F.col(CHANGE), F.col(time_col))).alias("_first"))
    later = spans.rowsBetween(1, Window.unboundedFollowing)
    heads = heads.select(key, "_s", F.first("_first", ignorenulls=True).over(later).alias("_after"))
    ahead = inside.rowsBetween(1, Window.unboundedFollowing)
    following = F.coalesce(F.first(F.when(F.col(CHANGE), F.col(time_col)), ignorenulls=True).over(ahead), F.col("_after"))
    closed = marked.join(heads, [key, "_s"]).withColumn("_next", following)
    out = [F.col(f"_v.`{c}`").alias(c) for c in values]
    return closed.select(key, time_col, *out, HASH, CHANGE, F.when(F.col(CHANGE), F.col(time_col)).alias(FROM), F.when(F.col(CHANGE), F.col("_next")).alias(TO))


def update_history(spark: SparkSession, path: str, arrived: DataFrame, key: str, time_col: str, buckets: int = 64, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Merge observations, early or late, into the version table stored at ``path``, and return it.

    The table has one folder for each bucket of keys. Only buckets that hold an arrived key are read and replaced; of
    these only arrived keys are computed anew. Merging the same observations again changes nothing, so a load that broke off is repeated.
    """
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    arrived = arrived.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
    touched = [r[0] for r in arrived.select(bucket.alias("b")).distinct().collect()]  # buckets at most
    stored = read_if_there(spark, path)
    if stored is None:
        merged = build_history(arrived, key, time_col, span_seconds)
    else:
        near = stored.where(F.col(BUCKET).isin(touched))
        keys = arrived.select(F.col(key).alias("_key")).distinct()
        on = near[key] == keys["_key"]
        known = near.join(keys, on, "left_semi").drop(*_OWN)
        rest = near.join(keys, on, "left_anti").drop(BUCKET)
        merged = build_history(known.unionByName(arrived.drop(*_OWN), allowMissingColumns=True), key, time_col, span_seconds).unionByName(rest, allowMissingColumns=True)
    if touched:
        merged.withColumn(BUCKET, bucket).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    back = read_if_there(spark, path)
    return merged if back is None else back.withColumn(BUCKET, F.col(BUCKET).cast("int"))


def enrich_as_of(events: DataFrame, history: DataFrame, key: str, event_time: str, prefix: str = "", backfill: bool = False, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Every event with the values (prefixed) that were valid at its time, with valid_from and valid_to.

    With ``backfill`` a key's first version also holds for events before it, or without a time, marked by ``is_backfilled``; without
    it they stay unmatched.
    """
    known = history.where(CHANGE).drop(HASH, CHANGE, BUCKET)
    marked = known.columns
    if not backfill:
        joined = as_of_join(events, known.withColumn("_from", F.col(FROM)), key, event_time, "_from", prefix="_v_", span_seconds=span_seconds)
    else:
        since = F.lit("0001-01-01").cast("timestamp")
        starts = known.groupBy(key).agg(F.min(FROM).alias("_start")).withColumnRenamed(key, "_k")
        effective = F.when(F.col(FROM) == F.col("_start"), since).otherwise(F.col(FROM))
        timed = known.join(starts, known[key] == F.col("_k")).withColumn("_from", effective).drop("_k", "_start")
        asked = events.withColumn("_asked", F.greatest(F.col(event_time).cast("timestamp"), since))  # without a time: since
        joined = as_of_join(asked, timed, key, "_asked", "_from", prefix="_v_", span_seconds=span_seconds)
    added = [F.col(f"`_v_{c}`").alias(f"{prefix}{c}") for c in marked if c != key]
    late = [F.coalesce(F.col(event_time).isNull() | (F.col(event_time).cast("timestamp") < F.col(f"_v_{FROM}")), F.lit(False)).alias("is_backfilled")] if backfill else []
    if late:
        late = [(late[0] & F.col(f"_v_{FROM}").isNotNull()).alias("is_backfilled")]
    return joined.select(*[F.col(f"`{c}`") for c in events.columns], *added, *late)
