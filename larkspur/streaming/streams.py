"""Structured Streaming: the same transforms as in batch, restartable appends, rule checks and joins on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from larkspur.functions.projections import with_audit, with_path_partitions
from larkspur.operators.quality import apply_rules
from larkspur.operators.rules import Rule
from larkspur.operators.split import METRICS, Split, split_write
from larkspur.sources.readers import read_json, stream_json
from larkspur.sources.writers import stream_append


def bronze(df: DataFrame, partitions: bool = True) -> DataFrame:
    """Audit and, if asked, path partition columns; for batch frames and streams alike."""
    audited = with_audit(df)
    return with_path_partitions(audited) if partitions else audited


def batch_bronze(spark: SparkSession, landing: str, schema: StructType | str, partitions: bool = True) -> DataFrame:
    return bronze(read_json(spark, landing, schema), partitions)


def stream_bronze(spark: SparkSession, landing: str, schema: StructType | str, table: str, checkpoint: str, partition_by: list[str] | None = None, max_files: int = 1, available_now: bool = True, glob: str | None = None) -> StreamingQuery:
    """Append new landing files to a bronze table; one checkpoint a stream. ``glob`` selects folders."""
    rows = bronze(stream_json(spark, landing, schema, max_files, glob), partitions=True)
    return stream_append(rows, table, checkpoint, partition_by, available_now=available_now)


def run_streams(queries: list[StreamingQuery], timeout: int | None = None) -> None:
    """Wait until every stream has worked off its input, without a limit unless ``timeout`` (seconds in all) is given.

    A stream that still runs when a given time is up is an error (TimeoutError), as its table is not whole. Errors of streams are
    raised; whatever still runs then is stopped.
    """
    import time

    end = None if timeout is None else time.monotonic() + timeout
    try:
        for q in queries:
            if end is None:
                q.awaitTermination()
            elif not q.awaitTermination(max(1, int(end - time.monotonic()))):
                raise TimeoutError(f"a stream still had input after {timeout} seconds")
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def stream_silver(source: DataFrame, rules: list[Rule], clean: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Apply rules to a stream, with a clean and a quarantine sink.

    Every micro-batch replaces its own ``batch_id`` folder in both tables, so a batch that is repeated after a failure leaves no
    duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            checked = apply_rules(kept, rules)
            checked.clean.write.mode("overwrite").parquet(f"{clean}/batch_id={batch_id}")
            checked.quarantine.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_checked(source: DataFrame, rules: list[Rule], path: str, checkpoint: str) -> StreamingQuery:
    """Rules of every action on a stream, with their counts: each micro-batch is one scan and one write.

    A batch's rows (``rows``: clean and dead letters) and counts (``metrics``) are folders of their own, which a repeated batch replaces, so counts
    add up to those of a batch run over the same rows. A rule of action *fail* ends the stream before anything of the batch is visible; a
    restart begins with that batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        made = split_write(batch, rules, f"{path}/rows/batch_id={batch_id}")
        made.metrics.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics/batch_id={batch_id}")

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def checked_rows(spark: SparkSession, path: str, schema: StructType) -> Split:
    """Both outcomes of all batches of :func:`stream_checked`; ``schema`` is that of clean rows."""
    return Split(spark, f"{path}/rows", schema)


def checked_metrics(spark: SparkSession, path: str) -> DataFrame:
    """rule, n_pass, n_fail, n_null and batch_id of all batches."""
    return spark.read.schema(f"{METRICS}, batch_id long").parquet(f"{path}/metrics")


def stream_attach_labels(claims: DataFrame, labels: DataFrame, key: str = "claim_id", time_col: str = "timestamp", label_time: str = "label_available_date", late: str = "1 day", max_delay: str = "90 days") -> DataFrame:
    """Left-outer interval join of two streams: a label belongs to its claim if it comes within ``max_delay``.

    State holds ``max_delay`` of claims; a claim without a label is emitted when the watermark passes its interval.
    """
    left = claims.withWatermark(time_col, late)
    right = labels.select(F.col(key).alias("_label_key"), *[c for c in labels.columns if c != key]).withWatermark(label_time, late)
    within = (F.col(key) == F.col("_label_key")) & (F.col(label_time) >= F.col(time_col)) & (F.col(label_time) <= F.col(time_col) + F.expr(f"interval {max_delay}"))
    return left.join(right, within, "left_outer").drop("_label_key")


def stream_alerts(claims: DataFrame, reference: DataFrame, key: str, risky) -> DataFrame:
    """Claims of a stream, joined to a static reference table, for which ``risky`` holds."""
    return claims.join(reference, key).where(risky)

