"""Batch and streaming sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.functions.projections import public_columns


def stream_append(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, fmt: str = "parquet", available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Append a stream to a table; the checkpoint makes a restart continue where the last run stopped."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace a table. An empty frame is written too, so readers of a quarantine always find its schema."""
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def export_json(df: DataFrame, path: str, time_col: str, rows_a_file: int = 1_000_000) -> None:
    """JSON lines in one folder a month, sorted by time inside each file; private columns are left out. Null fields are written.

    Rows are dealt out by ranges of month, time and content, so a month of any size is spread over as many tasks as it fills, and
    files of a month follow each other in time.
    """
    time = F.col(time_col).cast("timestamp")
    year = F.when(F.year(time).between(1000, 9999), F.year(time).cast("string")).otherwise(F.date_format(time, "yyyy"))  # cheaper than to format each time
    dated = public_columns(df).withColumns({"year": year, "month": F.lpad(F.month(time).cast("string"), 2, "0")})
    spread = dated.withColumn("_part", F.xxhash64(*[F.col(f"`{c}`") for c in public_columns(df).columns]))
    order = ("year", "month", time_col, "_part")
    placed = spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("_part")
    writer = placed.write.mode("overwrite").option("ignoreNullFields", False).option("maxRecordsPerFile", rows_a_file)
    writer.partitionBy("year", "month").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; private columns are left out."""
    public_columns(df).write.mode("overwrite").option("header", True).csv(path)
