"""Intermediate tables in the folder all executors share, so that lineage is cut and a lost executor costs only its tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from larkspur.sources.workdir import new_dir, remove, shared_dir

__all__ = ["Tables", "shared_dir", "sliced", "small_batches", "written"]

ARROW_ROWS_CONF, ARROW_ROWS_DEFAULT, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 10_000, 1000


class Tables:
    """The intermediate tables of one run of an operator.

    What later steps no longer read is dropped on the way. Tables that the (lazy) result reads stay until the application's
    folder is cleared (``workdir.clear``).
    """

    def __init__(self, spark: SparkSession, what: str) -> None:
        self.spark, self.base, self.made = spark, new_dir(spark, what), 0

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as Parquet under ``name`` (and a number, so names may repeat), read back."""
        self.made += 1
        path = f"{self.base}/{name}-{self.made}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.scratch_path = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that :meth:`written` returned."""
        for df in frames:
            remove(self.spark, df.scratch_path)

    def clear(self) -> None:
        """Delete all tables of this run."""
        remove(self.spark, self.base)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a scratch table of its own, read back."""
    return Tables(df.sparkSession, what).written(df, what)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, for a pass of its long texts through Python workers.

    A session that leaves the rows of an Arrow batch at Spark's default gets ``ARROW_ROWS`` from here on: the value counts when a plan
    runs, which for a lazy result is later than any place where it could be put back. A value that the session chose stays.
    """
    conf = df.sparkSession.conf
    if int(conf.get(ARROW_ROWS_CONF, str(ARROW_ROWS_DEFAULT))) == ARROW_ROWS_DEFAULT:
        conf.set(ARROW_ROWS_CONF, str(ARROW_ROWS))
    return df


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut (without a copy) to at most ``rows`` rows, so that what is made of long texts fits a Python worker.

    After each batch the worker gives back to the system what Arrow holds but does not use.
    """
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
        del batch
        pa.default_memory_pool().release_unused()
