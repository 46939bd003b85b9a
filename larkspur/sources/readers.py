"""Batch and streaming readers. Batch and stream of one landing folder share schema and transforms."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from larkspur.sources.workdir import exists


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema, unparsable fields become null; without one, all columns are text."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines below ``path`` at any depth; partition folders stay out of the schema."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def stream_json(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int = 1, glob: str | None = None) -> DataFrame:
    """JSON lines as a stream of at most ``max_files`` new files a micro-batch; ``glob`` (such as ``*/*/``) selects folders."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        return reader.json(f"{path.rstrip('/')}/{glob}")
    return reader.option("recursiveFileLookup", True).json(path)


def infer_schema(spark: SparkSession, path: str, store: str, sampling_ratio: float = 1.0) -> T.StructType:
    """The schema of a JSON landing folder: inferred at first, from all records unless a ratio is given, then read back from ``store``.

    A field that occurs only in records outside a sample would be lost for good, so sampling is for the caller to ask for.
    """
    try:
        return T.StructType.fromJson(json.loads(spark.read.text(store, wholetext=True).first()[0]))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    found = spark.read.option("recursiveFileLookup", True).option("samplingRatio", sampling_ratio).json(path).schema
    spark.createDataFrame([(found.json(),)], "value string").coalesce(1).write.text(store)
    return found


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table; ``fmt`` is any installed format."""
    return spark.read.format(fmt).load(path)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet") -> DataFrame | None:
    """A stored table, or None if there is nothing at ``path`` yet."""
    if not exists(spark, path):
        return None
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)
