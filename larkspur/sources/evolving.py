"""An incremental JSON source whose schema grows with what arrives.

Records come as lines of text. For every micro-batch one aggregation finds the batch's schema (``schema_of_variant_agg``: only new
files are read, whole); it is merged by field into the stored one, and a changed schema becomes a new version in the store. The batch is parsed
with the merged schema and stored below its version. A reader sees all versions under the latest schema.

Merging: new fields are added; integers widen to doubles; structs and arrays merge inside; any other pair of types becomes text, which holds
scalars as they were written and nested values as JSON. With ``evolve=False`` the first schema stays: fields it lacks and values that do not fit go to
``_rescued`` (a map from field to text). Lines that are no JSON objects go there whole under ``_corrupt``. So no value is lost, but for integers beyond
2^53 in a column that meets fractions.

A batch that is repeated after a failure replaces its own folder; merging its schema again changes nothing. Field names go by their exact
spelling; a field called ``_rescued`` or ``_version`` is an error.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from larkspur.sources.workdir import exists

RESCUED, CORRUPT = "_rescued", "_corrupt"


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    numbers = (T.LongType, T.DoubleType)
    return T.DoubleType() if isinstance(a, numbers) and isinstance(b, numbers) else T.StringType()


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of ``a`` in their order, widened by those of ``b``, then what only ``b`` has."""
    known = {f.name: f.dataType for f in a}
    other = {f.name: f.dataType for f in b}
    fields = [T.StructField(n, widened(t, other.get(n, T.NullType()))) for n, t in known.items()]
    return T.StructType(fields + [T.StructField(n, t) for n, t in other.items() if n not in known])


def _plain(t: T.DataType) -> T.DataType:
    """The types of JSON values: whole numbers, doubles, text, truth values, structs and arrays."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType))
    if isinstance(t, T.DecimalType):
        return T.LongType() if t.scale == 0 and t.precision <= 18 else T.DoubleType()
    if isinstance(t, T.IntegralType):
        return T.LongType()
    return t if isinstance(t, T.DoubleType | T.BooleanType | T.NullType) else T.StringType()


def _settled(t: T.DataType) -> T.DataType:
    """What is only null so far is kept as text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType))
    return T.StringType() if isinstance(t, T.NullType) else t


def batch_schema(lines: DataFrame) -> T.StructType:
    """The schema of the JSON objects in ``value``; one pass over all records."""
    parsed = F.try_parse_json("value")
    objects = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)
    found = lines.agg(F.schema_of_variant_agg(objects).alias("s")).first().s
    if not found or not found.startswith("OBJECT"):
        return T.StructType([])
    ddl = found.replace("OBJECT<", "STRUCT<")
    kind = lines.sparkSession.range(0).select(F.from_json(F.lit("{}"), f"STRUCT<x: {ddl}>").alias("x")).schema["x"].dataType["x"].dataType
    return _plain(kind)


class SchemaStore:
    """Versions of a schema (1, 2, ...) as JSON texts below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def versions(self) -> dict[int, T.StructType]:
        """All versions, in order."""
        if not exists(self.spark, self.path):
            return {}
        rows = self.spark.read.schema("value string, version int").option("wholetext", True).text(self.path).collect()  # one short text a version
        return {r.version: T.StructType.fromJson(json.loads(r.value)) for r in sorted(rows, key=lambda r: r.version)}

    def evolve(self, found: T.StructType) -> tuple[int, T.StructType]:
        """Merge a batch's schema; the version that holds it now."""
        known = self.versions()
        last = max(known, default=0)
        grown = merged(known[last], found) if last else found
        if last and grown == known[last]:
            return last, grown
        if clash := {RESCUED, "_version"} & set(grown.names):
            raise ValueError(f"fields may not be called {', '.join(sorted(clash))}")
        self.spark.createDataFrame([(grown.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/version={last + 1}")
        return last + 1, grown


def _rescued(schema: T.StructType) -> Column:
    """Fields of the line that the parsed row ``_row`` does not hold, as text; null if there are none."""
    held = F.array(*[F.when(F.col(f"_row.`{f.name}`").isNotNull(), F.lit(f.name)) for f in schema]) if len(schema) else F.array().cast("array<string>")
    left = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, v: v.isNotNull() & ~F.coalesce(F.array_contains(held, k), F.lit(False)))
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    whole = F.when(is_object, left).otherwise(F.create_map(F.lit(CORRUPT), F.col("value")))
    return F.when(F.size(whole) > 0, whole)


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` and ``_rescued``."""
    settled = _settled(schema)
    # A missing field, a field that does not fit and a line that is no object all leave nulls and never fail.
    rows = lines.where("value is not null and trim(value) <> ''").withColumn("_row", F.from_json("value", settled, {"mode": "PERMISSIVE"}) if len(settled) else F.struct(F.lit(1).alias("_none")))
    return rows.select(*[F.col(f"_row.`{f.name}`").alias(f.name) for f in settled], _rescued(settled).alias(RESCUED))


def stream_evolving(spark: SparkSession, landing: str, store: str, table: str, checkpoint: str, evolve: bool = True, max_files: int = 1000) -> StreamingQuery:
    """Append new lines below ``landing`` to ``table`` until all are worked off; see the module for what happens to their schema."""
    schemas = SchemaStore(spark, store)

    def write(batch: DataFrame, batch_id: int) -> None:
        known = schemas.versions()
        if known and not evolve:
            version = max(known)
            schema = known[version]
        else:
            version, schema = schemas.evolve(batch_schema(batch))
        parsed(batch, schema).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}/version={version}")

    lines = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True).text(landing)
    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _as(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A stored value under a later type."""
    if old == new:
        return value
    if isinstance(old, T.StructType | T.ArrayType):
        return F.to_json(value) if isinstance(new, T.StringType) else F.from_json(F.to_json(value), new)
    return value.cast(new)


def read_evolved(spark: SparkSession, store: str, table: str) -> DataFrame:
    """All stored rows under the latest schema, with ``_rescued`` and ``_version`` (of the schema they came with)."""
    known = {v: _settled(s) for v, s in SchemaStore(spark, store).versions().items()}
    if not known:
        raise ValueError("nothing was stored yet")
    last, parts = known[max(known)], []
    for version, schema in known.items():
        if not exists(spark, table):
            continue
        kinds = T.StructType([*schema.fields, T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType())), T.StructField("batch_id", T.LongType()), T.StructField("version", T.IntegerType())])
        old = {f.name: f.dataType for f in schema}
        rows = spark.read.schema(kinds).parquet(table).where(F.col("version") == version)
        columns = [(_as(F.col(f"`{f.name}`"), old[f.name], f.dataType) if f.name in old else F.lit(None).cast(f.dataType)).alias(f.name) for f in last]
        parts.append(rows.select(*columns, RESCUED, F.lit(version).alias("_version")))
    return reduce(DataFrame.unionByName, parts)
