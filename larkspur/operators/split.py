"""One write, several sinks: rules are evaluated in one scan whose rows go to a folder for each outcome.

Clean rows and rejected records are partitions of one table, so the source is read once for both. Every row also keeps which rules it failed
(a bit a rule), so counts are an aggregation over one stored column, for this run or a later one. (Observations would count in the same
pass, but a session that has used one cannot serialize the tasks of Spark's classifiers.) A rule of action *fail* stops the job before
anything of the table is visible.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.projections import dedupe_columns
from larkspur.operators.integrity import mark_repeated
from larkspur.operators.quality import DROPPED, FAILED, dead_letter_columns, fails, tag_rules
from larkspur.operators.rules import DROP, FLAG, QUARANTINE, Rule
from larkspur.schemas import QUARANTINE as QUARANTINE_SCHEMA

OUTCOME, CLEAN, REJECTED, GONE = "outcome", "clean", "quarantine", "dropped"
_DEAD, _TESTED, _SCHEMA = "_dead_letter", "_tested", "_schema"
_BITS = 32  # rules of one mask
METRICS = "rule string, n_pass long, n_fail long, n_null long"


@dataclass(frozen=True)
class Split:
    """A table of all outcomes at ``path``; ``schema`` is that of clean rows, ``rules`` are the names of the tested rules."""

    spark: SparkSession
    path: str
    schema: T.StructType
    rules: tuple[str, ...] = ()

    def _read(self, schema: T.StructType, outcome: str) -> DataFrame:
        # Both folders are read through the table's path, so an outcome without rows is an empty frame.
        whole = T.StructType([*schema.fields, T.StructField(OUTCOME, T.StringType())])
        return self.spark.read.schema(whole).parquet(self.path).where(F.col(OUTCOME) == outcome).drop(OUTCOME)

    @property
    def clean(self) -> DataFrame:
        return self._read(self.schema, CLEAN)

    @property
    def quarantine(self) -> DataFrame:
        return self._read(T.StructType([T.StructField(_DEAD, QUARANTINE_SCHEMA)]), REJECTED).select(f"{_DEAD}.*")

    @property
    def metrics(self) -> DataFrame:
        """rule, n_pass, n_fail and n_null, dropped rows included."""
        if not self.rules:
            return self.spark.createDataFrame([], METRICS)
        stored = self.spark.read.schema(T.StructType([T.StructField(_TESTED, T.ArrayType(T.LongType()))])).parquet(self.path)
        bit = lambda i, part: F.get(_TESTED, 2 * (i // _BITS) + part).bitwiseAND(1 << i % _BITS) != 0
        counts = [c for i in range(len(self.rules)) for c in (F.count_if(bit(i, 0)).alias(f"f{i}"), F.count_if(bit(i, 1)).alias(f"n{i}"))]
        rows = [F.struct(F.lit(r).alias("rule"), (F.col("every") - F.col(f"f{i}") - F.col(f"n{i}")).alias("n_pass"), F.col(f"f{i}").alias("n_fail"), F.col(f"n{i}").alias("n_null")) for i, r in enumerate(self.rules)]
        return stored.agg(F.count("*").alias("every"), *counts).select(F.inline(F.array(*rows)))


def _masks(rules: list[Rule]) -> Column:
    """For every ``_BITS`` rules a mask of those that fail and one of those that are null."""
    out = []
    for lo in range(0, len(rules), _BITS):
        tests = [F.expr(r.constraint).cast("boolean") for r in rules[lo : lo + _BITS]]
        for hit in ([~t for t in tests], [t.isNull() for t in tests]):
            out.append(reduce(Column.__add__, [F.when(h, 1 << i).otherwise(0).cast("long") for i, h in enumerate(hit)]))
    return F.array(*out) if out else F.array().cast("array<bigint>")


def written_split(rows: DataFrame, outcome: Column, dead_letter: Column, clean_columns: list[str], path: str, rules: list[Rule] | None = None) -> T.StructType:
    """Write ``rows`` partitioned by ``outcome``. Clean rows keep their columns, rejected rows their dead letter, and all what they failed of ``rules``."""
    kept = [F.when(F.col(OUTCOME) == CLEAN, F.col(f"`{c}`")).alias(c) for c in clean_columns]
    letter = F.when(F.col(OUTCOME) == REJECTED, dead_letter).alias(_DEAD)
    if OUTCOME in clean_columns:
        raise ValueError(f"a column may not be called {OUTCOME}")
    out = rows.withColumn(OUTCOME, outcome).select(*kept, letter, _masks(rules or []).alias(_TESTED), OUTCOME)
    out.write.mode("overwrite").partitionBy(OUTCOME).parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema if f.name in clean_columns])
    # Readers skip the folder; without any row it is all that tells the columns.
    held = rows.sparkSession.createDataFrame([(json.dumps({"schema": schema.jsonValue(), "rules": [r.name for r in rules or []]}),)], "value string")
    held.coalesce(1).write.mode("overwrite").text(f"{path}/{_SCHEMA}")
    return schema


def split_write(df: DataFrame, rules: list[Rule], path: str, on_null: str = "fail", once: Rule | None = None) -> Split:
    """Evaluate ``rules`` over one scan of ``df`` and store clean rows (with warn flags) and dead letters below ``path``.

    Outcomes and records are those of ``quality.apply_rules``, counts those of ``quality.rule_metrics``. Rows of action *drop* are in neither.
    ``once`` is a rule whose constraint lists columns: of the rows that pass all others and agree in these, the first is clean and the rest fail it.
    """
    df = dedupe_columns(df)
    columns = df.columns
    if once is not None:
        bad = [fails(r, on_null) for r in rules if r.action in (QUARANTINE, DROP)]
        whole = df.withColumn("_ok", ~reduce(Column.__or__, bad, F.lit(False)))
        df = mark_repeated(whole, [*(c.strip() for c in once.constraint.split(",")), "_ok"]).drop("_ok")
        rules = [*rules, replace(once, constraint="NOT _repeated")]
    tagged = tag_rules(df, rules, on_null)
    errors = [r for r in rules if r.action == QUARANTINE]
    flags = [f"warn_{r.name}" for r in rules if r.action == FLAG]
    outcome = F.when(F.col(DROPPED), GONE).when(F.col(FAILED).isNull(), CLEAN).otherwise(REJECTED)
    schema = written_split(tagged, outcome, F.struct(*dead_letter_columns(F.col(FAILED), errors, columns)), [*columns, *flags], path, rules)
    return Split(df.sparkSession, path, schema, tuple(r.name for r in rules))


def stored_split(spark: SparkSession, path: str) -> Split:
    """A split that an earlier run has written."""
    held = json.loads(spark.read.text(f"{path}/{_SCHEMA}", wholetext=True).first()[0])
    return Split(spark, path, T.StructType.fromJson(held["schema"]), tuple(held["rules"]))
