"""Quarantine replay: rejected records wait in a ledger and are released once what they lacked has arrived.

The ledger has two tables of folders, one folder a load: records that were rejected, and records that were released. A record is
known by the hash of its source, rule and JSON; equal records are one row with their number. A load that is repeated replaces its own folders and sees
the releases of other loads only, so nothing is released twice and nothing is lost if a run breaks off.

Edge cases: only records of the given rule are released, all others stay open; a record without the key stays open. ``record_json`` is parsed with the
schema of the source, so times, numbers and nested values come back as they were (binary columns do not). A load without rejected
records has an empty folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.sources.readers import read_if_there

_OPENED = "record_id string, record_json string, error_rule string, error_source_table string, n long, batch string"


@dataclass(frozen=True)
class Ledger:
    """Rejected and released records below ``path``."""

    spark: SparkSession
    path: str

    def _read(self, name: str) -> DataFrame:
        found = read_if_there(self.spark, f"{self.path}/{name}", _OPENED)
        return self.spark.createDataFrame([], _OPENED) if found is None else found

    def _write(self, rows: DataFrame, name: str, batch: str) -> None:
        rows.select("record_id", "record_json", "error_rule", "error_source_table", "n").write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def add(self, rejected: DataFrame, batch: str) -> None:
        """Note the dead letters (quarantine schema) of a load."""
        made = F.sha2(F.concat_ws("\n", F.coalesce("error_source_table", F.lit("")), F.coalesce("error_rule", F.lit("")), "record_json"), 256)
        counted = rejected.select(made.alias("record_id"), "record_json", "error_rule", "error_source_table").groupBy("record_id").agg(
            F.any_value("record_json").alias("record_json"), F.any_value("error_rule").alias("error_rule"), F.any_value("error_source_table").alias("error_source_table"), F.count("*").alias("n")
        )
        self._write(counted, "rejected", batch)

    def open(self, but: str | None = None) -> DataFrame:
        """Records not released yet: rejected less released, by record, of all loads or of all others than ``but``."""
        both = self._read("rejected").unionByName(self._read("released").withColumn("n", -F.col("n")))
        if but is not None:
            both = both.where(F.col("batch") != but)
        left = both.groupBy("record_id").agg(F.any_value("record_json").alias("record_json"), F.any_value("error_rule").alias("error_rule"), F.any_value("error_source_table").alias("error_source_table"), F.sum("n").alias("n"))
        return left.where("n > 0")

    def release(self, parents: DataFrame, rule: str, key: str, schema: T.StructType, batch: str, parent_key: str | None = None) -> DataFrame:
        """Rows (of ``schema``) of open records of ``rule`` whose ``key`` now occurs in ``parents``, each as often as it was rejected."""
        waiting = self.open(but=batch).where(F.col("error_rule") == rule).withColumn("_row", F.from_json("record_json", schema))
        keys = parents.select(F.col(parent_key or key).alias("_parent")).where("_parent is not null")
        freed = waiting.join(keys, F.col(f"_row.`{key}`") == F.col("_parent"), "left_semi")
        self._write(freed, "released", batch)
        stored = self._read("released").where(F.col("batch") == batch)
        return stored.select(F.from_json("record_json", schema).alias("_row"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_copy")).select("_row.*")


def load_with_replay(ledger: Ledger, arrived: DataFrame, parents: DataFrame, key: str, batch: str, source: str, rule: str = "policy_fk_missing") -> DataFrame:
    """The rows of a load that have a parent: arrived ones, and earlier orphans whose parent has come since. New orphans are noted.

    Arrived rows and rows that stay open add up: rows in of all loads = rows out of all loads + open records.
    """
    from larkspur.operators.integrity import fk_split

    split = fk_split(arrived, parents, key)
    freed = ledger.release(parents, rule, key, arrived.schema, batch)
    ledger.add(split.quarantine(rule, key, source), batch)
    return split.matched.unionByName(freed)
