"""Referential integrity. Keys are tested themselves, never through another column of the parent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.quality import quarantine_union, to_dlq


@dataclass
class Matched:
    """Child rows with a parent, and those without."""

    matched: DataFrame
    orphans: DataFrame

    def quarantine(self, rule: str, key: str, source: str) -> DataFrame:
        """The orphans in the quarantine schema."""
        return to_dlq(self.orphans, rule, constraint=f"{key} has a parent", source=source)


def fk_split(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> Matched:
    """Split by whether ``key`` occurs in the parent. A null key has no parent. Repeated parent keys do not repeat child rows.

    Semi and anti-join need the parent's key column only; Spark picks the join, and splits a hot child key, at run time.
    """
    keys = parent.select(F.col(parent_key or key).alias("_parent"))
    on = child[key] == keys["_parent"]
    return Matched(child.join(keys, on, "left_semi"), child.join(keys, on, "left_anti"))


def with_parent_key(child: DataFrame, parent: DataFrame, key: str, parent_columns: tuple[str, ...] = ()) -> DataFrame:
    """``child`` with ``key`` as the parent has it, null for orphans, and some of the parent's columns: rows for rules on joined tables.

    Repeated parent keys do not repeat child rows; of their columns the least values (as one struct) are taken.
    """
    keys = parent.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_parent")).agg(F.min(F.struct(F.lit(0), *parent_columns)).alias("_row"))
    joined = child.join(keys, child[key] == F.col("_parent"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in child.columns if c != key], F.col("_parent").alias(key), *[F.col(f"_row.{c}").alias(c) for c in parent_columns])


def fk_reason(child: DataFrame, parent: DataFrame, parent_clean: DataFrame, key: str, missing: str = "policy_fk_missing", rejected: str = "policy_rejected") -> DataFrame:
    """``child`` with fk_error: null, ``missing`` (no such parent) or ``rejected`` (the parent failed its own rules)."""
    known = parent.select(F.col(key).alias("_known")).where("_known is not null").distinct()
    good = parent_clean.select(F.col(key).alias("_good")).where("_good is not null").distinct()
    joined = child.join(known, child[key] == F.col("_known"), "left").join(good, child[key] == F.col("_good"), "left")
    reason = F.when(F.col("_known").isNull(), missing).when(F.col("_good").isNull(), rejected)
    return joined.withColumn("fk_error", reason).drop("_known", "_good")


def apply_foreign_keys(tables: dict[str, DataFrame], foreign_keys: dict[str, dict]) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Check keys such as ``{"claims.policy_id": {"references": "policies.policy_id", "action": "quarantine"}}`` in order.

    Returns the tables, each without its orphans, and the orphans in the quarantine schema (for action ``drop`` none). A later
    key sees the tables that earlier ones have left, so a rejected claim also orphans its labels.
    """
    tables, rejected = dict(tables), []
    for child_key, spec in foreign_keys.items():
        (child, key), (parent, parent_key) = child_key.split("."), spec["references"].split(".")
        split = fk_split(tables[child], tables[parent], key, parent_key)
        tables[child] = split.matched
        if spec.get("action", "quarantine") == "quarantine":
            rejected.append(split.quarantine(f"{child}_{key}_fk_missing", key, child))
    return tables, quarantine_union(*rejected)


def mark_repeated(df: DataFrame, columns: list[str], name: str = "_repeated", salts: int = 64) -> DataFrame:
    """``df`` with a flag: false for the first row (in the order of all columns) of each value of ``columns``, true for the others.

    Rows are numbered in ``salts`` parts of each value and then the first rows of the parts, so a value of very many rows is no single task.
    """
    order = [F.col(f"`{c}`") for c in df.columns]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    part = salted.withColumn("_place", F.row_number().over(Window.partitionBy(*columns, "_salt").orderBy(*order)))
    heads = part.withColumn("_group", F.when(F.col("_place") == 1, -1).otherwise(F.col("_salt")))
    first = F.row_number().over(Window.partitionBy(*columns, "_group").orderBy(*order)) == 1
    return heads.withColumn(name, (F.col("_place") > 1) | ~first).drop("_salt", "_place", "_group")


def unique_key(df: DataFrame, key: str, order_by: list[str] | None = None, salts: int = 64) -> Matched:
    """First row of each key (matched) and its repetitions (orphans), so that a join on the key cannot multiply rows.

    Rows with a null key are all kept. Rows are numbered in ``salts`` parts of each key and then the first rows of the parts; both steps deal rows by key
    and part, so a task holds one sort of its own share, whatever a key repeats.
    """
    order = [F.col(c) for c in (order_by or df.columns)]
    keyed = df.where(F.col(key).isNotNull()).withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    part = keyed.withColumn("_place", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)))
    heads = part.withColumn("_group", F.when(F.col("_place") == 1, -1).otherwise(F.col("_salt")))
    nth = F.row_number().over(Window.partitionBy(key, "_group").orderBy(*order, "_salt"))
    placed = heads.withColumn("_nth", nth)
    again = (F.col("_place") > 1) | (F.col("_nth") > 1)
    first, repeated = (placed.where(w).drop("_salt", "_place", "_group", "_nth") for w in (~again, again))
    return Matched(first.unionByName(df.where(F.col(key).isNull())), repeated)
