"""Trailing counts kept up to date load by load: a load reads and writes only the months its rows can reach.

``path`` holds three tables by month (UTC): ``deltas`` (rows by key and instant of every load; a repeated load replaces its own folder, so it must hold the
same rows), ``days`` (rows by key and day) and ``counts`` (the trailing count at every instant of a key). The count at an instant is the difference of
two running totals, of the instant and of the window's start. A running total is the key's days before (a prefix sum over days) and the rows of
one key and day before it, so neither a hot key nor a long history is one task, and only the days at both ends of a window are read by instant.

Edge cases: rows without a time are not stored and count 0. Null keys count as one key. Rows of one instant are counted together, the row itself included.
An empty load changes nothing. Loads may come in any order; a late one brings the months after it up to date, for its own keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.temporal import DAY, counts_between
from larkspur.sources.workdir import exists

_SCHEMAS = {"deltas": "us long, n long", "days": "day long, n long", "counts": "us long, trailing long"}


def _month_of(day: Column) -> Column:
    date = F.date_from_unix_date(day.cast("int"))
    return F.year(date) * 12 + F.month(date) - 1


@dataclass(frozen=True)
class Load:
    """What a load touched: months (year * 12 + month - 1) it brought up to date, and files it read of the stored tables."""

    months: list[int]
    files: list[str]


@dataclass(frozen=True)
class TrailingCounts:
    """Trailing counts of ``key`` over ``days`` days below ``path``."""

    spark: SparkSession
    path: str
    key: str
    time_col: str
    days: int = 365

    def _keyed(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.col(self.key).alias("k"), F.unix_micros(F.col(self.time_col).cast("timestamp")).alias("us"))

    def _read(self, name: str, months: list[int], key_type: str, read: list[str] | None = None) -> DataFrame:
        folders = [f for f in (f"{self.path}/{name}/month={m}" for m in months) if exists(self.spark, f)]
        schema = f"k {key_type}, {_SCHEMAS[name]}, month int"
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*folders)
        if read is not None:
            read.extend(found.inputFiles())
        return found

    def _write(self, rows: DataFrame, name: str, by: list[str]) -> None:
        writer = rows.repartition(*by, F.pmod(F.xxhash64("k"), F.lit(16))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).parquet(f"{self.path}/{name}")

    def update(self, arrived: DataFrame, load: str) -> Load:
        """Add the rows of a load and bring the counts of every instant they reach up to date; doing it again changes nothing."""
        rows = self._keyed(arrived).where("us is not null").groupBy("k", "us").agg(F.count("*").alias("n"))
        key_type = rows.schema["k"].dataType.simpleString()
        self._write(rows.withColumns({"month": _month_of(F.floor(F.col("us") / DAY)), "load": F.lit(load)}), "deltas", ["month", "load"])
        touched = [r[0] for r in self._keyed(arrived).where("us is not null").select(_month_of(F.floor(F.col("us") / DAY))).distinct().collect()]  # months
        if not touched:
            return Load([], [])
        read: list[str] = []
        own = self._read("deltas", touched, key_type, read)
        self._write(own.groupBy("k", F.floor(F.col("us") / DAY).alias("day"), "month").agg(F.sum("n").alias("n")), "days", ["month"])
        reach = self.days // 28 + 1  # no month is shorter
        near = {m + i for m in touched for i in range(reach + 1)}
        changed = sorted(m for m in near if exists(self.spark, f"{self.path}/deltas/month={m}"))
        starts = {m - i for m in changed for i in range(self.days // 31 - 1, reach + 1)}  # months in which their windows start
        spanned = sorted({m - i for m in changed for i in range(reach + 1)})
        keys = rows.select(F.col("k").alias("_k")).distinct()

        def mine(df: DataFrame, how: str = "left_semi") -> DataFrame:
            return df.join(keys, df["k"].eqNullSafe(keys["_k"]), how)

        instants = mine(self._read("deltas", sorted(starts | set(changed)), key_type, read)).groupBy("k", "us", "month").agg(F.sum("n").alias("n"))
        daily = mine(self._read("days", spanned, key_type, read))
        asked = instants.where(F.col("month").isin(changed)).select("k", "us")
        counted = counts_between(asked, daily, instants, self.days * DAY).withColumn("month", _month_of(F.floor(F.col("us") / DAY)))
        others = mine(self._read("counts", changed, key_type, read), "left_anti")
        self._write(counted.unionByName(others.select(counted.columns)), "counts", ["month"])
        return Load(changed, sorted(set(read)))

    def attach(self, rows: DataFrame, name: str = "prior_claims_12m", months: list[int] | None = None) -> DataFrame:
        """``rows`` with their counts; ``months`` names the months they lie in, if only those shall be read."""
        keyed = self._keyed(rows)
        key_type = keyed.schema["k"].dataType.simpleString()
        if months is None:
            schema = f"k {key_type}, {_SCHEMAS['counts']}, month int"
            there = exists(self.spark, f"{self.path}/counts")
            known = self.spark.read.schema(schema).parquet(f"{self.path}/counts") if there else self.spark.createDataFrame([], schema)
        else:
            known = self._read("counts", months, key_type)
        asked = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), F.col(self.key).alias("_key"), F.unix_micros(F.col(self.time_col).cast("timestamp")).alias("_us"))
        joined = asked.join(known, asked["_key"].eqNullSafe(known["k"]) & (asked["_us"] == known["us"]), "left")
        return joined.select("_row.*", F.coalesce("trailing", F.lit(0)).alias(name))
