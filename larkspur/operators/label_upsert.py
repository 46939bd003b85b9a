"""Claims by month with the newest label known so far; a load of labels replaces only the months whose claims it labels.

A load writes the new state of its months to a folder of its own and then names them in one small manifest file, which is what readers go by. A load that breaks
off leaves every month as it was, since nothing names its folder, and is repeated; a load that is named already is done and changes nothing.
Months that a load does not touch keep their files.

Edge cases: of several labels of a claim the one available last holds (ties: the largest row), in whatever order they arrive; a label without that date counts
as oldest. A label whose claim is not there yet waits in ``labels``. Claims of a null key are never labelled and are not joined; claims without a time lie in month 0
of year 0. Repeated claims stay, each with the label. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.sources.readers import read_if_there

Month = tuple[int, int]


@dataclass(frozen=True)
class LabelledClaims:
    """The table below ``path``; ``claims`` and ``labels`` are the schemas of what is loaded, which share no column but ``key``."""

    spark: SparkSession
    path: str
    claims: T.StructType
    labels: T.StructType
    key: str = "claim_id"
    time_col: str = "timestamp"
    available: str = "label_available_date"
    _added: list[str] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "_added", [c for c in self.labels.names if c != self.key])
        clash = set(self._added) & set(self.claims.names)
        if clash:
            raise ValueError(f"columns of both claims and labels: {sorted(clash)}")

    def months(self) -> dict[Month, str]:
        """The load that holds each month's current rows (a table of months, read by the driver)."""
        manifest = read_if_there(self.spark, f"{self.path}/manifest", "year int, month int, load string, seq int")
        if manifest is None:
            return {}
        newest = manifest.groupBy("year", "month").agg(F.max_by("load", "seq").alias("load"))
        return {(r.year, r.month): r.load for r in newest.collect()}

    def read(self, months: list[Month] | None = None) -> DataFrame:
        """Current claims, labelled or not, with year and month; of the given months only, if any are given."""
        held = self.months()
        wanted = sorted(held if months is None else set(months) & set(held))
        schema = T.StructType([*self.claims.fields, *[self.labels[c] for c in self._added], T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
        if not wanted:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/rows/load={held[m]}/year={m[0]}/month={m[1]}" for m in wanted]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*folders).select(*schema.names)

    def _done(self, load: str) -> int | None:
        """The next number of a manifest, or None if the load is named in one."""
        manifest = read_if_there(self.spark, f"{self.path}/manifest", "year int, month int, load string, seq int")
        if manifest is None:
            return 0
        r = manifest.agg(F.max("seq").alias("last"), F.coalesce(F.bool_or(F.col("load") == load), F.lit(False)).alias("done")).first()
        return None if r.done else (r.last if r.last is not None else -1) + 1

    def _store(self, rows: DataFrame, months: list[Month], load: str, seq: int) -> None:
        spread = rows.repartition("year", "month", F.pmod(F.xxhash64(self.key, self.time_col), F.lit(16)))
        spread.write.mode("overwrite").partitionBy("year", "month").parquet(f"{self.path}/rows/load={load}")
        self._name(months, load, seq)

    def _name(self, months: list[Month], load: str, seq: int) -> None:
        named = self.spark.createDataFrame([(*m, load) for m in months], "year int, month int, load string")
        named.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/seq={seq}")

    def _newest(self, arrived: DataFrame) -> DataFrame:
        order = F.struct(F.col(self.available), F.struct(*self._added))
        return arrived.where(F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("_key")).agg(F.max(order).alias("_new"))

    def _labelled(self, rows: DataFrame, newest: DataFrame) -> DataFrame:
        """``rows`` with the newer of the label they have and the one in ``newest``."""
        keyed = rows.where(F.col(self.key).isNotNull()).withColumn("_old", F.struct(F.col(self.available), F.struct(*self._added)))
        joined = keyed.join(newest, F.col(self.key) == F.col("_key"), "left").withColumn("_best", F.greatest("_old", "_new"))
        better = [F.col(f"_best.col2.{c}").alias(c) for c in self._added]
        kept = [F.col(f"`{c}`") for c in self.claims.names]
        return joined.select(*kept, *better, "year", "month").unionByName(rows.where(F.col(self.key).isNull()))

    def add_claims(self, claims: DataFrame, load: str) -> list[Month]:
        """Add claims, with the labels that arrived before them; returns the months rewritten."""
        seq = self._done(load)
        if seq is None:
            return []
        time = F.col(self.time_col)
        dated = claims.select(*self.claims.names).withColumns({c: F.lit(None).cast(self.labels[c].dataType) for c in self._added})
        dated = dated.withColumns({"year": F.coalesce(F.year(time), F.lit(0)), "month": F.coalesce(F.month(time), F.lit(0))})
        months = [tuple(r) for r in dated.select("year", "month").distinct().collect()]
        arrived = read_if_there(self.spark, f"{self.path}/labels", self.labels)
        if arrived is not None:
            dated = self._labelled(dated, self._newest(arrived))
        if months:
            self._store(self.read(months).unionByName(dated), months, load, seq)
        return months

    def add_labels(self, labels: DataFrame, load: str) -> list[Month]:
        """Label claims; returns the months rewritten, which are those with a claim that the load labels anew."""
        seq = self._done(load)
        if seq is None:
            return []
        folder = f"{self.path}/labels/load={load}"
        labels.select(*self.labels.names).write.mode("overwrite").parquet(folder)
        newest = self._newest(self.spark.read.schema(self.labels).parquet(folder))
        known = self.read().select(self.key, self.available, *[c for c in self._added if c != self.available], "year", "month").where(F.col(self.key).isNotNull())
        old = F.struct(F.col(self.available), F.struct(*self._added))
        changed = known.join(newest, F.col(self.key) == F.col("_key")).where(F.greatest(old, F.col("_new")) != old)
        months = [tuple(r) for r in changed.select("year", "month").distinct().collect()]
        if months:
            self._store(self._labelled(self.read(months), newest), months, load, seq)
        return months
