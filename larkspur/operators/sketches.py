"""Quantile sketches by month and column, stored once and merged for any periods, and the exact forms beside them.

A sketch (KLL, of Spark's own functions) of ``k`` = 800 has a rank error of about 0.4 % at 99 % confidence (0.5 % for differences), whatever it has seen and however
often it was merged; it takes some kilobytes. Nulls and NaN are counted as missing and are in no quantile; a month without values has no sketch. Rows
without a time are month null.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.reports import cost_curve
from larkspur.sources.workdir import new_dir

K, GRID, FLOOR = 800, 500, 1e-4


def month_sketches(df: DataFrame, time_col: str, columns: list[str], k: int = K) -> DataFrame:
    """month (first day), column, n, n_missing and sketch (binary): one scan and one aggregation for all columns."""
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in columns}
    rows = df.select(F.trunc(time_col, "month").alias("month"), *[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    made = [F.struct(F.lit(c).alias("column"), F.count(f"v{i}").alias("n"), (F.count("*") - F.count(f"v{i}")).alias("n_missing"), F.kll_sketch_agg_double(f"v{i}", F.lit(k)).alias("sketch")) for i, c in enumerate(columns)]
    stacked = rows.groupBy("month").agg(F.array(*made).alias("all")).select("month", F.explode("all").alias("s")).select("month", "s.*")
    return stacked.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def sketch_percentiles(sketches: DataFrame, period: Column, probabilities: list[float]) -> DataFrame:
    """period, column, n and percentiles (an array) of stored sketches; periods are any grouping of their months."""
    merged = sketches.where("n > 0").groupBy(period.alias("period"), "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("period", "column", "n", F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, probabilities))).alias("percentiles"))


def sketch_drift(sketches: DataFrame, later: Column, bins: int = 10) -> DataFrame:
    """column, n_before, n_after, psi and ks between the months that are not ``later`` and those that are; null if one side has no value.

    psi is over ``bins`` bins that end at the earlier side's quantiles, shares below 0.0001 counting as that. ks is the greatest difference of ranks at 500 quantiles
    of either side. Ranks are read off those quantiles (the sketch's own ranks need constants), so each may be off by 1 / 500 besides the rank error.
    """
    side = F.coalesce(later, F.lit(False))
    merged = sketches.where("n > 0").select("column", "n", "sketch", side.alias("later")).groupBy("column", "later").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    a, b = (merged.where(w).select("column", F.col("n").alias(n), F.col("sketch").alias(s)) for w, n, s in (("not later", "n_before", "a"), ("later", "n_after", "b")))
    both = a.join(b, "column", "full")

    def cuts(n: int, last: int) -> Column:
        return F.array(*[F.lit(i / n) for i in range(1, last + 1)])

    def ranks(side: str, at: Column) -> Column:
        return F.transform(at, lambda x: F.size(F.filter(F.col(side), lambda q: q <= x)) / F.lit(GRID))

    def shares(side: str) -> Column:
        ends = F.concat(F.array(F.lit(0.0)), ranks(side, F.col("edges")), F.array(F.lit(1.0)))
        return F.zip_with(F.slice(ends, 2, F.size(ends) - 1), F.slice(ends, 1, F.size(ends) - 1), lambda y, x: F.greatest(y - x, F.lit(FLOOR)))

    grid = {f"q{side}": F.kll_sketch_get_quantile_double(side, cuts(GRID, GRID)) for side in ("a", "b")}
    edges = F.array_distinct(F.kll_sketch_get_quantile_double("a", cuts(bins, bins - 1)))
    known = both.where("a is not null and b is not null").withColumns({**grid, "edges": edges}).withColumn("at", F.array_distinct(F.concat("qa", "qb")))
    terms = F.zip_with(shares("qa"), shares("qb"), lambda x, y: (y - x) * F.log(y / x))
    gaps = F.zip_with(ranks("qa", F.col("at")), ranks("qb", F.col("at")), lambda x, y: F.abs(x - y))
    found = known.select("column", "n_before", "n_after", F.aggregate(terms, F.lit(0.0), lambda s, t: s + t).alias("psi"), F.array_max(gaps).alias("ks"))
    rest = both.where("a is null or b is null").select("column", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
    return found.unionByName(rest, allowMissingColumns=True)


def _between(low, high, share):
    """``low`` and ``high`` mixed by ``share``, with the product of ``low`` added before it is rounded, as DuckDB's quantile_cont does."""
    if low is None or low == high:
        return low
    rest = high * share
    if not (math.isfinite(low) and math.isfinite(rest)):
        return low * (1.0 - share) + rest if share else low
    return float(Fraction(low) * Fraction(1.0 - share) + Fraction(rest))


def exact_percentiles(df: DataFrame, value: str, period: Column, probabilities: list[float], parts: int | None = None) -> DataFrame:
    """period, n and percentiles (an array, interpolated) of all values, to the last bit those of DuckDB's quantile_cont.

    Values are counted first, and the counts stored in ranges of period and value (``parts``, else as many as the session's shuffle partitions). A count's place
    is its running sum inside a range and what the period's earlier ranges hold, so no task holds a whole period.
    """
    spark = df.sparkSession
    ranges = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.nanvl(F.col(value).cast("double"), F.lit(None))
    counted = df.select(period.alias("period"), number.alias("v")).where("v is not null").groupBy("period", "v").agg(F.count("*").alias("c"))
    dealt = counted.repartitionByRange(ranges, "period", "v").withColumn("part", F.spark_partition_id())
    path = new_dir(spark, "percentiles")
    dealt.write.parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)
    of_period = Window.partitionBy("_period")
    sums = stored.groupBy(F.col("period").alias("_period"), F.col("part").alias("_part")).agg(F.sum("c").alias("_c"))
    carried = sums.select("_period", "_part", F.sum("_c").over(of_period).alias("n"), (F.sum("_c").over(of_period.orderBy("_part")) - F.col("_c")).alias("_before"))
    placed = stored.join(carried, F.col("period").eqNullSafe(F.col("_period")) & (F.col("part") == F.col("_part")))
    until = F.col("_before") + F.sum("c").over(Window.partitionBy("part", "period").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.select("period", "v", "n", until.alias("until"))
    ends = []
    for i, p in enumerate(probabilities):
        at = (F.col("n") - 1) * F.lit(float(p))
        ends += [F.min(F.when(F.col("until") > F.floor(at), F.col("v"))).alias(f"low{i}"), F.min(F.when(F.col("until") > F.ceil(at), F.col("v"))).alias(f"high{i}")]
    found = placed.groupBy("period", "n").agg(*ends)
    between = F.udf(_between, "double")
    mixed = [between(f"low{i}", f"high{i}", (F.col("n") - 1) * F.lit(float(p)) - F.floor((F.col("n") - 1) * F.lit(float(p)))) for i, p in enumerate(probabilities)]
    return found.select("period", "n", F.array(*mixed).alias("percentiles"))  # a row for each period


def exact_ks(df: DataFrame, value: str, later: Column) -> DataFrame:
    """One row, ks: the Kolmogorov-Smirnov distance of both sides' values, from running sums carried over ranges; null if a side has none."""
    known = df.where(F.nanvl(F.col(value).cast("double"), F.lit(None)).isNotNull())
    curve = cost_curve(known, value, later)
    gap = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")) - F.try_divide(F.col("fp"), F.col("fp") + F.col("tn"))
    return curve.agg(F.max(F.abs(gap)).alias("ks"))
