"""Reports: counts, rates, shares, drift, delay and cost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.features import expected_rate
from larkspur.functions.projections import sample_rows
from larkspur.sources.workdir import new_dir


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name and n of every table, as one job."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def partition_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows by partition columns."""
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def trainable_count(claims: DataFrame, labels: DataFrame, key: str = "claim_id", percent: int = 100) -> DataFrame:
    """Claims (of a sample by key, if below 100 percent) that have a label."""
    sampled = claims if percent >= 100 else sample_rows(claims, percent, key)
    return sampled.select(key).join(labels.select(key), key).agg(F.count("*").alias("n_trainable"))


def monthly_rate(df: DataFrame, time_col: str, positive: Column, cumulative: bool = False) -> DataFrame:
    """month (yyyy-MM), n, n_positive and rate; with running totals if ``cumulative`` (a window over months)."""
    monthly = df.groupBy(F.date_format(time_col, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_if(positive).alias("n_positive"))
    monthly = monthly.withColumn("rate", F.col("n_positive") / F.col("n"))
    if cumulative:
        so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
        monthly = monthly.withColumns({"total": F.sum("n").over(so_far), "total_positive": F.sum("n_positive").over(so_far)})
    return monthly


def segment_share(df: DataFrame, segment: str) -> DataFrame:
    """segment, n and share of all rows."""
    counted = df.groupBy(F.col(segment).alias("segment")).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def overall_summary(df: DataFrame, time_col: str, positive: Column) -> DataFrame:
    """One row: n, n_positive, rate and n_months."""
    months = F.count_distinct(F.date_format(time_col, "yyyy-MM"))
    out = df.agg(F.count("*").alias("n"), F.count_if(positive).alias("n_positive"), months.alias("n_months"))
    return out.withColumn("rate", F.try_divide("n_positive", "n"))


def prevalence_ratio(df: DataFrame, segment: str, positive: Column) -> DataFrame:
    """segment, n, rate and ratio to the overall rate; one aggregation, the total is summed from the groups."""
    grouped = df.groupBy(F.col(segment).alias("segment")).agg(F.count("*").alias("n"), F.count_if(positive).alias("hit"))
    every = Window.partitionBy()
    base = F.sum("hit").over(every) / F.sum("n").over(every)
    return grouped.select("segment", "n", (F.col("hit") / F.col("n")).alias("rate"), F.try_divide(F.col("hit") / F.col("n"), base).alias("ratio"))


def category_drift(df: DataFrame, category: str, later: Column, floor: float = 1e-4) -> DataFrame:
    """category, share before and after, their difference, the population-stability term ``(b - a) * ln(b / a)`` and the total of all terms.

    In the term a share counts as at least ``floor``, so a category that appears or vanishes adds to it. A row whose ``later`` is null lies on neither
    side; a side without rows has null shares, terms and total.
    """
    counted = df.groupBy(F.col(category).alias("category")).agg(F.count_if(~later).alias("n_before"), F.count_if(later).alias("n_after"))
    every = Window.partitionBy()
    a, b = F.try_divide("n_before", F.sum("n_before").over(every)), F.try_divide("n_after", F.sum("n_after").over(every))
    shares = counted.select("category", a.alias("share_before"), b.alias("share_after")).withColumn("difference", F.col("share_after") - F.col("share_before"))
    low, high = (F.when(F.col(c).isNotNull(), F.greatest(c, F.lit(floor))) for c in ("share_before", "share_after"))
    return shares.withColumn("psi", (high - low) * F.log(high / low)).withColumn("total_psi", F.sum("psi").over(every))


def numeric_drift(df: DataFrame, value: str, period: Column) -> DataFrame:
    """period, n, mean, and the mean's ratio to the period before (null for the first)."""
    means = df.groupBy(period.alias("period")).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    return means.withColumn("ratio", F.try_divide("mean", F.lag("mean").over(Window.orderBy("period"))))


def label_delay_stats(df: DataFrame, delay: str = "label_delay_days", exact: bool = True) -> DataFrame:
    """One row: n, least, greatest, mean, median and 90th percentile; approximate percentiles if not ``exact``.

    Delays are counted by day first, so the exact percentiles weigh a table of days.
    """
    days = df.where(F.col(delay).isNotNull()).groupBy(F.col(delay).alias("d")).agg(F.count("*").alias("c"))
    if exact:
        median, high = (F.percentile("d", p, F.col("c")) for p in (0.5, 0.9))
    else:
        median, high = (F.percentile_approx("d", p, 10_000) for p in (0.5, 0.9))
    return days.agg(F.sum("c").alias("n"), F.min("d").alias("least"), F.max("d").alias("greatest"), (F.sum(F.col("d") * F.col("c")) / F.sum("c")).alias("mean"), median.alias("median"), high.alias("p90"))


#: Cost of a missed positive and of a false alarm, in euros.
MISSED_COST, ALARM_COST = 800, 100


def flag_quality(df: DataFrame, flagged: Column, positive: Column) -> DataFrame:
    """One row of confusion counts: tp, fp, fn, tn, precision and recall. A null flag or label counts as negative."""
    f, p = F.coalesce(flagged, F.lit(False)), F.coalesce(positive, F.lit(False))
    out = df.agg(F.count_if(f & p).alias("tp"), F.count_if(f & ~p).alias("fp"), F.count_if(~f & p).alias("fn"), F.count_if(~f & ~p).alias("tn"))
    return out.withColumns({"precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))})


def cost_summary(df: DataFrame, flagged: Column, positive: Column, missed: int = MISSED_COST, alarm: int = ALARM_COST) -> DataFrame:
    """One row: missed positives, false alarms, and what each costs."""
    counts = flag_quality(df, flagged, positive).select(F.col("fn").alias("n_missed"), F.col("fp").alias("n_alarms"))
    return counts.withColumns({"missed_cost": F.col("n_missed") * missed, "alarm_cost": F.col("n_alarms") * alarm, "total_cost": F.col("n_missed") * missed + F.col("n_alarms") * alarm})


def cost_curve(df: DataFrame, score: str, positive: Column, missed: int = MISSED_COST, alarm: int = ALARM_COST, parts: int | None = None) -> DataFrame:
    """tp, fp, fn, tn and total_cost of flagging every row whose score is at least ``threshold``, for each distinct score and for none (null).

    Scores are counted first, so ties are one row. Their counts are stored in ranges of score (``parts``, else as many as the session's shuffle partitions); running sums
    are taken inside a range, and what the ranges before it hold, a row for each range, is added. A null or NaN score is never flagged, a null label
    counts as negative. An empty table has the row of no flags, with zeros.
    """
    spark = df.sparkSession
    ranges = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hit = F.coalesce(positive, F.lit(False))
    value = F.nanvl(F.col(score).cast("double"), F.lit(None)) + F.lit(0.0)  # -0.0 is 0.0
    counted = df.select(value.alias("threshold"), hit.alias("_hit")).groupBy("threshold").agg(F.count_if("_hit").alias("p"), F.count_if(~F.col("_hit")).alias("n"))
    path = new_dir(spark, "cost-curve")
    schema = "threshold double, p long, n long, part int"
    counted.repartitionByRange(ranges, F.desc("threshold")).withColumn("part", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    sums = stored.groupBy("part").agg(F.sum(F.when(F.col("threshold").isNotNull(), F.col("p"))).alias("p"), F.sum(F.when(F.col("threshold").isNotNull(), F.col("n"))).alias("n"), F.sum("p").alias("all_p"), F.sum("n").alias("all_n"))
    carried, before, n_before = [], 0, 0
    totals = sorted(sums.collect(), key=lambda r: r.part)  # a row for each range
    for r in totals:
        carried.append((r.part, before, n_before))
        before, n_before = before + (r.p or 0), n_before + (r.n or 0)
    positives, negatives = (sum(r[c] for r in totals) for c in ("all_p", "all_n"))
    offsets = F.broadcast(spark.createDataFrame(carried, "part int, p_before long, n_before long"))
    running = Window.partitionBy("part").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    flagged = stored.where("threshold is not null").join(offsets, "part")
    flagged = flagged.select("threshold", (F.sum("p").over(running) + F.col("p_before")).alias("tp"), (F.sum("n").over(running) + F.col("n_before")).alias("fp"))
    every = flagged.unionByName(spark.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp")))
    every = every.withColumns({"fn": F.lit(positives) - F.col("tp"), "tn": F.lit(negatives) - F.col("fp")})
    return every.withColumn("total_cost", F.col("fn") * missed + F.col("fp") * alarm)


def least_cost(curve: DataFrame) -> DataFrame:
    """The row of a cost curve with the least cost; of equal ones that which flags least."""
    return curve.orderBy("total_cost", F.desc_nulls_first("threshold")).limit(1)


def observed_vs_expected(df: DataFrame, time_col: str, positive: Column) -> DataFrame:
    """year, month, n, observed rate, expected rate of the seasonal curve, and their difference."""
    grouped = df.groupBy(F.year(time_col).alias("year"), F.month(time_col).alias("month")).agg(F.count("*").alias("n"), (F.count_if(positive) / F.count("*")).alias("observed"))
    return grouped.withColumn("expected", expected_rate(F.col("year"), F.col("month"))).withColumn("difference", F.col("observed") - F.col("expected"))
