"""Point-in-time operators that never look into the future.

Windows by key alone would put a key that holds a third of all rows into one task. Where an operator needs an order inside a key, it
also cuts time into spans: what a span must know of earlier ones is carried in as one row for each key and span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_SECONDS = 30 * 86_400
DAY = 86_400_000_000  # microseconds


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def span_of(time: str, seconds: int) -> Column:
    """Number of the span of time a row lies in."""
    return F.floor(_micros(time) / (seconds * 1_000_000))


def as_of_join(events: DataFrame, versions: DataFrame, key: str, event_time: str, version_time: str, tie: str | None = None, prefix: str = "v_", span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Every event with the columns (prefixed) of the latest version of its key at or before its time; null if there is none.

    Versions of equal time go by ``tie``, then by their whole row (the largest wins). Events of a null key or time stay unmatched. The last version
    of every key and span is carried forward by a window over spans, so a window over rows never spans a whole key.
    """
    columns = [c for c in versions.columns if c != key]
    packed = F.struct(F.col(version_time).alias("_t"), *([F.col(tie).alias("_tie")] if tie else []), F.struct(*[F.col(c) for c in columns]).alias("_row"))
    known = versions.where(F.col(key).isNotNull() & F.col(version_time).isNotNull())
    known = known.select(F.col(key).alias("_k"), F.col(version_time).alias("_at"), packed.alias("_v"), span_of(version_time, span_seconds).alias("_s"))
    asked = events.select(F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("_e"), F.col(key).alias("_k"), F.col(event_time).alias("_at"))
    whole = asked.where("_k is not null and _at is not null").withColumn("_s", span_of("_at", span_seconds))
    rest = asked.where("_k is null or _at is null").select("_e", F.lit(None).cast(known.schema["_v"].dataType).alias("_v"))
    # One row for each key and span: the span's last version, carried to every later span that has rows of the key.
    ends = known.groupBy("_k", "_s").agg(F.max("_v").alias("_last")).unionByName(whole.groupBy("_k", "_s").agg(F.lit(None).alias("_last")), allowMissingColumns=True)
    ends = ends.groupBy("_k", "_s").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_in", F.last("_last", ignorenulls=True).over(before)).select("_k", "_s", "_in")
    rows = known.select("_k", "_s", "_at", F.lit(0).alias("_side"), "_v", F.lit(None).cast(whole.schema["_e"].dataType).alias("_e"))
    rows = rows.unionByName(whole.select("_k", "_s", "_at", F.lit(1).alias("_side"), F.lit(None).cast(known.schema["_v"].dataType).alias("_v"), "_e"))
    inside = Window.partitionBy("_k", "_s").orderBy("_at", "_side", F.col("_v")).rowsBetween(Window.unboundedPreceding, 0)
    latest = rows.withColumn("_now", F.last("_v", ignorenulls=True).over(inside)).where("_side = 1")
    found = latest.join(carried, ["_k", "_s"], "left").select("_e", F.coalesce("_now", "_in").alias("_v")).unionByName(rest)
    return found.select("_e.*", *[F.col(f"_v._row.`{c}`").alias(f"{prefix}{c}") for c in columns])


def counts_between(asked: DataFrame, days: DataFrame, instants: DataFrame, width: int) -> DataFrame:
    """k, us and trailing for distinct (k, us) in ``asked``: rows of k from ``width`` microseconds before us up to us.

    ``days`` (k, day, n) must cover every day of the windows, ``instants`` (k, us, n) those days on which a window starts or ends.
    """
    upper = asked.select("k", "us", F.col("us").alias("at"), F.lit(2).alias("side"), F.lit(0).cast("long").alias("n"))
    lower = asked.select("k", "us", (F.col("us") - width).alias("at"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("n"))
    marks = upper.unionByName(lower).unionByName(instants.select("k", "us", F.col("us").alias("at"), F.lit(1).alias("side"), "n"))
    marks = marks.withColumn("day", F.floor(F.col("at") / DAY))
    inside = Window.partitionBy("k", "day").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    ends = marks.withColumn("inside", F.sum("n").over(inside)).where("side <> 1")
    ends_days = upper.unionByName(lower).select("k", F.floor(F.col("at") / DAY).alias("day"), "n")
    daily = days.select("k", "day", "n").unionByName(ends_days).groupBy("k", "day").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("k").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    daily = daily.select(F.col("k").alias("_k"), F.col("day").alias("_day"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    total = ends.join(daily, ends["k"].eqNullSafe(daily["_k"]) & (ends["day"] == daily["_day"]))
    signed = F.when(F.col("side") == 2, F.col("inside") + F.col("earlier")).otherwise(-F.col("inside") - F.col("earlier"))
    return total.groupBy("k", "us").agg(F.sum(signed).alias("trailing"))


def trailing_count(df: DataFrame, key: str, time_col: str, days: int = 365, name: str = "prior_claims_12m", exclude_current: bool = False) -> DataFrame:
    """Rows of the same key in the ``days`` days up to and including the row's time, ties and the row itself included.

    Rows are counted by instant and by day first (:func:`counts_between`), so the largest window is one key's instants of one day, or its days. Null
    keys count as one key. Rows without a time count 0 and are counted by none; ``exclude_current`` leaves the row itself out.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(key).alias("_key"), _micros(time_col).alias("_us"))
    instants = rows.where("_us is not null").groupBy(F.col("_key").alias("k"), F.col("_us").alias("us")).agg(F.count("*").alias("n"))
    daily = instants.groupBy("k", F.floor(F.col("us") / DAY).alias("day")).agg(F.sum("n").alias("n"))
    counted = counts_between(instants.select("k", "us"), daily, instants, days * DAY)
    joined = rows.join(counted, rows["_key"].eqNullSafe(counted["k"]) & (rows["_us"] == counted["us"]), "left")
    return joined.select("_row.*", F.coalesce(F.col("trailing") - int(exclude_current), F.lit(0)).alias(name))


def training_set(claims: DataFrame, labels: DataFrame, as_of: str, key: str = "claim_id", available_col: str = "label_available_date") -> DataFrame:
    """Claims with the labels that were available at ``as_of`` (a timestamp text), and no others."""
    return claims.join(labels.where(F.col(available_col) <= F.lit(as_of).cast("timestamp")), key)


def active_by_month(starts: DataFrame, start_col: str, months: DataFrame) -> DataFrame:
    """month and n_active: rows whose start lies before the first day of the month.

    Starts are counted by month and summed up along the months (a table of months, not of rows); a range join is not needed.
    """
    counted = starts.where(F.col(start_col).isNotNull()).groupBy(F.add_months(F.trunc(start_col, "month"), 1).alias("month")).agg(F.count("*").alias("n"))
    both = counted.select("month", "n", F.lit(False).alias("asked")).unionByName(months.select(F.to_date("month").alias("month"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("asked")))
    monthly = both.groupBy("month").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    running = monthly.withColumn("n_active", F.sum("n").over(Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)))
    return running.where("asked").select("month", "n_active")
