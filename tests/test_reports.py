import datetime as dt

from pyspark.sql import functions as F

from larkspur.functions import features
from larkspur.operators import reports, scoring, temporal


def test_age_and_vehicle_groups(spark):
    df = spark.createDataFrame([(24, 2022), (25, 2015), (70, 2014), (71, 1990), (None, None)], "a int, y int")
    out = df.select(features.age_group("a").alias("a"), features.vehicle_age_group("y", 2025).alias("v")).collect()
    assert [tuple(r) for r in out] == [("young", "new"), ("adult", "mid"), ("adult", "old"), ("senior", "old"), (None, None)]


def test_rates_and_scores_are_clamped(spark):
    one = spark.range(1)
    value = one.select(features.expected_rate(F.lit(2025), F.lit(7)).alias("a"), features.segment_score(F.lit(0.5), F.lit(3.0), F.lit(1.0)).alias("b"), features.clamp(F.lit(None).cast("double"), 0, 1).alias("c")).first()
    assert abs(value.a - (0.05 + 0.005 + 0.0002 * (10 * 12 + 6) / 12 + 0.012)) < 1e-12
    assert value.b == 0.25 and value.c is None
    assert one.select(features.segment_multiplier(F.lit("young"), F.lit("sea"), F.lit("new")).alias("m")).first().m is None


def test_months_and_actives(spark):
    starts = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 31),), (dt.date(2019, 5, 2),), (None,)], "s date")
    out = temporal.active_by_month(starts, "s", features.month_spine(spark, "2020-01", "2020-03")).orderBy("month").collect()
    assert [r.n_active for r in out] == [1, 3, 3]


def test_quality_counts_nulls_as_negative(spark):
    df = spark.createDataFrame([(True, 1), (True, 0), (None, 1), (False, None)], "f boolean, y int")
    q = reports.flag_quality(df, F.col("f"), F.col("y") == 1).first()
    assert (q.tp, q.fp, q.fn, q.tn) == (1, 1, 1, 1)
    assert reports.cost_summary(df, F.col("f"), F.col("y") == 1).first().total_cost == 900
    assert reports.flag_quality(df.where("false"), F.col("f"), F.col("y") == 1).first().precision is None


def test_delay_percentiles_weigh_rows(spark):
    df = spark.createDataFrame([(x,) for x in [1, 1, 1, 5, None]], "label_delay_days int")
    exact = reports.label_delay_stats(df).first()
    assert (exact.n, exact.least, exact.greatest, exact.mean, exact.median) == (4, 1, 5, 2.0, 1.0)
    assert reports.label_delay_stats(df, exact=False).first().median == 1


def test_anomalies_need_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), (None, 2.0)] + [("c", float(i % 2)) for i in range(40)] + [("c", 50.0)], "s string, v double")
    out = scoring.anomaly_flags(df, "v", "s")
    assert [r.v for r in out.where("is_anomaly = 1").collect()] == [50.0]
    assert out.count() == df.count()


def test_top_cases_break_ties_by_key(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None), (4, 9.0)], "k int, s double")
    assert [r.k for r in scoring.top_cases(df, "s", "k", 3).collect()] == [4, 1, 2]


def test_training_rows_are_made_once(spark):
    """A fit passes over its rows several times; what makes them runs once."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def feature(n):
        made.add(1)
        return float(n % 7)

    rows = spark.range(60).select(feature("id").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    scoring.fit_classifier(rows, ["x"], "y")
    assert made.value == 60
