"""Derived features as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_features(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Adds event_date, event_year, event_month, event_week (ISO) and year_month."""
    t = F.col(time_col)
    return df.withColumns({"event_date": F.to_date(t), "event_year": F.year(t), "event_month": F.month(t), "event_week": F.weekofyear(t), "year_month": F.date_format(t, "yyyy-MM")})


def derive_columns(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Adds columns from SQL expressions; one may use an earlier one."""
    for name, text in expressions.items():
        df = df.withColumn(name, F.expr(text))
    return df


def label_delay(available: Column | str, event: Column | str) -> Column:
    """Calendar days from event to label."""
    return F.datediff(F.to_date(_col(available)), F.to_date(_col(event)))


def age_group(age: Column | str) -> Column:
    """Under 25 young, over 70 senior, else adult."""
    a = _col(age)
    return F.when(a < 25, "young").when(a > 70, "senior").when(a.isNotNull(), "adult")


def vehicle_age_group(vehicle_year: Column | str, as_of_year: Column | int) -> Column:
    """Under 4 years new, up to 10 mid, else old; the year of comparison is a parameter so that results can be repeated."""
    years = (F.lit(as_of_year) if isinstance(as_of_year, int) else as_of_year) - _col(vehicle_year)
    return F.when(years < 4, "new").when(years <= 10, "mid").when(years.isNotNull(), "old")


def hash_id(prefix: str, n: Column | str, seed: int = 42) -> Column:
    """Surrogate key: the prefix and the first 12 hex digits (upper case) of md5(prefix, n, seed)."""
    # Seed 42, twelve digits.
    digest = F.md5(F.concat(F.lit(prefix), _col(n).cast("string"), F.lit(str(seed))).cast("binary"))
    return F.concat(F.lit(prefix), F.upper(F.substring(digest, 1, 12)))


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` limited to [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def add_delay(time: Column | str, days: Column | int = 0, hours: Column | int = 0) -> Column:
    """``time`` moved by days and hours; both may be columns."""
    lift = [F.lit(x) if isinstance(x, int) else x for x in (days, hours)]
    return _col(time) + F.make_dt_interval(lift[0], lift[1], F.lit(0), F.lit(0))


def iso_format(time: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` in UTC."""
    return F.date_format(_col(time), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def expected_rate(year: Column, month: Column) -> Column:
    """Seasonal curve with trend and step, within 2.5 % and 12 %."""
    # Base rate, seasonal swing, yearly trend, step from 2025-03, limits.
    base, swing, trend, step, low, high = 0.050, 0.005, 0.0002, 0.012, 0.025, 0.12
    season = swing * F.sin(2 * math.pi * (month - 4) / 12)
    slope = trend * ((year - 2015) * 12 + (month - 1)) / 12
    jump = F.when((year == 2025) & (month >= 3), step).otherwise(0.0)
    return clamp(base + season + slope + jump, low, high)


# Prevalence multipliers by segment.
AGE_MULTIPLIER = {"young": 2.00, "adult": 0.75, "senior": 1.80}
REGION_MULTIPLIER = {"urban": 1.60, "suburban": 1.00, "rural": 0.60}
VEHICLE_AGE_MULTIPLIER = {"new": 0.80, "mid": 1.00, "old": 1.70}



def segment_multiplier(age: Column, region: Column, vehicle_age: Column) -> Column:
    """Product of the three segment multipliers; null for an unknown segment."""
    return F.try_element_at(F.create_map(*_pairs(AGE_MULTIPLIER)), age) * F.try_element_at(F.create_map(*_pairs(REGION_MULTIPLIER)), region) * F.try_element_at(F.create_map(*_pairs(VEHICLE_AGE_MULTIPLIER)), vehicle_age)


def _pairs(table: dict[str, float]) -> list[Column]:
    return [F.lit(x) for pair in table.items() for x in pair]


def segment_score(rate: Column, multiplier: Column, propensity: Column) -> Column:
    """Rate scaled by segment and propensity, within 0.5 % and 25 %."""
    # The formula's constants and limits.
    return clamp(rate * (0.5 + 0.5 * multiplier) * (0.6 + 0.8 * propensity), 0.005, 0.25)


def business_hours_flag(time: Column | str) -> Column:
    """1 outside business hours: before 8 or after 20 o'clock."""
    h = F.hour(_col(time))  # fixed values: 8 and 20
    return ((h < 8) | (h > 20)).cast("int")


def third_party_flag(injury: Column | str, parties: Column | str) -> Column:
    """1 if somebody is hurt and more than one party is involved."""
    return ((_col(injury) != "none") & (_col(parties) > 1)).cast("int")


def deflate_amount(amount: Column | str, year: Column) -> Column:
    """Amount in 2015 prices: 3 % a year since then, and a step of 12 % in 2025."""
    # Yearly inflation, base year, step.
    index = (1 + 0.03 * (year - 2015)) * F.when(year == 2025, 1.12).otherwise(1.0)
    return _col(amount) / index


def pattern_flag(electric: Column, location: Column, mileage: Column, time: Column) -> Column:
    """1 for electric cars of low mileage at charging stations from March 2025 on."""
    # Location, mileage, first day.
    return F.coalesce((electric == 1) & (location == "charging_station") & (mileage < 8000) & (time >= F.lit("2025-03-01").cast("timestamp")), F.lit(False)).cast("int")


def month_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row (month: first day) for each month from ``first`` to ``last``, both yyyy-MM."""
    bounds = spark.range(1).select(F.to_date(F.lit(f"{first}-01")).alias("a"), F.to_date(F.lit(f"{last}-01")).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
