"""Trailing counts kept load by load against the batch operator."""

import datetime as dt
import random

from conftest import rows_of

from larkspur.operators.temporal import trailing_count
from larkspur.operators.trailing import TrailingCounts

START = dt.datetime(2020, 1, 1)
SCHEMA = "id int, k string, t timestamp"


def _rows(n, months, seed):
    rng = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", "c", None]
    out = [(i, rng.choice(keys), START + dt.timedelta(days=rng.randrange(months * 30), microseconds=rng.choice([0, 0, 1, 86_399_999_999]))) for i in range(n)]
    out += [(n + i, k, START + dt.timedelta(days=d)) for i, (k, d) in enumerate([("edge", 0), ("edge", 365), ("edge", 366), ("edge", 31), ("edge", 396), ("edge", 90), ("edge", 91)])]  # both ends of a window
    return out


def _month(t):
    return t.year * 12 + t.month - 1


def _brute(rows, days):
    width = dt.timedelta(days=days)
    return sorted(((*r, sum(x[1] == r[1] and r[2] - width <= x[2] <= r[2] for x in rows)) for r in rows), key=repr)


def _whole(spark, rows, days=365):
    return rows_of(trailing_count(spark.createDataFrame(rows, SCHEMA), "k", "t", days=days))


def test_batch_equals_brute_force(spark):
    rows = _rows(250, 20, 5)
    assert _whole(spark, rows) == _brute(rows, 365) and _whole(spark, rows, 1) == _brute(rows, 1)


def test_month_by_month_equals_the_whole_and_reads_no_more_with_history(spark, tmp_path):
    rows = _rows(300, 14, 1)
    kept = TrailingCounts(spark, str(tmp_path / "t"), "k", "t", days=90)
    read = []
    for month in sorted({_month(r[2]) for r in rows}):
        done = kept.update(spark.createDataFrame([r for r in rows if _month(r[2]) == month], SCHEMA), f"m{month}")
        assert done.months == [month]
        read.append(len(done.files))
    assert rows_of(kept.attach(spark.createDataFrame(rows, SCHEMA))) == _whole(spark, rows, 90)
    months = {f.split("month=")[1].split("/")[0] for f in done.files}
    assert len(months) <= 5 and max(read[-4:]) <= max(read[5:9]) + 8  # a window's months, however long the history


def test_late_and_repeated_loads(spark, tmp_path):
    rows = _rows(200, 20, 2)
    kept = TrailingCounts(spark, str(tmp_path / "t"), "k", "t", days=40)
    late = [r for r in rows if r[0] % 7 == 0]  # rows of all months come last
    first = [r for r in rows if r[0] % 7]
    kept.update(spark.createDataFrame(first, SCHEMA), "first")
    before = rows_of(kept.attach(spark.createDataFrame(first, SCHEMA)))
    assert before == _whole(spark, first, 40)
    for _ in range(2):
        kept.update(spark.createDataFrame(late, SCHEMA), "late")
        assert rows_of(kept.attach(spark.createDataFrame(rows, SCHEMA))) == _whole(spark, rows, 40)


def test_a_late_key_leaves_other_keys_and_months_alone(spark, tmp_path):
    kept = TrailingCounts(spark, str(tmp_path / "t"), "k", "t", days=31)
    rows = [(i, k, START + dt.timedelta(days=30 * i)) for i in range(12) for k in ("a", "b")]
    kept.update(spark.createDataFrame(rows, SCHEMA), "first")
    done = kept.update(spark.createDataFrame([(99, "a", START + dt.timedelta(days=150))], SCHEMA), "late")
    at = _month(START + dt.timedelta(days=150))
    assert done.months == [at, at + 1, at + 2]
    everything = [*rows, (99, "a", START + dt.timedelta(days=150))]
    assert rows_of(kept.attach(spark.createDataFrame(everything, SCHEMA))) == _whole(spark, everything, 31)
    some = spark.createDataFrame([r for r in everything if _month(r[2]) == at], SCHEMA)
    assert rows_of(kept.attach(some, months=[at])) == rows_of(kept.attach(some))


def test_nulls_and_empty_loads(spark, tmp_path):
    kept = TrailingCounts(spark, str(tmp_path / "t"), "k", "t")
    none = spark.createDataFrame([], SCHEMA)
    assert kept.update(none, "none").months == [] and kept.attach(none).count() == 0
    rows = [(1, None, START), (2, None, START), (3, "a", None), (4, "a", START)]
    assert rows_of(kept.attach(spark.createDataFrame(rows, SCHEMA)).select("id", "prior_claims_12m")) == [(1, 0), (2, 0), (3, 0), (4, 0)]
    kept.update(spark.createDataFrame(rows, SCHEMA), "one")
    assert rows_of(kept.attach(spark.createDataFrame(rows, SCHEMA)).select("id", "prior_claims_12m")) == [(1, 2), (2, 2), (3, 0), (4, 1)]
