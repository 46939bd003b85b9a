"""Sketches merged by period against exact values."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import sketches

SCHEMA = "t timestamp, v double, w double"
CUT = dt.datetime(2024, 4, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = []
    for _ in range(20_000):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(180))
        out.append((t, rng.gauss(0.3 if t >= CUT else 0.0, 1.0), float(rng.randrange(3))))
    return [*out, (dt.datetime(2024, 2, 1), None, float("nan")), (None, 1.0, None)]


def test_merged_sketches_keep_their_error(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    made = sketches.month_sketches(df, "t", ["v", "w"]).cache()
    got = {(r.period, r.column): r for r in sketches.sketch_percentiles(made.where("month is not null"), F.quarter("month"), [0.1, 0.5, 0.9]).collect()}
    for quarter in (1, 2):
        side = np.sort([v for t, v, _ in rows if t is not None and v is not None and (t >= CUT) == (quarter == 2)])
        r = got[quarter, "v"]
        assert r.n == len(side)
        assert all(abs(np.searchsorted(side, x) / len(side) - p) < 0.01 for x, p in zip(r.percentiles, (0.1, 0.5, 0.9)))
        exact = {e.period: e for e in sketches.exact_percentiles(df, "v", F.quarter("t"), [0.1, 0.5, 0.9]).collect()}[quarter]
        assert exact.n == len(side) and np.allclose(exact.percentiles, np.quantile(side, [0.1, 0.5, 0.9]))
    missing = {(r.month, r.column): r.n_missing for r in made.collect() if r.n_missing}
    assert missing == {(dt.date(2024, 2, 1), "v"): 1, (dt.date(2024, 2, 1), "w"): 1, (None, "w"): 1}


def test_drift_of_a_shift_and_of_none(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[0]], SCHEMA)
    found = {r.column: r for r in sketches.sketch_drift(sketches.month_sketches(df, "t", ["v", "w"]), F.col("month") >= CUT).collect()}
    a, b = (np.sort([v for t, v, _ in rows if t and v is not None and (t >= CUT) is late]) for late in (False, True))
    at = np.concatenate([a, b])
    ks = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
    edges = [-np.inf, *np.quantile(a, np.arange(1, 10) / 10), np.inf]
    p, q = (np.histogram(x, edges)[0] / len(x) for x in (a, b))
    assert abs(found["v"].ks - ks) < 0.015 and abs(found["v"].psi - ((q - p) * np.log(q / p)).sum()) < 0.02
    assert found["w"].ks < 0.03 and found["w"].psi < 0.01
    assert abs(sketches.exact_ks(df, "v", F.col("t") >= CUT).first().ks - ks) < 1e-12


def test_one_side_or_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sketches.sketch_drift(sketches.month_sketches(empty, "t", ["v"]), F.col("month") >= CUT).count() == 0
    one = spark.createDataFrame([(CUT, 1.0, None)], SCHEMA)
    got = sketches.sketch_drift(sketches.month_sketches(one, "t", ["v", "w"]), F.col("month") >= CUT).collect()
    assert [(r.column, r.n_before, r.n_after, r.psi, r.ks) for r in got] == [("v", 0, 1, None, None)]
    assert sketches.exact_ks(one, "v", F.col("t") >= CUT).first().ks is None


def test_percentiles_are_those_of_sql_to_the_last_bit(spark):
    """Interpolated as the twin does: values with cents, of which a plain sum of two rounded products misses some by a last bit."""
    import duckdb

    rng = random.Random(11)
    data = [(n if n < 60 else None, round(rng.uniform(900, 500_000), 2)) for n in range(61) for _ in range(n + 1)]
    data += [(70, 5.0)] * 40 + [(70, 7.25)] * 3 + [(71, -2.5), (72, None), (73, math.inf), (73, 1.0)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k INTEGER, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", data)
    want = con.execute("SELECT k, count(v), quantile_cont(v, [0.1, 0.5, 0.9]) FROM t WHERE v IS NOT NULL AND k IS DISTINCT FROM 73 GROUP BY k").fetchall()
    df = spark.createDataFrame(data, "k int, v double")
    for parts in (1, 7):
        got = {r.period: (r.n, r.percentiles) for r in sketches.exact_percentiles(df, "v", F.col("k"), [0.1, 0.5, 0.9], parts).collect()}
        assert got.pop(73) == (2, [math.inf] * 3)
        assert got == {k: (n, list(p)) for k, n, p in want}
