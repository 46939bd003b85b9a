"""The cost curve against brute force."""

import random

from larkspur.operators.reports import cost_curve, least_cost
from pyspark.sql import functions as F

SCHEMA = "s double, y int"


def _brute(rows):
    nan = float("nan")
    scores = {s for s, _ in rows if s is not None and s == s}
    out = []
    for t in [*scores, None]:
        flags = [t is not None and s is not None and s == s and s >= t for s, _ in rows]
        tp, fp, fn, tn = (sum(f is a and (y == 1) is b for f, (_, y) in zip(flags, rows)) for a, b in ((True, True), (True, False), (False, True), (False, False)))
        out.append((t, tp, fp, fn, tn, fn * 8 + fp * 3))
    assert nan not in scores
    return sorted(out, key=repr)


def test_equals_brute_force_with_ties_and_odd_scores(spark):
    rng = random.Random(4)
    odd = [(None, 1), (float("nan"), 1), (None, 0), (0.0, None), (-0.0, 1), (float("inf"), 0), (float("-inf"), 1)]
    rows = [(rng.choice([rng.random(), rng.randrange(5) / 4]), int(rng.random() < 0.4)) for _ in range(400)] + odd
    curve = cost_curve(spark.createDataFrame(rows, SCHEMA), "s", F.col("y") == 1, missed=8, alarm=3, parts=7)
    want = _brute(rows)
    assert sorted((tuple(r) for r in curve.collect()), key=repr) == want
    best = least_cost(curve).first()
    flagless_first = min(want, key=lambda r: (r[5], -float("inf") if r[0] is None else -r[0]))
    assert best.total_cost == flagless_first[5] and best.threshold == flagless_first[0]


def test_no_window_over_the_whole_table(spark):
    curve = cost_curve(spark.range(50).selectExpr("id / 7 AS s", "CAST(id % 2 AS int) AS y"), "s", F.col("y") == 1)
    plan = curve._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_empty_and_unscored(spark):
    assert [tuple(r) for r in cost_curve(spark.createDataFrame([], SCHEMA), "s", F.col("y") == 1).collect()] == [(None, 0, 0, 0, 0, 0)]
    unscored = cost_curve(spark.createDataFrame([(None, 1), (None, 0)], SCHEMA), "s", F.col("y") == 1)
    assert [tuple(r) for r in unscored.collect()] == [(None, 0, 0, 1, 1, 800)]
