import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import reports, rolling, scoring

ORIGINS = ["2021-03-31 00:00:00", "2021-04-30 00:00:00", "2021-06-01 12:00:00"]
SCHEMA = "t timestamp, known timestamp, y int, a double, b double"


def rows(n=4000, seed=3):
    """A rate that bends twice along ``a``, which a straight line in its log odds cannot follow; every tenth value is missing."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = dt.datetime(2021, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 240))
        a, b = rng.uniform(-3, 3), rng.gauss(5, 2)
        rate = 0.05 if a < 0 else 0.45 if a < 2 else 0.5
        y = int(rng.random() < rate)
        out.append((t, t + dt.timedelta(days=rng.randrange(40)), y, None if i % 10 == 0 else a, float("nan") if i % 11 == 0 else b))
    return out + [(None, out[0][1], 1, 0.0, 0.0), (out[0][0], None, 1, 0.0, 0.0), (out[0][0], out[0][1], None, 0.0, 0.0)]


def month_later(t, k):
    month = t.month - 1 + k
    year, month = t.year + month // 12, month % 12 + 1
    last = (dt.datetime(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return t.replace(year=year, month=month, day=min(t.day, last))


def role(row, origin):
    t, known, y = row[:3]
    if t is None or known is None or y is None:
        return None
    if t <= origin:
        return "train" if known <= origin else None
    return "calibrate" if t <= month_later(origin, 1) else "test" if t <= month_later(origin, 2) else None


def test_roles(spark):
    data = rows(800)
    got = rolling.role_counts(rolling.origin_roles(spark.createDataFrame(data, SCHEMA), ORIGINS + ORIGINS[:1], "t", "known", "y"), "y").collect()
    want = {}
    for text in ORIGINS:
        origin = dt.datetime.fromisoformat(text)
        for r in data:
            if role(r, origin):
                n, p = want.get((origin, role(r, origin)), (0, 0))
                want[origin, role(r, origin)] = (n + 1, p + r[2])
    assert {(r.origin, r.role): (r.n, r.n_positive) for r in got} == want and len(want) == 9
    with pytest.raises(ValueError, match="origins"):
        rolling.origin_roles(spark.createDataFrame(data, SCHEMA), [], "t", "known", "y")


def test_models_are_the_optimum(spark):
    data = rows(1500)
    models = rolling.fit_origins(rolling.origin_roles(spark.createDataFrame(data, SCHEMA), ORIGINS, "t", "known", "y"), ["a", "b"], "y")
    assert sorted(models) == [dt.datetime.fromisoformat(o) for o in ORIGINS]
    for origin, m in models.items():
        mine = [r for r in data if role(r, origin) == "train"]
        x = np.array([[math.nan if v is None else v for v in r[3:]] for r in mine], float)
        z = (x - np.nanmean(x, axis=0)) / np.nanstd(x, axis=0)
        z = np.column_stack([np.ones(len(z)), np.nan_to_num(z)])
        y = np.array([r[2] for r in mine])
        gradient = z.T @ (1 / (1 + np.exp(-z @ m.weights)) - y) / len(y) + 0.01 * np.array([0, 1, 1]) * m.weights
        assert len(mine) == m.n and np.abs(gradient).max() < 1e-7


def test_calibration_is_better_on_months_not_seen(spark):
    out = rolling.evaluate_origins(spark.createDataFrame(rows(20_000), SCHEMA), ORIGINS, ["a", "b"], "y", "t", "known").orderBy("origin").collect()
    assert [str(r.origin) for r in out] == ORIGINS
    for r in out:
        assert r.calibrated_loss < r.raw_loss < r.base_loss and r.n_blocks > 1 and min(r.n_train, r.n_calibrate, r.n_test) > 500


def test_scores_that_cannot_be_learned(spark):
    data = spark.createDataFrame(rows(600), SCHEMA)
    origins = ["2020-01-01 00:00:00", ORIGINS[0], "2021-08-20 00:00:00"]  # nothing known; all; nothing to test on
    out = {str(r.origin): r for r in rolling.evaluate_origins(data, origins, ["a", "b"], "y", "t", "known").collect()}
    none, whole, last = (out[o] for o in origins)
    assert (none.n_train, none.n_test, none.raw_loss, none.calibrated_loss) == (0, 0, None, None)
    assert whole.raw_loss > 0 and whole.calibrated_loss > 0
    assert last.n_train > 0 and (last.n_test, last.base_loss, last.calibrated_loss) == (0, None, None)
    one_class = rolling.evaluate_origins(data.withColumn("y", F.lit(1)), ORIGINS[:1], ["a", "b"], "y", "t", "known").first()
    assert one_class.n_train > 0 and one_class.raw_loss is None and one_class.n_blocks == 0
    assert rolling.evaluate_origins(data.where("false"), ORIGINS, ["a", "b"], "y", "t", "known").count() == 3


def test_features_without_values_or_spread(spark):
    data = spark.createDataFrame(rows(600), SCHEMA).withColumns({"void": F.lit(None).cast("double"), "same": F.lit(7), "wild": F.expr("CASE WHEN a > 2 THEN double('infinity') ELSE a END")})
    models = rolling.fit_origins(rolling.origin_roles(data, ORIGINS[:1], "t", "known", "y"), ["a", "void", "same", "wild"], "y")
    weights = next(iter(models.values())).weights
    assert np.isfinite(weights).all() and weights[2] == weights[3] == 0


def test_one_scan_of_the_rows(spark, tmp_path):
    spark.createDataFrame(rows(200), SCHEMA).write.parquet(str(tmp_path / "t"))
    dealt = rolling.origin_roles(spark.read.parquet(str(tmp_path / "t")), ORIGINS, "t", "known", "y")
    plan = rolling.role_counts(dealt, "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_classifier_needs_both_classes_and_some_value(spark):
    data = spark.createDataFrame([(0, 1.0, None), (1, 2.0, None), (None, 3.0, 1.0), (1, None, None), (0, 0.5, None)], "y int, a double, void double")
    scored = scoring.score_cases(scoring.fit_classifier(data, ["a", "void"], "y"), data)
    assert scored.count() == 5 and scored.where("score is null").count() == 0
    for bad in (data.where("false"), data.where("y = 1")):
        with pytest.raises(ValueError, match="classes"):
            scoring.fit_classifier(bad, ["a"], "y")
    with pytest.raises(ValueError, match="value"):
        scoring.fit_classifier(data, ["void"], "y")


def test_drift_of_categories_that_come_and_go(spark):
    data = spark.createDataFrame([("old", False)] * 3 + [("new", True)] * 2 + [("both", True), ("both", False), ("both", None), (None, True)], "c string, later boolean")
    out = {r.category: r for r in reports.category_drift(data, "c", F.col("later")).collect()}
    assert abs(out["old"].psi - (1e-4 - 0.75) * math.log(1e-4 / 0.75)) < 1e-9 and out["both"].psi == 0
    assert abs(out["new"].psi - (0.5 - 1e-4) * math.log(0.5 / 1e-4)) < 1e-9 and out[None].psi > 0
    assert all(abs(r.total_psi - sum(x.psi for x in out.values())) < 1e-9 for r in out.values())
    assert all(r.total_psi is None for r in reports.category_drift(data.where("not later"), "c", F.col("later")).collect())


def test_training_rows_are_stored_once_for_all_origins(spark, monkeypatch):
    seen, fit = [], rolling._fit

    def watched(train, times, *more):
        seen.append((train.count(), len(times)))
        return fit(train, times, *more)

    monkeypatch.setattr(rolling, "_fit", watched, raising=False)
    data = rows(900)
    out = rolling.evaluate_origins(spark.createDataFrame(data, SCHEMA), ORIGINS, ["a", "b"], "y", "t", "known").orderBy("origin").collect()
    want = [sum(role(r, dt.datetime.fromisoformat(o)) == "train" for r in data) for o in ORIGINS]
    assert [r.n_train for r in out] == want and seen == [(max(want), 3)]
