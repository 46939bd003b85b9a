"""Rolling-origin evaluation: at each of several origins in time a model learns from the labels known then, is calibrated on the
month that follows, and is judged on the month after that.

Training rows are stored once, each with the range of origins that train on it; only the rows of the months after an origin are dealt out. The
models of all origins are fitted together: a Newton step is one pass over the stored rows, in which a task sends one row of sums for each origin, and
only their totals reach the driver. Its cost grows with origins times the square of features, both of them parameters.

Rows without a time, a label or the time it became available have no role. Null, NaN and infinite features count as their
origin's mean; a feature without spread has no weight. An origin without training rows of both classes has no model: its scores, and the
losses that follow from them, are null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.calibration import isotonic_blocks, score_counts, with_rate
from larkspur.sources.workdir import new_dir

TRAIN, CALIBRATE, TEST = "train", "calibrate", "test"


def origin_roles(df: DataFrame, origins: list[str], time_col: str, available_col: str, label: str) -> DataFrame:
    """The rows of ``df`` with origin (timestamp) and role, once for each origin that uses them.

    Train: time and availability of the label lie at or before the origin. Calibrate: the time lies in the month after it. Test: in the
    month after that one. ``origins`` (at least one) are timestamp texts; equal texts count once.
    """
    if not origins:
        raise ValueError("no origins")
    spans = []
    for at in sorted(set(origins)):
        start = F.lit(at).cast("timestamp")
        spans.append(F.struct(start.alias("at"), (start + F.expr("INTERVAL 1 MONTH")).alias("middle"), (start + F.expr("INTERVAL 2 MONTHS")).alias("end")))
    time, available = F.col(time_col), F.col(available_col)
    known = df.where(time.isNotNull() & available.isNotNull() & F.col(label).isNotNull())
    dealt = known.withColumn("_span", F.explode(F.array(*spans)))
    role = F.when((time <= F.col("_span.at")) & (available <= F.col("_span.at")), TRAIN)
    role = role.when((time > F.col("_span.at")) & (time <= F.col("_span.middle")), CALIBRATE)
    role = role.when((time > F.col("_span.middle")) & (time <= F.col("_span.end")), TEST)
    return dealt.withColumns({"origin": F.col("_span.at"), "role": role}).where("role is not null").drop("_span")


def role_counts(roles: DataFrame, label: str) -> DataFrame:
    """origin, role, n and n_positive."""
    return roles.groupBy("origin", "role").agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("n_positive"))


@dataclass
class OriginModel:
    """Logistic regression of one origin on standardised features."""

    n: int
    mean: list[float]
    deviation: list[float]  # 0: no spread
    weights: np.ndarray  # intercept first
    base: float


def _number(feature: str) -> Column:
    value = F.col(feature).cast("double")
    return F.when(F.abs(value) < math.inf, value)  # neither null nor NaN nor infinite


def _with_margin(rows: DataFrame, models: dict, features: list[str]) -> DataFrame:
    """Rows of origins with a model, with standardised features z0, z1, ... and margin."""
    flat = [(at, *m.mean, *m.deviation, *map(float, m.weights)) for at, m in models.items()]
    names = [f"{part}{j}" for part in ("m", "d") for j in range(len(features))] + [f"w{j}" for j in range(len(features) + 1)]
    table = rows.sparkSession.createDataFrame(flat, "_at timestamp, " + ", ".join(f"_{c} double" for c in names))
    joined = rows.join(F.broadcast(table), F.col("origin") == F.col("_at"))  # a row for each origin
    z = {f"_z{j}": F.when(F.col(f"_d{j}") > 0, F.coalesce((_number(f) - F.col(f"_m{j}")) / F.col(f"_d{j}"), F.lit(0.0))).otherwise(0.0) for j, f in enumerate(features)}
    margin = sum((F.col(f"_w{j + 1}") * F.col(f"_z{j}") for j in range(len(features))), F.col("_w0"))
    return joined.withColumns(z).withColumn("_margin", margin)


def _training_rows(rows: DataFrame, low: Column, high: Column, features: list[str], label: str) -> DataFrame:
    """_lo and _hi (first and last place in the sorted origins that train on a row), _y and the features x0, x1, ... as finite numbers or null."""
    named = [_number(f).alias(f"x{j}") for j, f in enumerate(features)]
    return rows.select(low.cast("int").alias("_lo"), high.cast("int").alias("_hi"), (F.col(label) == 1).cast("double").alias("_y"), *named)


def _place(times: list, at: Column) -> Column:
    """How many of the sorted ``times`` lie before ``at``."""
    return sum((F.when(at > F.lit(t), 1).otherwise(0) for t in times), F.lit(0))


def fit_origins(roles: DataFrame, features: list[str], label: str, ridge: float = 0.01, steps: int = 25, tolerance: float = 1e-8) -> dict:
    """A model for each origin (by its timestamp) that has training rows of both classes.

    Minimised is the mean log loss plus ``ridge / 2`` times the squared weights, the intercept's left out, by Newton's method. A step
    that raises it is halved. All origins share a pass over the rows; passes end once no weight moves by ``tolerance``.
    """
    train = roles.where(F.col("role") == TRAIN)
    times = sorted(r.origin for r in train.select("origin").distinct().collect())  # a row for each origin
    place = _place(times, F.col("origin"))
    return _fit(_training_rows(train, place, place, features, label), times, len(features), ridge, steps, tolerance)[0]


def _fit(train: DataFrame, times: list, d: int, ridge: float = 0.01, steps: int = 25, tolerance: float = 1e-8) -> tuple[dict, dict]:
    """The models of :func:`fit_origins` and the number of training rows, both by origin, from rows of :func:`_training_rows`."""
    sums = [F.count("*").alias("n"), F.sum("_y").alias("p")]
    for j in range(d):
        x = f"x{j}"
        sums += [F.count(x).alias(f"c{j}"), F.avg(x).alias(f"m{j}"), F.var_pop(x).alias(f"v{j}"), F.min(x).alias(f"a{j}"), F.max(x).alias(f"b{j}")]
    groups = train.groupBy("_lo", "_hi").agg(*sums).collect()  # at most a row for each pair of origins
    models, sizes = {}, {}
    for k, at in enumerate(times):
        mine = [r for r in groups if r["_lo"] <= k <= r["_hi"]]
        n, p = sum(r.n for r in mine), sum(r.p for r in mine)
        sizes[at] = n
        if 0 < p < n:
            start = np.zeros(d + 1)
            start[0] = math.log(p / (n - p))
            moments = [_moments([r for r in mine if r[f"c{j}"]], j) for j in range(d)]
            models[at] = OriginModel(n, [m for m, _ in moments], [s for _, s in moments], start, p / n)
    if not models:
        return {}, sizes
    flat = np.append(0.0, np.full(d, ridge))
    step = {at: np.zeros(d + 1) for at in models}
    least = dict.fromkeys(models, math.inf)
    for _ in range(steps):
        fitted = [(k, models[at].mean, models[at].deviation, models[at].weights) for k, at in enumerate(times) if at in models]
        parts = train.mapInPandas(_newton_sums(fitted, d), "k int, s array<double>")  # a row for each task and origin
        size = 1 + (d + 1) + (d + 1) * (d + 1)
        for r in parts.groupBy("k").agg(*[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(size)]).collect():  # a row for each origin
            at, total = times[r.k], np.array(r[1:])
            m = models[at]
            goal = total[0] / m.n + (flat * m.weights**2).sum() / 2
            if goal > least[at] + 1e-12:
                step[at] = step[at] / 2
                m.weights = m.weights - step[at]
                continue
            least[at] = goal
            gradient = total[1 : d + 2] / m.n + flat * m.weights
            curve = total[d + 2 :].reshape(d + 1, d + 1) / m.n + np.diag(flat + 1e-12)
            step[at] = -np.linalg.solve(curve, gradient)
            m.weights = m.weights + step[at]
        if max(np.abs(s).max() for s in step.values()) < tolerance:
            break
    return models, sizes


def _moments(groups: list, j: int) -> tuple[float, float]:
    """Mean and deviation of feature ``j`` over groups that have values of it; a single value has no deviation at all."""
    if not groups:
        return 0.0, 0.0
    low, high = min(r[f"a{j}"] for r in groups), max(r[f"b{j}"] for r in groups)
    if low == high:
        return low, 0.0
    n = sum(r[f"c{j}"] for r in groups)
    mean = sum(r[f"c{j}"] * r[f"m{j}"] for r in groups) / n
    return mean, math.sqrt(sum(r[f"c{j}"] * (r[f"v{j}"] + (r[f"m{j}"] - mean) ** 2) for r in groups) / n)


def _newton_sums(fitted: list, d: int):
    """Loss, gradient and curvature of a task's rows, summed for each origin: a row is read once, whatever the number of origins that train on it."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {k: np.zeros(1 + (d + 1) * (d + 2)) for k, *_ in fitted}
        for batch in batches:
            low, high, every_y = (batch[c].to_numpy() for c in ("_lo", "_hi", "_y"))
            every_x = batch[[f"x{j}" for j in range(d)]].to_numpy(float)
            for k, mean, deviation, weights in fitted:
                mine = (low <= k) & (k <= high)
                if not mine.any():
                    continue
                y, spread = every_y[mine], np.array(deviation) > 0
                z = np.where(spread, np.nan_to_num((every_x[mine] - mean) / np.where(spread, deviation, 1.0)), 0.0)
                z = np.column_stack([np.ones(len(y)), z])
                margin = z @ weights
                small = np.exp(-np.abs(margin))  # log(1 + e^m) - y m, for margins of any size
                chance = np.where(margin >= 0, 1.0, small) / (1 + small)
                loss = np.maximum(margin, 0) + np.log1p(small) - y * margin
                curve = z.T @ (z * (chance * (1 - chance))[:, None])
                totals[k] += np.concatenate([[loss.sum()], z.T @ (chance - y), curve.ravel()])
        yield pd.DataFrame({"k": pd.Series(list(totals), dtype="int32"), "s": [t.tolist() for t in totals.values()]})

    return sums


def score_origins(roles: DataFrame, models: dict, features: list[str]) -> DataFrame:
    """The rows of origins with a model, with score (probability of the positive class by their origin's model)."""
    kept = roles.columns
    if not models:
        return roles.where("false").withColumn("score", F.lit(0.0))
    return _with_margin(roles, models, features).select(*kept, (1 / (1 + F.exp(-F.col("_margin")))).alias("score"))


def _loss(p: str) -> Column:
    """Sum of the log loss of counts p and n at probability ``p``."""
    q = F.least(F.greatest(F.col(p), F.lit(1e-15)), F.lit(1 - 1e-15))
    return F.sum(-F.col("p") * F.log(q) - F.col("n") * F.log(1 - q))


def evaluate_origins(df: DataFrame, origins: list[str], features: list[str], label: str, time_col: str, available_col: str) -> DataFrame:
    """One row for each origin: n_train, n_calibrate, n_test, n_blocks, and the mean log loss on the test month of the training base rate, the
    raw score and the calibrated score.

    Calibrated rates stay 1 / (n_calibrate + 2) away from 0 and 1, so a block without one of the classes costs a bounded loss. An origin without
    calibration rows has a null calibrated loss; one without test rows has null losses.
    """
    spark = df.sparkSession
    narrow = df.select(*dict.fromkeys([time_col, available_col, label, *features]))
    path = new_dir(spark, "rolling")
    narrow.write.parquet(f"{path}/rows")
    rows = spark.read.schema(narrow.schema).parquet(f"{path}/rows")
    times = [r.at for r in spark.createDataFrame([(at,) for at in set(origins)], "at string").select(F.col("at").cast("timestamp").alias("at")).distinct().orderBy("at").collect()]
    since = F.greatest(F.col(time_col).cast("timestamp"), F.col(available_col).cast("timestamp"))
    known = rows.where(F.col(time_col).isNotNull() & F.col(available_col).isNotNull() & F.col(label).isNotNull())
    train = _training_rows(known.where(since <= F.lit(times[-1])), _place(times, since), F.lit(len(times) - 1), features, label)
    train.write.parquet(f"{path}/train")
    models, n_train = _fit(spark.read.schema(train.schema).parquet(f"{path}/train"), times, len(features))
    roles = origin_roles(known.where(F.col(time_col) > F.lit(times[0])), origins, time_col, available_col, label).where(F.col("role") != TRAIN)
    scored = score_origins(roles, models, features)
    scored = scored.withColumn("_key", F.concat_ws("|", "role", F.unix_micros("origin")))
    counts = score_counts(scored, "_key", "score", F.col(label) == 1)
    counts.write.parquet(f"{path}/counts")  # both months: one pass
    both = spark.read.schema(counts.schema).parquet(f"{path}/counts")

    def of(role: str) -> DataFrame:
        return both.where(F.col("key").startswith(role + "|")).withColumn("key", F.substring_index("key", "|", -1).cast("long"))

    blocks = isotonic_blocks(of(CALIBRATE))
    blocks.write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(blocks.schema).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("key").agg(F.sum(F.col("p") + F.col("n")).alias("_learned"), F.count("*").alias("n_blocks"))
    bases = spark.createDataFrame([(at, m.base) for at, m in models.items()], "at timestamp, base double").select(F.unix_micros("at").alias("key"), "base")
    tested = with_rate(of(TEST), blocks).join(F.broadcast(sizes), "key", "left").join(F.broadcast(bases), "key")  # a row for each origin
    edge = 1 / (F.col("_learned") + 2)
    tested = tested.withColumn("calibrated", F.least(F.greatest("rate", edge), 1 - edge))
    total = F.sum(F.col("p") + F.col("n"))
    has_rate = F.when(F.count("rate") > 0, _loss("calibrated") / total)
    losses = tested.groupBy("key").agg((_loss("base") / total).alias("base_loss"), (_loss("score") / total).alias("raw_loss"), has_rate.alias("calibrated_loss"))
    sized = roles.groupBy(F.unix_micros("origin").alias("key")).agg(*[F.count_if(F.col("role") == r).alias(f"n_{r}") for r in (CALIBRATE, TEST)])
    every = spark.createDataFrame([(at, n_train[at]) for at in times], "at timestamp, n_train long").select(F.unix_micros("at").alias("key"), "n_train")
    out = every.join(sized, "key", "left").join(losses, "key", "left").join(sizes.select("key", "n_blocks"), "key", "left")
    whole = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_train", "n_calibrate", "n_test", "n_blocks")]
    return out.select(F.timestamp_micros("key").alias("origin"), *whole, "base_loss", "raw_loss", "calibrated_loss")
