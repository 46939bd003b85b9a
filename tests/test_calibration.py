import random
from bisect import bisect_right

from pyspark.sql import functions as F

from larkspur.operators import calibration


def max_min(counts):
    """Isotonic rates of (p, n) in order of score, by the max-min form: plain and cubic."""
    out = []
    for i in range(len(counts)):
        rates = []
        for j in range(i + 1):
            rates.append(min(sum(c[0] for c in counts[j : k + 1]) / sum(sum(c) for c in counts[j : k + 1]) for k in range(i, len(counts))))
        out.append(max(rates))
    return out


def made(spark, seed, keys):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), rng.randrange(25) / 7, rng.random() < 0.2 + 0.02 * rng.randrange(25)) for _ in range(600)]
    rows += [("a", float("nan"), True), ("a", None, True), ("a", 1.0, None), ("b", -0.0, True), ("b", 0.0, False)]
    return spark.createDataFrame(rows, "k string, s double, y boolean")


def test_rates_equal_the_max_min_form(spark):
    for parts in (1, 3, 40):
        counts = calibration.score_counts(made(spark, parts, ["a", "b", None, ""]), "k", "s", F.col("y"))
        rated = calibration.with_rate(counts, calibration.isotonic_blocks(counts, parts), parts).collect()
        assert {r.key for r in rated} == {"a", "b", None, ""}
        for key in ("a", "b", None, ""):
            mine = sorted((r for r in rated if r.key == key), key=lambda r: r.score)
            want = max_min([(r.p, r.n) for r in mine])
            assert all(abs(r.rate - w) < 1e-12 for r, w in zip(mine, want, strict=True))
            assert len({r.score for r in mine}) == len(mine)


def test_blocks_increase_and_lose_no_row(spark):
    counts = calibration.score_counts(made(spark, 5, ["a", "b"]), "k", "s", F.col("y"))
    blocks = sorted(calibration.isotonic_blocks(counts, 7).collect(), key=lambda r: (r.key, r.low))
    for a, b in zip(blocks, blocks[1:], strict=False):
        assert a.key != b.key or (a.high < b.low and a.rate < b.rate)
    assert sum(b.p + b.n for b in blocks) == 602


def test_scores_between_and_outside_blocks(spark):
    learned = calibration.score_counts(made(spark, 9, ["a", "b"]), "k", "s", F.col("y"))
    blocks = calibration.isotonic_blocks(learned, 4)
    asked = spark.createDataFrame([("a", x / 10 - 2, x) for x in range(70)] + [("c", 1.0, 70)], "key string, score double, extra int")
    steps = sorted((b.low, b.rate) for b in blocks.where("key = 'a'").collect())
    for r in calibration.with_rate(asked, blocks, 5).collect():
        want = steps[max(bisect_right([s for s, _ in steps], r.score) - 1, 0)][1] if r.key == "a" else None
        assert r.rate == want and (r.key == "c" or r.score == r.extra / 10 - 2)


def test_no_rows(spark):
    none = calibration.score_counts(made(spark, 1, ["a"]).where("false"), "k", "s", F.col("y"))
    blocks = calibration.isotonic_blocks(none)
    assert blocks.collect() == [] and calibration.with_rate(none, blocks).collect() == []


def test_no_window_over_everything(spark):
    counts = calibration.score_counts(made(spark, 2, ["a"]), "k", "s", F.col("y"))
    plan = calibration.with_rate(counts, calibration.isotonic_blocks(counts))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan
