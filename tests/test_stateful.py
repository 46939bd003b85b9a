"""The as-of join of two streams against the batch form and brute force."""

import datetime as dt
import random

import pytest
from conftest import rows_of

from larkspur.operators.temporal import as_of_join
from larkspur.sources.writers import stream_append
from larkspur.streaming import stateful, streams

START = dt.datetime(2024, 1, 1)
EVENT, VERSION = "id int, k string, t timestamp, amount double", "k string, since timestamp, version int, note string"


def test_due_events_are_answered_and_old_versions_forgotten():
    rng = random.Random(3)
    for _ in range(300):
        versions = [(rng.randrange(20), rng.choice([None, 1, 2]), f"v{i}") for i in range(rng.randrange(6))]
        events = [(rng.randrange(20), None, f"e{i}") for i in range(rng.randrange(6))]
        passed = rng.randrange(-1, 21)
        answered, kept, waiting = stateful.answer_due(versions, events, passed)

        def held(at, among):
            return max((v for v in among if v[0] <= at), key=stateful._rank, default=(None,) * 3)[2]

        assert sorted(answered) == sorted((e[2], held(e[0], versions)) for e in events if e[0] <= passed)
        assert sorted(waiting) == sorted(e for e in events if e[0] > passed)
        assert all(held(at, kept) == held(at, versions) for at in range(passed + 1, 21))
        assert sum(v[0] <= passed for v in kept) <= 1


def _random_rows(n, seed):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]  # most rows of one key

    def time():
        return None if rng.random() < 0.05 else START + dt.timedelta(days=rng.randrange(20), hours=rng.randrange(0, 24, 6), microseconds=rng.choice([0, 1, 999]))

    events = [(i, rng.choice(keys), time(), rng.choice([None, 1.5, float("inf")])) for i in range(n)]
    versions = [(rng.choice(keys), time(), i, rng.choice([None, "", 'q"\né'])) for i in range(n // 2)]
    return events, versions


def test_shuffled_arrival_and_restarts_equal_the_batch_join(spark, tmp_path):
    """Two loads whose rows overlap by days, a restart between them, and closing rows that move the watermark past the end."""
    events, versions = _random_rows(120, 1)
    rng, cut = random.Random(2), START + dt.timedelta(days=12)
    end = START + dt.timedelta(days=400)

    def load(t):  # before the cut with the first, but for some of the last four days
        return 1 if t is not None and (t >= cut or t >= cut - dt.timedelta(days=4) and rng.random() < 0.5) else 0

    event_loads, version_loads = [load(e[2]) for e in events], [load(v[1]) for v in versions]
    loads = [([e for e, x in zip(events, event_loads) if x == n], [v for v, x in zip(versions, version_loads) if x == n]) for n in (0, 1)]
    loads.append(([(-1, "end", end, None)], [("end", end, -1, None)]))
    out, progress, seen = str(tmp_path / "out"), str(tmp_path / "p"), []
    batch = as_of_join(spark.createDataFrame(events, EVENT), spark.createDataFrame(versions, VERSION), "k", "t", "since", tie="version")
    before = spark.conf.get(stateful.PROVIDER_CONF, None)
    for n, (some_events, some_versions) in enumerate(loads):
        rng.shuffle(some_events)
        rng.shuffle(some_versions)
        for name, rows, schema in (("e", some_events, EVENT), ("v", some_versions, VERSION)):
            spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(str(tmp_path / name))
        source = [spark.readStream.schema(s).parquet(str(tmp_path / x)) for x, s in (("e", EVENT), ("v", VERSION))]
        joined = stateful.stream_as_of(*source, "k", "t", "since", tie="version", late="5 days", salts=3)
        assert joined.columns == batch.columns
        with stateful.rocksdb_state(spark):
            streams.run_streams([stream_append(joined, out, progress)], timeout=240)
        seen.append(rows_of(spark.read.schema(joined.schema).parquet(out).where("id >= 0")))
    assert spark.conf.get(stateful.PROVIDER_CONF, None) == before
    want = rows_of(batch)
    assert 0 < len(seen[0]) < len(seen[1]) < len(want)  # answers come when the watermark has passed, and stay as they are
    assert set(map(repr, seen[0])) <= set(map(repr, seen[1])) <= set(map(repr, want))
    assert seen[2] == want


def test_ties_need_an_order(spark, tmp_path):
    events, versions = spark.createDataFrame([], EVENT), spark.createDataFrame([], VERSION)
    with pytest.raises(ValueError):
        stateful.stream_as_of(events, versions, "k", "t", "since", tie="note")


def test_keys_share_groups(spark, tmp_path):
    """Calls to the state store do not grow with keys: 300 keys in 3 x 2 groups, whole numbers of 19 digits kept."""
    big = 2**62
    events = [(i, f"k{i % 300}", START + dt.timedelta(hours=i % 7), 1.0) for i in range(600)]
    versions = [(f"k{i % 300}", START + dt.timedelta(hours=i % 5), big + i, None) for i in range(900)]
    kind = VERSION.replace("version int", "version long")
    end = START + dt.timedelta(days=400)
    for n, (e, v) in enumerate(((events, versions), ([(-1, "end", end, None)], [("end", end, -1, None)]))):
        spark.createDataFrame(e, EVENT).write.mode("append").parquet(str(tmp_path / "e"))
        spark.createDataFrame(v, kind).write.mode("append").parquet(str(tmp_path / "v"))
        source = [spark.readStream.schema(s).parquet(str(tmp_path / x)) for x, s in (("e", EVENT), ("v", kind))]
        joined = stateful.stream_as_of(*source, "k", "t", "since", tie="version", salts=2, buckets=3)
        with stateful.rocksdb_state(spark):
            query = stream_append(joined, str(tmp_path / "out"), str(tmp_path / "p"))
            streams.run_streams([query], timeout=240)
        if n == 0:
            groups = max(p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress)
            assert 0 < groups <= 6
    batch = as_of_join(spark.createDataFrame(events, EVENT), spark.createDataFrame(versions, kind), "k", "t", "since", tie="version")
    assert rows_of(spark.read.schema(joined.schema).parquet(str(tmp_path / "out")).where("id >= 0")) == rows_of(batch)
