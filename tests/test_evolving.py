"""A source whose schema grows, rules with counts on a stream, replay and history in their odd cases."""

import datetime
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import history, replay
from larkspur.operators.rules import Rule
from larkspur.operators.split import split_write
from larkspur.sources import evolving
from larkspur.streaming import streams


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def ingest(spark, base, **kw):
    streams.run_streams([evolving.stream_evolving(spark, str(base / "landing"), str(base / "schemas"), str(base / "table"), str(base / "progress"), **kw)])


def test_schema_grows_and_no_value_is_lost(spark, tmp_path):
    land(tmp_path / "landing", "a.json", [{"id": 1, "v": 5, "s": {"x": 1}}, {"id": 2}, "no json", "[1]", ""])
    ingest(spark, tmp_path)
    land(tmp_path / "landing", "b.json", [{"id": 3, "v": 2.5, "new": True, "s": {"y": ["k"]}}, {"id": 4, "none": None}])
    ingest(spark, tmp_path)
    ingest(spark, tmp_path)  # nothing new
    land(tmp_path / "landing", "c.json", [{"id": 5, "v": "text", "s": "flat", "none": 7}])
    ingest(spark, tmp_path)
    assert list(evolving.SchemaStore(spark, str(tmp_path / "schemas")).versions()) == [1, 2, 3]
    rows = {r.id: r for r in evolving.read_evolved(spark, str(tmp_path / "schemas"), str(tmp_path / "table")).where("id is not null").collect()}
    assert [rows[i].v for i in range(1, 6)] == ["5", None, "2.5", None, "text"]
    assert json.loads(rows[1].s) == {"x": 1} and json.loads(rows[3].s) == {"y": ["k"]} and rows[5].s == "flat"
    assert rows[3].new is True and rows[1].new is None and rows[5].none == 7 and rows[4].none is None
    corrupt = evolving.read_evolved(spark, str(tmp_path / "schemas"), str(tmp_path / "table")).where("id is null").collect()
    assert sorted(r._rescued["_corrupt"] for r in corrupt) == ["[1]", "no json"]


def test_fixed_schema_rescues_what_does_not_fit(spark, tmp_path):
    land(tmp_path / "landing", "a.json", [{"id": 1, "v": 5}])
    ingest(spark, tmp_path, evolve=False)
    land(tmp_path / "landing", "b.json", [{"id": 2, "v": "five", "new": {"k": 1}}, {"id": 3, "v": None}])
    ingest(spark, tmp_path, evolve=False)
    rows = {r.id: r._rescued for r in evolving.read_evolved(spark, str(tmp_path / "schemas"), str(tmp_path / "table")).collect()}
    assert rows == {1: None, 2: {"v": "five", "new": '{"k":1}'}, 3: None}


def test_widening():
    long, double, text = T.LongType(), T.DoubleType(), T.StringType()
    assert evolving.widened(long, double) == double and evolving.widened(T.BooleanType(), long) == text
    assert evolving.widened(T.ArrayType(long), T.ArrayType(T.NullType())) == T.ArrayType(long)
    assert evolving.widened(T.ArrayType(long), long) == text


CLAIMS = "id long, v int, outcome_ string"


def test_failing_batch_leaves_nothing_and_restarts(spark, tmp_path):
    rules = [Rule("v_known", "v IS NOT NULL"), Rule("v_small", "v < 100", "fail"), Rule("v_even", "v % 2 = 0", "warn"), Rule("v_plus", "coalesce(v, 0) >= 0", "drop")]
    landing, base = str(tmp_path / "in"), str(tmp_path / "out")
    stream = lambda: spark.readStream.schema(CLAIMS).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, None, "c"), (4, -1, "d")], CLAIMS).coalesce(1).write.parquet(f"{landing}/1")
    fixed = [*rules[:1], *rules[2:]]
    run = lambda r: streams.run_streams([streams.stream_checked(stream(), r, base, f"{base}/progress")])
    run(fixed)
    spark.createDataFrame([(5, 4, "e"), (6, 500, "f")], CLAIMS).coalesce(1).write.parquet(f"{landing}/2")
    with pytest.raises(StreamingQueryException):
        run(rules)
    schema = T.StructType.fromDDL(f"{CLAIMS}, warn_v_even boolean")
    kept = streams.checked_rows(spark, base, schema)
    assert sorted((r.id, r.warn_v_even) for r in kept.clean.collect()) == [(1, True), (2, False)]
    assert [(r.error_rule, json.loads(r.record_json)["id"]) for r in kept.quarantine.collect()] == [("v_known", 3)]
    assert streams.checked_metrics(spark, base).select("batch_id").distinct().count() == 1
    run(fixed)
    assert sorted(r.id for r in streams.checked_rows(spark, base, schema).clean.collect()) == [1, 2, 5, 6]
    counts = streams.checked_metrics(spark, base).groupBy("rule").agg(F.sum("n_pass"), F.sum("n_fail"), F.sum("n_null"))
    assert {tuple(r) for r in counts.collect()} == {("v_known", 5, 1, 0), ("v_even", 3, 2, 1), ("v_plus", 5, 1, 0)}


def test_split_has_one_scan_and_any_columns(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b string")
    empty = split_write(df, [Rule("a_known", "a IS NOT NULL")], str(tmp_path / "e"))
    assert empty.clean.count() == 0 and empty.quarantine.count() == 0 and empty.metrics.first().n_pass == 0
    with pytest.raises(ValueError):
        split_write(spark.createDataFrame([(1,)], "outcome int"), [], str(tmp_path / "o"))
    without = split_write(spark.createDataFrame([(1, "x")], "a int, b string"), [], str(tmp_path / "n"))
    assert [tuple(r) for r in without.clean.collect()] == [(1, "x")]


def at(day):
    return datetime.datetime(2024, 1, day)


def test_history_of_late_and_equal_observations(spark, tmp_path):
    path, schema = str(tmp_path / "h"), "k string, t timestamp, v int, w string"
    loads = [
        [("a", at(1), 1, "x"), ("a", at(20), 1, "x"), ("b", at(5), None, None), (None, at(1), 1, "x"), ("a", None, 9, "x")],
        [("a", at(10), 2, "x"), ("b", at(6), None, None), ("c", at(3), 7, "z")],
        [("a", at(10), 2, "x"), ("a", at(10), 3, "x")],
    ]
    for rows in loads:
        table = history.update_history(spark, path, spark.createDataFrame(rows, schema), "k", "t", buckets=3, span_seconds=4 * 86_400)
    want = {("a", at(1), at(10), 1), ("a", at(10), at(20), 3), ("a", at(20), None, 1), ("b", at(5), None, None), ("c", at(3), None, 7)}
    assert {(r.k, r.valid_from, r.valid_to, r.v) for r in table.where("is_change").collect()} == want
    again = history.update_history(spark, path, spark.createDataFrame(loads[2], schema), "k", "t", buckets=3, span_seconds=4 * 86_400)
    assert {(r.k, r.valid_from, r.valid_to, r.v) for r in again.where("is_change").collect()} == want
    events = spark.createDataFrame([(1, "a", at(9)), (2, "a", at(10)), (3, "b", at(1)), (4, "d", at(1)), (5, "a", None), (6, None, at(1))], "i int, k string, at timestamp")
    seen = {r.i: (r.v, r.valid_from, r.is_backfilled) for r in history.enrich_as_of(events, again.drop("t"), "k", "at", backfill=True).collect()}
    assert seen == {1: (1, at(1), False), 2: (3, at(10), False), 3: (None, at(5), True), 4: (None, None, False), 5: (1, at(1), True), 6: (None, None, False)}
    plain = {r.i: r.valid_from for r in history.enrich_as_of(events, again.drop("t"), "k", "at").collect()}
    assert plain == {1: at(1), 2: at(10), 3: None, 4: None, 5: None, 6: None}


def test_ledger_releases_each_record_once(spark, tmp_path):
    ledger = replay.Ledger(spark, str(tmp_path / "ledger"))
    schema = "id long, k string, t timestamp, x double"
    rows = [(1, "a", at(1), 0.5), (2, "b", at(2), None), (2, "b", at(2), None), (3, None, None, 1.0)]
    parents = spark.createDataFrame([("a",), (None,)], "k string")
    load = lambda name, r, p: sorted((tuple(x) for x in replay.load_with_replay(ledger, spark.createDataFrame(r, schema), p, "k", name, "s").collect()), key=repr)
    assert load("1", rows, parents) == [rows[0]]
    assert sum(r.n for r in ledger.open().collect()) == 3
    both = parents.union(spark.createDataFrame([("b",)], "k string"))
    for _ in range(2):  # a repeated load gives the same
        assert load("2", [(4, "b", None, 1.0)], both) == [(2, "b", at(2), None), (2, "b", at(2), None), (4, "b", None, 1.0)]
        assert [r.n for r in ledger.open().collect()] == [1]
    assert load("3", [], both) == []
