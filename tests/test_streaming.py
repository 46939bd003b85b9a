import datetime as dt
import json

import pytest
from conftest import rows_of

from larkspur.operators.quality import apply_rules
from larkspur.operators.rules import Rule
from larkspur.sources.writers import stream_append
from larkspur.streaming import streams

SCHEMA = "k int, v double"


def land(folder, month, rows):
    path = folder / "2024" / f"{month:02d}"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"data{len(list(path.iterdir()))}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_stream_equals_batch_and_a_restart_adds_nothing(spark, tmp_path):
    landing, table, progress = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "p")
    for m in (1, 2, 3):
        land(landing, m, [{"k": m * 10 + i, "v": float(i)} for i in range(4)])

    def run():
        streams.run_streams([streams.stream_bronze(spark, str(landing), SCHEMA, table, progress, ["year", "month"])])
        return rows_of(spark.read.schema("k int, v double, year string, month string").parquet(table).select("k", "v", "year", "month"))

    first = run()
    assert first == rows_of(streams.batch_bronze(spark, str(landing), SCHEMA).select("k", "v", "year", "month"))
    assert run() == first
    land(landing, 3, [{"k": 99, "v": 1.0}])
    assert len(run()) == len(first) + 1


def test_rules_on_a_stream(spark, tmp_path):
    rules = [Rule("v_positive", "v > 0", "error", "t")]
    rows = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], SCHEMA)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = [str(tmp_path / x) for x in ("clean", "bad", "p")]
    streams.run_streams([streams.stream_silver(source, rules, *out)])
    want = apply_rules(rows, rules)
    assert rows_of(spark.read.parquet(out[0]).select("k", "v")) == rows_of(want.clean.select("k", "v"))
    assert spark.read.parquet(out[1]).count() == want.quarantine.count() == 10


def test_unlabelled_claims_come_out_after_the_interval(spark, tmp_path):
    def write(name, i, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name / f"b{i}"))

    t = dt.datetime(2024, 1, 1)
    claim, label = "claim_id int, timestamp timestamp", "claim_id int, is_fraud int, label_available_date timestamp"
    write("claims", 0, [(1, t), (2, t)], claim)
    write("labels", 0, [(1, 1, t + dt.timedelta(days=20))], label)

    def run():
        claims = spark.readStream.schema(claim).parquet(str(tmp_path / "claims/*"))
        labels = spark.readStream.schema(label).parquet(str(tmp_path / "labels/*"))
        joined = streams.stream_attach_labels(claims, labels).select("claim_id", "is_fraud")
        streams.run_streams([stream_append(joined, str(tmp_path / "out"), str(tmp_path / "p"))])
        return rows_of(spark.read.schema("claim_id int, is_fraud int").parquet(str(tmp_path / "out")))

    assert run() == [(1, 1)]
    late = t + dt.timedelta(days=400)
    write("claims", 1, [(3, late)], claim)
    write("labels", 1, [(9, 0, late)], label)
    assert run() == [(1, 1), (2, None)]


def test_a_stream_cut_off_by_time_is_an_error(spark, tmp_path):
    endless = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "p")).start()
    with pytest.raises(TimeoutError):
        streams.run_streams([endless], timeout=1)
    assert not endless.isActive


def test_without_a_given_time_streams_are_awaited_without_limit():
    class Query:
        isActive, asked = False, None

        def awaitTermination(self, *limit):
            self.asked = limit
            return None

    q = Query()
    streams.run_streams([q])
    assert q.asked == ()
