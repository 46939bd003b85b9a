"""As-of join of two streams: every event gets the version of its key that held at the event's own time, however both arrive.

The state of a key is its versions and the events that wait. An event is answered once the watermark (the slower of both streams', less
``late``) has passed its time, as no version at or before it can come any more; versions are forgotten once a later one is at or before the
watermark. A key's events are dealt over ``salts`` groups, each of which holds the key's versions, so a hot key is not one task.

Calls to the state store cost more than rows, so keys share groups: there are ``buckets`` times ``salts`` of them, however many keys there are, and a
group's rows are stored in chunks. A batch that wakes a group reads its whole state, which is the versions still needed of keys / ``buckets`` keys
and a share of the waiting events; more ``buckets`` make that less. Both numbers are part of the state: a checkpoint goes on with those it was made with.

Edge cases: events of a null key or time come out at once, unmatched; versions of a null key or time match nothing. Versions of equal time go by
``tie`` (a whole number, date or time; nulls first), then by their JSON text (the largest wins), in whatever order they came. Rows more than ``late`` behind
are dropped by Spark, which counts them in the query's progress (``numRowsDroppedByWatermark``): ``late`` must cover the disorder of the streams.
Values travel as JSON, so map columns need keys of text.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SALTS, BUCKETS = 8, 512
CHUNK = 1000

_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_STATE = "rows string"  # a chunk: (key, time, tie, body) rows as JSON
_ANSWER = "event string, version string"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed state needs; the session is as before afterwards."""
    before = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_CONF)
        else:
            spark.conf.set(PROVIDER_CONF, before)


def _rank(version: tuple) -> tuple:
    at, tie, body = version
    return at, tie is not None, tie or 0, body


def answer_due(versions: list[tuple], waiting: list[tuple], passed: int) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """(event, version) of the events at or before ``passed``, then the versions and the events to keep. All are (time, tie, body)."""
    versions = sorted(versions, key=_rank)
    answered, place = [], -1
    for at, _, body in sorted((e for e in waiting if e[0] <= passed), key=lambda e: e[0]):
        while place + 1 < len(versions) and versions[place + 1][0] <= at:
            place += 1
        answered.append((body, versions[place][2] if place >= 0 else None))
    over = sum(v[0] <= passed for v in versions)
    return answered, versions[max(over - 1, 0) :], [e for e in waiting if e[0] > passed]


def _chunks(rows: list[tuple]) -> list[tuple]:
    """(key, time, tie, body) rows as chunks of the state."""
    return [(json.dumps(rows[i : i + CHUNK]),) for i in range(0, len(rows), CHUNK)]


def _by_key(chunks: Iterator[tuple]) -> dict[str, list[tuple]]:
    found = defaultdict(list)
    for (chunk,) in chunks:
        for key, *row in json.loads(chunk):
            found[key].append(tuple(row))
    return found


def _flat(of_keys: dict[str, list[tuple]]) -> list[tuple]:
    return [(key, *row) for key, rows in of_keys.items() for row in rows]


class _AsOf(StatefulProcessor):
    """State of a group of keys; one timer stands at the least time that the watermark has not passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", _STATE)
        self.waiting = handle.getListState("waiting", _STATE)
        self.timer = handle.getValueState("timer", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        versions, events, unmatched = [], [], []
        for part in rows:
            for k, at, tie, body, is_event in zip(part["k"], part["at"], part["tie"], part["body"], part["is_event"]):
                if at is None or k is None:
                    unmatched.append(body)
                else:
                    (events if is_event else versions).append((k, int(at), None if tie is None else int(tie), body))
        if versions:
            self.versions.appendList(_chunks(versions))
        if events:
            self.waiting.appendList(_chunks(events))
        if versions or events:
            self._wake(min(row[1] for row in versions + events))
        if unmatched:
            yield pd.DataFrame({"event": unmatched, "version": None})

    def _wake(self, at: int) -> None:
        """A timer at ``at``, unless one stands before it."""
        ms, stands = max(-(-at // 1000), 1), self.timer.get()  # whole milliseconds, rounded up
        if stands is not None and stands[0] <= ms:
            return
        if stands is not None:
            self.handle.deleteTimer(stands[0])
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held, asked = _by_key(self.versions.get()), _by_key(self.waiting.get())
        answers, versions, waiting = [], {}, {}
        for k in held.keys() | asked.keys():
            answered, versions[k], waiting[k] = answer_due(held.get(k, []), asked.get(k, []), passed)
            answers += answered
        kept, later = _flat(versions), _flat(waiting)
        if len(kept) < sum(map(len, held.values())):
            self.versions.put(_chunks(kept))
        if answers:
            self.waiting.put(_chunks(later)) if later else self.waiting.clear()
        self.timer.clear()  # it has expired
        ahead = [row[1] for row in kept + later if row[1] > passed]
        if ahead:
            self._wake(min(ahead))
        if answers:
            yield pd.DataFrame(answers, columns=["event", "version"])

    def close(self) -> None:
        pass


def stream_as_of(events: DataFrame, versions: DataFrame, key: str, event_time: str, version_time: str, tie: str | None = None, prefix: str = "v_", late: str = "1 day", salts: int = SALTS, buckets: int = BUCKETS) -> DataFrame:
    """The stream form of ``temporal.as_of_join``: events with the columns (prefixed) of the version that held at their time.

    Start it in append mode inside :func:`rocksdb_state`, with a checkpoint: a restart goes on with the stored state.
    """
    if tie is not None and not isinstance(versions.schema[tie].dataType, T.IntegralType | T.DateType | T.TimestampType):
        raise ValueError(f"{tie} must be a whole number, a date or a time to break ties")

    def packed(df: DataFrame, time: str, is_event: bool):
        columns = [F.col(f"`{c}`") for c in df.columns if is_event or c != key]
        body = F.to_json(F.struct(*columns), _JSON)
        by = F.lit(None) if is_event or tie is None else F.unix_date(tie) if isinstance(df.schema[tie].dataType, T.DateType) else F.unix_micros(tie) if isinstance(df.schema[tie].dataType, T.TimestampType) else F.col(tie)
        parts = [F.col(key).cast("string").alias("k"), F.col(time).cast("timestamp").alias("t"), by.cast("long").cast("string").alias("tie"), body.alias("body"), F.lit(is_event).alias("is_event")]
        return df.select(*parts).withWatermark("t", late)

    asked = packed(events, event_time, True).withColumn("salt", F.pmod(F.xxhash64("body"), F.lit(salts)).cast("int"))
    known = packed(versions, version_time, False).where("k is not null and t is not null").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    bucket = F.pmod(F.xxhash64(F.coalesce("k", "body")), F.lit(buckets)).cast("int")
    both = asked.unionByName(known).withColumns({"at": F.unix_micros("t").cast("string"), "bucket": bucket})  # numbers as text: pandas would make nullable ones floats
    answered = both.groupBy("bucket", "salt").transformWithStateInPandas(_AsOf(), _ANSWER, "Append", "EventTime")
    kept = T.StructType([f for f in versions.schema.fields if f.name != key])
    rows = answered.select(F.from_json("event", events.schema, _JSON).alias("e"), F.from_json("version", kept, _JSON).alias("v"))
    return rows.select("e.*", *[F.col(f"v.`{c}`").alias(f"{prefix}{c}") for c in kept.names])
