"""Label loads replace only the months they label, whole or not at all."""

import datetime as dt
import random

import pytest
from conftest import rows_of

from pyspark.sql import types as T

from larkspur.operators.label_upsert import LabelledClaims

CLAIM, LABEL = "claim_id int, timestamp timestamp, amount double", "claim_id int, is_fraud int, label_available_date timestamp"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def table(spark, tmp_path):
    return LabelledClaims(spark, str(tmp_path / "t"), *(T._parse_datatype_string(s) for s in (CLAIM, LABEL)))


def _files(table):
    found = table.read().select("year", "month", "_metadata.file_path").distinct().collect()
    return {(r.year, r.month): {x.file_path for x in found if (x.year, x.month) == (r.year, r.month)} for r in found}


def _want(claims, labels):
    best = {}
    for k, f, at in labels:
        best[k] = max(best.get(k, (dt.datetime.min, -1)), (at, f))
    return sorted(((*c, *(best[c[0]][::-1] if c[0] in best else (None, None))) for c in claims), key=repr)


def _state(table):
    return rows_of(table.read().drop("year", "month"))


def test_three_loads_of_labels(spark, table):
    rng = random.Random(1)
    claims = [(i, T0 + dt.timedelta(days=5 * i), float(i)) for i in range(60)] + [(None, T0, 1.0), (5, T0, 2.0), (61, None, 3.0)]
    assert len(table.add_claims(spark.createDataFrame(claims, CLAIM), "c0")) == 11
    loads = [
        [(i, rng.randrange(2), T0 + dt.timedelta(days=5 * i + 40)) for i in range(20)],
        [(i, rng.randrange(2), T0 + dt.timedelta(days=5 * i + 40)) for i in range(15, 40)] + [(3, 1, T0)],  # the last is older than what is known
        [(i, 1, T0 + dt.timedelta(days=900)) for i in (50, 51, 61, 777)] + [(50, 0, T0 + dt.timedelta(days=901)), (None, 1, T0)],
    ]
    so_far = []
    for n, labels in enumerate(loads):
        before = _files(table)
        touched = table.add_labels(spark.createDataFrame(labels, LABEL), f"l{n}")
        so_far += [x for x in labels if x[0] is not None]
        assert _state(table) == _want(claims, so_far)
        after = _files(table)
        assert 0 < len(touched) < len(after)
        assert all((after[m] == before[m]) == (m not in touched) for m in after)
        assert table.add_labels(spark.createDataFrame(labels, LABEL), f"l{n}") == [] and _files(table) == after
    assert table.add_claims(spark.createDataFrame([(777, T0, 0.0)], CLAIM), "c1") == [(2024, 1)]  # its label came first
    assert _state(table) == _want([*claims, (777, T0, 0.0)], so_far)


def test_a_load_that_breaks_off_changes_nothing(spark, table, monkeypatch):
    claims, labels = [(1, T0, 1.0), (2, T0, 2.0)], [(1, 1, T0)]
    table.add_claims(spark.createDataFrame(claims, CLAIM), "c0")
    before = _files(table)
    with monkeypatch.context() as m:
        m.setattr(LabelledClaims, "_name", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.add_labels(spark.createDataFrame(labels, LABEL), "l0")
    assert _files(table) == before and _state(table) == _want(claims, [])
    assert table.add_labels(spark.createDataFrame(labels, LABEL), "l0") == [(2024, 1)]
    assert _state(table) == _want(claims, labels)


def test_empty_loads_and_clashes(spark, table, tmp_path):
    none = spark.createDataFrame([], LABEL)
    assert table.add_labels(none, "l0") == [] and table.add_claims(spark.createDataFrame([], CLAIM), "c0") == [] and table.read().count() == 0
    with pytest.raises(ValueError):
        LabelledClaims(spark, str(tmp_path), *(T._parse_datatype_string(s) for s in (CLAIM, LABEL + ", amount double")))
