import datetime as dt
import random

from conftest import rows_of

from larkspur.functions.projections import dedupe_columns
from larkspur.operators import enrichment, integrity, temporal


def day(n, hour=0):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n, hours=hour)


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, v string")
    parent = spark.createDataFrame([(1, "good"), (1, "again"), (3, "bad")], "k int, p string")
    split = integrity.fk_split(child, parent, "k")
    assert rows_of(split.matched) == [(1, "a"), (3, "d")]
    assert sorted(r.v for r in split.orphans.collect()) == ["b", "c"]
    assert split.quarantine("no_parent", "k", "child").count() == 2
    named = {r.v: r.fk_error for r in integrity.fk_reason(child, parent, parent.where("p <> 'bad'"), "k").collect()}
    assert named == {"a": None, "b": "policy_fk_missing", "c": "policy_fk_missing", "d": "policy_rejected"}


def test_unique_key(spark):
    rows = spark.createDataFrame([(1, 5), (1, 4), (2, 1), (None, 1), (None, 1)], "k int, o int")
    split = integrity.unique_key(rows, "k", ["o"])
    assert rows_of(split.matched) == sorted([(1, 4), (2, 1), (None, 1), (None, 1)], key=repr)
    assert rows_of(split.orphans) == [(1, 5)]


def test_unique_key_deals_a_hot_key(spark):
    """One row of each key stays, and no shuffle brings all rows of a key together."""
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.randrange(40), rng.choice("ab")) for _ in range(400)]
    split = integrity.unique_key(spark.createDataFrame(data, "k int, o int, v string"), "k", ["o"], salts=4)
    matched, orphans = rows_of(split.matched), rows_of(split.orphans)
    assert sorted(matched + orphans, key=repr) == sorted(data, key=repr)
    assert [r for r in matched if r[0] is None] == sorted((r for r in data if r[0] is None), key=repr)
    assert {r[:2] for r in matched if r[0]} == {(k, min(o for x, o, _ in data if x == k)) for k in (1, 2, 3)}
    assert len([r for r in matched if r[0]]) == 3
    plan = split.orphans._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffles and all("_salt" in line or "_group" in line for line in shuffles)


def test_enrich_drops_audit_columns_and_prefixes_clashes(spark):
    claims = spark.createDataFrame([(1, 7, "s", "x")], "claim_id int, policy_id int, source_file string, note string")
    policies = spark.createDataFrame([(7, "p", "y", 3)], "policy_id int, source_file string, note string, age int")
    out = enrichment.enrich(claims, policies)
    assert sorted(out.columns) == sorted(["policy_id", "claim_id", "source_file", "note", "policy_note", "age"])
    assert out.first().policy_note == "y"


def test_duplicate_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF("x", "x", "x", "x_dup")
    assert dedupe_columns(df).columns == ["x", "x_dup2", "x_dup3", "x_dup"]


def test_label_delay_counts_calendar_days(spark):
    claims = spark.createDataFrame([(1, day(0, 23)), (2, day(0))], "claim_id int, timestamp timestamp")
    labels = spark.createDataFrame([(1, 1, day(1, 1))], "claim_id int, is_fraud int, label_available_date timestamp")
    out = {r.claim_id: r.label_delay_days for r in enrichment.attach_labels(claims, labels).collect()}
    assert out == {1: 1, 2: None}


def test_as_of_join_against_brute_force(spark):
    rng = random.Random(3)
    versions = [(rng.choice([1, 1, 1, 2, None]), day(rng.randrange(200)), i) for i in range(120)]
    events = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, day(rng.randrange(200))]), i) for i in range(150)]
    v = spark.createDataFrame(versions, "k int, vt timestamp, vid int")
    e = spark.createDataFrame(events, "k int, t timestamp, eid int")
    got = {r.eid: r.v_vid for r in temporal.as_of_join(e, v, "k", "t", "vt", tie="vid", span_seconds=20 * 86_400).collect()}
    want = {}
    for k, t, i in events:
        before = [(vt, vid) for vk, vt, vid in versions if k is not None and t is not None and vk == k and vt <= t]
        want[i] = max(before)[1] if before else None
    assert got == want


def test_trailing_count_edges(spark):
    times = [day(0), day(365), day(365), day(366), day(900)]
    rows = spark.createDataFrame([(1, t, i) for i, t in enumerate(times)] + [(None, day(1), 9)], "k int, t timestamp, i int")
    got = {r.i: r.n for r in temporal.trailing_count(rows, "k", "t", name="n").collect()}
    assert got == {0: 1, 1: 3, 2: 3, 3: 3, 4: 1, 9: 1}
    less = {r.i: r.n for r in temporal.trailing_count(rows, "k", "t", name="n", exclude_current=True).collect()}
    assert less[1] == 2


def test_training_set_ends_at_its_date(spark):
    claims = spark.createDataFrame([(1,), (2,)], "claim_id int")
    labels = spark.createDataFrame([(1, 1, day(10)), (2, 0, day(10, 1))], "claim_id int, is_fraud int, label_available_date timestamp")
    assert rows_of(temporal.training_set(claims, labels, "2020-01-11 00:00:00").select("claim_id")) == [(1,)]


def test_flag_membership_both_ways(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    for limit in (10, 0):
        assert sorted((r.k or 0, r.f) for r in enrichment.flag_membership(df, members, "k", "f", limit).collect()) == [(0, 0), (1, 1), (2, 0)]
