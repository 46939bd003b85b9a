import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from larkspur.operators.quality import apply_rules, empty_quarantine, observe_rules, quarantine_summary, quarantine_union, rule_metrics, to_dlq
from larkspur.operators.rules import DROP, FAIL, Rule, compile_rules, load_all_rules, load_rules, with_action

RULES = [Rule("a_set", "a IS NOT NULL", "error", "t"), Rule("a_positive", "a > 0", "error", "t"), Rule("b_small", "b < 10", "warn", "t")]
ROWS = [(1, 5), (None, 5), (-1, 50), (2, None), (0, 10)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "a int, b int")


def test_first_failure_wins_and_nothing_is_lost(spark):
    out = apply_rules(frame(spark), RULES)
    assert sorted((r.a, r.b, r.warn_b_small) for r in out.clean.collect()) == [(1, 5, False), (2, None, True)]
    assert sorted(r.error_rule for r in out.quarantine.collect()) == ["a_positive", "a_positive", "a_set"]


def test_record_keeps_nulls_and_source_columns_only(spark):
    record = apply_rules(frame(spark, [(None, 5)]), RULES).quarantine.first()
    assert record.record_json == '{"a":null,"b":5}'
    assert (record.error_severity, record.error_constraint, record.error_source_table) == ("error", "a IS NOT NULL", "t")


def test_all_failures(spark):
    out = apply_rules(frame(spark, [(None, 5)]), RULES, all_failures=True)
    assert sorted(r.error_rule for r in out.quarantine.collect()) == ["a_positive", "a_set"]


@pytest.mark.parametrize(("policy", "clean", "rejected"), [("fail", 2, 3), ("pass", 2, 3), ("drop", 2, 2)])
def test_null_policy(spark, policy, clean, rejected):
    rules = [RULES[1]] if policy == "drop" else RULES[:2]
    out = apply_rules(frame(spark), rules, on_null=policy)
    assert (out.clean.count(), out.quarantine.count()) == (clean, rejected)


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.tuples(st.none() | st.integers(-5, 5), st.none() | st.integers(0, 20)), max_size=20))
def test_rows_are_conserved(spark, rows):
    out = apply_rules(frame(spark, rows), RULES)
    assert out.clean.count() + out.quarantine.count() == len(rows)


def test_actions(spark):
    assert apply_rules(frame(spark), with_action(RULES[:2], DROP)).quarantine.count() == 0
    assert apply_rules(frame(spark), with_action(RULES[:2], DROP)).clean.count() == 2
    with pytest.raises(PySparkException, match="a_set"):
        apply_rules(frame(spark), with_action(RULES[:1], FAIL)).clean.collect()
    assert apply_rules(frame(spark, [(1, 1)]), with_action(RULES[:1], FAIL)).clean.count() == 1


def test_metrics_and_observation(spark):
    found = {r.rule: (r.n_pass, r.n_fail, r.n_null) for r in rule_metrics(frame(spark), RULES).collect()}
    assert found == {"a_set": (4, 1, 0), "a_positive": (2, 2, 1), "b_small": (2, 2, 1)}
    watched, seen = observe_rules(frame(spark), RULES)
    watched.count()
    assert seen.get["a_positive"] == 3
    assert rule_metrics(frame(spark), []).count() == 0


def test_duplicate_columns_and_empty_tables(spark):
    doubled = frame(spark).toDF("a", "a")
    assert "a_dup" in apply_rules(doubled, [Rule("always", "true")]).clean.columns
    empty = apply_rules(frame(spark, []), RULES)
    assert empty.clean.count() == empty.quarantine.count() == 0
    assert quarantine_summary(empty_quarantine(frame(spark))).count() == 0


def test_dlq_keeping_columns_and_union(spark):
    kept = to_dlq(frame(spark), "manual", constraint="c", source="s", keep_columns=True)
    assert {"a", "b", "error_rule", "error_timestamp"} <= set(kept.columns)
    assert quarantine_union(None, None) is None
    assert quarantine_union(to_dlq(frame(spark), "x"), None, to_dlq(frame(spark), "y").drop("error_source_table")).count() == 10


def test_rule_sets(tmp_path):
    names = [r.name for r in load_all_rules()]
    assert len(load_rules("claims")) == 9 and len(load_rules("labels")) == 3 and len(load_rules("policies")) == 8
    assert names.count("policy_id_not_null") == 3 and "bodyshop_flag_binary" in names  # claims, policies, enriched
    own = tmp_path / "own.yml"
    own.write_text("table: t\nrules:\n  - {name: n, constraint: 'x > 0', action: drop, tag: other}\n")
    assert load_rules(str(own)) == [Rule("n", "x > 0", "drop", "other")]
    compiled = compile_rules({"not_null": ["x"], "allowed_values": {"y": ["it's", 1]}, "conditional_rules": [{"condition": "a", "requires": "b"}]}, "t")
    assert [r.constraint for r in compiled] == ["x IS NOT NULL", "y IN ('it''s', 1)", "NOT coalesce(a, false) OR (b)"]


def test_other_severities_flag(spark):
    rules = [Rule("soft_one", "a > 0", "soft"), Rule("held", "b < 10", "quarantine"), Rule("told", "a > 1", "flag_only")]
    assert [r.action for r in rules] == ["warn", "error", "warn"]
    out = apply_rules(frame(spark), rules)
    assert sorted((r.a is None, r.warn_soft_one, r.warn_told) for r in out.clean.collect()) == [(False, False, True), (True, True, True)]
    assert out.quarantine.count() == 3


def test_unknown_blocks_are_refused(tmp_path):
    with pytest.raises(ValueError, match="not_nul"):
        compile_rules({"not_nul": ["x"]}, "t")
    own = tmp_path / "own.yml"
    own.write_text("table: t\nrule: []\n")
    with pytest.raises(ValueError, match="rule"):
        load_rules(str(own))
    assert compile_rules({"soft_rules": {"s": {"expression": "x > 0", "action": "drop"}, "f": {"expression": "x > 1"}}}, "t") == [Rule("s", "x > 0", "drop", "t"), Rule("f", "x > 1", "warn", "t")]
