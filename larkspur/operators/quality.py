"""Single-pass rule evaluation.

All predicates of a rule set become columns of one projection: the name of the first failing error rule, and one flag for each
warn rule. Clean rows, rejected rows and counts are selections on it, so a rule more costs an expression and not a scan.

A predicate that is null counts as ``on_null`` says: ``fail`` (the default: nothing vanishes), ``pass``, or ``drop`` (the row is
in neither output). For every rule set with ``fail`` or ``pass``: rows in = clean + rejected + dropped by rules of action drop.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.projections import dedupe_columns
from larkspur.operators.rules import DROP, FAIL, FLAG, QUARANTINE, Rule
from larkspur.schemas import QUARANTINE as QUARANTINE_SCHEMA

FAILED, DROPPED = "_failed_rule", "_dropped"


@dataclass
class Checked:
    """Rows that passed (with warn flags), and rejected rows in the quarantine schema."""

    clean: DataFrame
    quarantine: DataFrame


def fails(rule: Rule, on_null: str = "fail") -> Column:
    """True where the rule fails, never null."""
    return ~F.coalesce(F.expr(rule.constraint).cast("boolean"), F.lit(on_null != "fail"))


def tag_rules(df: DataFrame, rules: list[Rule], on_null: str = "fail") -> DataFrame:
    """``df`` with ``_failed_rule`` (first failing error rule or null), ``_dropped`` and ``warn_<rule>`` flags."""
    errors = [r for r in rules if r.action == QUARANTINE]
    drops = [fails(r, on_null) for r in rules if r.action == DROP]
    if on_null == "drop":
        drops += [F.expr(r.constraint).isNull() for r in errors]
    first = F.coalesce(*[F.when(fails(r, on_null), r.name) for r in errors], F.lit(None).cast("string"))
    added = {f"warn_{r.name}": fails(r, "fail" if on_null == "drop" else on_null) for r in rules if r.action == FLAG}
    for r in rules:
        if r.action == FAIL:
            first = F.when(fails(r, on_null), F.raise_error(F.lit(f"rule {r.name} failed: {r.constraint}")).cast("string")).otherwise(first)
    return df.withColumns({FAILED: first, DROPPED: reduce(Column.__or__, drops, F.lit(False)), **added})


def to_dlq(df: DataFrame, name: Column | str, rules: list[Rule] | None = None, severity: str = QUARANTINE, constraint: str = "", source: str = "", keep_columns: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Rows in the quarantine schema; ``record_json`` holds the source columns with their nulls.

    ``name`` is a fixed rule name, or a column of names that ``rules`` explains. ``keep_columns`` keeps the columns instead of the JSON.
    """
    named = F.lit(name) if isinstance(name, str) else name
    if rules is None:
        facts = {"error_severity": F.lit(severity), "error_constraint": F.lit(constraint), "error_source_table": F.lit(source)}
    else:
        facts = _facts(named, rules)
    if keep_columns:
        return df.withColumns({"error_rule": named, **facts, "error_timestamp": F.current_timestamp()})
    return df.select(_record(columns or df.columns), named.alias("error_rule"), *[v.alias(k) for k, v in facts.items()], F.current_timestamp().alias("error_timestamp"))


def _facts(named: Column, rules: list[Rule]) -> dict[str, Column]:
    """Severity, constraint and source of the rule of that name: one lookup in a literal map."""
    fields = {"error_severity": "action", "error_constraint": "constraint", "error_source_table": "tag"}
    if not rules:
        return {k: F.lit(None).cast("string") for k in fields}
    entries = [x for r in rules for x in (F.lit(r.name), F.struct(*[F.lit(getattr(r, f)).alias(f) for f in fields.values()]))]
    found = F.try_element_at(F.create_map(*entries), named)
    return {k: found[f] for k, f in fields.items()}


def _record(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}).alias("record_json")


def dead_letter_columns(name: Column, rules: list[Rule], columns: list[str]) -> list[Column]:
    """The fields of a dead letter (quarantine schema) as columns."""
    return [_record(columns), name.alias("error_rule"), *[v.alias(k) for k, v in _facts(name, rules).items()], F.current_timestamp().alias("error_timestamp")]


def apply_rules(df: DataFrame, rules: list[Rule], on_null: str = "fail", all_failures: bool = False) -> Checked:
    """Split ``df``: a row goes to quarantine once, with its first failing error rule, or once for each with ``all_failures``.

    The order of the rules is the order of precedence. Repeated column names get a suffix first.
    """
    df = dedupe_columns(df)
    tagged = tag_rules(df, rules, on_null)
    flags = [f"warn_{r.name}" for r in rules if r.action == FLAG]
    kept = tagged.where(F.col(FAILED).isNull() & ~F.col(DROPPED)).select(*[F.col(f"`{c}`") for c in df.columns], *flags)
    bad = tagged.where(F.col(FAILED).isNotNull() & ~F.col(DROPPED))
    errors = [r for r in rules if r.action == QUARANTINE]
    if all_failures and errors:
        each = F.array_compact(F.array(*[F.when(fails(r, on_null), r.name) for r in errors]))
        bad = bad.withColumn(FAILED, F.explode(each))
    return Checked(kept, to_dlq(bad, F.col(FAILED), errors, columns=df.columns))


def rule_metrics(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule, n_pass, n_fail and n_null of every rule, from one aggregation over ``df``; no row is removed."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, n_pass long, n_fail long, n_null long")
    counts = []
    for i, r in enumerate(rules):
        test = F.expr(r.constraint).cast("boolean")
        counts += [F.count_if(test).alias(f"p{i}"), F.count_if(~test).alias(f"f{i}"), F.count_if(test.isNull()).alias(f"n{i}")]
    rows = [F.struct(F.lit(r.name).alias("rule"), F.col(f"p{i}").alias("n_pass"), F.col(f"f{i}").alias("n_fail"), F.col(f"n{i}").alias("n_null")) for i, r in enumerate(rules)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def observe_rules(df: DataFrame, rules: list[Rule], name: str = "rules") -> tuple[DataFrame, object]:
    """``df`` unchanged with an observation that counts every rule's failures while some other action runs.

    Spark cannot serialize the tasks of its classifiers in a session that has used an observation; ``split.split_write`` counts without.
    """
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[F.count_if(fails(r)).alias(r.name) for r in rules]), seen


def quarantine_union(*frames: DataFrame | None) -> DataFrame | None:
    """All quarantines as one; missing columns become null, ``None`` is skipped."""
    present = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present) if present else None


def empty_quarantine(df: DataFrame) -> DataFrame:
    """No rows in the quarantine schema."""
    return df.sparkSession.createDataFrame([], QUARANTINE_SCHEMA)


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """Rejected rows by source table, rule and severity."""
    return quarantine.groupBy("error_source_table", "error_rule", "error_severity").agg(F.count("*").alias("n"))
