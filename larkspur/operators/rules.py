"""Declarative data-quality rules: a name, a SQL predicate, what to do when it fails, and the table it belongs to."""

from __future__ import annotations

from dataclasses import dataclass, replace
from importlib import resources

import yaml

#: What an action does to a failing row.
QUARANTINE, FLAG, DROP, FAIL, EXPECT = "error", "warn", "drop", "fail", "expect"
#: Other words for them; every severity that is listed nowhere flags the row, as only errors take rows away.
ACTIONS = {"error": QUARANTINE, "quarantine": QUARANTINE, "warn": FLAG, "flag": FLAG, "flag_only": FLAG, "drop": DROP, "fail": FAIL, "expect": EXPECT}
BLOCKS = {"not_null", "domain_constraints", "allowed_values", "temporal_rules", "conditional_rules", "soft_rules"}
RULE_SETS = ("claims", "labels", "policies", "integrity", "derived", "bodyshops", "cross_table", "enriched")


@dataclass(frozen=True)
class Rule:
    """``action``: error (quarantine), warn (flag), drop (remove), fail (stop the job) or expect (count only).

    Words of ``ACTIONS`` are taken for what they stand for, any other severity for warn.
    """

    name: str
    constraint: str
    action: str = QUARANTINE
    tag: str = ""

    def __post_init__(self) -> None:
        object.__setattr__(self, "action", ACTIONS.get(self.action, FLAG))


def compile_rules(spec: dict, table: str) -> list[Rule]:
    """Predicates for structured rule kinds.

    ``not_null`` (columns), ``domain_constraints`` (column: comparison), ``allowed_values`` (column: list), ``temporal_rules``
    (predicates), ``conditional_rules`` (condition and what it requires) and ``soft_rules`` (name: expression and action, by
    default flagged). Conditional rules hold where the condition is false or null. A block of another name is an error.
    """
    if unknown := set(spec) - BLOCKS:
        raise ValueError(f"unknown blocks of rules for {table}: {', '.join(sorted(unknown))}")
    rules = [Rule(f"{c}_not_null", f"{c} IS NOT NULL", QUARANTINE, table) for c in spec.get("not_null", [])]
    rules += [Rule(f"{c}_domain", f"{c} {test}", QUARANTINE, table) for c, test in spec.get("domain_constraints", {}).items()]
    for column, values in spec.get("allowed_values", {}).items():
        listed = ", ".join(str(v) if isinstance(v, int | float) else "'" + str(v).replace("'", "''") + "'" for v in values)
        rules.append(Rule(f"{column}_allowed", f"{column} IN ({listed})", FLAG, table))
    rules += [Rule(f"temporal_{i}", text, FLAG, table) for i, text in enumerate(spec.get("temporal_rules", []), 1)]
    for i, r in enumerate(spec.get("conditional_rules", []), 1):
        rules.append(Rule(f"conditional_{i}", f"NOT coalesce({r['condition']}, false) OR ({r['requires']})", FLAG, table))
    for name, soft in spec.get("soft_rules", {}).items():
        rules.append(Rule(name, soft["expression"], soft.get("action", FLAG), table))
    return rules


def parse_rules(text: str) -> list[Rule]:
    """Rules of a YAML document with ``table`` and ``rules`` (and, or, ``structured``)."""
    spec = yaml.safe_load(text)
    table = spec["table"]
    if unknown := set(spec) - {"table", "rules", "structured"}:
        raise ValueError(f"unknown parts of the rule file for {table}: {', '.join(sorted(unknown))}")
    plain = [Rule(r["name"], r["constraint"], r.get("action", r.get("severity", QUARANTINE)), r.get("tag", table)) for r in spec.get("rules", [])]
    return plain + compile_rules(spec.get("structured", {}), table)


def load_rules(name: str) -> list[Rule]:
    """A rule set of this package by name, or of any YAML file by path."""
    if name in RULE_SETS:
        return parse_rules(resources.files("larkspur").joinpath("rules", f"{name}.yml").read_text())
    with open(name, encoding="utf-8") as f:
        return parse_rules(f.read())


def load_all_rules() -> list[Rule]:
    """All rule sets of this package, in a fixed order."""
    return [r for name in RULE_SETS for r in load_rules(name)]


def with_action(rules: list[Rule], action: str) -> list[Rule]:
    """The same rules with another action."""
    return [replace(r, action=action) for r in rules]


def load_contract(path: str | None = None, **values: object) -> dict:
    """The structured contract (tables, foreign_keys, derived_columns, reference_tables); ``values`` fill its placeholders.

    The shipped contract has one: ``current_year``.
    """
    if path is None:
        text = resources.files("larkspur").joinpath("rules", "documented.yml").read_text()
    else:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    for name, value in values.items():
        text = text.replace("{" + name + "}", str(value))
    return yaml.safe_load(text)


def contract_rules(contract: dict, table: str) -> list[Rule]:
    """The rules of one table of a contract."""
    return compile_rules(contract.get("tables", {}).get(table, {}), table)
