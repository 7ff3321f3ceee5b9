"""Ordered rule lists turned into one CASE expression.

A rule list is data: the first rule that fires gives the result. Building the
whole list into a single ``when`` chain keeps it one JVM expression that
whole-stage codegen compiles once, instead of one projection per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _result(value: Any, subject: Column) -> Column:
    """A rule result: literal, Column, or ("replace", pattern, replacement)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, tuple) and value and value[0] == "replace":
        _, pattern, replacement = value
        return F.regexp_replace(subject, pattern, replacement)
    return F.lit(value)


def _condition(kind: str, arg: str, subject: Column) -> Column:
    if kind == "contains":
        return subject.contains(arg)
    if kind == "equals":
        return subject == F.lit(arg)
    if kind == "regex":
        return subject.rlike(arg)
    raise ValueError(f"unknown rule kind {kind!r}")


def map_by_rules(subject: Column, rules: Sequence[tuple], default: Any) -> Column:
    """First-match mapping over ``(kind, arg, result[, unless_contains])`` rules.

    ``kind`` is ``contains``, ``equals`` or ``regex`` and is tested on
    ``subject``. The optional fourth item is a substring that vetoes the rule.
    ``default`` is a Column or literal returned when nothing fires.
    """
    expr = None
    for rule in rules:
        kind, arg, result = rule[0], rule[1], rule[2]
        cond = _condition(kind, arg, subject)
        if len(rule) > 3 and rule[3]:
            cond = cond & ~subject.contains(rule[3])
        value = _result(result, subject)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    fallback = _result(default, subject)
    return fallback if expr is None else expr.otherwise(fallback)


def classify(subject: Column, rules: Sequence[tuple[str, Any]], default: Any) -> Column:
    """First regex in ``(pattern, label)`` that finds a match in ``subject`` wins."""
    return map_by_rules(subject, [("regex", p, label) for p, label in rules], default)
