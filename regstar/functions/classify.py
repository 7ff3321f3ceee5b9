"""Rule-driven classification and code mapping (ordered CASE expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from regstar.domain import registrations as R
from regstar.functions.rules import classify, map_by_rules


def classify_fuel(fuel: Column, model_desc: Column, rules: Sequence[tuple] = R.FUEL_RULES,
                  trailer_words: str = R.TRAILER_FUEL_WORDS, unknown: str = R.UNKNOWN) -> Column:
    """Ordered fuel classes; a NULL fuel on a trailer-like model is DIESEL."""
    trailer_rule = (fuel.isNull() & F.lower(model_desc).rlike(trailer_words), "DIESEL")
    expr = None
    for pattern, label in rules:
        cond = fuel.rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    expr = expr.when(trailer_rule[0], trailer_rule[1]).otherwise(unknown)
    return F.upper(expr)


def classify_ownership(second_vehicle: Column, yes_values: Sequence[str] = R.SECOND_VEHICLE_YES) -> Column:
    flag = F.lower(F.trim(F.coalesce(second_vehicle, F.lit(""))))
    return F.when(flag.isin(*yes_values), F.lit("PRE_OWNED")).otherwise(F.lit("NEW"))


def classify_transport(category: Column, vehicle_class: Column) -> Column:
    cat = F.lower(F.trim(category))
    return (F.when(cat.rlike(R.NON_TRANSPORT_CATEGORY), F.lit("NON_TRANSPORT"))
            .when(cat.rlike(R.TRANSPORT_CATEGORY), F.lit("TRANSPORT"))
            .when(vehicle_class.rlike(R.TRANSPORT_CLASS), F.lit("TRANSPORT"))
            .otherwise(F.lit("NON_TRANSPORT")))


def map_office_name(c: Column, rules: Sequence[tuple] = R.OFFICE_NAME_RULES) -> Column:
    """Office names -> codes; values no rule knows are kept as they are."""
    return map_by_rules(F.upper(F.trim(c)), rules, c)


def standardize_code(c: Column, rules: Sequence[tuple] = R.OFFICE_CODE_RULES,
                     default: tuple = R.OFFICE_CODE_DEFAULT, fix_prefix: bool = False) -> Column:
    """Old and zero-padded office codes -> current codes; ``fix_prefix`` also turns a remaining TG into TS."""
    code = classify(F.upper(F.trim(c)), rules, default)
    return F.regexp_replace(code, "^TG", "TS") if fix_prefix else code
