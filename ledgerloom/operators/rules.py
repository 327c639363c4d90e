"""Evaluator for the declarative rule catalogue.

Rule types and their expressions: NOT_NULL (none), RANGE (``BETWEEN a AND b`` or comparisons), REGEX (a pattern for the
whole value), REFERENTIAL (``table.column`` that must hold the value) and FRESHNESS (``<= n DAYS``: the age of a table's
newest day). An ERROR rule blocks: the rows that break it are rejected under its number, and a stale table stops the run. A
WARNING rule is counted and logged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.convert import to_decimal

_NUMBER = r"[+-]?\d+(?:\.\d+)?"
_BETWEEN = re.compile(rf"^\s*BETWEEN\s+({_NUMBER})\s+AND\s+({_NUMBER})\s*$", re.IGNORECASE)
_COMPARISON = re.compile(rf"^\s*(>=|<=|<>|=|>|<)\s*({_NUMBER})\s*$")

_DAYS = re.compile(r"^\s*<=\s*(\d+)\s+DAYS?\s*$", re.IGNORECASE)

_OPERATORS = {
    ">=": Column.__ge__, "<=": Column.__le__, ">": Column.__gt__, "<": Column.__lt__,
    "=": Column.__eq__, "<>": Column.__ne__,
}


def range_condition(value: Column, expression: str) -> Column:
    """``BETWEEN a AND b``, or comparisons with the column left out, joined by AND.

    Only numbers and these operators are accepted, so a catalogue row cannot smuggle in SQL.
    """
    between = _BETWEEN.match(expression)
    if between:
        low, high = (F.lit(bound).cast("decimal(38,6)") for bound in between.groups())
        return value.between(low, high)
    conditions = []
    for part in re.split(r"\s+AND\s+", expression.strip(), flags=re.IGNORECASE):
        match = _COMPARISON.match(part)
        if not match:
            raise ValueError(f"unsupported rule expression: {expression!r}")
        operator, bound = match.groups()
        conditions.append(_OPERATORS[operator](value, F.lit(bound).cast("decimal(38,6)")))
    return reduce(Column.__and__, conditions)


def rule_failed(column: str, rule_type: str, expression: str | None) -> Column:
    """True when a staged (text) value breaks the rule. A RANGE rule does not judge missing
    text, and text that is no number breaks it."""
    raw = F.col(column)
    if rule_type == "NOT_NULL":
        return raw.isNull()
    if rule_type == "RANGE":
        inside = range_condition(to_decimal(raw, 38, 6), expression)
        return raw.isNotNull() & ~F.coalesce(inside, F.lit(False))
    if rule_type == "REGEX":
        return raw.isNotNull() & ~raw.rlike(f"^(?:{expression})$")
    raise ValueError(f"unsupported rule type for single rows: {rule_type}")


class RuleError(RuntimeError):
    """A rule of severity ERROR that concerns a whole table is broken."""


def parent_column(expression: str) -> tuple[str, str]:
    """Table and column of a REFERENTIAL rule."""
    table, dot, column = (expression or "").strip().partition(".")
    if not (table and dot and column):
        raise ValueError(f"a REFERENTIAL rule names table.column, not {expression!r}")
    return table, column


def is_stale(expression: str, slots: Iterable, today: date) -> bool:
    """Whether a FRESHNESS rule is broken, from the slots' statistics alone; a table without days is stale."""
    match = _DAYS.match(expression or "")
    if not match:
        raise ValueError(f"unsupported rule expression: {expression!r}")
    newest = max((s.high for s in slots if s.high is not None), default=None)
    return newest is None or (today - newest).days > int(match[1])


def with_broken_rules(rows: DataFrame, rules: list, parents: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ``rule_id``, the first ERROR rule that a row breaks, and ``warned``, the WARNING rules it breaks.

    A REFERENTIAL rule costs one outer join with the distinct values of its column; hot values are on the streamed side.
    """
    out, tests = rows, {}
    for rule in sorted((r for r in rules if r.rule_type != "FRESHNESS"), key=lambda r: r.rule_id):
        if rule.rule_type == "REFERENTIAL":
            table, column = parent_column(rule.rule_expression)
            known, value = f"_known_{rule.rule_id}", f"_value_{rule.rule_id}"
            values = parents[table].select(F.col(column).alias(value)).distinct().withColumn(known, F.lit(True))
            out = out.join(values, F.col(rule.target_column) == F.col(value), "left")
            tests[rule] = F.col(rule.target_column).isNotNull() & F.col(known).isNull()
        else:
            tests[rule] = rule_failed(rule.target_column, rule.rule_type, rule.rule_expression)
    errors = [F.when(test, F.lit(rule.rule_id)) for rule, test in tests.items() if rule.severity == "ERROR"]
    warnings = [F.when(test, F.lit(rule.rule_id)) for rule, test in tests.items() if rule.severity != "ERROR"]
    none = F.lit(None).cast("int")
    return out.select(*rows.columns, F.coalesce(*errors, none).cast("int").alias("rule_id"),
                      F.array_compact(F.array(*warnings)).cast("array<int>").alias("warned"))


def rule_text(rule) -> str:
    return " ".join(filter(None, (f"rule {rule.rule_id}:", rule.target_column, rule.rule_type, rule.rule_expression)))


def _referential(df: DataFrame, rule, parents: dict[str, DataFrame]) -> DataFrame:
    """Rows checked and rows whose value the parent lacks; equal values are counted before they are looked up."""
    table, column = parent_column(rule.rule_expression)
    if table not in parents:
        raise ValueError(f"rule {rule.rule_id} needs the table {table}")
    value = F.col(rule.target_column)
    counted = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    known = parents[table].select(F.col(column).alias("value")).distinct().withColumn("known", F.lit(True))
    missing = F.col("value").isNotNull() & F.col("known").isNull()
    return counted.join(known, "value", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("rows_failed"))


def _listed(rule, rows_checked: Column, rows_failed: Column) -> list[Column]:
    return [F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.target_table).alias("target_table"),
            F.lit(rule.target_column).alias("target_column"), F.lit(rule.rule_type).alias("rule_type"),
            F.lit(rule.severity).alias("severity"), rows_checked.cast("bigint").alias("rows_checked"),
            rows_failed.cast("bigint").alias("rows_failed")]


def rule_report(staged: dict[str, DataFrame], rules: DataFrame, parents: dict[str, DataFrame] | None = None,
                slots: dict[str, list] | None = None, today: date | None = None) -> DataFrame:
    """Rows checked and failed per active rule: one aggregation per staged table, one more per REFERENTIAL rule.

    FRESHNESS rules are judged from ``slots`` (a table's slots as the manifest knows them) at ``today`` and read no table; a
    stale one counts as one failure.
    """
    by_table: dict[str, list] = {}
    for rule in rules.where("is_active").orderBy("rule_id").collect():  # the catalogue is small
        by_table.setdefault(rule.target_table, []).append(rule)
    parts = []
    for table, its_rules in by_table.items():
        fresh = [r for r in its_rules if r.rule_type == "FRESHNESS"]
        for rule in fresh if slots is not None and table in slots else []:
            rows = sum(s.rows or 0 for s in slots[table])
            stale = is_stale(rule.rule_expression, slots[table], today)
            parts.append(rules.sparkSession.range(1).select(*_listed(rule, F.lit(rows), F.lit(int(stale)))))
        if table not in staged:
            continue
        simple = [r for r in its_rules if r.rule_type not in ("FRESHNESS", "REFERENTIAL")]
        if simple:
            failures = [F.count_if(rule_failed(r.target_column, r.rule_type, r.rule_expression))
                        .alias(f"f{r.rule_id}") for r in simple]
            counted = staged[table].agg(F.count("*").alias("rows_checked"), *failures)
            listing = F.array(*[F.struct(*_listed(r, F.col("rows_checked"), F.col(f"f{r.rule_id}"))) for r in simple])
            parts.append(counted.select(F.inline(listing)))
        for rule in (r for r in its_rules if r.rule_type == "REFERENTIAL"):
            found = _referential(staged[table], rule, parents or staged)
            parts.append(found.select(*_listed(rule, F.col("rows_checked"), F.col("rows_failed"))))
    if not parts:
        raise ValueError("no active rule matches the given tables")
    return reduce(DataFrame.unionByName, parts)
