"""Conditions on a value: ``{{value}} > 100``, ``{{value}} != done``, or a bare ``{{value}}``.

The operator is found once, in the configured text, and the column is bound to it; data never becomes part of an
expression. ``==`` and ``!=`` compare trimmed texts, the others numbers. A null value never meets a condition. A side
that is no number is an error of the row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACE = "{{value}}"
_OPERATOR = re.compile(r"!=|==|>=|<=|>|<")


def trimmed(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _side(text: str, value: Column) -> Column:
    parts = text.split(PLACE)
    if len(parts) == 1:
        return F.lit(text.strip())
    if not any(p.strip() for p in parts) and len(parts) == 2:
        return value.cast("string")
    return F.concat(*(x for i, p in enumerate(parts) for x in ([value.cast("string")] if i else []) + [F.lit(p)]))


def condition(text: str, value: Column, semantics: str = "documented") -> tuple[Column, Column]:
    """Is it met (never null), and an error text or null. ``compat``: ``>=`` and ``<=`` fail as they do in the field."""
    none = F.lit(None).cast("string")
    found = _OPERATOR.search(text)
    if not found:
        side = _side(text, value)
        return F.coalesce(side != "", F.lit(False)), none
    left, operator, right = _side(text[: found.start()], value), found.group(), _side(text[found.end() :], value)
    if operator in ("==", "!="):
        same = trimmed(left) == trimmed(right)
        return F.coalesce(same if operator == "==" else ~same, F.lit(False)), none
    if semantics == "compat" and operator in (">=", "<="):
        return F.lit(False), F.when(value.isNotNull(), F.lit(f"condition cannot be read: {text}"))
    numbers = [trimmed(x).try_cast("double") for x in (left, right)]
    met = {">": numbers[0] > numbers[1], "<": numbers[0] < numbers[1], ">=": numbers[0] >= numbers[1], "<=": numbers[0] <= numbers[1]}[operator]
    bad = value.isNotNull() & (numbers[0].isNull() | numbers[1].isNull())
    return F.coalesce(met, F.lit(False)), F.when(bad, F.concat(F.lit(f"condition needs numbers: {text}: "), value.cast("string")))
