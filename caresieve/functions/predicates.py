"""Predicate strings and formulas of a protocol, compiled to columns; nothing is ever evaluated as code."""

from __future__ import annotations

import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

OPERATORS = {"<=": operator.le, ">=": operator.ge, "<": operator.lt, ">": operator.gt, "==": operator.eq, "!=": operator.ne}
_PREDICATE = re.compile(r"\s*(<=|>=|<|>|==|!=)\s*(-?\d+(?:\.\d+)?)\s*%?\s*")
_FORMULA = re.compile(r"\s*(\w+)\s*([-+*/])\s*(\w+)\s*")


class SpecError(ValueError):
    """A protocol says something that has no meaning here."""


def parse(text: str) -> tuple[str, float]:
    """('>=', 0.0) of '>= 0'; a trailing % is allowed."""
    m = _PREDICATE.fullmatch(text)
    if not m:
        raise SpecError(f"not a predicate: {text!r}")
    return m[1], float(m[2])


def predicate(text: str, value: Column) -> Column:
    """Whether value satisfies the predicate."""
    op, number = parse(text)
    return OPERATORS[op](value, F.lit(number))


def holds(text: str, value: float) -> bool:
    """The same for a number on the driver."""
    op, number = parse(text)
    return OPERATORS[op](value, number)


def violates_any(predicates: list[str], value: Column) -> Column:
    """Whether at least one predicate fails; a null value fails none."""
    out = F.lit(False)
    for p in predicates:
        out = out | ~predicate(p, value)
    return F.coalesce(out, F.lit(False))


def formula(text: str, names: dict[str, Column]) -> Column:
    """A formula of two operands, such as 'var2 - var1', over the named columns or numbers."""
    m = _FORMULA.fullmatch(text)
    if not m:
        raise SpecError(f"not a formula: {text!r}")

    def operand(x: str) -> Column:
        if x in names:
            return names[x]
        if re.fullmatch(r"\d+", x):
            return F.lit(int(x))
        raise SpecError(f"unknown name {x!r} in {text!r}")

    return {"-": operator.sub, "+": operator.add, "*": operator.mul, "/": operator.truediv}[m[2]](operand(m[1]), operand(m[3]))


def days_between(text: str, dates: dict[str, Column]) -> Column:
    """Days of a formula that subtracts one date from another."""
    m = _FORMULA.fullmatch(text)
    if not m or m[2] != "-" or m[1] not in dates or m[3] not in dates:
        raise SpecError(f"not a difference of dates: {text!r}")
    return F.datediff(dates[m[1]], dates[m[3]])
