"""Structured predicates; each is a plain Column that can reach the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def gt(field: str, value) -> Column:
    return F.col(field) > F.lit(value)


def ge(field: str, value) -> Column:
    return F.col(field) >= F.lit(value)


def lt(field: str, value) -> Column:
    return F.col(field) < F.lit(value)


def le(field: str, value) -> Column:
    return F.col(field) <= F.lit(value)


def eq(field: str, value) -> Column:
    return F.col(field) == F.lit(value)


def has(field: str, value) -> Column:
    """Value match on an array field."""
    return F.array_contains(F.col(field), value)


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
