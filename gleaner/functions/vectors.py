"""Vector distances as column expressions (arrays of float, arithmetic in double)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "ip", "l2sq")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2sq(a: Column, b: Column) -> Column:
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: Column, b: Column, metric: str = "cosine") -> Column:
    if metric == "cosine":
        length = norm(a) * norm(b)
        return F.lit(1.0) - F.when(length == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(length, F.lit(0.0)))
    if metric == "ip":
        return F.lit(1.0) - dot(a, b)
    if metric == "l2sq":
        return l2sq(a, b)
    raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
