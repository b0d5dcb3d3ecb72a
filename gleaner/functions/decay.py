"""Decay curves for ranking by closeness to an origin."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _beyond(value: Column, origin: float, offset: float) -> Column:
    return F.greatest(F.lit(0.0), F.abs(value - F.lit(float(origin))) - F.lit(float(offset)))


def gauss(value: Column, origin, scale, offset=0.0, factor=0.5) -> Column:
    z = _beyond(value, origin, offset)
    return F.exp(F.lit(math.log(factor)) * z * z / F.lit(float(scale) ** 2))


def exponential(value: Column, origin, scale, offset=0.0, factor=0.5) -> Column:
    return F.exp(F.lit(math.log(factor)) * _beyond(value, origin, offset) / F.lit(float(scale)))


def linear(value: Column, origin, scale, offset=0.0, factor=0.5) -> Column:
    slope = (1.0 - factor) / float(scale)
    return F.greatest(F.lit(0.0), F.lit(1.0) - _beyond(value, origin, offset) * F.lit(slope))
