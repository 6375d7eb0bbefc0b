"""Column builders for ratios and rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.text import col


def ratio(num: str | Column, den: str | Column) -> Column:
    """NULL when the denominator is zero or missing."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def per90(total: str | Column, minutes: str | Column) -> Column:
    return ratio(total, minutes) * 90


def per90_columns(totals: Mapping[str, str], minutes: str) -> list[Column]:
    """One rate per entry of {rate name: total column}."""
    return [per90(total, minutes).alias(name) for name, total in totals.items()]


def share_pct(part: str | Column, whole: str | Column, digits: int | None = None) -> Column:
    pct = ratio(part, whole) * 100
    return pct if digits is None else F.round(pct, digits)


def clamp(c: str | Column, lo: float, hi: float) -> Column:
    """Value limited to [lo, hi], NULL kept."""
    value = col(c)
    return F.when(value < lo, F.lit(float(lo))).when(value > hi, F.lit(float(hi))).otherwise(value)


def zscore(c: str | Column, mean: str | Column, sd: str | Column) -> Column:
    """NULL when the spread is zero or undefined."""
    return F.try_divide(col(c) - col(mean), F.nullif(col(sd), F.lit(0.0)))


def weighted_sum(columns: Sequence[str | Column], weights: Sequence[Column]) -> Column:
    """Σ value·weight with missing values counted as 0."""
    total = F.lit(0.0)
    for value, weight in zip(columns, weights):
        total = total + F.coalesce(col(value), F.lit(0.0)) * weight
    return total


def mean_abs_gap(left: Sequence[str], right: Sequence[str]) -> Column:
    """Mean of |left − right| over pairs, missing values counted as 0."""
    total = F.lit(0.0)
    for a, b in zip(left, right):
        total = total + F.abs(F.coalesce(F.col(a), F.lit(0.0)) - F.coalesce(F.col(b), F.lit(0.0)))
    return total / len(left)
