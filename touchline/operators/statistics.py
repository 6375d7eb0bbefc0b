"""Contingency and rank statistics as aggregations."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.windows import running_totals


def chi2_tail(x: str | Column, dof: str | Column) -> Column:
    """P(χ² > x) in closed form for whole degrees of freedom.

    Spark has no built-in for it. The function only ever sees result rows.
    """

    def tails(values: pd.Series, freedoms: pd.Series) -> pd.Series:
        out = []
        for value, freedom in zip(values, freedoms):
            if not (value >= 0 and freedom >= 1):
                out.append(None)
                continue
            half = value / 2.0
            even = freedom % 2 == 0
            total, power = (0.0, 0.0) if even else (math.erfc(math.sqrt(half)), 0.5)
            while power < freedom / 2.0:
                term = math.exp(power * math.log(half) - half - math.lgamma(power + 1.0)) if half > 0 else float(power == 0)
                total, power = total + term, power + 1.0
            out.append(min(total, 1.0))
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(tails, T.DoubleType())(x, dof)


def chi2(df: DataFrame, row: str, column: str, by: Sequence[str] = (), p_value: bool = True) -> DataFrame:
    """Independence test of two categories, per group: n, χ², dof, Cramér's V, p.

    χ² = n·(Σ o²/(r·c) − 1), which needs only the cells that occur.
    """
    present = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    cells = present.groupBy(*by, row, column).agg(F.count(F.lit(1)).alias("_o"))
    rows = cells.groupBy(*by, row).agg(F.sum("_o").alias("_r"))
    cols = cells.groupBy(*by, column).agg(F.sum("_o").alias("_c"))
    share = F.col("_o") * F.col("_o") / (F.col("_r").cast("double") * F.col("_c"))
    terms = cells.join(rows, on=[*by, row]).join(cols, on=[*by, column])
    sums = terms.groupBy(*by).agg(
        F.sum("_o").alias("n"),
        F.sum(share).alias("_sum"),
        F.count_distinct(row).alias("n_rows"),
        F.count_distinct(column).alias("n_cols"),
    )
    small = F.least(F.col("n_rows"), F.col("n_cols")) - 1
    out = sums.select(
        *by,
        "n",
        F.greatest(F.col("n") * (F.col("_sum") - 1), F.lit(0.0)).alias("chi2"),
        ((F.col("n_rows") - 1) * (F.col("n_cols") - 1)).alias("dof"),
        small.alias("_small"),
    ).withColumn("cramers_v", cramers_v("chi2", "n", "_small"))
    out = out.drop("_small")
    return out.withColumn("p_value", chi2_tail("chi2", F.col("dof").cast("double"))) if p_value else out


def cramers_v(chi2_value: str, n: str, smaller_dim: str) -> Column:
    return F.sqrt(F.try_divide(F.col(chi2_value), (F.col(n) * F.col(smaller_dim)).cast("double")))


def max_deviation(df: DataFrame, row: str, column: str, by: str) -> DataFrame:
    """Per row category, the largest gap in percentage points between one group's
    row profile and the pooled one.

    Cells missing in a group count as 0 % as long as the row occurs in it.
    """
    cells = df.groupBy(by, row, column).agg(F.count(F.lit(1)).alias("_o"))

    def profile(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        part = table.groupBy(*keys, column).agg(F.sum("_o").alias("_cell"))
        whole = table.groupBy(*keys).agg(F.sum("_o").alias("_all"))
        pct = F.round(F.col("_cell") * 100.0 / F.col("_all"), 1)
        return part.join(whole, on=list(keys)).select(*keys, column, pct.alias(name))

    pooled = profile(cells, [row], "_pooled")
    grouped = profile(cells, [by, row], "_own")
    present = cells.select(by, row).distinct()
    grid = present.join(pooled, on=row)
    gap = F.abs(F.coalesce(F.col("_own"), F.lit(0.0)) - F.col("_pooled"))
    return (
        grid.join(grouped, on=[by, row, column], how="left")
        .groupBy(row)
        .agg(F.max(F.round(gap, 1)).alias("max_abs_pct_point_deviation"))
    )


def mann_whitney(
    df: DataFrame, is_first: Column, value: str, p_value: bool = True, slices: int | None = None
) -> DataFrame:
    """Two-sided U test of first group against the rest, with tie and continuity correction.

    Ranks come from counts per distinct value and a running total, so equal
    values are one row and nothing is sorted in one task beyond a slice.
    """
    data = df.select(is_first.alias("_first"), F.col(value).alias("_value")).dropna()
    counts = data.groupBy("_value").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_first")).alias("_n1")
    )
    below = running_totals(counts, [], ["_value"], {"_below": "_n"}, slices)
    mid_rank = F.col("_below") + (F.col("_n") + 1) / 2.0
    ties = (F.col("_n").cast("double") * F.col("_n") * F.col("_n")) - F.col("_n")
    sums = below.agg(
        F.sum("_n1").alias("n_first"),
        F.sum(F.col("_n") - F.col("_n1")).alias("n_second"),
        F.sum(F.col("_n1") * mid_rank).alias("_ranks"),
        F.sum(ties).alias("_ties"),
    )
    n1, n2 = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    n = n1 + n2
    u = F.col("_ranks") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1))))
    z = F.try_divide(F.greatest(F.abs(u - n1 * n2 / 2) - 0.5, F.lit(0.0)), sd)
    out = sums.select("n_first", "n_second", u.alias("u"), z.alias("z"))
    return out.withColumn("p_value", chi2_tail(F.col("z") * F.col("z"), F.lit(1.0))) if p_value else out


def text_summary(facts: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One-row table of facts as (metric, value) with the value as text."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics])
    return facts.select(F.inline(cells))
