"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_present(df: DataFrame, ids: Sequence[str], columns: Sequence[str], key: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long, leaving out missing values."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(ids), list(columns), key, value).filter(F.col(value).isNotNull())


def pivot_known(df: DataFrame, ids: Sequence[str], key: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long to wide for a known list of names, as one aggregation."""
    return df.groupBy(*ids).agg(*[F.max(F.when(F.col(key) == n, F.col(value))).alias(n) for n in names])


def two_context_wide(
    df: DataFrame,
    keys: Sequence[str],
    flag: str,
    columns: Sequence[str],
    first: str = "club_",
    second: str = "nat_",
    delta: str | None = "delta_",
) -> DataFrame:
    """One row per key with both contexts side by side; keys lacking one context drop out."""
    aggs: list[Column] = []
    for c in columns:
        aggs.append(F.max(F.when(~F.col(flag), F.col(c))).alias(f"{first}{c}"))
        aggs.append(F.max(F.when(F.col(flag), F.col(c))).alias(f"{second}{c}"))
    wide = (
        df.groupBy(*keys)
        .agg(F.count_if(~F.col(flag)).alias("_n1"), F.count_if(F.col(flag)).alias("_n2"), *aggs)
        .filter((F.col("_n1") > 0) & (F.col("_n2") > 0))
        .drop("_n1", "_n2")
    )
    if delta is None:
        return wide
    return wide.select("*", *[(F.col(f"{second}{c}") - F.col(f"{first}{c}")).alias(f"{delta}{c}") for c in columns])


def match_sides(df: DataFrame, shared: Sequence[str], home: Mapping[str, str], away: Mapping[str, str]) -> DataFrame:
    """Two rows per match, one for each side, without a second scan.

    ``home`` and ``away`` give {output: source} for the two sides.
    """

    def side(columns: Mapping[str, str], is_home: bool) -> Column:
        return F.struct(F.lit(is_home).alias("is_home"), *[F.col(src).alias(out) for out, src in columns.items()])

    both = F.inline(F.array(side(home, True), side(away, False)))
    return df.select(*shared, both)


def metric_long(wide: DataFrame, key: str, metrics: Sequence[str], prefixes: Mapping[str, str]) -> DataFrame:
    """Rows (key, metric, context, value) from prefixed columns."""
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(label).alias("context"), F.col(f"{p}{m}").cast("double").alias("value"))
            for m in metrics
            for p, label in prefixes.items()
        ]
    )
    return wide.select(key, F.inline(cells))


def crosstab(df: DataFrame, row: str, column: str, columns: Sequence[object], prefix: str = "n_") -> DataFrame:
    """Counts per row value with one zero-filled column per category, and the row total."""
    counts = [F.count_if(F.col(column) == c).alias(f"{prefix}{c}") for c in columns]
    return df.groupBy(row).agg(*counts, F.count_if(F.col(column).isin(*columns)).alias("total"))


def row_pct(table: DataFrame, row: str, names: Sequence[str], total: str = "total", digits: int = 1) -> DataFrame:
    """Each cell as % of its row, with the largest cell and its name (first wins a tie)."""
    pct = {n: F.round(F.try_divide(F.col(n) * 100.0, F.col(total)), digits) for n in names}
    out = table.select(row, *[e.alias(n) for n, e in pct.items()])
    best = F.greatest(*[F.col(n) for n in names])
    which = F.when(F.lit(False), "")
    for n in names:
        which = which.when(F.col(n) == best, n)
    return out.select("*", which.alias("dominant"), best.alias("dominant_pct"))


def union_checks(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def in_both(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    return a.select(*columns).intersect(b.select(*columns))


def only_left(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    return a.select(*columns).subtract(b.select(*columns))
