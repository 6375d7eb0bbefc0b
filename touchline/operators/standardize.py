"""Imputation, clipping and standardising of feature columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import CLIP_QUANTILE
from touchline.functions.rates import zscore
from touchline.operators.aggregates import exact_percentiles
from touchline.operators.joins import by_bounded_groups


def column_values(df: DataFrame, columns: Sequence[str], p: float) -> Mapping[str, float]:
    """One exact percentile per feature column: as many numbers as there are features."""
    rows = exact_percentiles(df, columns, [p]).collect()
    return {r["column"]: r["value"] for r in rows}


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = column_values(df, columns, 0.5)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in columns}
    )


def clip_upper(df: DataFrame, columns: Sequence[str], p: float = CLIP_QUANTILE, skip: Sequence[str] = ()) -> DataFrame:
    chosen = [c for c in columns if c not in skip]
    caps = column_values(df, chosen, p)
    return df.withColumns({c: F.least(F.col(c), F.lit(caps.get(c)).cast("double")) for c in chosen})


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x − mean) / population sd in place; a constant column becomes 0."""
    one = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    scaled = {}
    for c in columns:
        mean, sd = one[f"m_{c}"], one[f"s_{c}"]
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(sd if sd else 1.0)
    return df.withColumns(scaled)


def zscores(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), prefix: str = "z_") -> DataFrame:
    """Sample z-score of each column within its group; NULL where the spread is 0 or undefined.

    Statistics are aggregated and attached, so a group of any size is never
    gathered the way a window over it would.
    """
    aggs = [F.avg(c).alias(f"_m_{c}") for c in columns] + [F.stddev_samp(c).alias(f"_s_{c}") for c in columns]
    if by:
        joined = by_bounded_groups(df, df.groupBy(*by).agg(*aggs), by)
    else:
        joined = df.withColumn("_stats", df.agg(F.struct(*aggs)).scalar()).select("*", "_stats.*")
    return joined.select(*df.columns, *[zscore(c, f"_m_{c}", f"_s_{c}").alias(f"{prefix}{c}") for c in columns])


def zscores_long(
    long: DataFrame, features: Sequence[str], key: str = "feature", value: str = "value", name: str = "z_value"
) -> DataFrame:
    """Sample z-score within each feature of a long table.

    The statistics hold one row per listed feature, which bounds the broadcast.
    """
    stats = (
        long.filter(F.col(key).isin(*features))
        .groupBy(key)
        .agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    )
    return long.join(F.broadcast(stats), on=key, how="inner").withColumn(name, zscore(value, "_m", "_s")).drop("_m", "_s")


def component_scores(
    long: DataFrame, loadings: DataFrame, ids: Sequence[str], components: Sequence[str], features: Sequence[str]
) -> DataFrame:
    """Σ z·loading per row and component, from the long tables.

    Loadings become one row per listed feature, which bounds the broadcast and
    keeps the long table from being multiplied by the number of components.
    """
    wide = (
        loadings.filter(F.col("feature").isin(*features))
        .groupBy("feature")
        .agg(*[F.sum(F.when(F.col("component") == c, F.col("loading"))).alias(f"_l_{c}") for c in components])
    )
    joined = long.join(F.broadcast(wide), on="feature", how="inner")
    sums = []
    for c in components:
        part = F.when(F.col(f"_l_{c}").isNotNull(), F.col("z_value") * F.col(f"_l_{c}")).otherwise(F.lit(0.0))
        sums.append(F.sum(part).alias(c.lower()))
    return joined.groupBy(*ids).agg(*sums)
