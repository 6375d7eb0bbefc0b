"""Join operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known_only(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), on=list(on), how="left_semi")


def orphans(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key has no parent; a missing key counts as an orphan."""
    return df.join(keys.select(*on), on=list(on), how="left_anti")


def left_join_filled(left: DataFrame, right: DataFrame, on: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """Left join with 0 in the given right columns where nothing matched."""
    joined = left.join(right, on=list(on), how="left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in fill})


def attach_sides(
    matches: DataFrame,
    features: DataFrame,
    key: str,
    columns: Mapping[str, str],
    home: str = "home_team",
    away: str = "away_team",
    how: str = "left",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Join one per-team table twice, once for each side.

    ``columns`` maps source columns to suffixes after ``home_`` and ``away_``;
    ``extra`` are further equality keys shared by both tables.
    """
    out = matches
    for side, team in (("home", home), ("away", away)):
        renamed = features.select(
            F.col(key).alias(team), *extra, *[F.col(src).alias(f"{side}_{name}") for src, name in columns.items()]
        )
        out = out.join(renamed, on=[team, *extra], how=how)
    return out


def one_to_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join that fails the job when a key repeats on either side.

    Each side is folded to one row per key with its count, so the check costs
    no extra pass.
    """

    def single(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in on]
        folded = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in rest])
        twice = F.raise_error(F.lit("join key repeats: " + ", ".join(on))).cast("boolean")
        return folded.filter(F.when(F.col("_n") > 1, twice).otherwise(F.lit(True))).drop("_n")

    return single(left).join(single(right), on=list(on), how="inner")


def attach_year(df: DataFrame, features: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join of yearly features that keeps unmatched rows."""
    return df.join(features.select(*keys, *columns), on=list(keys), how="left")


def coverage(df: DataFrame, column: str, name: str = "coverage") -> DataFrame:
    """Share of rows where a joined column is present."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(column).isNotNull().cast("double")).alias(name)
    )


def by_bounded_groups(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-group statistics to rows.

    Boolean keys have at most three values each, so their statistics fit a
    broadcast whatever the data size. Other keys are left to a plain join,
    where the measured size decides.
    """
    flags = all(df.schema[k].dataType.typeName() == "boolean" for k in keys)
    right = stats.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in stats.columns if c not in keys])
    test: Column = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(F.broadcast(right) if flags else right, on=test, how="left").drop(*[f"_k_{k}" for k in keys])


def rename_in_force(df: DataFrame, names: DataFrame, team: str, day: str) -> DataFrame:
    """Current name of a team for the day of the match.

    ``names`` holds (former, current, start_date, end_date). An equality on the
    former name carries the join; the dates only filter its matches. When
    intervals overlap the first current name is taken, so no row repeats.
    """
    dated = df.select(F.col(team).alias("former"), F.col(day).alias("_day")).distinct()
    found = (
        dated.join(names, on="former", how="inner")
        .filter(F.col("_day").between(F.col("start_date"), F.col("end_date")))
        .groupBy("former", "_day")
        .agg(F.min("current").alias("_current"))
    )
    hit = (F.col(team) == F.col("former")) & (F.col(day) == F.col("_day"))
    return df.join(found, on=hit, how="left").withColumn(team, F.coalesce("_current", team)).drop("former", "_day", "_current")
