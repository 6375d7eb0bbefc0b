"""Counting and summarising operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.rates import ratio, share_pct

# of the approximate percentiles that bracket the exact ones: one in so many ranks off at most
ACCURACY = 50_000


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(
    df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column], sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """Many filtered counts and sums in one pass over the rows."""
    aggs = [F.count_if(test).alias(name) for name, test in counts.items()]
    aggs += [F.sum(value).alias(name) for name, value in (sums or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def share_of_all(counts: DataFrame, n: str, name: str = "pct", digits: int = 2) -> DataFrame:
    """Percentage of the grand total, from an already counted table."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(name, F.round(ratio(F.col(n) * 100.0, total), digits))


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Value as a share of the group's sum, groups being summed before the join."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_group_total"))
    return df.join(sums, on=list(keys), how="inner").withColumn(name, ratio(value, "_group_total")).drop("_group_total")


def outcome_rates(matches: DataFrame, keys: Sequence[str] = (), home: str = "home_score", away: str = "away_score") -> DataFrame:
    """Home win, away win and draw counts with percentages; unscored matches are left out."""
    scored = matches.filter(F.col(home).isNotNull() & F.col(away).isNotNull())
    tests = {
        "n_home_win": F.col(home) > F.col(away),
        "n_away_win": F.col(home) < F.col(away),
        "n_draw": F.col(home) == F.col(away),
    }
    aggs = [F.count_if(t).alias(name) for name, t in tests.items()] + [F.count(F.lit(1)).alias("n_matches")]
    counted = scored.groupBy(*keys).agg(*aggs)
    return counted.select(
        "*",
        share_pct("n_home_win", "n_matches", 2).alias("pct_home"),
        share_pct("n_away_win", "n_matches", 2).alias("pct_away"),
        share_pct("n_draw", "n_matches", 2).alias("pct_draw"),
    )


def outcome_rate_levels(matches: DataFrame, levels: Sequence[Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """Outcome counts overall and at several key levels, from one grouping-sets pass."""
    scored = matches.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    grouped = scored.groupingSets([[F.col(c) for c in level] for level in levels], *[F.col(c) for c in keys])
    counted = grouped.agg(
        F.grouping_id().alias("level"),
        F.count_if(F.col("home_score") > F.col("away_score")).alias("n_home_win"),
        F.count_if(F.col("home_score") < F.col("away_score")).alias("n_away_win"),
        F.count_if(F.col("home_score") == F.col("away_score")).alias("n_draw"),
        F.count(F.lit(1)).alias("n_matches"),
    )
    return counted.withColumn("pct_home", share_pct("n_home_win", "n_matches", 2))


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Exact, linearly interpolated percentiles as rows (keys, column, p, value).

    Approximate percentiles a little below and above bracket each wanted
    position. A second pass counts the values below the bracket and, one by one,
    those inside it: about one row in 6,000, or a whole group of up to twice
    ``accuracy`` rows. No task gathers more of a group than that.
    """
    doubles = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(list(keys), list(columns), "column", "_value").filter(F.col("_value").isNotNull())
    group = [*keys, "column"]
    margin = 4 / accuracy
    lows = [max(0.0, float(p) - margin) for p in probabilities]
    highs = [min(1.0, float(p) + margin) for p in probabilities]
    grid = F.array(*[F.lit(p) for p in (*lows, *highs)])
    stats = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_total"),
        F.min("_value").alias("_min"),
        F.max("_value").alias("_max"),
        F.percentile_approx("_value", grid, accuracy).alias("_near"),
    )
    whole = F.col("_total") <= 2 * accuracy
    n = len(lows)

    def bracket(k: int, p: float) -> Column:
        low = F.when(whole | F.lit(lows[k] == 0), F.col("_min")).otherwise(F.col("_near")[k])
        high = F.when(whole | F.lit(highs[k] == 1), F.col("_max")).otherwise(F.col("_near")[n + k])
        return F.struct(F.lit(float(p)).alias("p"), low.alias("_low"), high.alias("_high"))

    marks = stats.select(
        *[F.col(c).alias(f"_of_{c}") for c in group], "_total", F.explode(F.array(*[bracket(k, p) for k, p in enumerate(probabilities)])).alias("_mark")
    ).select("*", "_mark.*")
    test = F.col("_value") <= F.col("_high")
    for c in group:
        test = test & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    # below the bracket all rows count as one
    seen = F.when(F.col("_value") >= F.col("_low"), F.col("_value"))
    counts = (
        # without keys there is a mark for each column and percentile only
        long.join(marks if keys else F.broadcast(marks), test)
        .groupBy(*group, "p", "_total", seen.alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    earlier = Window.partitionBy(*group, "p").orderBy(F.asc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, -1)
    below = counts.withColumn("_below", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    at = F.col("p") * (F.col("_total") - 1)

    def covers(place: Column) -> Column:
        return (F.col("_below") <= place) & (place < F.col("_below") + F.col("_n"))

    picked = (
        below.filter(F.col("_value").isNotNull() & (covers(F.floor(at)) | covers(F.ceil(at))))
        .groupBy(*group, "p", at.alias("_at"))
        .agg(F.min("_value").alias("_lo"), F.max("_value").alias("_hi"))
    )
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))
    return picked.select(*group, "p", value.alias("value"))


def numeric_summary(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample sd, min, quartiles and max of each column as rows."""
    basics = df.groupBy(*keys).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("sd"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    long = basics.unpivot(list(keys), list(columns), "column", "_stats").select(*keys, "column", "_stats.*")
    quartiles = (
        exact_percentiles(df, columns, (0.25, 0.5, 0.75), keys)
        .groupBy(*keys, "column")
        .agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    )
    return long.join(quartiles, on=[*keys, "column"], how="left")


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int, name: str = "bin") -> DataFrame:
    """Equal-width bin counts of the values inside [lo, hi]; the top edge opens bin n+1."""
    inside = df.filter(F.col(column).between(lo, hi))
    return count_by(inside.withColumn(name, F.width_bucket(column, F.lit(lo), F.lit(hi), F.lit(bins))), [name])


def density_grid(df: DataFrame, x: str, y: str, width: float, height: float, cells_x: int, cells_y: int) -> DataFrame:
    """Counts on a rectangular grid over [0,width]×[0,height]; the far edges fall in the last cell."""

    def cell(c: str, size: float, n: int) -> Column:
        return F.least(F.floor(F.col(c) * n / size), F.lit(n - 1)).cast("int")

    inside = df.filter(F.col(x).between(0, width) & F.col(y).between(0, height))
    return inside.groupBy(cell(x, width, cells_x).alias("cell_x"), cell(y, height, cells_y).alias("cell_y")).agg(
        F.count(F.lit(1)).alias("n")
    )


def approx_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles as rows (p, value), one pass, bounded memory."""
    grid = F.array(*[F.lit(float(p)) for p in probabilities])
    one = df.agg(F.percentile_approx(column, grid, accuracy).alias("_values"))
    pairs = F.arrays_zip(grid.alias("p"), F.col("_values").alias("value"))
    return one.select(F.explode(pairs).alias("_pair")).select("_pair.p", "_pair.value")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count, nulls and % null per column as rows, from one pass."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    long = one.unpivot(["_rows"], list(columns), "column", "nulls")
    return long.select("column", F.col("_rows").alias("n_rows"), "nulls", share_pct("nulls", "_rows", 2).alias("pct_null"))


def group_mean_gap(df: DataFrame, flag: str, columns: Sequence[str], names: tuple[str, str] = ("club", "national")) -> DataFrame:
    """Mean of each column in two contexts, their difference and its % of the first mean."""
    first, second = names
    one = df.agg(
        *[
            F.struct(
                F.avg(F.when(~F.col(flag), F.col(c))).alias(f"{first}_mean"),
                F.avg(F.when(F.col(flag), F.col(c))).alias(f"{second}_mean"),
            ).alias(c)
            for c in columns
        ]
    )
    long = one.unpivot([], list(columns), "metric", "_m").select("metric", "_m.*")
    delta = F.col(f"{second}_mean") - F.col(f"{first}_mean")
    return long.select("*", delta.alias("delta"), F.round(ratio(delta, f"{first}_mean") * 100, 1).alias("delta_pct"))


def coverage_by_start(df: DataFrame, year: str, rated_years: DataFrame, starts: Sequence[int]) -> DataFrame:
    """Rows from each start year on, and how many lie in a rated year.

    Counts per year first, so thresholds meet a table of years, not of rows.
    """
    years = count_by(df, [year], "_n").join(
        rated_years.select(F.col(year), F.lit(True).alias("_rated")).distinct(), on=year, how="left"
    )
    reached = years.withColumn("from_year", F.explode(F.array(*[F.lit(s) for s in starts]))).filter(
        F.col(year) >= F.col("from_year")
    )
    counted = reached.groupBy("from_year").agg(
        F.sum("_n").alias("n_matches"),
        F.sum(F.when(F.col("_rated"), F.col("_n")).otherwise(0)).alias("n_with_rating_year"),
    )
    return counted.withColumn("pct_with_ratings", share_pct("n_with_rating_year", "n_matches", 1))


def mean_group_size(df: DataFrame, key: str, name: str) -> DataFrame:
    return count_by(df, [key], "_n").agg(F.avg("_n").alias(name))


def correlation(a: str, b: str) -> Column:
    """Pearson correlation of the rows that have both; NULL without rows, NaN when one value never varies.

    Spark's own ``corr`` divides by zero there, which fails the job.
    """
    x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
    y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    corr = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(varies, corr).when(F.count(x) > 0, F.lit(float("nan")))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise Pearson correlations (upper triangle) as rows, from one pass.

    A pair uses the rows where both values are present.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("corr")) for a, b in pairs]
    )
    return one.select(F.explode(entries).alias("_e")).select("_e.*")
