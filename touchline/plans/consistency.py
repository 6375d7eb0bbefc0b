"""Club against national team: weights, scores, quadrants, gaps and who drives them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.constants import FEATURES, MIN_MINUTES, QUADRANTS, SHIFT_METRICS
from touchline.functions.labels import competition_label, context_flag, position_group, sort_key
from touchline.functions.rates import mean_abs_gap, ratio, weighted_sum
from touchline.operators.aggregates import exact_percentiles, share_of_all
from touchline.operators.reshape import crosstab, row_pct, two_context_wide
from touchline.operators.windows import dominant, top_n, with_rank
from touchline.plans.players import dual_context
from touchline.session import materialize


def feature_weights(loadings: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Σ|loading| per feature over all components, as shares of the total.

    A missing feature or an all-zero table fails the job.
    """
    sums = (
        loadings.filter(F.col("feature").isin(*features))
        .groupBy("feature")
        .agg(F.sum(F.abs("loading")).alias("_w"))
    )
    total = sums.agg(F.struct(F.sum("_w").alias("all"), F.count("_w").alias("n"))).scalar()
    checked = (
        F.when(F.col("_t.n") < len(features), F.raise_error(F.lit("loadings lack some features")).cast("double"))
        .when(F.col("_t.all") == 0, F.raise_error(F.lit("all loadings are zero")).cast("double"))
        .otherwise(F.col("_w") / F.col("_t.all"))
    )
    return sums.withColumn("_t", total).select("feature", checked.alias("weight"))


def weight_columns(weights: DataFrame, features: Sequence[str] = FEATURES) -> list[Column]:
    """One scalar column per feature from the weight table (one row per feature)."""
    one = weights.agg(F.map_from_entries(F.collect_list(F.struct("feature", "weight"))))
    table = one.scalar()
    return [F.try_element_at(table, F.lit(f)) for f in features]


def eligible(contexts: DataFrame, min_minutes: float = MIN_MINUTES) -> DataFrame:
    """Players with enough minutes in both contexts, the row of most minutes per context."""
    rows = contexts.withColumn("is_international", context_flag("is_international")).filter(
        F.col("total_minutes") >= min_minutes
    )
    order = [F.desc("total_minutes"), F.asc("player_name")]
    return top_n(dual_context(rows), ["player_id", "is_international"], order, 1)


def score_wide(rows: DataFrame, weights: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row per player: both performance scores, both minute totals, z-scores side by side."""
    z = [f"z_{f}" for f in features]
    scored = rows.withColumn("performance_score", weighted_sum(z, weight_columns(weights, features)))
    flag = F.col("is_international")

    def of(c: str, national: bool) -> Column:
        return F.max(F.when(flag if national else ~flag, F.col(c)))

    return scored.groupBy("player_id").agg(
        of("player_name", False).alias("player_name"),
        of("performance_score", False).alias("club_performance_score"),
        of("performance_score", True).alias("national_performance_score"),
        of("total_minutes", False).alias("club_minutes"),
        of("total_minutes", True).alias("national_minutes"),
        *[of(c, False).alias(f"club_{c}") for c in z],
        *[of(c, True).alias(f"nat_{c}") for c in z],
    )


def with_consistency(wide: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    gap = mean_abs_gap([f"club_z_{f}" for f in features], [f"nat_z_{f}" for f in features])
    return wide.withColumn("consistency_score", 1 - gap)


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column."""
    long = exact_percentiles(df, columns, [0.5])
    return long.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


def with_quadrant(wide: DataFrame) -> DataFrame:
    """Quadrant by the cohort medians of the two scores; a tie counts as high."""
    columns = ["club_performance_score", "national_performance_score"]
    cut = medians(wide, columns).agg(F.first(F.struct(*columns)).alias("cut")).scalar()
    high = [F.col(c) >= F.col(f"_cut.{c}") for c in columns]
    elite, club, national, under = QUADRANTS
    label = (
        F.when(high[0] & high[1], elite).when(high[0], club).when(high[1], national).otherwise(under)
    )
    return wide.withColumn("_cut", cut).withColumn("performance_quadrant", label).drop("_cut")


def consistency_scores(contexts: DataFrame, loadings: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Full scoring from per-context z-scores and loadings, least consistent first.

    One row per player is written before the medians are taken from it.
    """
    wide = with_consistency(score_wide(eligible(contexts), feature_weights(loadings, features), features), features)
    scored = with_quadrant(materialize(wide, "scores"))
    return scored.select(
        "player_id",
        "player_name",
        "club_performance_score",
        "national_performance_score",
        "consistency_score",
        "performance_quadrant",
        "club_minutes",
        "national_minutes",
    ).orderBy("consistency_score", "player_id")


# --- what drives the difference -------------------------------------------------------------


def gap_table(wide: DataFrame, weights: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Δz = national − club and w·|Δz| per feature, with totals, per player."""
    w = weight_columns(weights, features)
    delta = {f: F.coalesce(f"nat_z_{f}", F.lit(0.0)) - F.coalesce(f"club_z_{f}", F.lit(0.0)) for f in features}
    gaps = wide.withColumns({f"delta_{f}": d for f, d in delta.items()})
    gaps = gaps.withColumns({f"contrib_{f}": F.abs(F.col(f"delta_{f}")) * x for f, x in zip(features, w)})
    total = F.lit(0.0)
    for f in features:
        total = total + F.col(f"contrib_{f}")
    return gaps.select(
        "player_id",
        "player_name",
        *[f"delta_{f}" for f in features],
        *[f"contrib_{f}" for f in features],
        total.alias("total_weighted_gap"),
        (F.col("national_performance_score") - F.col("club_performance_score")).alias("performance_gap"),
    )


def feature_importance(gaps: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean weighted gap per feature with rank and share; one pass, one row per feature."""
    one = gaps.agg(
        *[
            F.struct(
                F.avg(F.abs(F.col(f"delta_{f}"))).alias("mean_abs_delta_z"),
                F.avg(f"delta_{f}").alias("mean_delta_z"),
                F.avg(f"contrib_{f}").alias("importance"),
            ).alias(f)
            for f in features
        ]
    )
    long = one.unpivot([], list(features), "feature", "_m").select("feature", "_m.*")
    ranked = with_rank(long, [F.desc("importance"), F.asc("feature")])
    return share_of_all(ranked, "importance", "pct_of_total", 2)


def specialist_compare(gaps: DataFrame, quadrants: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Mean Δz and importance of the two specialist groups per feature, by size of difference."""
    labelled = gaps.join(quadrants.select("player_id", "performance_quadrant"), on="player_id", how="inner")
    club = F.col("performance_quadrant") == QUADRANTS[1]
    national = F.col("performance_quadrant") == QUADRANTS[2]
    one = labelled.agg(
        *[
            F.struct(
                F.avg(F.when(club, F.col(f"delta_{f}"))).alias("club_mean_dz"),
                F.avg(F.when(national, F.col(f"delta_{f}"))).alias("nat_mean_dz"),
                F.avg(F.when(club, F.col(f"contrib_{f}"))).alias("club_importance"),
                F.avg(F.when(national, F.col(f"contrib_{f}"))).alias("nat_importance"),
            ).alias(f)
            for f in features
        ]
    )
    long = one.unpivot([], list(features), "feature", "_m").select("feature", "_m.*")
    diff = long.withColumn("difference", F.col("nat_mean_dz") - F.col("club_mean_dz"))
    return with_rank(diff, [F.desc(F.abs("difference")), F.asc("feature")], "rank_separation")


def specialist_top(scores: DataFrame, quadrant: str, n: int = 5) -> DataFrame:
    """n players of a quadrant with the largest score difference in its favour."""
    gap = F.col("club_performance_score") - F.col("national_performance_score")
    signed = gap if quadrant == QUADRANTS[1] else -gap
    return (
        scores.filter(F.col("performance_quadrant") == quadrant)
        .withColumn("specialist_score", signed)
        .orderBy(F.desc("specialist_score"), "player_id")
        .limit(n)
    )


def context_shift(wide: DataFrame, metrics: Sequence[str] = SHIFT_METRICS) -> DataFrame:
    """Sum of raw national − club gaps, weighted down for unequal minutes.

    Expects ``club_<metric>``, ``nat_<metric>`` and the two minute totals.
    """
    gap = F.lit(0.0)
    for m in metrics:
        gap = gap + F.coalesce(F.col(f"nat_{m}"), F.lit(0.0)) - F.coalesce(F.col(f"club_{m}"), F.lit(0.0))
    nat = F.coalesce(F.col("national_minutes").cast("double"), F.lit(0.0))
    club = F.coalesce(F.col("club_minutes").cast("double"), F.lit(0.0))
    weight = F.try_divide(2 * nat * club, (nat + club) * F.greatest(nat, club))
    return wide.select("player_id", gap.alias("raw_gap"), weight.alias("minutes_weight")).withColumn(
        "context_shift_score", F.col("raw_gap") * F.col("minutes_weight")
    )


# --- reading the scores -----------------------------------------------------------------------


def quadrant_distribution(scores: DataFrame, digits: int = 1) -> DataFrame:
    counts = scores.groupBy(F.col("performance_quadrant").alias("quadrant")).agg(F.count(F.lit(1)).alias("players"))
    return share_of_all(counts, "players", "pct", digits)


def notable(scores: DataFrame, n: int = 10) -> DataFrame:
    """n players per quadrant with the largest mean absolute score."""
    size = (F.abs("club_performance_score") + F.abs("national_performance_score")) / 2
    return top_n(
        scores.withColumn("notable_score", size),
        ["performance_quadrant"],
        [F.desc("notable_score"), F.asc("player_id")],
        n,
    )


def enrich(scores: DataFrame, player_match: DataFrame, matches: DataFrame, competitions: Sequence[str]) -> DataFrame:
    """Main club position and competition by minutes, with their display groups."""
    meta = matches.filter(
        ~F.coalesce(F.col("is_international"), F.lit(False)) & F.col("competition_name").isin(*competitions)
    ).select("match_id", "competition_name")
    rows = player_match.join(meta, on="match_id", how="inner")
    # one shuffle of the long table; both rankings start from these sums
    sums = rows.groupBy("player_id", "position_name", "competition_name").agg(F.sum("minutes_played").alias("mins"))
    named = sums.filter(~F.col("position_name").isin("", "Unknown"))
    position = dominant(named, ["player_id"], "position_name", "mins").select(
        "player_id", F.col("position_name").alias("primary_position")
    )
    league = dominant(sums, ["player_id"], "competition_name", "mins").select(
        "player_id", F.col("competition_name").alias("primary_competition_name")
    )
    context = position.join(league, on="player_id", how="left")
    return scores.join(context, on="player_id", how="left").withColumns(
        {
            "position_group": position_group("primary_position"),
            "competition_label": competition_label("primary_competition_name"),
        }
    )


def consistency_by(scores: DataFrame, key: str, order: Sequence[str], value: str = "consistency_score") -> DataFrame:
    """Players, mean, median and sample sd per group, with the fixed display order."""
    known = F.col(key).isNotNull() & F.col(value).isNotNull()
    rows = materialize(scores.filter(known).select("player_id", key, value), "groups")
    basics = rows.groupBy(key).agg(
        F.count_distinct("player_id").alias("n_players"),
        F.avg(value).alias("mean_consistency"),
        F.stddev_samp(value).alias("std_consistency"),
    )
    middle = exact_percentiles(rows, [value], [0.5], [key]).select(key, F.col("value").alias("median_consistency"))
    return basics.join(middle, on=key, how="left").withColumn("sort_key", sort_key(key, order))


def quadrant_mix(scores: DataFrame, key: str) -> DataFrame:
    """Quadrant shares per group in row %."""
    table = crosstab(scores.filter(F.col(key).isNotNull()), key, "performance_quadrant", QUADRANTS, prefix="")
    return row_pct(table, key, QUADRANTS)


def context_deltas(table: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """club_, nat_ and delta_ columns per player from the two-row context table."""
    flagged = table.withColumn("_national", F.col("context") == "National")
    return two_context_wide(flagged, ["player"], "_national", [*metrics, "total_minutes"])


def delta_summary(wide: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Players, mean shift and share of players shifting up, per metric."""
    one = wide.agg(
        *[
            F.struct(
                F.count(f"delta_{m}").alias("players"),
                F.avg(f"delta_{m}").alias("mean_delta"),
                ratio(F.count_if(F.col(f"delta_{m}") > 0), F.count(f"delta_{m}")).alias("share_up"),
            ).alias(m)
            for m in metrics
        ]
    )
    return one.unpivot([], list(metrics), "metric", "_m").select("metric", "_m.*")
