"""Report aggregates: archetype counts, data overview, league summary, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import GOALKEEPER, MIN_MINUTES, QUADRANTS, REPORT_LABELS, TOP5_COMPETITIONS
from touchline.functions.labels import lookup, sort_key
from touchline.functions.rates import ratio
from touchline.operators.aggregates import count_by
from touchline.operators.windows import top_n
from touchline.plans.marts import SEASON_GRAIN


def archetype_distribution(assignments: DataFrame) -> DataFrame:
    return count_by(assignments, ["archetype"], "seasons")


def competition_archetypes(
    assignments: DataFrame, season: DataFrame, competitions: Sequence[str] = TOP5_COMPETITIONS
) -> DataFrame:
    """Archetype counts in the named competitions, goalkeepers left out."""
    names = season.filter(F.col("competition_name").isin(*competitions)).select(*SEASON_GRAIN, "competition_name")
    outfield = assignments.filter(F.col("archetype") != GOALKEEPER).select(*SEASON_GRAIN, "archetype")
    return count_by(outfield.join(names, on=list(SEASON_GRAIN), how="inner"), ["competition_name", "archetype"], "seasons")


def data_overview(matches: DataFrame, events: DataFrame, lineups: DataFrame, assignments: DataFrame) -> DataFrame:
    """Row counts of the inputs and the number of competitions with archetypes, as one row."""
    n = F.count(F.lit(1))
    return matches.agg(n.alias("n_matches")).select(
        "n_matches",
        events.agg(n).scalar().alias("n_events"),
        lineups.agg(n).scalar().alias("n_lineups"),
        assignments.agg(F.count_distinct("competition_id")).scalar().alias("n_competitions"),
    )


def league_summary(
    counts: DataFrame,
    competitions: Sequence[str] = TOP5_COMPETITIONS,
    quiet: str = "Low Activity",
    pressing: str = "Pressing Forward",
    pressing_min: int = 70,
) -> DataFrame:
    """Largest and second archetype per league and the first pattern that fits.

    Takes the (league × archetype) counts, which are a handful of rows.
    """
    rows = counts.filter(F.col("competition_name").isin(*competitions))
    order = [F.desc("seasons"), F.asc("archetype")]
    podium = (
        top_n(rows, ["competition_name"], order, 2, rank="_place")
        .groupBy("competition_name")
        .agg(
            *[
                F.max(F.when(F.col("_place") == i, F.col(c))).alias(f"{c}_{i}")
                for i in (1, 2)
                for c in ("archetype", "seasons")
            ]
        )
    )
    totals = rows.groupBy("competition_name").agg(
        F.sum("seasons").alias("total"),
        F.sum(F.when(F.col("archetype") == quiet, F.col("seasons")).otherwise(0)).alias("quiet"),
        F.sum(F.when(F.col("archetype") == pressing, F.col("seasons")).otherwise(0)).alias("pressing"),
    ).withColumn("quiet_share", ratio("quiet", "total"))
    bounds = totals.agg(
        F.struct(
            F.max("total").alias("most"),
            # a listed league without rows counts as total 0
            F.when(F.count("total") < len(competitions), F.lit(0)).otherwise(F.min("total")).alias("least"),
            F.max("quiet_share").alias("quietest"),
        )
    ).scalar()
    second_n = F.coalesce(F.col("seasons_2"), F.lit(0))
    near = F.greatest(F.lit(5), F.floor(F.col("total") * 0.05))
    pattern = (
        F.when(F.col("total") == F.col("_b.most"), F.concat(F.lit("Highest volume. "), "archetype_1", F.lit("s lead")))
        .when(F.col("quiet_share") == F.col("_b.quietest"), F.lit(f"Most {quiet} share among top five"))
        .when(
            (F.col("total") == F.col("_b.least")) & (F.col("pressing") >= pressing_min),
            F.concat(F.lit(f"Smallest top-five sample. More {pressing} ("), F.col("pressing").cast("string"), F.lit(")")),
        )
        .when(F.abs(F.col("seasons_1") - second_n) <= near, F.lit("Near-even top two clusters"))
        .otherwise(F.lit("Similar anchor vs low-activity mix"))
    )

    def shown(i: int):
        return F.concat(F.col(f"archetype_{i}"), F.lit(" ("), F.col(f"seasons_{i}").cast("string"), F.lit(")"))

    return (
        podium.join(totals, on="competition_name", how="inner")
        .withColumn("_b", bounds)
        .select(
            lookup("competition_name", REPORT_LABELS, F.col("competition_name")).alias("competition"),
            shown(1).alias("largest"),
            F.coalesce(shown(2), F.lit("")).alias("second_largest"),
            pattern.alias("notable_pattern"),
            sort_key("competition_name", competitions).alias("sort_key"),
        )
    )


def report_metrics(archetypes: DataFrame, quadrants: DataFrame, overview: DataFrame) -> DataFrame:
    """All headline numbers as one row, from the small count tables."""
    totals = archetypes.agg(
        F.sum("seasons").alias("n_player_seasons"),
        F.sum(F.when(F.col("archetype") != GOALKEEPER, F.col("seasons")).otherwise(0)).alias("n_outfield_player_seasons"),
        F.sum(F.when(F.col("archetype") == GOALKEEPER, F.col("seasons")).otherwise(0)).alias("n_goalkeeper_seasons"),
    )
    names = ("elite", "club_specialist", "international_specialist", "underperformer")
    shares = quadrants.agg(
        F.struct(
            F.sum("players").alias("n_dual_context_players"),
            *[
                (ratio(F.sum(F.when(F.col("quadrant") == q, F.col("players")).otherwise(0)), F.sum("players")) * 100).alias(f"pct_{n}")
                for q, n in zip(QUADRANTS, names)
            ],
        )
    ).scalar()
    sizes = overview.agg(F.first(F.struct("n_matches", "n_events", "n_lineups", "n_competitions"))).scalar()
    return totals.withColumns({"_q": shares, "_o": sizes}).select(
        "_o.*",
        F.round(F.col("_o.n_events") / 1_000_000, 1).alias("n_events_millions"),
        "n_player_seasons",
        "n_outfield_player_seasons",
        "n_goalkeeper_seasons",
        "_q.*",
        (F.col("_q.pct_club_specialist") + F.col("_q.pct_international_specialist")).alias("pct_single_context_specialist"),
        F.lit(MIN_MINUTES).alias("min_minutes"),
    )
