"""Team tables: match statistics, seasons, form, match features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.constants import FORM_MATCHES, MIN_MATCHES
from touchline.functions.labels import points, side_result
from touchline.functions.rates import ratio
from touchline.operators.aggregates import conditional_counts
from touchline.operators.joins import attach_sides
from touchline.operators.reshape import match_sides
from touchline.operators.windows import latest, prior_meetings, rolling_means
from touchline.plans.staging import mens_scope
from touchline.session import materialize

FORM = {
    "rolling_avg_xg": "total_xg",
    "rolling_avg_points": "points_earned",
    "rolling_avg_possession_pct": "possession_share",
    "rolling_avg_pressures": "total_pressures",
    "rolling_avg_pass_completion_pct": "pass_completion_pct",
}
FORM_SHORT = {
    "rolling_avg_xg": "rolling_xg",
    "rolling_avg_points": "rolling_points",
    "rolling_avg_possession_pct": "rolling_possession",
    "rolling_avg_pressures": "rolling_pressures",
    "rolling_avg_pass_completion_pct": "rolling_pass_accuracy",
}


def team_match_aggregates(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    tests = {
        "total_shots": kind == "Shot",
        "passes_attempted": kind == "Pass",
        "passes_completed": (kind == "Pass") & F.col("pass_outcome").isNull(),
        "total_pressures": kind == "Pressure",
        "total_carries": kind == "Carry",
    }
    xg = F.when(kind == "Shot", F.col("shot_xg")).otherwise(0.0)
    return conditional_counts(events, ["match_id", "team"], tests, {"total_xg": xg})


def match_stats(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Team statistics per men's match; possession is the team's share of all passes."""
    # only the few team rows of a match meet in its window
    all_passes = F.sum("passes_attempted").over(Window.partitionBy("match_id"))
    shares = team_match_aggregates(events).withColumn("possession_share", ratio("passes_attempted", all_passes))
    meta = mens_scope(matches).select(
        "match_id", "match_date", "competition_id", "competition_name", "season_id", "season_name",
        "home_team", "away_team", "match_result",
    )
    joined = shares.join(meta, on="match_id", how="inner")
    return joined.withColumns(
        {
            "side": F.when(F.col("team") == F.col("home_team"), "home").otherwise("away"),
            "pass_completion_pct": ratio("passes_completed", "passes_attempted"),
        }
    )


def team_season_stats(stats: DataFrame, min_matches: int = MIN_MATCHES) -> DataFrame:
    """Results, points and averages per team and season from ``min_matches`` matches on."""
    result = side_result("side", "match_result")
    return (
        stats.groupBy("team", "competition_id", "competition_name", "season_id", "season_name")
        .agg(
            F.count("match_id").alias("matches_played"),
            F.count_if(result == "win").alias("wins"),
            F.count_if(result == "draw").alias("draws"),
            F.count_if(result == "loss").alias("losses"),
            F.sum(points("side", "match_result")).alias("total_points"),
            F.sum("total_xg").alias("total_xg"),
            F.avg("total_xg").alias("avg_xg_per_match"),
            F.avg("possession_share").alias("avg_possession_share"),
            F.sum("total_pressures").alias("total_pressures"),
            F.avg("total_pressures").alias("avg_pressures_per_match"),
        )
        .filter(F.col("matches_played") >= min_matches)
    )


def rolling_form(stats: DataFrame, n: int = FORM_MATCHES, slices: int | None = None) -> DataFrame:
    """Mean of five measures over the team's previous n matches, per team-match.

    Runs across seasons and competitions. Matches on one day are ordered by id.
    Team rows are few next to events, and are written before the passes over them.
    """
    scored = stats.withColumn("points_earned", points("side", "match_result")).select(
        "match_id", "match_date", "team", "side", "competition_id", "season_id", *FORM.values()
    )
    form = rolling_means(materialize(scored, "team-matches"), ["team"], ["match_date", "match_id"], FORM, n, slices)
    return form.select("match_id", "match_date", "team", "side", "competition_id", "season_id", *FORM)


def latest_form(form: DataFrame) -> DataFrame:
    """Form at the team's last match of each competition season."""
    grain = ["team", "competition_id", "season_id"]
    return latest(form, grain, ["match_date", "match_id"]).select(*grain, *FORM)


def match_features(matches: DataFrame, form: DataFrame) -> DataFrame:
    """One row per match with both sides' form and the earlier meetings: the modelling table.

    Matches without form rows for both sides are left out. Both sides come from
    one join and are folded without a further shuffle.
    """
    base = matches.select(
        "match_id", "match_date", "competition_id", "competition_name", "season_name",
        "home_team", "away_team", "match_result",
    )
    rows = base.join(form.select("match_id", "team", "side", *FORM), on="match_id", how="inner")
    own = {s: (F.col("side") == s) & (F.col("team") == F.col(f"{s}_team")) for s in ("home", "away")}
    out = (
        rows.groupBy(*base.columns)
        .agg(
            *[F.count_if(test).alias(f"_{s}") for s, test in own.items()],
            *[
                F.max(F.when(test, F.col(c))).alias(f"{s}_{short}")
                for s, test in own.items()
                for c, short in FORM_SHORT.items()
            ],
        )
        .filter((F.col("_home") > 0) & (F.col("_away") > 0))
        .drop("_home", "_away")
    )
    history = prior_meetings(matches, "match_id", "match_date", "home_team", "away_team", "match_result")
    return out.join(history.select("match_id", "h2h_home_win_pct"), on="match_id", how="left")


def long_results(results: DataFrame) -> DataFrame:
    """Two rows per international match, one per team, with goals and a won flag (NULL unscored)."""
    shared = ["match_id", "date", "tournament", "city", "country", "neutral"]
    sides = match_sides(
        results,
        shared,
        {"team": "home_team", "opponent": "away_team", "goals_for": "home_score", "goals_against": "away_score"},
        {"team": "away_team", "opponent": "home_team", "goals_for": "away_score", "goals_against": "home_score"},
    )
    return sides.withColumns(
        {
            "match_year": F.year("date"),
            "won": (F.col("goals_for") > F.col("goals_against")).cast("int"),
        }
    )


def international_form(results: DataFrame, n: int = FORM_MATCHES, slices: int | None = None) -> DataFrame:
    """Goals for and against and win rate over each side's last n scored matches, per match."""
    long = long_results(results.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull()))
    measures = {"roll_gf": "goals_for", "roll_ga": "goals_against", "roll_win_rate": "won"}
    form = rolling_means(
        long.select("match_id", "date", "team", *measures.values()),
        ["team"],
        ["date", "match_id"],
        measures,
        n,
        slices,
    )
    sides = results.select("match_id", "date", "home_team", "away_team", "home_score", "away_score")
    joined = attach_sides(sides, form, "team", {m: m for m in measures}, how="left", extra=["match_id"])
    return joined.withColumns(
        {
            "roll_gf_diff": F.col("home_roll_gf") - F.col("away_roll_gf"),
            "roll_ga_diff": F.col("home_roll_ga") - F.col("away_roll_ga"),
        }
    )
