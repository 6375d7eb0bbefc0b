"""National teams: squad strength, rankings, match frames, name alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import COUNTRY_ALIASES, DEPTH_RATING, RANKING_ALIASES, RATING_BLOCK, TOP_SQUAD
from touchline.functions.labels import country_name, match_result
from touchline.operators.aggregates import correlation, count_by, share_of_all
from touchline.operators.joins import attach_sides
from touchline.operators.windows import as_of_join_many, rank_by, top_mean

TEAM_YEAR = ("intl_team", "year")


def with_team(players: DataFrame, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> DataFrame:
    return players.withColumn("intl_team", country_name("nationality", aliases))


def team_strength(players: DataFrame, top: int = TOP_SQUAD, depth: int = DEPTH_RATING) -> DataFrame:
    """One row per team and year: squad size, depth, best goalkeeper, and top-squad means."""
    simple = players.groupBy(*TEAM_YEAR).agg(
        F.count_distinct("player_id").alias("n_players"),
        F.avg("overall").alias("mean_overall"),
        F.count_if(F.col("overall") >= depth).alias("depth_75"),
        F.count_if("was_world_cup_squad_member").alias("wc_squad_n"),
        F.max(F.when(F.col("primary_position") == "GK", F.col("overall"))).alias("gk_overall_max"),
    )
    best = top_mean(players, TEAM_YEAR, ["overall", *RATING_BLOCK], top, f"top{top}_")
    return simple.join(best, on=list(TEAM_YEAR), how="left")


def match_strength(results: DataFrame, strength: DataFrame) -> DataFrame:
    """Scored matches with both sides' strength in the match year and their difference."""
    scored = results.withColumn("year", F.year("date"))
    feats = strength.withColumnRenamed("intl_team", "team")
    joined = attach_sides(scored, feats, "team", {"top11_overall": "top11", "depth_75": "depth_75"}, extra=["year"])
    return joined.withColumns(
        {
            "top11_diff": F.col("home_top11") - F.col("away_top11"),
            "has_squad_ratings": (F.col("home_top11").isNotNull() & F.col("away_top11").isNotNull()).cast("int"),
            "home_win": F.when(
                F.col("home_score").isNotNull() & F.col("away_score").isNotNull(),
                (F.col("home_score") > F.col("away_score")).cast("int"),
            ),
        }
    )


def outcome_mix(results: DataFrame) -> DataFrame:
    """Share of home wins, away wins and draws in scored matches."""
    scored = results.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    counts = count_by(scored.withColumn("outcome_label", match_result("home_score", "away_score")), ["outcome_label"])
    return share_of_all(counts, "n", "pct", 1)


def gap_win_correlation(frame: DataFrame) -> DataFrame:
    """Correlation of the strength gap with a home win over rows that have both; NaN when one of them never varies."""
    return frame.filter(F.col("top11_diff").isNotNull() & F.col("home_win").isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), correlation("top11_diff", "home_win").alias("corr")
    )


def squad_table(players: DataFrame, year: int) -> DataFrame:
    """Squad size and mean rating per nation of one tournament year."""
    return (
        players.filter(F.col("was_world_cup_squad_member") & (F.col("world_cup_squad_tournament_year") == year))
        .groupBy("nationality")
        .agg(F.count("player_id").alias("squad_size"), F.avg("overall").alias("mean_overall"))
    )


def name_overlap(players: DataFrame, results: DataFrame) -> DataFrame:
    """Every team name with the tables it occurs in."""
    ours = players.select(F.col("intl_team").alias("team")).filter(F.col("team").isNotNull()).distinct()
    theirs = results.select(F.explode(F.array("home_team", "away_team")).alias("team")).distinct()
    return (
        ours.withColumn("in_profiles", F.lit(True))
        .join(theirs.withColumn("in_results", F.lit(True)), on="team", how="full")
        .withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("in_profiles", "in_results")})
    )


def ratings_by_nation(players: DataFrame, nations: Sequence[str]) -> DataFrame:
    """Rows, mean rating and mean goalkeeper rating per year and chosen nation."""
    return (
        players.filter(F.col("nationality").isin(*nations))
        .groupBy("year", "nationality")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("overall"), 1).alias("mean_ovr"),
            F.round(F.avg(F.when(F.col("primary_position") == "GK", F.col("overall"))), 1).alias("mean_gk"),
        )
    )


def rating_profile(players: DataFrame, digits: int = 1) -> DataFrame:
    columns = [*RATING_BLOCK, "overall"]
    return players.groupBy("primary_position").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c), digits).alias(c) for c in columns]
    )


def ranked(rankings: DataFrame) -> DataFrame:
    """Rank per date by points, ties sharing the lowest rank, with team names aligned by both tables."""
    named = rankings.withColumn("team", country_name("country", {**COUNTRY_ALIASES, **RANKING_ALIASES}))
    return rank_by(named, ["rank_date"], "points", "rank")


def rank_features(results: DataFrame, rankings: DataFrame) -> DataFrame:
    """Rank, points and confederation of both sides as of the match date, with differences."""
    found = as_of_join_many(
        results, rankings, ["match_id"], {"home_": "home_team", "away_": "away_team"}, "team", "date", "rank_date",
        ["rank", "points", "confederation"],
    )
    sides = ("home", "away")
    out = found.withColumnsRenamed({f"{s}_rank": f"{s}_fifa_rank" for s in sides} | {f"{s}_points": f"{s}_fifa_points" for s in sides})
    return out.withColumns(
        {
            "fifa_rank_diff": F.col("away_fifa_rank") - F.col("home_fifa_rank"),
            "same_confederation": F.col("home_confederation") == F.col("away_confederation"),
        }
    )
