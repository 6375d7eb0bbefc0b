"""Raw tables to typed, cleaned, scoped tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.constants import FIRST_SEASON, MIN_MATCHES
from touchline.functions.labels import is_international, match_result
from touchline.functions.text import clock_minutes, location_xy, null_if_token, parse_location, season_year
from touchline.operators.joins import known_only


def matches(raw: DataFrame, first_season: int = FIRST_SEASON) -> DataFrame:
    """One typed row per match from the given season on."""
    return raw.filter(season_year("season") >= first_season).select(
        F.col("match_id").cast("long").alias("match_id"),
        F.col("match_date").cast("date").alias("match_date"),
        F.col("kick_off").cast("string").alias("kick_off"),
        F.col("competition_id").cast("long").alias("competition_id"),
        F.col("season_id").cast("long").alias("season_id"),
        F.trim("home_team").alias("home_team"),
        F.trim("away_team").alias("away_team"),
        F.col("home_score").cast("long").alias("home_score"),
        F.col("away_score").cast("long").alias("away_score"),
        F.col("competition_name").cast("string").alias("competition_name"),
        F.col("season").cast("string").alias("season_name"),
        is_international("competition_name").alias("is_international"),
        F.col("home_team_gender").cast("string").alias("gender"),
        F.lit(False).alias("is_youth"),
        match_result("home_score", "away_score").alias("match_result"),
    )


def events(raw: DataFrame, staged_matches: DataFrame) -> DataFrame:
    """One typed row per on-ball action of a known match with a known player.

    Matches are looked up by the id as the actions hold it, so actions that lie by match need not move.
    """
    kind = raw.schema["match_id"].dataType
    if isinstance(kind, T.IntegerType):
        # an id beyond the type is no action's
        raw = known_only(raw, staged_matches.select(F.col("match_id").try_cast(kind).alias("match_id")), ["match_id"])
    if raw.schema["location"].dataType.typeName() == "array":
        x, y = location_xy("location")
    else:
        x, y = parse_location(null_if_token("location"))
    typed = raw.select(
        F.col("id").cast("string").alias("event_id"),
        F.col("match_id").cast("long").alias("match_id"),
        F.col("period").cast("long").alias("period"),
        F.col("minute").cast("long").alias("minute"),
        F.col("second").cast("long").alias("second"),
        F.col("type").cast("string").alias("event_type"),
        F.trim("team").alias("team"),
        null_if_token("player").alias("player"),
        x.alias("location_x"),
        y.alias("location_y"),
        F.col("play_pattern").cast("string").alias("play_pattern"),
        F.col("shot_statsbomb_xg").try_cast("double").alias("shot_xg"),
        null_if_token("pass_outcome").alias("pass_outcome"),
    ).withColumn("shot_xg", F.when(~F.isnan("shot_xg"), F.col("shot_xg")))
    named = typed.filter(F.col("player").isNotNull())
    if isinstance(kind, T.IntegerType):
        return named.select("match_id", *[c for c in named.columns if c != "match_id"])
    return known_only(named, staged_matches, ["match_id"])


def _first(array: str, field: str) -> Column:
    """First value of a field in a list of entries that is neither missing nor empty."""
    values = F.transform(F.col(array), lambda entry: entry[field])
    return F.try_element_at(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(1))


def lineups(raw: DataFrame, staged_matches: DataFrame) -> DataFrame:
    """One row per lineup entry with the first known position, start, end and card.

    The first non-missing value of the whole list counts, so a player whose
    first stint has no end takes the end of a later one.
    """
    typed = raw.select(
        F.col("match_id").cast("long").alias("match_id"),
        F.col("player_id").cast("long").alias("player_id"),
        F.col("player_name").cast("string").alias("player_name"),
        F.trim("team_name").alias("team_name"),
        F.col("jersey_number").cast("long").alias("jersey_number"),
        F.coalesce(_first("positions", "position"), F.lit("Unknown")).alias("position_name"),
        _first("positions", "from").alias("from_time"),
        _first("positions", "to").alias("to_time"),
        _first("cards", "card_type").alias("card_type"),
    )
    return known_only(typed, staged_matches, ["match_id"])


def lineups_flat(raw: DataFrame, staged_matches: DataFrame) -> DataFrame:
    """The same from the flat layout, one row per stint and no player id: stints are put in order of their start."""
    entry = ["match_id", "team_name", "player_name", "jersey_number"]
    typed = raw.select(
        F.col("match_id").cast("long").alias("match_id"),
        F.trim("team_name").alias("team_name"),
        "player_name",
        F.col("jersey_number").cast("long").alias("jersey_number"),
        F.struct(clock_minutes("from_time").alias("start"), "position_name", "from_time", "to_time", "card_type").alias("stint"),
    )
    folded = typed.groupBy(*entry).agg(F.sort_array(F.collect_list("stint")).alias("stints"))
    rows = folded.select(
        *entry,
        F.coalesce(_first("stints", "position_name"), F.lit("Unknown")).alias("position_name"),
        *[_first("stints", c).alias(c) for c in ("from_time", "to_time", "card_type")],
    )
    return known_only(rows, staged_matches, ["match_id"])


def lineup_stints(raw: DataFrame, staged_matches: DataFrame) -> DataFrame:
    """One row per position stint; an empty list keeps one row without position."""
    typed = raw.select(
        F.col("match_id").cast("long").alias("match_id"),
        F.col("player_id").cast("long").alias("player_id"),
        F.col("player_name").alias("player_name"),
        F.trim("team_name").alias("team_name"),
        F.explode_outer("positions").alias("stint"),
    ).select(
        "match_id",
        "player_id",
        "player_name",
        "team_name",
        F.col("stint.position").alias("position_name"),
        F.col("stint.from").alias("from_time"),
        F.col("stint.to").alias("to_time"),
    )
    return known_only(typed, staged_matches, ["match_id"])


def parse_lineup_json(raw: DataFrame) -> DataFrame:
    """Lineups whose nested lists arrive as JSON text, as arrays of structs."""
    return raw.withColumns(
        {
            "positions": F.from_json("positions", "array<struct<position:string,from:string,to:string>>"),
            "cards": F.from_json("cards", "array<struct<card_type:string>>"),
        }
    )


def mens_scope(df: DataFrame) -> DataFrame:
    return df.filter((F.col("gender") == "male") & ~F.coalesce(F.col("is_youth"), F.lit(False)))


def scope(competitions: DataFrame, names: Sequence[str], gender: str, first_year: int) -> DataFrame:
    """Competition seasons to ingest: name, gender, and season year."""
    return competitions.filter(
        F.col("competition_name").isin(*names)
        & (F.col("competition_gender") == gender)
        & (season_year("season_name") >= first_year)
    )


def season_from(df: DataFrame, year: int, column: str = "season_name") -> DataFrame:
    return df.filter(season_year(column) >= year)


def min_matches(staged_matches: DataFrame, n: int = MIN_MATCHES) -> DataFrame:
    """Matches of competition-seasons with at least ``n`` distinct matches."""
    keys = ["competition_name", "season_name"]
    enough = (
        staged_matches.groupBy(*keys)
        .agg(F.count_distinct("match_id").alias("_n"))
        .filter(F.col("_n") >= n)
        .select(*keys)
    )
    return staged_matches.join(enough, on=keys, how="left_semi")


def split_completed(df: DataFrame, home: str = "home_score", away: str = "away_score") -> tuple[DataFrame, DataFrame]:
    scored = F.col(home).isNotNull() & F.col(away).isNotNull()
    return df.filter(scored), df.filter(~scored)


def exclude(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Rows except the named ones; a missing name is kept."""
    return df.filter(~F.coalesce(F.col(column).isin(*names), F.lit(False)))


def active_only(df: DataFrame, rates: Sequence[str]) -> DataFrame:
    test = F.lit(False)
    for c in rates:
        test = test | (F.coalesce(F.col(c), F.lit(0.0)) > 0)
    return df.filter(test)
