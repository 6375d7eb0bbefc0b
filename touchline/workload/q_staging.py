"""Staging, text parsing, labels and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.constants import COMPETITION_LABEL_ORDER, FIRST_SEASON
from touchline.functions import labels, text
from touchline.plans import international, players, staging
from touchline.session import new_folder
from touchline.sources import writers
from touchline.sources.readers import read_raw, read_table
from touchline.sources.schemas import SCHEMAS
from touchline.workload import base, feeds
from touchline.workload.registry import query
from touchline.workload.tables_sql import BROAD_CASE, LEAGUE_CASE, POSITION_CASE, with_tables


@query("stg_matches", ["B1", "B2", "B3", "B11", "N"], with_tables("SELECT * FROM stg_matches", "stg_matches"),
       longs=["competition_id", "season_id"], texts=["match_date"])
def stg_matches(spark, d):
    return base.Run(spark, d).stg_matches


@query("stg_events", ["B4", "B5", "C3"], with_tables("SELECT * FROM stg_events", "stg_events"),
       doubles=["location_x", "location_y", "shot_xg"], longs=["period"])
def stg_events(spark, d):
    return base.Run(spark, d).stg_events


def _typed(spark, d, name):
    """A raw table written as files of its declared types and read back with the declared schema.

    Events of a large table lie by match and are written and read so.
    """
    parts = feeds.line_parts(spark, d) if name == "events" else None
    fields = T.StructType.fromDDL(SCHEMAS[name]).fields
    raw = feeds.raw_events(spark, d, "int") if parts else getattr(feeds, f"raw_{name}")(spark, d)
    typed = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    folder = new_folder(spark, "raw")
    if parts:
        writers.write_bucketed(typed, f"{folder}/{name}.parquet", "match_id", parts)
        return read_raw(spark, folder, name, "match_id", parts)
    typed.write.parquet(f"{folder}/{name}.parquet")
    return read_raw(spark, folder, name)


@query("stg_matches_typed", ["A1", "B1", "B11"], with_tables("SELECT * FROM stg_matches", "stg_matches"),
       longs=["competition_id", "season_id"], texts=["match_date"])
def stg_matches_typed(spark, d):
    return staging.season_from(staging.matches(_typed(spark, d, "matches"), 0), FIRST_SEASON)


@query("stg_events_typed", ["A1", "B4"], with_tables("SELECT * FROM stg_events", "stg_events"),
       doubles=["location_x", "location_y", "shot_xg"], longs=["period"])
def stg_events_typed(spark, d):
    return staging.events(_typed(spark, d, "events"), base.Run(spark, d).stg_matches)


@query(
    "stg_lineups_flat",
    ["B6"],
    with_tables(
        """SELECT match_id, team_name, player_name, jersey_number, position_name, from_time, to_time, card_type FROM stg_lineups
           QUALIFY count(*) OVER (PARTITION BY match_id, team_name, player_name, jersey_number) = 1""",
        "stg_lineups",
    ),
)
def stg_lineups_flat(spark, d):
    """Entries with a name and number of their own in the flat layout, stints as rows in any order."""
    raw = _typed(spark, d, "lineups").withColumn("team_name", F.trim("team_name"))
    entry = ["match_id", "team_name", "player_name", "jersey_number"]
    single = raw.groupBy(*entry).count().filter("count = 1").select(*entry)
    stints = raw.join(single, entry).select(*entry, F.explode_outer("positions").alias("p"), F.get("cards", F.lit(0))["card_type"].alias("card_type"))
    flat = stints.select(*entry, F.col("p.position").alias("position_name"), F.col("p.from").alias("from_time"), F.col("p.to").alias("to_time"), "card_type")
    return staging.lineups_flat(flat.repartition("from_time", *entry), base.Run(spark, d).stg_matches)


@query("stg_lineups", ["B6"], with_tables("SELECT * FROM stg_lineups", "stg_lineups"))
def stg_lineups(spark, d):
    return base.Run(spark, d).stg_lineups


@query("stg_lineups_json", ["B6", "N"], with_tables("SELECT * FROM stg_lineups", "stg_lineups"))
def stg_lineups_json(spark, d):
    raw = feeds.raw_lineups(spark, d).withColumns({"positions": F.to_json("positions"), "cards": F.to_json("cards")})
    return staging.lineups(staging.parse_lineup_json(raw), base.Run(spark, d).stg_matches)


_CLOCK = """
    SELECT event_id, CASE event_id % 9
        WHEN 0 THEN (event_id % 95) || ':' || lpad((event_id % 60)::VARCHAR, 2, '0')
        WHEN 1 THEN '1:' || lpad((event_id % 60)::VARCHAR, 2, '0') || ':' || lpad((event_id % 59)::VARCHAR, 2, '0')
        WHEN 2 THEN '90+' || (event_id % 9) || ':' || lpad((event_id % 60)::VARCHAR, 2, '0')
        WHEN 3 THEN '' WHEN 4 THEN 'nan' WHEN 5 THEN NULL WHEN 6 THEN 'abc'
        WHEN 7 THEN '90+' || (event_id % 9) ELSE ' ' || (event_id % 120) || ':30 ' END AS clock
    FROM events"""


@query(
    "clock_parsing",
    ["B7", "B8", "B9", "O1"],
    f"""
    SELECT event_id,
           CASE WHEN n = 2 THEN a + b / 60 END AS plain,
           CASE WHEN n = 2 THEN a + b / 60 WHEN n = 3 THEN a * 60 + b + c / 60 END AS hms,
           CASE WHEN t LIKE '%+%' THEN 90 + coalesce(try_cast(split_part(split_part(t, '+', 2), ':', 1) AS DOUBLE), 0)
                     + coalesce(try_cast(split_part(split_part(t, '+', 2), ':', 2) AS DOUBLE), 0) / 60
                WHEN n = 2 THEN a + b / 60 END AS stoppage
    FROM (SELECT *, len(string_split(t, ':')) AS n, try_cast(split_part(t, ':', 1) AS DOUBLE) AS a,
                 try_cast(split_part(t, ':', 2) AS DOUBLE) AS b, try_cast(split_part(t, ':', 3) AS DOUBLE) AS c
          FROM (SELECT event_id, nullif(nullif(trim(clock), ''), 'nan') AS t FROM ({_CLOCK})))""",
    doubles=["plain", "hms", "stoppage"],
)
def clock_parsing(spark, d):
    return feeds.clock_texts(spark, d).select(
        "event_id",
        text.clock_minutes("clock").alias("plain"),
        text.clock_minutes("clock", hms=True).alias("hms"),
        text.clock_minutes("clock", stoppage=True).alias("stoppage"),
    )


@query(
    "stint_minutes",
    ["B10"],
    with_tables(
        """SELECT match_id, player_id, s['position'] AS position_name,
                  greatest(0, least(coalesce(split_part(s['to'], ':', 1)::DOUBLE + split_part(s['to'], ':', 2)::DOUBLE / 60, 90), 120)
                              - coalesce(split_part(s['from'], ':', 1)::DOUBLE + split_part(s['from'], ':', 2)::DOUBLE / 60, 0)) AS minutes_played
           FROM (SELECT match_id, player_id, unnest(CASE WHEN len(positions) = 0 THEN [NULL] ELSE positions END) AS s
                 FROM raw_lineups WHERE match_id IN (SELECT match_id FROM stg_matches))""",
        "raw_lineups",
        "stg_matches",
    ),
    doubles=["minutes_played"],
)
def stint_minutes(spark, d):
    stints = staging.lineup_stints(feeds.raw_lineups(spark, d), base.Run(spark, d).stg_matches)
    return players.lineup_minutes(stints, floor_at_zero=True).select("match_id", "player_id", "position_name", "minutes_played")


@query(
    "busy_competition_seasons",
    ["B12", "B13"],
    with_tables(
        """SELECT match_id, competition_name, season_name FROM stg_matches WHERE gender = 'male'
           QUALIFY count(*) OVER (PARTITION BY competition_name, season_name) >= 10""",
        "stg_matches",
    ),
)
def busy_competition_seasons(spark, d):
    rows = staging.min_matches(staging.mens_scope(base.Run(spark, d).stg_matches))
    return rows.select("match_id", "competition_name", "season_name")


@query(
    "event_type_keys",
    ["B14"],
    """SELECT lower(trim(t)) AS kind, count(*) AS n FROM (
           SELECT CASE WHEN event_id % 2 = 0 THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS t FROM events) GROUP BY 1""",
)
def event_type_keys(spark, d):
    mixed = read_table(spark, d, "events").withColumn(
        "raw",
        F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("name"))))
        .otherwise(F.col("event_type")),
    )
    return mixed.groupBy(text.event_type_key("raw").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "context_flags",
    ["B15"],
    "SELECT event_id, event_id % 6 IN (0, 1, 2) AS is_national FROM events",
)
def context_flags(spark, d):
    return read_table(spark, d, "events").select(
        "event_id",
        labels.context_flag(
            F.expr("element_at(array('true', ' National', '1', 'False', 'club ', '0'), cast(event_id % 6 AS int) + 1)")
        ).alias("is_national"),
    )


@query(
    "world_cup_matches",
    ["B16", "B17"],
    with_tables(
        """SELECT tournament, count(*) AS n, count(*) FILTER (home_score IS NOT NULL AND away_score IS NOT NULL) AS completed,
                  count(*) FILTER (home_score IS NULL OR away_score IS NULL) AS scheduled
           FROM results WHERE tournament ILIKE '%world cup%' GROUP BY 1""",
        "results",
    ),
)
def world_cup_matches(spark, d):
    found = feeds.results(spark, d).filter(labels.label_contains("tournament", "World Cup"))
    done, todo = staging.split_completed(found.select("tournament", "home_score", "away_score"))
    tagged = done.select("tournament", F.lit(1).alias("c"), F.lit(0).alias("s")).unionByName(
        todo.select("tournament", F.lit(0).alias("c"), F.lit(1).alias("s"))
    )
    return tagged.groupBy("tournament").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("completed"), F.sum("s").alias("scheduled")
    )


@query(
    "position_groups",
    ["B18"],
    with_tables(
        f"""SELECT position_name, {POSITION_CASE} AS position_group, {BROAD_CASE} AS broad, count(*) AS n
            FROM stg_lineups GROUP BY 1, 2, 3""",
        "stg_lineups",
    ),
)
def position_groups(spark, d):
    return (
        base.Run(spark, d).stg_lineups
        .groupBy("position_name", labels.position_group("position_name").alias("position_group"),
                 labels.broad_position("position_name").alias("broad"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "league_labels",
    ["B19"],
    with_tables(
        f"""SELECT label, list_position(['La Liga', 'EPL', 'Bundesliga', 'Serie A', 'Ligue 1'], label) AS sort_key, n
            FROM (SELECT {LEAGUE_CASE} AS label, count(*) AS n FROM stg_matches GROUP BY 1)""",
        "stg_matches",
    ),
    longs=["sort_key"],
)
def league_labels(spark, d):
    rows = base.Run(spark, d).stg_matches.groupBy(labels.competition_label("competition_name").alias("label"))
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("sort_key", labels.sort_key("label", COMPETITION_LABEL_ORDER))


@query(
    "country_crosswalk",
    ["B20"],
    with_tables("SELECT nationality, intl_team, count(*) AS n FROM players_h GROUP BY 1, 2", "players_h"),
)
def country_crosswalk(spark, d):
    return base.Run(spark, d).rated_players.groupBy("nationality", "intl_team").agg(F.count(F.lit(1)).alias("n"))


@query(
    "former_team_names",
    ["B21"],
    with_tables("SELECT match_id, date, home_team, away_team FROM results_now", "results_now"),
    texts=["date"],
)
def former_team_names(spark, d):
    return base.Run(spark, d).results_now.select("match_id", "date", "home_team", "away_team")


@query(
    "active_players",
    ["B22", "B23"],
    with_tables(
        """SELECT player_id, competition_id, season_id FROM season WHERE player_name <> 'Player 7'
           AND (passes_per_90 > 0 OR carries_per_90 > 0 OR shots_per_90 > 0)""",
        "season",
    ),
    longs=["competition_id", "season_id"],
)
def active_players(spark, d):
    kept = staging.exclude(base.Run(spark, d).season, "player_name", ["Player 7"])
    rows = staging.active_only(kept, ["passes_per_90", "carries_per_90", "shots_per_90"])
    return rows.select("player_id", "competition_id", "season_id")


@query(
    "world_cup_squads",
    ["J17"],
    with_tables(
        """SELECT nationality, count(*) AS squad_size, avg(overall) AS mean_overall FROM players
           WHERE was_world_cup_squad_member AND world_cup_squad_tournament_year = 2022 GROUP BY 1""",
        "players",
    ),
    doubles=["mean_overall"],
)
def world_cup_squads(spark, d):
    return international.squad_table(feeds.players(spark, d), 2022)
