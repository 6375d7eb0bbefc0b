"""Counting and summarising queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.constants import FEATURES, MIN_MINUTES
from touchline.functions.labels import context_label
from touchline.operators import aggregates, joins
from touchline.operators.sketches import estimates, merge_rule, merged, sketches
from touchline.plans import exploration, players, staging
from touchline.session import materialize, new_folder
from touchline.sources.readers import read_table
from touchline.streaming.versions import VersionedTable
from touchline.workload import base, feeds
from touchline.workload.registry import query
from touchline.workload.tables_sql import COUNTERS, with_tables


@query("player_match_events", ["D1"], with_tables("SELECT * FROM player_match_events", "player_match_events"),
       doubles=["total_xg"])
def player_match_events(spark, d):
    return players.player_match_events(base.Run(spark, d).stg_events)


@query("player_match_stats", ["D2", "C2"], with_tables("SELECT * FROM player_match_stats", "player_match_stats"),
       doubles=["minutes_played", "total_xg", "pass_completion_pct"])
def player_match_stats(spark, d):
    return base.Run(spark, d).player_match


@query("match_stats", ["D3", "D4"], with_tables("SELECT * FROM match_stats", "match_stats"),
       doubles=["total_xg", "pass_completion_pct", "possession_share"], longs=["competition_id", "season_id"], texts=["match_date"])
def match_stats(spark, d):
    return base.Run(spark, d).match_stats


@query("player_season_totals", ["D5", "D7", "D8"], with_tables("SELECT * FROM season_totals", "season_totals"),
       doubles=["total_minutes", "total_xg"], longs=["competition_id", "season_id"])
def player_season_totals(spark, d):
    return players.player_season_totals(base.Run(spark, d).player_match, base.Run(spark, d).stg_matches)


_SEASON_DOUBLES = ["total_minutes", "total_xg", "pass_completion_pct", "xg_per_shot"] + list(players.RATE_OF)


@query("player_season_stats", ["D6"], with_tables("SELECT * FROM season", "season"),
       doubles=_SEASON_DOUBLES, longs=["competition_id", "season_id"])
def player_season_stats(spark, d):
    return base.Run(spark, d).season


@query("team_season_stats", ["D9"], with_tables("SELECT * FROM team_season", "team_season"),
       doubles=["total_xg", "avg_xg_per_match", "avg_possession_share", "avg_pressures_per_match"],
       longs=["competition_id", "season_id"])
def team_season_stats(spark, d):
    from touchline.plans.teams import team_season_stats as build

    return build(base.Run(spark, d).match_stats)


@query("context_per90", ["D10", "D11"], with_tables("SELECT * FROM contexts", "contexts"),
       doubles=_SEASON_DOUBLES + list(players.CONTEXT_ONLY_RATES))
def context_per90(spark, d):
    return base.Run(spark, d).contexts


@query("club_vs_national", ["D12", "E3"], with_tables("SELECT * FROM club_national", "club_national"),
       doubles=_SEASON_DOUBLES + list(players.CONTEXT_ONLY_RATES) + [f"z_{f}" for f in players.FEATURES])
def club_vs_national(spark, d):
    return base.Run(spark, d).club_national


# --- straight from raw rows -----------------------------------------------------------------------

_RAW = """count(*) FILTER (type = 'Shot') AS shots, sum(CASE WHEN type = 'Shot' THEN coalesce(shot_xg, 0) ELSE 0 END) AS xg,
    count(*) FILTER (type = 'Pass') AS passes, count(*) FILTER (type = 'Pass' AND pass_outcome IS NULL) AS passes_completed,
    count(*) FILTER (type = 'Pass' AND location_x > 80) AS passes_att_third, count(*) FILTER (type = 'Pressure') AS pressures,
    count(*) FILTER (type = 'Carry') AS carries, count(*) FILTER (type = 'Carry' AND location_x > 80) AS carries_att_third,
    count(*) FILTER (type = 'Dribble') AS dribbles, count(*) FILTER (type = 'Interception') AS interceptions,
    count(*) FILTER (type = 'Clearance') AS clearances, count(*) FILTER (type = 'Duel') AS duels"""
_RAW_RATES = ", ".join(f"{c} / (total_minutes / 90) AS {c}_p90" for c in players.RAW_RATES)
_RAW_RATES += ", CASE WHEN shots > 0 THEN xg / shots ELSE 0 END AS xg_per_shot, 100.0 * passes_completed::DOUBLE / nullif(passes, 0) AS pass_completion_pct"
_RAW_DOUBLES = [f"{c}_p90" for c in players.RAW_RATES] + ["xg_per_shot", "pass_completion_pct", "total_minutes"]
_TYPED = """SELECT e.*, s.location_x, s.shot_xg, nullif(e.pass_outcome, 'None') AS outcome FROM raw_events e
    JOIN stg_events s ON e.id = s.event_id"""


def _typed_events(spark, d):
    """Staged events with player id and duration; identical raw rows are one event.

    The id of an event names its match, so the match joins with it: both sides lie by match.
    Durations have two decimals. Thresholds on their sums lie between two
    possible sums, so that the order of adding cannot decide.
    """
    staged = base.Run(spark, d).stg_events.select(
        F.col("event_id").alias("id"), "match_id", F.col("event_type").alias("type"), "location_x", "shot_xg", "pass_outcome"
    ).distinct()
    raw = feeds.raw_events(spark, d).select("id", "match_id", "player_id", "duration").distinct()
    return staged.join(raw, on=["id", "match_id"], how="inner")


_EVENT_CTE = """
    SELECT DISTINCT s.event_id AS id, s.match_id, s.event_type AS type, s.location_x, s.shot_xg, s.pass_outcome, r.player_id, r.duration
    FROM stg_events s JOIN raw_events r ON r.id = s.event_id"""


@query(
    "raw_player_season",
    ["D13"],
    with_tables(
        f"""SELECT player_id, player_name, position_name, competition_name, season_name, matches_played, total_minutes, {_RAW_RATES}
            FROM (SELECT e.player_id, l.player_name, l.position_name, m.competition_name, m.season_name,
                         count(DISTINCT e.match_id) AS matches_played, sum(e.duration) AS total_minutes, {_RAW}
                  FROM ({_EVENT_CTE}) e JOIN stg_lineups l ON l.match_id = e.match_id AND l.player_id = e.player_id
                  JOIN stg_matches m ON m.match_id = e.match_id GROUP BY 1, 2, 3, 4, 5 HAVING sum(e.duration) >= 270)""",
        "stg_events", "raw_events", "stg_lineups", "stg_matches",
    ),
    doubles=_RAW_DOUBLES,
)
def raw_player_season(spark, d):
    return players.raw_player_season(_typed_events(spark, d), base.Run(spark, d).stg_lineups, base.Run(spark, d).stg_matches, MIN_MINUTES)


@query(
    "raw_player_context",
    ["D14", "E9"],
    with_tables(
        f"""WITH j AS (
                SELECT e.*, l.player_name, l.position_name, CASE WHEN m.is_international THEN 'National' ELSE 'Club' END AS context
                FROM ({_EVENT_CTE}) e JOIN stg_lineups l ON l.match_id = e.match_id AND l.player_id = e.player_id
                JOIN stg_matches m ON m.match_id = e.match_id WHERE m.gender = 'male'),
            p AS (SELECT player_id, context, position_name FROM j GROUP BY 1, 2, 3
                  QUALIFY row_number() OVER (PARTITION BY player_id, context ORDER BY round(sum(duration), 4) DESC, position_name) = 1)
            SELECT b.player_id, b.context, player_name, matches_played, total_minutes, {_RAW_RATES}, position_name
            FROM (SELECT player_id, context, max(player_name) AS player_name, count(DISTINCT match_id) AS matches_played,
                         sum(duration) AS total_minutes, {_RAW} FROM j GROUP BY 1, 2 HAVING sum(duration) >= 270) b
            LEFT JOIN p ON p.player_id = b.player_id AND p.context = b.context""",
        "stg_events", "raw_events", "stg_lineups", "stg_matches",
    ),
    doubles=_RAW_DOUBLES,
)
def raw_player_context(spark, d):
    return players.raw_player_context(_typed_events(spark, d), base.Run(spark, d).stg_lineups, base.Run(spark, d).stg_matches, MIN_MINUTES)


_CTX_COUNTS = """count(*) FILTER (event_type = 'Shot') AS shots, sum(shot_xg) FILTER (event_type = 'Shot') AS xg,
    count(*) FILTER (event_type = 'Pass') AS passes, count(*) FILTER (event_type = 'Pass' AND pass_outcome IS NULL) AS passes_completed,
    count(*) FILTER (event_type = 'Pass' AND location_x > 80) AS passes_att_third, count(*) FILTER (event_type = 'Pressure') AS pressures,
    count(*) FILTER (event_type = 'Carry') AS carries, count(*) FILTER (event_type = 'Carry' AND location_x > 80) AS carries_att_third,
    count(*) FILTER (event_type = 'Duel') AS duels, count(*) FILTER (event_type = 'Dribble') AS dribbles,
    count(*) FILTER (event_type = 'Interception') AS interceptions, count(*) FILTER (event_type = 'Clearance') AS clearances,
    count(*) FILTER (event_type = 'Ball Receipt*') AS ball_receipts"""
_CONTEXT = "CASE WHEN m.is_international THEN 'National' ELSE 'Club' END"
CONTEXT_EVENTS_SQL = f"""
    SELECT e.player, {_CONTEXT} AS context, {_CTX_COUNTS} FROM stg_events e JOIN stg_matches m USING (match_id)
    WHERE m.gender = 'male' GROUP BY 1, 2"""


@query("player_context_events", ["D15", "D27"], with_tables(CONTEXT_EVENTS_SQL, "stg_events", "stg_matches"), doubles=["xg"])
def player_context_events(spark, d):
    return players.player_context_events(base.Run(spark, d).stg_events, base.Run(spark, d).stg_matches)


def _clock(c: str) -> str:
    return f"try_cast(split_part({c}, ':', 1) AS DOUBLE) + try_cast(split_part({c}, ':', 2) AS DOUBLE) / 60"


_SPAN = f"greatest(0, least(coalesce({_clock('l.to_time')}, 90), 120) - coalesce({_clock('l.from_time')}, 0))"


def minutes_sql(key: str, names: str) -> str:
    return f"""
    SELECT t.*, coalesce(p.position_name, 'Unknown') AS position_name
    FROM (SELECT l.player_name, {key} AS {names}, sum({_SPAN}) AS total_minutes, count(DISTINCT match_id) AS match_count
          FROM stg_lineups l JOIN stg_matches m USING (match_id) WHERE m.gender = 'male' GROUP BY 1, 2) t
    LEFT JOIN (SELECT l.player_name, {key} AS {names}, l.position_name FROM stg_lineups l JOIN stg_matches m USING (match_id)
               WHERE m.gender = 'male' AND position_name <> 'Unknown' GROUP BY 1, 2, 3
               QUALIFY row_number() OVER (PARTITION BY l.player_name, {key} ORDER BY count(*) DESC, l.position_name) = 1) p
    ON p.player_name = t.player_name AND p.{names} = t.{names}"""


CONTEXT_MINUTES_SQL = minutes_sql(_CONTEXT, "context")


@query("player_minutes", ["D16"], with_tables(CONTEXT_MINUTES_SQL, "stg_lineups", "stg_matches"), doubles=["total_minutes"])
def player_minutes(spark, d):
    return players.player_minutes(base.Run(spark, d).stg_lineups, base.Run(spark, d).stg_matches)


@query(
    "player_features",
    ["D17"],
    with_tables(
        f"""WITH s AS (SELECT e.player_id, {_RAW.replace("coalesce(shot_xg, 0)", "shot_xg")}, count(*) FILTER (type = 'Block') AS blocks
                       FROM ({_EVENT_CTE}) e JOIN stg_matches m USING (match_id) WHERE m.gender = 'male' GROUP BY 1),
            t AS (SELECT l.player_id, l.player_name, sum({_SPAN}) AS total_minutes, count(DISTINCT match_id) AS matches_played
                  FROM stg_lineups l JOIN stg_matches m USING (match_id) WHERE m.gender = 'male' GROUP BY 1, 2 HAVING sum({_SPAN}) >= 270),
            p AS (SELECT player_id, position_name FROM stg_lineups WHERE position_name <> 'Unknown' GROUP BY 1, 2
                  QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY count(*) DESC, position_name) = 1)
            SELECT t.*, p.position_name, {", ".join(f"{c} / total_minutes * 90 AS {c}_p90" for c in
                ("xg", "shots", "passes", "passes_att_third", "pressures", "carries", "dribbles", "interceptions", "blocks", "clearances", "duels"))},
                CASE WHEN shots > 0 THEN xg / shots ELSE 0 END AS xg_per_shot, 100.0 * passes_completed::DOUBLE / nullif(passes, 0) AS pass_completion_pct
            FROM t JOIN s USING (player_id) LEFT JOIN p USING (player_id)""",
        "stg_events", "raw_events", "stg_lineups", "stg_matches",
    ),
    doubles=["total_minutes", "xg_per_shot", "pass_completion_pct"]
    + [f"{c}_p90" for c in ("xg", "shots", "passes", "passes_att_third", "pressures", "carries", "dribbles", "interceptions", "blocks", "clearances", "duels")],
)
def player_features(spark, d):
    return players.player_features(_typed_events(spark, d), base.Run(spark, d).stg_lineups, base.Run(spark, d).stg_matches)


_PROFILE = ("shots", "xg", "passes", "passes_completed", "pressures", "carries")


def _profile_sql(national: str) -> str:
    return f"""
    SELECT v.competition_name, v.matches, players, {", ".join(f"{c}_p90" for c in _PROFILE)}, pass_completion_pct
    FROM (SELECT competition_name, count(DISTINCT match_id) AS matches FROM stg_matches
          WHERE gender = 'male' AND is_international = {national} GROUP BY 1) v
    LEFT JOIN (SELECT competition_name, count(*) AS players, {", ".join(f"avg({c} / total_minutes * 90) AS {c}_p90" for c in _PROFILE)},
                      avg(passes_completed::DOUBLE / nullif(passes, 0)) AS pass_completion_pct
               FROM (SELECT e.player, m.competition_name, {_CTX_COUNTS} FROM stg_events e JOIN stg_matches m USING (match_id)
                     WHERE m.gender = 'male' AND m.is_international = {national} GROUP BY 1, 2) c
               JOIN (SELECT l.player_name AS player, m.competition_name, sum({_SPAN}) AS total_minutes
                     FROM stg_lineups l JOIN stg_matches m USING (match_id)
                     WHERE m.gender = 'male' AND m.is_international = {national} GROUP BY 1, 2) t USING (player, competition_name)
               WHERE total_minutes >= 270 GROUP BY 1) p USING (competition_name)"""


_PROFILE_DOUBLES = [f"{c}_p90" for c in _PROFILE] + ["pass_completion_pct"]


@query("tournament_profile", ["D18"], with_tables(_profile_sql("true"), "stg_events", "stg_lineups", "stg_matches"), doubles=_PROFILE_DOUBLES)
def tournament_profile(spark, d):
    return players.competition_profile(base.Run(spark, d).stg_events, base.Run(spark, d).stg_lineups, base.Run(spark, d).stg_matches, True)


@query("league_profile", ["D18"], with_tables(_profile_sql("false"), "stg_events", "stg_lineups", "stg_matches"), doubles=_PROFILE_DOUBLES)
def league_profile(spark, d):
    return players.competition_profile(base.Run(spark, d).stg_events, base.Run(spark, d).stg_lineups, base.Run(spark, d).stg_matches, False)


# --- reports ---------------------------------------------------------------------------------------


@query(
    "rows_per_season",
    ["D19", "C1", "C11"],
    with_tables(
        """SELECT 'events' AS kind, m.competition_name, m.season AS season_name, count(*) AS n
           FROM raw_events JOIN raw_matches m USING (match_id) GROUP BY 1, 2, 3
           UNION ALL SELECT 'lineups', m.competition_name, m.season, count(*) FROM raw_lineups JOIN raw_matches m USING (match_id) GROUP BY 1, 2, 3
           UNION ALL SELECT 'matches', competition_name, season, count(*) FROM raw_matches GROUP BY 1, 2, 3""",
        "raw_events", "raw_lineups", "raw_matches",
    ),
)
def rows_per_season(spark, d):
    matches = feeds.with_flags(feeds.raw_matches(spark, d))
    parts = {"events": feeds.raw_events(spark, d), "lineups": feeds.raw_lineups(spark, d), "matches": matches}
    out = [
        exploration.rows_per_season(df.select("match_id"), matches).withColumn("kind", F.lit(kind)) for kind, df in parts.items()
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "event_type_share",
    ["D20", "E8"],
    "SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM events GROUP BY 1",
    doubles=["pct"],
)
def event_type_share(spark, d):
    return exploration.type_share(read_table(spark, d, "events"))


def _rates_sql(select: str, group: str) -> str:
    pct = ", ".join(
        f"round(100.0::DOUBLE * count(*) FILTER ({t}) / count(*), 2) AS pct_{n}"
        for n, t in (("home", "home_score > away_score"), ("away", "home_score < away_score"), ("draw", "home_score = away_score"))
    )
    return f"""SELECT {select} count(*) FILTER (home_score > away_score) AS n_home_win, count(*) FILTER (home_score < away_score) AS n_away_win,
        count(*) FILTER (home_score = away_score) AS n_draw, count(*) AS n_matches, {pct}
        FROM results WHERE home_score IS NOT NULL AND away_score IS NOT NULL {group}"""


@query("outcome_rates_overall", ["D21"], with_tables(_rates_sql("", ""), "results"), doubles=["pct_home", "pct_away", "pct_draw"])
def outcome_rates_overall(spark, d):
    return aggregates.outcome_rates(feeds.results(spark, d))


@query("outcome_rates_by_tournament", ["D21"], with_tables(_rates_sql("tournament, year(date) AS year,", "GROUP BY 1, 2"), "results"),
       doubles=["pct_home", "pct_away", "pct_draw"], longs=["year"])
def outcome_rates_by_tournament(spark, d):
    return aggregates.outcome_rates(feeds.results(spark, d).withColumn("year", F.year("date")), ["tournament", "year"])


@query(
    "outcome_rate_levels",
    ["D21"],
    with_tables(
        """SELECT competition_name, season_name, grouping_id(competition_name, season_name) AS level,
                  count(*) FILTER (home_score > away_score) AS n_home_win, count(*) FILTER (home_score < away_score) AS n_away_win,
                  count(*) FILTER (home_score = away_score) AS n_draw, count(*) AS n_matches,
                  round(100.0::DOUBLE * count(*) FILTER (home_score > away_score) / count(*), 2) AS pct_home
           FROM stg_matches GROUP BY GROUPING SETS ((), (competition_name), (competition_name, season_name))""",
        "stg_matches",
    ),
    doubles=["pct_home"],
    longs=["level"],
)
def outcome_rate_levels(spark, d):
    levels = [[], ["competition_name"], ["competition_name", "season_name"]]
    return aggregates.outcome_rate_levels(base.Run(spark, d).stg_matches, levels, ["competition_name", "season_name"])


def _summary_sql(c: str, source: str, keys: str = "", name: str = "") -> str:
    return f"""SELECT {keys} '{name or c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS sd, min({c})::DOUBLE AS min,
        max({c})::DOUBLE AS max, quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS median,
        quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {source}"""


_SUMMARY_DOUBLES = ["mean", "sd", "min", "max", "q1", "median", "q3"]


@query(
    "line_summary",
    ["D22"],
    _summary_sql("l_quantity", "lineitem") + " UNION ALL " + _summary_sql("l_extendedprice", "lineitem"),
    doubles=_SUMMARY_DOUBLES,
)
def line_summary(spark, d):
    return aggregates.numeric_summary(read_table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])


@query(
    "event_value_summary",
    ["D22", "D41"],
    _summary_sql("value", "events", "event_type,") + " GROUP BY 1",
    doubles=_SUMMARY_DOUBLES,
)
def event_value_summary(spark, d):
    return aggregates.numeric_summary(read_table(spark, d, "events"), ["value"], ["event_type"])


@query(
    "percentiles_of_heavy_groups",
    ["D22", "G3"],
    """SELECT l_returnflag, "column", p, CASE p WHEN 0.25 THEN a WHEN 0.5 THEN b ELSE c END AS value FROM (
           SELECT l_returnflag, 'l_extendedprice' AS "column", quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS b,
                  quantile_cont(l_extendedprice, 0.99) AS c FROM lineitem GROUP BY 1
           UNION ALL SELECT l_returnflag, 'l_quantity', quantile_cont(l_quantity, 0.25), quantile_cont(l_quantity, 0.5), quantile_cont(l_quantity, 0.99)
           FROM lineitem GROUP BY 1), (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.99::DOUBLE]) AS p)""",
    doubles=["p", "value"],
)
def percentiles_of_heavy_groups(spark, d):
    """Brackets much narrower than the groups."""
    return aggregates.exact_percentiles(
        read_table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.99], ["l_returnflag"], accuracy=1000
    )


@query(
    "xg_histogram",
    ["D23"],
    with_tables(
        """SELECT (floor(shot_xg * 20) + 1)::BIGINT AS bin, count(*) AS n FROM stg_events
           WHERE event_type = 'Shot' AND shot_xg BETWEEN 0 AND 1 GROUP BY 1""",
        "stg_events",
    ),
)
def xg_histogram(spark, d):
    return exploration.xg_histogram(base.Run(spark, d).stg_events)


@query(
    "minute_bins",
    ["D24"],
    with_tables(
        f"""SELECT CASE WHEN m IS NULL THEN 'null' WHEN m < 15 THEN '0-15' WHEN m < 30 THEN '15-30' WHEN m < 45 THEN '30-45'
                   WHEN m < 60 THEN '45-60' WHEN m < 75 THEN '60-75' WHEN m < 90 THEN '75-90' WHEN m <= 105 THEN '90-105'
                   ELSE '105-120' END AS min_bin, count(*) AS n
            FROM (SELECT CASE WHEN l.from_time IS NOT NULL AND l.to_time IS NOT NULL THEN
                         least(120, greatest(0, least({_clock('l.to_time')}, 120) - ({_clock('l.from_time')}))) END AS m FROM stg_lineups l) GROUP BY 1""",
        "stg_lineups",
    ),
)
def minute_bins(spark, d):
    return exploration.minute_bins(exploration.stint_minutes(base.Run(spark, d).stg_lineups))


@query(
    "approximate_quantiles",
    ["D25"],
    """SELECT p, CASE WHEN p = 0 THEN (SELECT min(l_quantity) FROM lineitem) WHEN p = 1 THEN (SELECT max(l_quantity) FROM lineitem)
              WHEN p = 0.5 THEN (SELECT quantile_disc(l_quantity, 0.5) FROM lineitem) END AS value
       FROM (SELECT unnest([0.0::DOUBLE, 0.5::DOUBLE, 1.0::DOUBLE]) AS p)""",
    doubles=["p", "value"],
)
def approximate_quantiles(spark, d):
    return aggregates.approx_quantiles(read_table(spark, d, "lineitem"), "l_quantity", [0.0, 0.5, 1.0])


@query(
    "distinct_counts",
    ["D26"],
    with_tables(
        "SELECT count(DISTINCT player_name) AS n_player_name, count(DISTINCT position_name) AS n_position_name, count(DISTINCT team_name) AS n_team_name FROM stg_lineups",
        "stg_lineups",
    ),
)
def distinct_counts(spark, d):
    return exploration.distinct_counts(base.Run(spark, d).stg_lineups, ["player_name", "position_name", "team_name"])


@query(
    "xg_leaders",
    ["D28", "F2"],
    with_tables(
        """SELECT team, count(*) AS shots, round(sum(shot_xg), 2) AS total_xg, round(avg(shot_xg), 4) AS avg_xg_per_shot FROM stg_events
           WHERE event_type = 'Shot' AND shot_xg IS NOT NULL GROUP BY 1 ORDER BY total_xg DESC, team LIMIT 20""",
        "stg_events",
    ),
    doubles=["total_xg", "avg_xg_per_shot"],
)
def xg_leaders(spark, d):
    return exploration.xg_leaders(base.Run(spark, d).stg_events)


@query(
    "pass_leaders",
    ["D28"],
    with_tables(
        """SELECT team, count(*) AS total_passes, count(*) FILTER (pass_outcome IS NULL) AS completed,
                  round(100.0::DOUBLE * count(*) FILTER (pass_outcome IS NULL) / count(*), 1) AS completion_pct
           FROM stg_events WHERE event_type = 'Pass' GROUP BY 1 HAVING count(*) > 500 ORDER BY completion_pct DESC, team LIMIT 20""",
        "stg_events",
    ),
    doubles=["completion_pct"],
)
def pass_leaders(spark, d):
    return exploration.pass_leaders(base.Run(spark, d).stg_events)


@query(
    "tempo",
    ["D29"],
    with_tables("SELECT minute, count(*) AS events FROM stg_events WHERE period IN (1, 2) AND minute <= 95 GROUP BY 1", "stg_events"),
)
def tempo(spark, d):
    return exploration.tempo(base.Run(spark, d).stg_events)


@query(
    "tracking_coverage",
    ["D31"],
    with_tables(
        """SELECT count(DISTINCT event_uuid) AS tracked_events, count(DISTINCT match_id) AS tracked_matches,
                  count(*) FILTER (actor) AS actor_rows, count(*) FILTER (keeper) AS keeper_rows, count(*) FILTER (teammate) AS teammate_rows
           FROM raw_tracking""",
        "raw_tracking",
    ),
)
def tracking_coverage(spark, d):
    return exploration.tracking_coverage(feeds.raw_tracking(spark, d))


@query(
    "players_per_frame",
    ["D32"],
    with_tables("SELECT avg(n) AS avg_players FROM (SELECT count(*) AS n FROM raw_tracking GROUP BY event_uuid)", "raw_tracking"),
    doubles=["avg_players"],
)
def players_per_frame(spark, d):
    return aggregates.mean_group_size(feeds.raw_tracking(spark, d), "event_uuid", "avg_players")


@query(
    "shot_grid",
    ["D33"],
    with_tables(
        """SELECT least(floor(location_x * 30 / 120), 29)::BIGINT AS cell_x, least(floor(location_y * 30 / 80), 29)::BIGINT AS cell_y, count(*) AS n
           FROM stg_events WHERE event_type = 'Shot' AND shot_xg IS NOT NULL AND location_x BETWEEN 0 AND 120 AND location_y BETWEEN 0 AND 80
           GROUP BY 1, 2""",
        "stg_events",
    ),
)
def shot_grid(spark, d):
    return exploration.shot_grid(base.Run(spark, d).stg_events)


_CORR = FEATURES
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM season" for i, a in enumerate(_CORR) for b in _CORR[i + 1 :]
)


@query("feature_correlations", ["D34"], with_tables(_CORR_SQL, "season"), doubles=["corr"])
def feature_correlations(spark, d):
    return aggregates.corr_matrix(base.Run(spark, d).season, _CORR)


_NULLS = ("location_x", "location_y", "shot_xg", "pass_outcome")


@query(
    "null_profile",
    ["D35"],
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS nulls,
                round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*), 2) AS pct_null FROM stg_events""" for c in _NULLS
        ),
        "stg_events",
    ),
    doubles=["pct_null"],
)
def null_profile(spark, d):
    return aggregates.null_profile(base.Run(spark, d).stg_events, _NULLS)


@query(
    "rating_coverage_by_start",
    ["D36"],
    with_tables(
        """SELECT s AS from_year, count(*) AS n_matches, count(*) FILTER (year(date) IN (SELECT DISTINCT year FROM players)) AS n_with_rating_year,
                  round(100.0::DOUBLE * count(*) FILTER (year(date) IN (SELECT DISTINCT year FROM players)) / count(*), 1) AS pct_with_ratings
           FROM results, (SELECT unnest([1990, 2021, 2023, 2026]) AS s)
           WHERE home_score IS NOT NULL AND away_score IS NOT NULL AND year(date) >= s GROUP BY 1""",
        "results", "players",
    ),
    doubles=["pct_with_ratings"],
    longs=["from_year"],
)
def rating_coverage_by_start(spark, d):
    completed, _ = staging.split_completed(feeds.results(spark, d))
    years = feeds.players(spark, d).select(F.col("year").cast("int").alias("match_year"))
    return aggregates.coverage_by_start(completed.withColumn("match_year", F.year("date")), "match_year", years, [1990, 2021, 2023, 2026])


_GAPS = ("xg_per_90", "passes_per_90", "pass_completion_pct")


@query(
    "context_means",
    ["D37"],
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS metric, c AS club_mean, n AS national_mean, n - c AS delta, round((n - c) / nullif(c, 0) * 100, 1) AS delta_pct
                FROM (SELECT avg({m}) FILTER (NOT is_international) AS c, avg({m}) FILTER (is_international) AS n FROM club_national)""" for m in _GAPS
        ),
        "club_national",
    ),
    doubles=["club_mean", "national_mean", "delta", "delta_pct"],
)
def context_means(spark, d):
    return aggregates.group_mean_gap(base.Run(spark, d).club_national, "is_international", _GAPS)


@query("goal_distribution", ["D38"], with_tables("SELECT home_score + away_score AS total_goals, count(*) AS n FROM stg_matches GROUP BY 1", "stg_matches"))
def goal_distribution(spark, d):
    return exploration.goal_distribution(base.Run(spark, d).stg_matches)


@query(
    "competition_landscape",
    ["D40"],
    with_tables(
        """SELECT competition_name, CASE WHEN is_international THEN 'National' ELSE 'Club' END AS context, count(DISTINCT match_id) AS matches,
                  count(DISTINCT season_name) AS seasons, min(match_date) AS earliest, max(match_date) AS latest
           FROM stg_matches WHERE gender = 'male' GROUP BY 1, 2""",
        "stg_matches",
    ),
    texts=["earliest", "latest"],
)
def competition_landscape(spark, d):
    return exploration.landscape(staging.mens_scope(base.Run(spark, d).stg_matches))


@query(
    "shot_xg_summary",
    ["D22"],
    with_tables(
        """SELECT count(*) AS n_shots_with_xg, round(avg(shot_xg), 4) AS mean_xg, round(stddev_samp(shot_xg), 4) AS sd_xg,
                  min(shot_xg) AS min_xg, max(shot_xg) AS max_xg FROM stg_events WHERE event_type = 'Shot' AND shot_xg IS NOT NULL""",
        "stg_events",
    ),
    doubles=["mean_xg", "sd_xg", "min_xg", "max_xg"],
)
def shot_xg_summary(spark, d):
    return exploration.shot_summary(base.Run(spark, d).stg_events)


@query(
    "monthly_orders",
    ["D30"],
    "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1",
    doubles=["total"],
    texts=["month"],
    digits=2,
)
def monthly_orders(spark, d):
    from touchline.plans.markets import monthly

    return monthly(read_table(spark, d, "orders"), "o_orderdate", [F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")])


@query(
    "weekend_activity",
    ["D1", "D5", "D6"],
    """SELECT user_id, CASE WHEN dayofweek(ts) IN (0, 6) THEN 'National' ELSE 'Club' END AS context, count(*) FILTER (event_type = 'click') AS clicks,
              count(*) FILTER (event_type = 'purchase') AS purchases, sum(value) FILTER (event_type = 'purchase') AS spent,
              count(DISTINCT date_trunc('hour', ts)) AS hours,
              count(*) FILTER (event_type = 'click') / nullif(count(DISTINCT date_trunc('hour', ts)), 0) * 90 AS clicks_per_90
       FROM events GROUP BY 1, 2 HAVING count(DISTINCT date_trunc('hour', ts)) >= 5""",
    doubles=["spent", "clicks_per_90"],
)
def weekend_activity(spark, d):
    from touchline.functions.rates import per90

    rows = read_table(spark, d, "events").withColumn("context", context_label(F.dayofweek("ts").isin(1, 7)))
    sums = rows.groupBy("user_id", "context").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("spent"),
        F.count_distinct(F.date_trunc("hour", "ts")).alias("hours"),
    )
    return sums.filter(F.col("hours") >= 5).withColumn("clicks_per_90", per90("clicks", "hours"))


@query(
    "rating_join_coverage",
    ["C10"],
    with_tables(
        """SELECT count(*) AS n_rows, avg((s.t IS NOT NULL)::INT) AS coverage
           FROM (SELECT home_team AS team, year(date) AS y FROM results_now WHERE home_score IS NOT NULL AND away_score IS NOT NULL
                 UNION ALL SELECT away_team, year(date) FROM results_now WHERE home_score IS NOT NULL AND away_score IS NOT NULL) l
           LEFT JOIN (SELECT DISTINCT intl_team AS t, year FROM players_h) s ON s.t = l.team AND s.year = l.y""",
        "results_now", "players_h",
    ),
    doubles=["coverage"],
)
def rating_join_coverage(spark, d):
    from touchline.plans.international import team_strength
    from touchline.plans.teams import long_results

    completed, _ = staging.split_completed(base.Run(spark, d).results_now)
    strength = team_strength(base.Run(spark, d).rated_players).withColumnsRenamed({"intl_team": "team", "year": "match_year"})
    long = long_results(completed)
    return joins.coverage(joins.attach_year(long, strength, ["team", "match_year"], ["top11_overall"]), "top11_overall")


assert set(COUNTERS) == set(players.COUNTERS)


@query(
    "sketched_days",
    ["D25", "D26"],
    """SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(value) AS n_values, true AS median_is_near FROM events GROUP BY 1""",
)
def sketched_days(spark, d):
    """Distinct users and the median value by event type, from sketches stored by day that two batches of rows were merged into."""
    rows = read_table(spark, d, "events").select("event_id", "event_type", "user_id", "value", F.to_date("ts").alias("day"))
    keys = ["event_type", "day"]
    table = VersionedTable(new_folder(spark, "day-sketches"), ("event_type", "day", "column"), merge_rule(keys), buckets=8, max_deltas=2)
    for k in range(2):
        table.merge(sketches(rows.where(F.col("event_id") % 2 == k), keys, ["user_id"], ["value"]), k, stream="halves")
    stored = table.rows(spark, sketches(rows, keys, ["user_id"], ["value"]).schema)
    whole = materialize(estimates(merged(stored, ["event_type"]), ["event_type"], [0.5]), "sketched")
    wide = whole.groupBy("event_type").agg(
        F.max(F.when(F.col("column") == "user_id", F.col("n"))).alias("n_rows"),
        F.max(F.when(F.col("column") == "user_id", F.col("n_distinct"))).alias("n_users"),
        F.max(F.when(F.col("column") == "value", F.col("n"))).alias("n_values"),
        F.max(F.when(F.col("column") == "value", F.col("quantiles")[0])).alias("median"),
    )
    ranks = rows.join(wide.select("event_type", "median"), "event_type").groupBy("event_type").agg(
        (F.count_if(F.col("value") < F.col("median")) / F.count("value")).alias("low"),
        (F.count_if(F.col("value") <= F.col("median")) / F.count("value")).alias("high"),
    )
    near = (F.col("low") <= 0.5 + 0.0165) & (F.col("high") >= 0.5 - 0.0165)
    return wide.join(ranks, "event_type").select("event_type", "n_rows", "n_users", "n_values", near.alias("median_is_near"))
