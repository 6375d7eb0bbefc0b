"""The same raw and derived tables in plain SQL, for checking.

``with_tables(body, names…)`` prefixes a query with the tables it needs.
"""

from __future__ import annotations

from touchline.constants import (
    ARCHETYPES,
    BROAD_POSITIONS,
    COMPETITION_LABELS,
    FEATURES,
    INTERNATIONAL_COMPETITIONS,
    POSITION_GROUPS,
)
from touchline.workload import feeds

TABLES: dict[str, tuple[str, tuple[str, ...]]] = {}


def table(name: str, sql: str, *needs: str) -> None:
    TABLES[name] = (sql, needs)


def with_tables(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in TABLES[name][1]:
            visit(other)
        order.append(name)

    for n in names:
        visit(n)
    parts = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n][0]})" for n in order)
    own = body.lstrip()
    if own.startswith("WITH "):
        return f"WITH {parts},\n{own.removeprefix('WITH ')}"
    return f"WITH {parts}\n{body}"


def values(names) -> str:
    return "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + "]"


def in_list(names) -> str:
    return "(" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + ")"


def case_map(column: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


table(
    "raw_matches",
    f"""
    SELECT k AS match_id, strftime(d, '%Y-%m-%d') AS match_date, (12 + k % 9)::VARCHAR || ':30' AS kick_off,
           ci + 1 AS competition_id, year(d) - 1990 AS season_id,
           ({values(feeds.COMPETITIONS)})[ci + 1] AS competition_name,
           CASE WHEN ci < 5 THEN y::VARCHAR || '/' || (y + 1)::VARCHAR ELSE y::VARCHAR END AS season,
           CASE WHEN k % 3 = 0 THEN ' ' ELSE '' END || 'Club ' || t AS home_team,
           'Club ' || a || CASE WHEN k % 5 = 0 THEN ' ' ELSE '' END AS away_team,
           floor(p)::BIGINT % 5 AS home_score, (k // 3) % 4 AS away_score,
           CASE WHEN (t // 4) % 20 = 7 THEN 'female' ELSE 'male' END AS home_team_gender
    FROM (SELECT *, (t // 4) % 8 AS ci, xor(t, 1 + k % 3) AS a, year(d) + 4 AS y
          FROM (SELECT o_orderkey AS k, o_orderkey * 37 % 200 AS t, o_orderdate AS d, o_totalprice AS p FROM orders))
    """,
)
table(
    "raw_events",
    f"""
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || slot AS id,
           l_orderkey AS match_id, CASE WHEN h % 95 >= 46 THEN 2 ELSE 1 END AS period, h % 95 AS minute, h % 60 AS second,
           type, CASE WHEN l_linenumber % 2 = 1 THEN 'Club ' || t ELSE 'Club ' || a || ' ' END AS team,
           CASE WHEN h % 97 = 0 THEN 'nan' ELSE 'Player ' || l_suppkey END AS player, l_suppkey AS player_id,
           CASE WHEN h % 53 = 0 THEN 'nan' WHEN h % 59 = 0 THEN '[-0.5, ' || (h % 81) || ']'
                ELSE '[' || (h % 121) || '.' || (h % 10) || ', ' || (h % 81) || '.5]' END AS location,
           CASE WHEN h % 6 = 0 THEN 'Aerial' ELSE 'Regular Play' END AS play_pattern,
           CASE WHEN type <> 'Shot' THEN NULL WHEN h % 41 = 0 THEN 'nan'
                ELSE '0.' || lpad((h % 1000 * 9765625)::VARCHAR, 10, '0') END AS shot_statsbomb_xg,
           CASE WHEN type = 'Pass' AND h % 5 = 0 THEN 'Incomplete' WHEN type = 'Pass' AND h % 7 = 0 THEN 'Assist'
                WHEN type = 'Pass' AND h % 11 = 0 THEN 'None'
                WHEN type = 'Shot' AND (h // 7) % 3 = 0 THEN 'Blocked' END AS pass_outcome,
           (h % 300)::DOUBLE / 32 AS duration
    FROM (SELECT *, ({values(feeds.ACTION_TYPES)})[h % (10 + l_suppkey % 9) + 1] AS type, xor(t, 1 + l_orderkey % 3) AS a
          FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s.slot,
                       l_orderkey * 31 + l_linenumber * 17 + s.slot * 101 + l_partkey * 7 + l_suppkey * 13 AS h,
                       l_orderkey * 37 % 200 AS t
                FROM lineitem, (SELECT unnest(range({feeds.ACTIONS_PER_ENTRY})) AS slot) AS s))
    """,
)


def _stint(p: str, start: str, end: str) -> str:
    return f"{{'position': {p}, 'from': {start}, 'to': {end}}}"


_NONE = "NULL::VARCHAR"
table(
    "raw_lineups",
    f"""
    SELECT l_orderkey AS match_id, l_suppkey AS player_id,
           'Player ' || l_suppkey || CASE WHEN l_suppkey % 25 = 3 AND l_orderkey % 2 = 0 THEN ' Jr' ELSE '' END AS player_name,
           CASE WHEN l_linenumber % 2 = 1 THEN 'Club ' || t ELSE 'Club ' || a || ' ' END AS team_name,
           l_partkey % 99 + 1 AS jersey_number,
           CASE WHEN g % 13 = 0 THEN []
                WHEN g % 5 = 0 THEN [{_stint('p', "'00:00'", _NONE)}, {_stint("'Left Wing'", "'60:00'", "'75:00'")}]
                WHEN g % 4 = 0 THEN [{_stint('p', "(45 + g % 40) || ':15'", _NONE)}]
                WHEN g % 17 = 0 THEN [{_stint('p', "'00:00'", "'125:00'")}]
                WHEN g % 7 = 0 THEN [{_stint('p', "'00:00'", "(60 + g % 30) || ':30'")}]
                ELSE [{_stint('p', "'00:00'", _NONE)}] END AS positions,
           CASE WHEN g % 19 = 0 THEN [{{'card_type': 'Yellow Card'}}] ELSE [] END AS cards
    FROM (SELECT *, ({values(feeds.POSITIONS)})[(l_suppkey + CASE WHEN g % 7 = 0 THEN 1 ELSE 0 END) % 27 + 1] AS p,
                 xor(t, 1 + l_orderkey % 3) AS a
          FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey + l_linenumber * 3 + l_suppkey AS g,
                       l_orderkey * 37 % 200 AS t FROM lineitem))
    """,
)
table(
    "raw_tracking",
    """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-0' AS event_uuid,
           l_orderkey AS match_id, (h + i) % 2 = 0 AS teammate, i = 0 AS actor, (h + i) % 11 = 0 AS keeper
    FROM (SELECT *, unnest(range(h % 5 + 1)) AS i
          FROM (SELECT *, l_orderkey * 7 + l_partkey * 3 + l_suppkey AS h FROM lineitem))
    """,
)
table(
    "markets",
    f"""
    SELECT market_id, 'Customer ' || o_custkey || ' ' || j AS question,
           CASE WHEN k % 10 = 9 THEN c || '-winner-' || year(d)
                ELSE c || '-' || chr((97 + t // 676)::INT) || chr((97 + t // 26 % 26)::INT) || chr((97 + t % 26)::INT)
                     || '-' || chr((97 + a // 676)::INT) || chr((97 + a // 26 % 26)::INT) || chr((97 + a % 26)::INT)
                     || '-' || strftime(d, '%Y-%m-%d') END AS event_slug,
           o_orderpriority AS category, floor(o_totalprice) * z::DOUBLE AS volume, z % 2 = 0 AS active, z % 5 = 0 AS closed,
           d - to_days(z::INT) AS created_at, d AS end_date
    FROM (SELECT *, xor(t, 1 + k % 3) AS a, ({values(feeds.COMPETITION_CODES)})[(t // 4) % 8 + 1] AS c
          FROM (SELECT o.*, o_orderkey * {feeds.MARKETS} + j AS market_id, j, o_orderkey AS k, o_orderdate AS d, o_orderkey * 37 % 200 AS t,
                       (o_orderkey * 7 + j * 3) % 50 + 1 AS z
                FROM orders o, range({feeds.MARKETS}) n(j)))
    """,
)
table(
    "tokens",
    f"""
    SELECT market_id, market_id * 10 + j AS token_id,
           CASE WHEN j = 2 THEN 'Draw' WHEN market_id % 7 = 0 THEN CASE WHEN j = 0 THEN 'Over' ELSE 'Under' END
                WHEN j = 0 THEN 'Yes' ELSE 'No' END AS outcome
    FROM (SELECT market_id, unnest(range(CASE WHEN market_id % 50 = 0 THEN 3 ELSE 2 END)) AS j
          FROM (SELECT o_orderkey * {feeds.MARKETS} + m AS market_id FROM orders, range({feeds.MARKETS}) n(m)))
    """,
)
table(
    "trades",
    f"""
    SELECT l_orderkey * {feeds.MARKETS} + l_partkey % {feeds.MARKETS} AS market_id,
           (l_orderkey * {feeds.MARKETS} + l_partkey % {feeds.MARKETS}) * 10 + l_linenumber % 2 AS token_id, l_shipdate AS "timestamp",
           (l_quantity - 1) / 48 AS price, l_extendedprice AS size, CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS side,
           CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE '0x' || l_suppkey END AS taker_address
    FROM lineitem
    """,
)
table(
    "odds",
    f"""
    SELECT event_id, user_id * {feeds.MARKETS} AS market_id, user_id * {feeds.MARKETS} * 10 + event_id % 2 AS token_id,
           make_timestamp((floor(epoch(ts))::BIGINT) * 1000) AS "timestamp", (event_id % 1006)::DOUBLE / 1000 - 0.0025::DOUBLE AS price
    FROM events
    """,
)
table(
    "players",
    f"""
    SELECT c_custkey AS player_id, c_name AS player_name,
           ({values(feeds.PROFILE_NAMES)})[c_nationkey + 1] AS nationality,
           (['GK', 'CB', 'FB', 'CM', 'AM', 'FW'])[c_custkey % 11 % 6 + 1] AS primary_position,
           2022 + c_custkey % 5 AS year, 50 + c_custkey * 17 % 45 AS overall,
           CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 40 + c_custkey * 3 % 55 END AS pace,
           40 + c_custkey * 5 % 55 AS shooting, 40 + c_custkey * 7 % 55 AS passing_rating, 40 + c_custkey * 9 % 55 AS dribbling,
           40 + c_custkey * 11 % 55 AS defending, 40 + floor(abs(c_acctbal))::BIGINT % 55 AS physical,
           c_custkey % 15 = 0 AS was_world_cup_squad_member,
           CASE WHEN c_custkey % 15 = 0 THEN 2022 END AS world_cup_squad_tournament_year
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
table(
    "players_h",
    f"""SELECT *, CASE WHEN nationality = 'ATLANTIS' THEN nationality
        ELSE ({values(feeds.RESULT_NAMES)})[list_position({values(feeds.PROFILE_NAMES)}, nationality)] END AS intl_team FROM players""",
    "players",
)
table(
    "results",
    f"""
    SELECT k AS match_id, date,
           CASE WHEN h % 5 = 4 AND date <= DATE '2022-06-30' THEN 'OLD_' ELSE '' END || ({values(feeds.RESULT_NAMES)})[h + 1] AS home_team,
           CASE WHEN a % 5 = 4 AND date <= DATE '2022-06-30' THEN 'OLD_' ELSE '' END || ({values(feeds.RESULT_NAMES)})[a + 1] AS away_team,
           CASE WHEN s = 'P' AND k % 4 = 0 THEN NULL ELSE floor(p)::BIGINT % 5 END AS home_score,
           CASE WHEN s = 'P' AND k % 4 = 0 THEN NULL ELSE (k // 3) % 4 END AS away_score,
           ({values(feeds.TOURNAMENTS)})[substr(pr, 1, 1)::INT] AS tournament,
           'City ' || h AS city, ({values(feeds.RESULT_NAMES)})[h + 1] AS country, k % 3 = 0 AS neutral
    FROM (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p, o_orderpriority AS pr,
                 o_orderdate::DATE + 9131 AS date, o_orderkey * 7 % 25 AS h, (o_orderkey * 7 + 1 + o_orderkey % 24) % 25 AS a
          FROM orders)
    """,
)
table(
    "results_now",
    """SELECT * REPLACE (replace(home_team, 'OLD_', '') AS home_team, replace(away_team, 'OLD_', '') AS away_team) FROM results""",
    "results",
)
table(
    "rankings",
    f"""
    SELECT ({values(feeds.RESULT_NAMES)})[o_custkey % 25 + 1] AS team, 'CONF_' || (o_custkey % 25 % 5) AS confederation,
           date_trunc('month', o_orderdate::DATE + 9131)::DATE AS rank_date, (sum(floor(o_totalprice)::BIGINT) % 997)::DOUBLE AS points
    FROM orders GROUP BY ALL
    """,
)
table(
    "ranked",
    "SELECT *, rank() OVER (PARTITION BY rank_date ORDER BY points DESC) AS rank FROM rankings",
    "rankings",
)

# --- staged tables -------------------------------------------------------------------------------

_RESULT = "CASE WHEN home_score > away_score THEN 'home_win' WHEN home_score < away_score THEN 'away_win' ELSE 'draw' END"
table(
    "stg_matches",
    f"""
    SELECT match_id, match_date::DATE AS match_date, kick_off, competition_id, season_id, trim(home_team) AS home_team,
           trim(away_team) AS away_team, home_score, away_score, competition_name, season AS season_name,
           competition_name IN {in_list(INTERNATIONAL_COMPETITIONS)} AS is_international, home_team_gender AS gender,
           false AS is_youth, {_RESULT} AS match_result
    FROM raw_matches WHERE season >= '2000'
    """,
    "raw_matches",
)
table(
    "stg_events",
    r"""
    SELECT id AS event_id, match_id, period, minute, second, type AS event_type, trim(team) AS team, player,
           try_cast(nullif(regexp_extract(location, '\[(-?[\d.]+)', 1), '') AS DOUBLE) AS location_x,
           try_cast(nullif(regexp_extract(location, '\s+(-?[\d.]+)\]', 1), '') AS DOUBLE) AS location_y,
           play_pattern, CASE WHEN shot_statsbomb_xg <> 'nan' THEN try_cast(shot_statsbomb_xg AS DOUBLE) END AS shot_xg,
           nullif(pass_outcome, 'None') AS pass_outcome
    FROM raw_events WHERE player <> 'nan' AND match_id IN (SELECT match_id FROM stg_matches)
    """,
    "raw_events",
    "stg_matches",
)
table(
    "stg_lineups",
    """
    SELECT match_id, player_id, player_name, trim(team_name) AS team_name, jersey_number,
           coalesce(nullif(regexp_extract(p, '"position":"([^"]+)"', 1), ''), 'Unknown') AS position_name,
           nullif(regexp_extract(p, '"from":"([^"]+)"', 1), '') AS from_time,
           nullif(regexp_extract(p, '"to":"([^"]+)"', 1), '') AS to_time,
           nullif(regexp_extract(c, '"card_type":"([^"]+)"', 1), '') AS card_type
    FROM (SELECT *, to_json(positions)::VARCHAR AS p, to_json(cards)::VARCHAR AS c FROM raw_lineups)
    WHERE match_id IN (SELECT match_id FROM stg_matches)
    """,
    "raw_lineups",
    "stg_matches",
)

_KIND = {
    "shots": "event_type = 'Shot'",
    "goals": "event_type = 'Shot' AND pass_outcome IS NULL",
    "passes_attempted": "event_type = 'Pass'",
    "passes_completed": "event_type = 'Pass' AND pass_outcome IS NULL",
    "assists": "event_type = 'Pass' AND pass_outcome = 'Assist'",
    "pressures": "event_type = 'Pressure'",
    "tackles": "event_type = 'Tackle'",
    "interceptions": "event_type = 'Interception'",
    "carries": "event_type = 'Carry'",
    "duels": "event_type = 'Duel'",
    "aerial_duels": "event_type = 'Duel' AND play_pattern = 'Aerial'",
    "dribbles": "event_type = 'Dribble'",
    "clearances": "event_type = 'Clearance'",
    "carries_att_third": "event_type = 'Carry' AND location_x > 80",
    "passes_att_third": "event_type = 'Pass' AND location_x > 80",
    "blocks": "event_type = 'Block'",
    "ball_recoveries": "event_type = 'Ball Recovery'",
    "fouls": "event_type = 'Foul Committed'",
}
COUNTERS = tuple(_KIND)
table(
    "player_match_events",
    "SELECT match_id, player AS player_name, team AS team_name, "
    + ", ".join(f"count(*) FILTER ({test}) AS {name}" for name, test in _KIND.items())
    + ", sum(CASE WHEN event_type = 'Shot' THEN shot_xg ELSE 0 END) AS total_xg FROM stg_events GROUP BY ALL",
    "stg_events",
)


def _minutes(c: str) -> str:
    return f"try_cast(split_part({c}, ':', 1) AS DOUBLE) + try_cast(split_part({c}, ':', 2) AS DOUBLE) / 60"


table(
    "player_match_stats",
    f"""
    SELECT l.match_id, l.player_id, l.player_name, l.team_name, l.position_name,
           least(coalesce({_minutes('to_time')}, 90), 120) - coalesce({_minutes('from_time')}, 0) AS minutes_played,
           from_time IS NULL AND to_time IS NULL AS unused_bench,
           {", ".join(f"coalesce(e.{c}, 0) AS {c}" for c in (*COUNTERS, "total_xg"))},
           e.passes_completed::DOUBLE / nullif(e.passes_attempted, 0) AS pass_completion_pct
    FROM stg_lineups l LEFT JOIN player_match_events e ON l.match_id = e.match_id AND l.player_name = e.player_name
    """,
    "stg_lineups",
    "player_match_events",
)
table(
    "pm_meta",
    """SELECT p.*, m.competition_id, m.season_id, m.competition_name, m.season_name, m.is_international
       FROM player_match_stats p JOIN stg_matches m USING (match_id) WHERE m.gender = 'male'""",
    "player_match_stats",
    "stg_matches",
)
_TOTALS = "sum(minutes_played) AS total_minutes, sum(total_xg) AS total_xg, " + ", ".join(
    f"sum({c})::BIGINT AS total_{c}" for c in COUNTERS
)


def p90(c: str) -> str:
    return f"total_{c} / nullif(total_minutes, 0) * 90"


_RATES = (
    "dribbles", "carries_att_third", "clearances", "passes_att_third", "blocks", "ball_recoveries", "fouls", "duels",
    "shots", "goals", "assists", "pressures", "interceptions", "tackles", "aerial_duels", "carries", "xg",
)
_RATE_SQL = ", ".join(f"{p90(c)} AS {c}_per_90" for c in _RATES) + f", {p90('passes_attempted')} AS passes_per_90"
RATE_NAMES = tuple(f"{c}_per_90" for c in _RATES) + ("passes_per_90",)
table(
    "season_totals",
    f"""
    SELECT t.*, b.position_name FROM (
        SELECT player_id, competition_id, competition_name, season_id, season_name, min(player_name) AS player_name, {_TOTALS}
        FROM pm_meta GROUP BY 1, 2, 3, 4, 5 HAVING sum(minutes_played) >= 270) t
    JOIN (SELECT player_id, competition_id, season_id, position_name FROM pm_meta GROUP BY 1, 2, 3, 4
          QUALIFY row_number() OVER (PARTITION BY player_id, competition_id, season_id ORDER BY count(*) DESC, position_name) = 1) b
    USING (player_id, competition_id, season_id)
    """,
    "pm_meta",
)
table(
    "season",
    f"""SELECT *, total_passes_completed::DOUBLE / nullif(total_passes_attempted, 0) AS pass_completion_pct,
               coalesce(total_xg / nullif(total_shots, 0), 0.0) AS xg_per_shot, {_RATE_SQL} FROM season_totals""",
    "season_totals",
)
table(
    "contexts",
    f"""SELECT *, total_xg / nullif(total_shots, 0) AS xg_per_shot,
               total_passes_completed::DOUBLE / nullif(total_passes_attempted, 0) AS pass_completion_pct, {_RATE_SQL},
               {p90('passes_attempted')} AS passes_attempted_per_90, {p90('passes_completed')} AS passes_completed_per_90
        FROM (SELECT player_id, player_name, is_international, {_TOTALS}, count(DISTINCT match_id) AS matches_played
              FROM pm_meta GROUP BY 1, 2, 3 HAVING sum(minutes_played) >= 270)""",
    "pm_meta",
)
table(
    "club_national",
    "SELECT * FROM (SELECT *, "
    + ", ".join(
        f"({f} - avg({f}) OVER w) / nullif(stddev_samp({f}) OVER w, 0) AS z_{f}" for f in FEATURES
    )
    + """ FROM contexts WINDOW w AS (PARTITION BY is_international))
    WHERE player_id IN (SELECT player_id FROM contexts GROUP BY 1 HAVING count(DISTINCT is_international) = 2)""",
    "contexts",
)
table(
    "match_stats",
    """
    SELECT a.match_id, m.match_date, m.competition_id, m.competition_name, m.season_id, m.season_name, m.home_team, m.away_team,
           m.match_result, a.team, CASE WHEN a.team = m.home_team THEN 'home' ELSE 'away' END AS side, total_shots, total_xg,
           passes_attempted, passes_completed, passes_completed::DOUBLE / nullif(passes_attempted, 0) AS pass_completion_pct,
           total_pressures, total_carries,
           passes_attempted::DOUBLE / nullif(sum(passes_attempted) OVER (PARTITION BY a.match_id), 0) AS possession_share
    FROM (SELECT match_id, team, count(*) FILTER (event_type = 'Shot') AS total_shots,
                 sum(CASE WHEN event_type = 'Shot' THEN shot_xg ELSE 0 END) AS total_xg,
                 count(*) FILTER (event_type = 'Pass') AS passes_attempted,
                 count(*) FILTER (event_type = 'Pass' AND pass_outcome IS NULL) AS passes_completed,
                 count(*) FILTER (event_type = 'Pressure') AS total_pressures,
                 count(*) FILTER (event_type = 'Carry') AS total_carries
          FROM stg_events GROUP BY 1, 2) a
    JOIN stg_matches m USING (match_id) WHERE m.gender = 'male'
    """,
    "stg_events",
    "stg_matches",
)
POINTS = """CASE WHEN side || '_win' = match_result THEN 3 WHEN match_result = 'draw' THEN 1 ELSE 0 END"""
table(
    "team_season",
    f"""
    SELECT team, competition_id, competition_name, season_id, season_name, count(*) AS matches_played,
           count(*) FILTER (pts = 3) AS wins, count(*) FILTER (pts = 1) AS draws, count(*) FILTER (pts = 0) AS losses,
           sum(pts)::BIGINT AS total_points, sum(total_xg) AS total_xg, avg(total_xg) AS avg_xg_per_match,
           avg(possession_share) AS avg_possession_share, sum(total_pressures)::BIGINT AS total_pressures,
           avg(total_pressures) AS avg_pressures_per_match
    FROM (SELECT *, {POINTS} AS pts FROM match_stats) GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 10
    """,
    "match_stats",
)
_FORM = {
    "rolling_avg_xg": "total_xg",
    "rolling_avg_points": "pts",
    "rolling_avg_possession_pct": "possession_share",
    "rolling_avg_pressures": "total_pressures",
    "rolling_avg_pass_completion_pct": "pass_completion_pct",
}
table(
    "form",
    "SELECT match_id, match_date, team, side, competition_id, season_id, "
    + ", ".join(f"avg({c}) OVER w AS {n}" for n, c in _FORM.items())
    + f""" FROM (SELECT *, {POINTS} AS pts FROM match_stats)
    WINDOW w AS (PARTITION BY team ORDER BY match_date, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
    "match_stats",
)
table(
    "h2h",
    """
    SELECT m.match_id, count(p.match_id) AS h2h_total_matches,
           count(*) FILTER ((p.home_team = m.home_team AND p.match_result = 'home_win')
                         OR (p.away_team = m.home_team AND p.match_result = 'away_win')) AS h2h_home_wins
    FROM stg_matches m LEFT JOIN stg_matches p
      ON least(p.home_team, p.away_team) = least(m.home_team, m.away_team)
     AND greatest(p.home_team, p.away_team) = greatest(m.home_team, m.away_team) AND p.match_date < m.match_date
    GROUP BY 1
    """,
    "stg_matches",
)

# --- model outputs given by rule, so that the tables built on them can be checked -----------------

LOADINGS = [
    (f"PC{i + 1}", feature, ((i * 7 + j * 5) % 11 - 5) / 10.0) for i in range(3) for j, feature in enumerate(FEATURES)
]
table(
    "loadings",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', '{f}', {v}::DOUBLE)" for c, f, v in LOADINGS)
    + ") AS t(component, feature, loading)",
)
table(
    "assignments",
    f"""SELECT player_id, competition_id, season_id,
               CASE WHEN position_name = 'Goalkeeper' THEN -1 ELSE (player_id + competition_id * 3 + season_id) % 5 END AS cluster,
               CASE WHEN position_name = 'Goalkeeper' THEN 'Goalkeeper'
                    ELSE ({values(ARCHETYPES)})[(player_id + competition_id * 3 + season_id) % 5 + 1] END AS archetype
        FROM season""",
    "season",
)
table("weights", "SELECT feature, sum(abs(loading)) / (SELECT sum(abs(loading)) FROM loadings) AS weight FROM loadings GROUP BY 1", "loadings")


def dot(prefix: str, alias: str = "") -> str:
    """Σ z·w over the 13 features with the weights as literals."""
    total = sum(abs(v) for _, _, v in LOADINGS)
    terms = []
    for f in FEATURES:
        w = sum(abs(v) for _, feature, v in LOADINGS if feature == f) / total
        terms.append(f"coalesce({alias}{prefix}{f}, 0) * {w!r}::DOUBLE")
    return " + ".join(terms)


table(
    "eligible",
    """SELECT * FROM club_national QUALIFY row_number() OVER (
           PARTITION BY player_id, is_international ORDER BY total_minutes DESC, player_name) = 1""",
    "club_national",
)
_GAP = " + ".join(f"abs(coalesce(c.z_{f}, 0) - coalesce(n.z_{f}, 0))" for f in FEATURES)
table(
    "scored",
    f"""
    SELECT c.player_id, c.player_name, {dot('z_', 'c.')} AS club_performance_score, {dot('z_', 'n.')} AS national_performance_score,
           1 - ({_GAP}) / 13 AS consistency_score, c.total_minutes AS club_minutes, n.total_minutes AS national_minutes
    FROM eligible c JOIN eligible n ON c.player_id = n.player_id AND NOT c.is_international AND n.is_international
    """,
    "eligible",
)
table(
    "scores",
    """
    SELECT *, CASE WHEN hc AND hn THEN 'Elite' WHEN hc THEN 'Club Specialist' WHEN hn THEN 'International Specialist'
                   ELSE 'Underperformer' END AS performance_quadrant
    FROM (SELECT *, club_performance_score >= (SELECT median(club_performance_score) FROM scored) AS hc,
                 national_performance_score >= (SELECT median(national_performance_score) FROM scored) AS hn FROM scored)
    """,
    "scored",
)
table(
    "gaps",
    "SELECT s.player_id, s.player_name, s.performance_quadrant, s.national_performance_score - s.club_performance_score AS performance_gap, "
    + ", ".join(f"coalesce(n.z_{f}, 0) - coalesce(c.z_{f}, 0) AS delta_{f}" for f in FEATURES)
    + """ FROM scores s JOIN eligible c ON c.player_id = s.player_id AND NOT c.is_international
    JOIN eligible n ON n.player_id = s.player_id AND n.is_international""",
    "scores",
    "eligible",
)
POSITION_CASE = case_map("position_name", POSITION_GROUPS)
LEAGUE_CASE = case_map("competition_name", COMPETITION_LABELS)
BROAD_CASE = f"coalesce({case_map('position_name', BROAD_POSITIONS)}, 'Unknown')"
