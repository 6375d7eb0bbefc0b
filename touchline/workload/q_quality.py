"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import quality
from touchline.operators.reshape import union_checks
from touchline.plans import exploration, players
from touchline.sources.readers import read_table
from touchline.workload import base, feeds
from touchline.workload.registry import query
from touchline.workload.tables_sql import with_tables


@query(
    "key_checks",
    ["M1", "M4", "M5"],
    with_tables(
        """SELECT 'match_id unique' AS "check", count(*) AS failures FROM (SELECT match_id FROM stg_matches GROUP BY 1 HAVING count(*) > 1)
           UNION ALL SELECT 'event_id unique', count(*) FROM (SELECT event_id FROM stg_events GROUP BY 1 HAVING count(*) > 1)
           UNION ALL SELECT 'order and line unique', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
           UNION ALL SELECT 'events in matches', count(*) FROM raw_events WHERE match_id NOT IN (SELECT match_id FROM stg_matches)
           UNION ALL SELECT 'lines in orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
        "stg_matches", "stg_events", "raw_events",
    ),
)
def key_checks(spark, d):
    run = base.Run(spark, d)
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return union_checks(
        [
            quality.unique(run.stg_matches, ["match_id"], "match_id unique"),
            quality.unique(run.stg_events, ["event_id"], "event_id unique"),
            quality.unique(lines, ["l_orderkey", "l_linenumber"], "order and line unique"),
            quality.relationship(run.raw_events, "match_id", run.stg_matches, "match_id", "events in matches"),
            quality.relationship(lines, "l_orderkey", read_table(spark, d, "orders"), "o_orderkey", "lines in orders"),
        ]
    )


_NOT_NULL = ("player", "location_x", "shot_xg", "pass_outcome")


@query(
    "null_checks",
    ["M2"],
    with_tables(
        " UNION ALL ".join(f"SELECT 'events.{c} not null' AS \"check\", count(*) FILTER ({c} IS NULL) AS failures FROM stg_events" for c in _NOT_NULL),
        "stg_events",
    ),
)
def null_checks(spark, d):
    return quality.not_null(base.Run(spark, d).stg_events, _NOT_NULL, "events")


@query(
    "value_checks",
    ["M3", "M6"],
    with_tables(
        """SELECT 'known result' AS "check", count(*) FILTER (match_result NOT IN ('home_win', 'draw')) AS failures FROM stg_matches
           UNION ALL SELECT 'score range', count(*) FILTER (home_score < 1 OR home_score > 3) FROM stg_matches
           UNION ALL SELECT 'price range', count(*) FILTER (price < 0 OR price > 1) FROM odds""",
        "stg_matches", "odds",
    ),
)
def value_checks(spark, d):
    matches = base.Run(spark, d).stg_matches
    return union_checks(
        [
            quality.accepted(matches, "match_result", ["home_win", "draw"], "known result"),
            quality.in_range(matches, "home_score", 1, 3, "score range"),
            quality.in_range(feeds.odds(spark, d), "price", 0.0, 1.0, "price range"),
        ]
    )


@query(
    "broken_rows",
    ["M7"],
    with_tables("SELECT event_id, price FROM odds WHERE NOT price BETWEEN 0 AND 1", "odds"),
    doubles=["price"],
)
def broken_rows(spark, d):
    return quality.assert_rows(feeds.odds(spark, d), F.col("price").between(0, 1)).select("event_id", "price")


@query(
    "quality_report",
    ["M8", "F3", "C4"],
    with_tables(
        """SELECT 'events: match_id NULL' AS "check", count(*) FILTER (match_id IS NULL) AS failures FROM stg_events
           UNION ALL SELECT 'shots with NULL xg', count(*) FILTER (event_type = 'Shot' AND shot_xg IS NULL) FROM stg_events
           UNION ALL SELECT 'lineups: match_id NULL', count(*) FILTER (match_id IS NULL) FROM stg_lineups
           UNION ALL SELECT 'lineups NULL from_time', count(*) FILTER (from_time IS NULL) FROM stg_lineups
           UNION ALL SELECT 'lineups NULL to_time', count(*) FILTER (to_time IS NULL) FROM stg_lineups
           UNION ALL SELECT 'lineups NULL player_name', count(*) FILTER (player_name IS NULL) FROM stg_lineups
           UNION ALL SELECT 'lineups NULL position_name', count(*) FILTER (position_name IS NULL) FROM stg_lineups
           UNION ALL SELECT 'matches NULL home_score', count(*) FILTER (home_score IS NULL) FROM stg_matches
           UNION ALL SELECT 'matches NULL away_score', count(*) FILTER (away_score IS NULL) FROM stg_matches
           UNION ALL SELECT 'events orphan match_id', count(*) FROM stg_events WHERE match_id NOT IN (SELECT match_id FROM stg_matches WHERE gender = 'male')
           UNION ALL SELECT 'lineups orphan match_id', count(*) FROM stg_lineups WHERE match_id NOT IN (SELECT match_id FROM stg_matches WHERE gender = 'male')""",
        "stg_events", "stg_lineups", "stg_matches",
    ),
)
def quality_report(spark, d):
    run = base.Run(spark, d)
    men = run.stg_matches.filter("gender = 'male'")
    report = exploration.quality_report(men, run.stg_events, run.stg_lineups)
    return report


@query(
    "duplicate_contexts",
    ["M9", "M10"],
    with_tables(
        """SELECT 'player and context unique' AS "check", count(*) AS failures
           FROM (SELECT player_id, is_international FROM contexts GROUP BY 1, 2 HAVING count(*) > 1)""",
        "contexts",
    ),
)
def duplicate_contexts(spark, d):
    table = quality.require_columns(base.Run(spark, d).contexts, list(players.FEATURES))
    return quality.unique(table, ["player_id", "is_international"], "player and context unique")


@query(
    "context_totals_agree",
    ["M11"],
    with_tables(
        """SELECT is_international, a_shots, b_shots, a_shots - b_shots AS diff_shots FROM
           (SELECT m.is_international, count(*) FILTER (event_type = 'Shot') AS a_shots FROM stg_events JOIN stg_matches m USING (match_id) WHERE gender = 'male' GROUP BY 1)
           FULL JOIN (SELECT is_international, sum(total_shots)::BIGINT AS b_shots FROM contexts GROUP BY 1) USING (is_international)""",
        "stg_events", "stg_matches", "contexts",
    ),
)
def context_totals_agree(spark, d):
    run = base.Run(spark, d)
    direct = players.player_context_events(run.stg_events, run.stg_matches).select(
        (F.col("context") == "National").alias("is_international"), "shots"
    )
    built = run.contexts.select("is_international", F.col("total_shots").alias("shots"))
    return quality.compare_totals(direct, built, ["is_international"], ["shots"])


@query(
    "lineup_fan_out",
    ["M12"],
    with_tables(
        "SELECT (SELECT count(*) FROM stg_lineups) AS rows_before, (SELECT count(*) FROM player_match_stats) AS rows_after, (SELECT count(*) FROM player_match_stats) - (SELECT count(*) FROM stg_lineups) AS extra_rows",
        "stg_lineups", "player_match_stats",
    ),
)
def lineup_fan_out(spark, d):
    run = base.Run(spark, d)
    return quality.fan_out(run.stg_lineups, run.player_match)


@query(
    "event_freshness",
    ["L7"],
    """SELECT max(ts)::DATE AS newest, date_diff('day', max(ts)::DATE, DATE '2024-02-10') AS age_days,
              CASE WHEN date_diff('day', max(ts)::DATE, DATE '2024-02-10') > 30 THEN 'error'
                   WHEN date_diff('day', max(ts)::DATE, DATE '2024-02-10') > 7 THEN 'warn' ELSE 'pass' END AS status FROM events""",
    texts=["newest"],
)
def event_freshness(spark, d):
    return quality.freshness(read_table(spark, d, "events"), "ts", F.lit("2024-02-10").cast("date"))


