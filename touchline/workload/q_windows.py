"""Joins, ordered windows, ranking and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.constants import FEATURES
from touchline.functions import labels
from touchline.operators import joins, reshape, standardize, windows
from touchline.plans import consistency, exploration, teams
from touchline.session import materialize
from touchline.sources.readers import read_table
from touchline.workload import base, feeds
from touchline.workload.registry import query
from touchline.workload.tables_sql import with_tables

# --- joins ----------------------------------------------------------------------------------------


@query(
    "orphan_rows",
    ["C4"],
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def orphan_rows(spark, d):
    customers = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    filled = read_table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.orphans(customers, filled, ["c_custkey"])


@query(
    "known_rows",
    ["C3"],
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1",
)
def known_rows(spark, d):
    urgent = read_table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    return joins.known_only(lines, urgent, ["l_orderkey"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "lines_per_order",
    ["C2"],
    """SELECT o_orderkey, coalesce(lines, 0) AS lines, coalesce(returned, 0) AS returned FROM orders LEFT JOIN (
           SELECT l_orderkey, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def lines_per_order(spark, d):
    lines = read_table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned")
    )
    return joins.left_join_filled(read_table(spark, d, "orders").select("o_orderkey"), lines, ["o_orderkey"], ["lines", "returned"])


@query(
    "supplier_share_of_order",
    ["D4"],
    """SELECT l_orderkey, l_suppkey, n, n::DOUBLE / sum(n) OVER (PARTITION BY l_orderkey) AS share
       FROM (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
    doubles=["share"],
)
def supplier_share_of_order(spark, d):
    from touchline.operators.aggregates import count_by, share_of_group

    counts = count_by(read_table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"])
    return share_of_group(counts, ["l_orderkey"], "n", "share")


@query(
    "sides_by_nation",
    ["C6"],
    """SELECT h.n_name AS home_name, a.n_name AS away_name, h.n_regionkey = a.n_regionkey AS same_region, count(*) AS n
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
       JOIN nation h ON h.n_nationkey = c_nationkey JOIN nation a ON a.n_nationkey = s_nationkey GROUP BY 1, 2, 3""",
)
def sides_by_nation(spark, d):
    lines = read_table(spark, d, "lineitem").selectExpr("l_orderkey AS o_orderkey", "l_suppkey AS s_suppkey")
    orders = read_table(spark, d, "orders").selectExpr("o_orderkey", "o_custkey AS c_custkey")
    home = read_table(spark, d, "customer").selectExpr("c_custkey", "c_nationkey AS home")
    away = read_table(spark, d, "supplier").selectExpr("s_suppkey", "s_nationkey AS away")
    pairs = lines.join(orders, on="o_orderkey").join(home, on="c_custkey").join(away, on="s_suppkey")
    # pairs are counted before names are attached
    counts = pairs.groupBy("home", "away").agg(F.count(F.lit(1)).alias("n"))
    named = joins.attach_sides(
        counts, read_table(spark, d, "nation"), "n_nationkey", {"n_name": "name", "n_regionkey": "region"}, "home", "away", how="inner"
    )
    return named.select("home_name", "away_name", (F.col("home_region") == F.col("away_region")).alias("same_region"), "n")


@query(
    "checked_one_to_one",
    ["C8"],
    with_tables(
        """SELECT c.player_id, c.total_minutes AS club_minutes, n.total_minutes AS nat_minutes
           FROM eligible c JOIN eligible n ON n.player_id = c.player_id AND n.is_international AND NOT c.is_international""",
        "eligible",
    ),
    doubles=["club_minutes", "nat_minutes"],
)
def checked_one_to_one(spark, d):
    rows = materialize(consistency.eligible(base.Run(spark, d).club_national), "eligible")
    club = rows.filter(~F.col("is_international")).select("player_id", F.col("total_minutes").alias("club_minutes"))
    national = rows.filter("is_international").select("player_id", F.col("total_minutes").alias("nat_minutes"))
    return joins.one_to_one(club, national, ["player_id"])


@query(
    "three_key_join",
    ["C7"],
    with_tables(
        """SELECT s.player_id, s.competition_id, s.season_id, s.total_minutes, a.archetype FROM season s
           LEFT JOIN (SELECT * FROM assignments WHERE cluster > 0) a USING (player_id, competition_id, season_id)""",
        "season", "assignments",
    ),
    doubles=["total_minutes"],
    longs=["competition_id", "season_id"],
)
def three_key_join(spark, d):
    keys = ["player_id", "competition_id", "season_id"]
    run = base.Run(spark, d, "season")
    named = run.assignments.filter("cluster > 0").select(*keys, "archetype")
    return run.season.select(*keys, "total_minutes").join(named, on=keys, how="left")


_ASOF = """SELECT p.event_id, p.user_id, p.ts, c.ts AS click_ts, c.value AS click_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'click' GROUP BY 1, 2) c
    ON c.user_id = p.user_id AND c.ts <= p.ts"""


def _last_click(spark, d, slices=None):
    log = read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    bought = log.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = log.filter("event_type = 'click'").select(
        "user_id", F.col("ts").alias("click_ts"), F.col("value").alias("click_value")
    )
    found = windows.as_of_join(bought, clicks, ["user_id"], "ts", "click_ts", ["click_value"], slices)
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("ts", "click_ts")})


def _asof_text(sql: str) -> str:
    f = "'%Y-%m-%d %H:%M:%S.%f'"
    return f"SELECT event_id, user_id, strftime(ts, {f}) AS ts, strftime(click_ts, {f}) AS click_ts, click_value FROM ({sql})"


@query("last_click_before_purchase", ["C9"], _asof_text(_ASOF), doubles=["click_value"])
def last_click_before_purchase(spark, d):
    return _last_click(spark, d)


@query("last_click_before_purchase_sliced", ["C9"], _asof_text(_ASOF), doubles=["click_value"])
def last_click_before_purchase_sliced(spark, d):
    """Same result with more slices than users."""
    return _last_click(spark, d, 400)


# --- ordered windows --------------------------------------------------------------------------------

_FORM_DOUBLES = list(teams.FORM)


@query("team_rolling_form", ["E1", "E2"], with_tables("SELECT * FROM form", "form"), doubles=_FORM_DOUBLES,
       longs=["competition_id", "season_id"], texts=["match_date"])
def team_rolling_form(spark, d):
    return base.Run(spark, d).form


_SPEND = """SELECT o_orderkey, o_custkey, avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
    ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS prior_mean FROM orders"""


def _spend(spark, d, slices=None):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    rolled = windows.rolling_means(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"prior_mean": "o_totalprice"}, 5, slices)
    return rolled.select("o_orderkey", "o_custkey", "prior_mean")


@query("rolling_spend", ["E1"], _SPEND, doubles=["prior_mean"], digits=3)
def rolling_spend(spark, d):
    return _spend(spark, d)


@query("rolling_spend_sliced", ["E1"], _SPEND, doubles=["prior_mean"], digits=3)
def rolling_spend_sliced(spark, d):
    """Same result in slices so short that customers span them."""
    return _spend(spark, d, 500)


_PRIORITY = """SELECT o_orderkey, o_orderpriority, avg(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
    ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS prior_mean FROM orders"""


@query("rolling_spend_hot_groups", ["E1"], _PRIORITY, doubles=["prior_mean"], digits=3)
def rolling_spend_hot_groups(spark, d):
    """Five groups hold all rows and span the slices."""
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    rolled = windows.rolling_means(orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], {"prior_mean": "o_totalprice"}, 5, 40)
    return rolled.select("o_orderkey", "o_orderpriority", "prior_mean")


@query(
    "latest_form",
    ["E4"],
    with_tables(
        """SELECT team, competition_id, season_id, rolling_avg_xg, rolling_avg_points, rolling_avg_possession_pct, rolling_avg_pressures,
                  rolling_avg_pass_completion_pct FROM form
           QUALIFY row_number() OVER (PARTITION BY team, competition_id, season_id ORDER BY match_date DESC, match_id DESC) = 1""",
        "form",
    ),
    doubles=_FORM_DOUBLES,
    longs=["competition_id", "season_id"],
)
def latest_form(spark, d):
    return teams.latest_form(base.Run(spark, d).form)


@query(
    "longest_season",
    ["E5", "E16"],
    with_tables(
        """SELECT player_id, competition_id, season_id, total_minutes FROM season
           QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY total_minutes DESC, competition_id, season_id) = 1""",
        "season",
    ),
    doubles=["total_minutes"],
    longs=["competition_id", "season_id"],
)
def longest_season(spark, d):
    order = [F.desc("total_minutes"), F.asc("competition_id"), F.asc("season_id")]
    return windows.top_n(base.Run(spark, d).season, ["player_id"], order).select("player_id", "competition_id", "season_id", "total_minutes")


_H2H = "SELECT match_id, h2h_total_matches, h2h_home_wins, h2h_home_wins::DOUBLE / nullif(h2h_total_matches, 0) AS h2h_home_win_pct FROM h2h"


@query("head_to_head", ["E6", "C5"], with_tables(_H2H, "h2h"), doubles=["h2h_home_win_pct"])
def head_to_head(spark, d):
    return windows.prior_meetings(base.Run(spark, d).stg_matches, "match_id", "match_date", "home_team", "away_team", "match_result")


@query(
    "feature_zscores",
    ["E7", "F7"],
    with_tables(
        f"""SELECT player_id, competition_id, season_id, feature,
                   (value - avg(value) OVER (PARTITION BY feature)) / nullif(stddev_samp(value) OVER (PARTITION BY feature), 0) AS z_value
            FROM (UNPIVOT (SELECT player_id, competition_id, season_id, {", ".join(FEATURES)} FROM season)
                  ON {", ".join(FEATURES)} INTO NAME feature VALUE value)""",
        "season",
    ),
    doubles=["z_value"],
    longs=["competition_id", "season_id"],
)
def feature_zscores(spark, d):
    keys = ["player_id", "competition_id", "season_id"]
    long = reshape.unpivot_present(base.Run(spark, d).season, keys, FEATURES)
    return standardize.zscores_long(long, FEATURES).drop("value")


@query(
    "usual_event_type",
    ["D7", "E9", "E10"],
    """SELECT user_id, event_type, weight FROM (SELECT user_id, event_type, count(*) AS weight FROM events GROUP BY 1, 2)
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, event_type) = 1""",
)
def usual_event_type(spark, d):
    return windows.dominant(read_table(spark, d, "events"), ["user_id"], "event_type")


@query(
    "top_orders_per_priority",
    ["E10"],
    """SELECT o_orderpriority, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS place
       FROM orders QUALIFY place <= 10""",
    doubles=["o_totalprice"],
)
def top_orders_per_priority(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return windows.top_n(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 10, rank="place")


@query(
    "biggest_movers",
    ["E11"],
    with_tables(
        """WITH w AS (SELECT c.player_id, n.xg_per_90 - c.xg_per_90 AS delta_xg_per_90
                      FROM eligible c JOIN eligible n ON n.player_id = c.player_id AND n.is_international AND NOT c.is_international)
           SELECT * FROM (SELECT * FROM w ORDER BY round(delta_xg_per_90, 9) DESC, player_id LIMIT 12)
           UNION SELECT * FROM (SELECT * FROM w ORDER BY round(delta_xg_per_90, 9), player_id LIMIT 12)""",
        "eligible",
    ),
    doubles=["delta_xg_per_90"],
)
def biggest_movers(spark, d):
    rows = consistency.eligible(base.Run(spark, d).club_national)
    wide = reshape.two_context_wide(rows, ["player_id"], "is_international", ["xg_per_90"])
    return windows.both_ends(wide, "delta_xg_per_90", 12, "player_id").select("player_id", "delta_xg_per_90")


_RANKS = "SELECT user_id, event_id, value, rank() OVER (PARTITION BY user_id ORDER BY value DESC) AS rank FROM events"


@query("value_ranks", ["E12"], _RANKS, doubles=["value"])
def value_ranks(spark, d):
    return windows.rank_by(read_table(spark, d, "events").select("user_id", "event_id", "value"), ["user_id"], "value")


@query(
    "value_ranks_sliced",
    ["E12"],
    "SELECT event_type, event_id, value, rank() OVER (PARTITION BY event_type ORDER BY value DESC) AS rank FROM events",
    doubles=["value"],
)
def value_ranks_sliced(spark, d):
    """Five groups hold all rows; the running count is cut into slices."""
    return windows.rank_by(read_table(spark, d, "events").select("event_type", "event_id", "value"), ["event_type"], "value", slices=60)


@query(
    "top_balance_mean",
    ["E13", "O2"],
    """SELECT c_nationkey, avg(c_acctbal) AS top11_c_acctbal FROM (
           SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 11) GROUP BY 1""",
    doubles=["top11_c_acctbal"],
    longs=["c_nationkey"],
)
def top_balance_mean(spark, d):
    return windows.top_mean(read_table(spark, d, "customer"), ["c_nationkey"], ["c_acctbal"], 11, "top11_")


@query(
    "ranked_leagues",
    ["E14", "F1"],
    with_tables(
        "SELECT competition_name, n, row_number() OVER (ORDER BY n DESC, competition_name) AS rank FROM (SELECT competition_name, count(*) AS n FROM stg_matches GROUP BY 1)",
        "stg_matches",
    ),
)
def ranked_leagues(spark, d):
    counts = base.Run(spark, d).stg_matches.groupBy("competition_name").agg(F.count(F.lit(1)).alias("n"))
    return windows.with_rank(counts, [F.desc("n"), F.asc("competition_name")]).orderBy("rank")


def intl_form_sql() -> str:
    side = """SELECT match_id, date, {t}_team AS team, {t}_score AS gf, {o}_score AS ga, ({t}_score > {o}_score)::INT AS won
              FROM results_now WHERE home_score IS NOT NULL AND away_score IS NOT NULL"""
    f = "avg({c}) OVER (PARTITION BY team ORDER BY date, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"
    return f"""WITH long AS ({side.format(t='home', o='away')} UNION ALL {side.format(t='away', o='home')}),
        f AS (SELECT match_id, team, {f.format(c='gf')} AS roll_gf, {f.format(c='ga')} AS roll_ga, {f.format(c='won')} AS roll_win_rate FROM long)
        SELECT m.match_id, h.roll_gf AS home_roll_gf, h.roll_ga AS home_roll_ga, h.roll_win_rate AS home_roll_win_rate,
               a.roll_gf AS away_roll_gf, a.roll_ga AS away_roll_ga, a.roll_win_rate AS away_roll_win_rate,
               h.roll_gf - a.roll_gf AS roll_gf_diff, h.roll_ga - a.roll_ga AS roll_ga_diff
        FROM results_now m LEFT JOIN f h ON h.match_id = m.match_id AND h.team = m.home_team
        LEFT JOIN f a ON a.match_id = m.match_id AND a.team = m.away_team"""


_INTL = [f"{s}_roll_{m}" for s in ("home", "away") for m in ("gf", "ga", "win_rate")] + ["roll_gf_diff", "roll_ga_diff"]


@query("international_form", ["E15"], with_tables(intl_form_sql(), "results_now"), doubles=_INTL)
def international_form(spark, d):
    return teams.international_form(base.Run(spark, d).results_now, slices=30).select("match_id", *_INTL)


@query(
    "international_head_to_head",
    ["E15", "E6"],
    with_tables(
        """SELECT m.match_id, count(p.match_id) AS h2h_prior_meetings FROM results_now m LEFT JOIN results_now p
             ON least(p.home_team, p.away_team) = least(m.home_team, m.away_team)
            AND greatest(p.home_team, p.away_team) = greatest(m.home_team, m.away_team) AND p.date < m.date GROUP BY 1""",
        "results_now",
    ),
)
def international_head_to_head(spark, d):
    rows = base.Run(spark, d).results_now.withColumn("result", labels.match_result("home_score", "away_score"))
    met = windows.prior_meetings(rows, "match_id", "date", "home_team", "away_team", "result")
    return met.select("match_id", F.col("h2h_total_matches").alias("h2h_prior_meetings"))


# --- sort, sets and reshaping -----------------------------------------------------------------------


@query(
    "table_sizes",
    ["F3"],
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("orders", "lineitem", "events", "customer")),
)
def table_sizes(spark, d):
    return exploration.table_sizes({t: read_table(spark, d, t) for t in ("orders", "lineitem", "events", "customer")})


@query(
    "users_in_both",
    ["F4"],
    "SELECT user_id, ts::DATE::VARCHAR AS day FROM events WHERE event_type = 'signup' INTERSECT SELECT user_id, ts::DATE::VARCHAR AS day FROM events WHERE event_type = 'error'",
)
def users_in_both(spark, d):
    log = read_table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return reshape.in_both(log.filter("event_type = 'signup'"), log.filter("event_type = 'error'"), ["user_id", "day"])


@query(
    "users_in_one",
    ["F5", "F6"],
    "SELECT user_id, ts::DATE::VARCHAR AS day FROM events WHERE event_type = 'signup' EXCEPT SELECT user_id, ts::DATE::VARCHAR AS day FROM events WHERE event_type = 'error'",
)
def users_in_one(spark, d):
    log = read_table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return reshape.only_left(log.filter("event_type = 'signup'"), log.filter("event_type = 'error'"), ["user_id", "day"])


@query(
    "distinct_pairs",
    ["F6"],
    "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
)
def distinct_pairs(spark, d):
    return read_table(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query(
    "loadings_both_ways",
    ["F8", "G7"],
    with_tables(
        """SELECT u.player_id, l.component, l.feature, l.loading * u.minutes AS weighted
           FROM loadings l, (SELECT player_id, sum(total_minutes) AS minutes FROM season GROUP BY 1) u""",
        "loadings", "season",
    ),
    doubles=["weighted"],
    digits=3,
)
def loadings_both_ways(spark, d):
    """Long loadings to one row per component and back, scaled per player."""
    wide = reshape.pivot_known(base.loadings(spark), ["component"], "feature", "loading", FEATURES)
    long = reshape.unpivot_present(wide, ["component"], FEATURES, "feature", "loading")
    table = long.agg(F.collect_list(F.struct("component", "feature", "loading"))).scalar()
    minutes = base.Run(spark, d).season.groupBy("player_id").agg(F.sum("total_minutes").alias("minutes"))
    return minutes.select("player_id", "minutes", F.inline(table)).select(
        "player_id", "component", "feature", (F.col("loading") * F.col("minutes")).alias("weighted")
    )


_WIDE = ("xg_per_90", "passes_per_90", "pass_completion_pct")


@query(
    "context_wide",
    ["F9", "H18"],
    with_tables(
        f"""SELECT c.player_id, {", ".join(f"c.{m} AS club_{m}, n.{m} AS nat_{m}, n.{m} - c.{m} AS delta_{m}" for m in _WIDE)}
            FROM eligible c JOIN eligible n ON n.player_id = c.player_id AND n.is_international AND NOT c.is_international""",
        "eligible",
    ),
    doubles=[f"{p}_{m}" for p in ("club", "nat", "delta") for m in _WIDE],
)
def context_wide(spark, d):
    return reshape.two_context_wide(consistency.eligible(base.Run(spark, d).club_national), ["player_id"], "is_international", _WIDE)


@query(
    "long_results",
    ["F10"],
    with_tables(
        """SELECT match_id, home_team AS team, away_team AS opponent, true AS is_home, home_score AS goals_for, away_score AS goals_against,
                  (home_score > away_score)::BIGINT AS won, year(date)::BIGINT AS match_year FROM results
           UNION ALL SELECT match_id, away_team, home_team, false, away_score, home_score, (away_score > home_score)::BIGINT, year(date)::BIGINT FROM results""",
        "results",
    ),
)
def long_results(spark, d):
    return teams.long_results(feeds.results(spark, d)).select(
        "match_id", "team", "opponent", "is_home", "goals_for", "goals_against", "won", "match_year"
    )


@query(
    "metric_long_table",
    ["F11"],
    with_tables(
        " UNION ALL ".join(
            f"SELECT player_id, '{m}' AS metric, CASE WHEN is_international THEN 'National' ELSE 'Club' END AS context, {m}::DOUBLE AS value FROM eligible"
            for m in _WIDE
        ),
        "eligible",
    ),
    doubles=["value"],
)
def metric_long_table(spark, d):
    wide = reshape.two_context_wide(consistency.eligible(base.Run(spark, d).club_national), ["player_id"], "is_international", _WIDE)
    return reshape.metric_long(wide, "player_id", _WIDE, {"club_": "Club", "nat_": "National"})


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_CELLS = ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS \"n_{p}\"" for p in _PRIORITIES)
_CROSS = f"SELECT c_mktsegment, {_CELLS}, count(*) AS total FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1"


def _segments(spark, d):
    orders = read_table(spark, d, "orders").selectExpr("o_custkey AS c_custkey", "o_orderpriority")
    return orders.join(read_table(spark, d, "customer").select("c_custkey", "c_mktsegment"), on="c_custkey")


@query("segment_by_priority", ["F12"], _CROSS)
def segment_by_priority(spark, d):
    return reshape.crosstab(_segments(spark, d), "c_mktsegment", "o_orderpriority", _PRIORITIES)


_NAMES = [f"n_{p}" for p in _PRIORITIES]
_PCT = ", ".join(f'round(100.0::DOUBLE * "{n}" / total, 1) AS "{n}"' for n in _NAMES)
_BEST = "greatest(" + ", ".join(f'"{n}"' for n in _NAMES) + ")"
_WHICH = " ".join(f"WHEN \"{n}\" = {_BEST} THEN '{n}'" for n in _NAMES)


@query(
    "segment_row_pct",
    ["F13"],
    f"SELECT *, CASE {_WHICH} END AS dominant, {_BEST} AS dominant_pct FROM (SELECT c_mktsegment, {_PCT} FROM ({_CROSS}))",
    doubles=[f'"{n}"' for n in _NAMES] + ["dominant_pct"],
)
def segment_row_pct(spark, d):
    table = reshape.crosstab(_segments(spark, d), "c_mktsegment", "o_orderpriority", _PRIORITIES).withColumnsRenamed(
        {n: f"c{i}" for i, n in enumerate(_NAMES)}
    )
    pct = reshape.row_pct(table, "c_mktsegment", [f"c{i}" for i in range(len(_NAMES))])
    back = {f"c{i}": n for i, n in enumerate(_NAMES)}
    return pct.withColumn("dominant", labels.lookup("dominant", back)).withColumnsRenamed(back)


@query(
    "outfield_and_keepers",
    ["F14", "G2"],
    with_tables(
        """SELECT player_id, competition_id, season_id, position_name = 'Goalkeeper' AS keeper FROM season""",
        "season",
    ),
    longs=["competition_id", "season_id"],
)
def outfield_and_keepers(spark, d):
    from touchline.plans.archetypes import split_goalkeepers

    keys = ["player_id", "competition_id", "season_id"]
    outfield, keepers = split_goalkeepers(base.Run(spark, d, "season").season)
    return outfield.select(*keys, F.lit(False).alias("keeper")).unionByName(keepers.select(*keys, F.lit(True).alias("keeper")))


