"""Marts, analyst questions, report aggregates, and the outcome model."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.constants import FEATURES, TOP5_COMPETITIONS
from touchline.plans import consistency, marts, reports, teams
from touchline.session import materialize
from touchline.sources.readers import read_table
from touchline.streaming.jobs import refresh
from touchline.workload import base
from touchline.workload.registry import query
from touchline.workload.tables_sql import POSITION_CASE, in_list, with_tables

_STATS = {"total_xg": "xg", "possession_share": "possession_proxy", "pass_completion_pct": "pass_completion_pct",
          "total_shots": "shots", "total_pressures": "total_pressures", "total_carries": "total_carries"}


def _side(s: str) -> str:
    return ", ".join(f"{s}.{c} AS {n}_{v}" for n in ["home" if s == "h" else "away"] for c, v in _STATS.items())


@query(
    "match_analysis",
    ["K1", "C6"],
    with_tables(
        f"""SELECT m.match_id, m.match_date, m.competition_id, m.competition_name, m.season_id, m.season_name, m.home_team, m.away_team,
                   m.home_score, m.away_score, m.match_result, {_side('h')}, {_side('a')}
            FROM stg_matches m LEFT JOIN (SELECT * FROM match_stats WHERE side = 'home') h USING (match_id)
            LEFT JOIN (SELECT * FROM match_stats WHERE side = 'away') a USING (match_id)""",
        "stg_matches", "match_stats",
    ),
    doubles=[f"{s}_{v}" for s in ("home", "away") for v in ("xg", "possession_proxy", "pass_completion_pct")],
    longs=["competition_id", "season_id"],
    texts=["match_date"],
)
def match_analysis(spark, d):
    run = base.Run(spark, d)
    return marts.match_analysis(run.stg_matches, run.match_stats)


_BEST = """best AS (SELECT player_id, cluster AS cluster_id, archetype AS cluster_label
    FROM assignments JOIN (SELECT player_id, competition_id, season_id, total_minutes FROM season) USING (player_id, competition_id, season_id)
    QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY total_minutes DESC, competition_id, season_id) = 1)"""
_GRAIN = "player_id, competition_id, season_id"
_COORDS = f"""coords AS (SELECT {_GRAIN}, sum(z * loading) FILTER (component = 'PC1') AS pc1, sum(z * loading) FILTER (component = 'PC2') AS pc2
    FROM (SELECT {_GRAIN}, feature, (value - avg(value) OVER (PARTITION BY feature)) / nullif(stddev_samp(value) OVER (PARTITION BY feature), 0) AS z
          FROM (UNPIVOT (SELECT {_GRAIN}, {", ".join(FEATURES)} FROM season) ON {", ".join(FEATURES)} INTO NAME feature VALUE value))
    JOIN loadings USING (feature) GROUP BY 1, 2, 3)"""
_CLUSTER_COLUMNS = f"""s.player_id, s.player_name, s.competition_id, s.competition_name, s.season_id, s.season_name, s.total_minutes,
    coalesce(b.cluster_id, -1)::BIGINT AS cluster_id, coalesce(b.cluster_label, 'Unknown') AS cluster_label, c.pc1, c.pc2,
    {", ".join(f"s.{f}" for f in FEATURES)}, s.goals_per_90, s.assists_per_90"""
_CLUSTER_DOUBLES = ["total_minutes", "pc1", "pc2", *FEATURES, "goals_per_90", "assists_per_90"]


@query(
    "player_clusters",
    ["K2"],
    with_tables(
        f"WITH {_BEST}, {_COORDS} SELECT {_CLUSTER_COLUMNS} FROM season s LEFT JOIN best b USING (player_id) LEFT JOIN coords c USING ({_GRAIN})",
        "season", "assignments", "loadings",
    ),
    doubles=_CLUSTER_DOUBLES,
    longs=["competition_id", "season_id"],
)
def player_clusters(spark, d):
    run = base.Run(spark, d, "season")
    return marts.player_clusters(run.season, run.assignments, run.loadings)


@query(
    "player_clusters_per_season",
    ["K2", "C7"],
    with_tables(
        f"""WITH b AS (SELECT {_GRAIN}, cluster AS cluster_id, archetype AS cluster_label FROM assignments), {_COORDS}
            SELECT {_CLUSTER_COLUMNS} FROM season s LEFT JOIN b USING ({_GRAIN}) LEFT JOIN coords c USING ({_GRAIN})""",
        "season", "assignments", "loadings",
    ),
    doubles=_CLUSTER_DOUBLES,
    longs=["competition_id", "season_id"],
)
def player_clusters_per_season(spark, d):
    run = base.Run(spark, d, "season")
    return marts.player_clusters(run.season, run.assignments, run.loadings, per_season=True)


_PERF = f"""perf AS (SELECT s.player_id, s.player_name, s.competition_id, s.competition_name, s.season_id, s.season_name, s.total_minutes,
    coalesce(b.cluster_id, -1)::BIGINT AS cluster_id, coalesce(b.cluster_label, 'Unknown') AS cluster_label,
    {", ".join(f"s.{c}" for c in marts.PERFORMANCE_COLUMNS)},
    x.club_performance_score, x.national_performance_score, x.consistency_score, x.performance_quadrant
    FROM season s LEFT JOIN best b USING (player_id) LEFT JOIN scores x USING (player_id))"""
_PERF_DOUBLES = ["total_minutes", *[c for c in marts.PERFORMANCE_COLUMNS if not c.startswith("total_") or c == "total_xg"],
                 "club_performance_score", "national_performance_score", "consistency_score"]
_PERF_NEEDS = ("season", "assignments", "scores")


def _performance(spark, d):
    run = base.Run(spark, d, "season")
    return marts.player_performance(run.season, run.assignments, run.scores)


@query("player_performance", ["K3"], with_tables(f"WITH {_BEST}, {_PERF} SELECT * FROM perf", *_PERF_NEEDS),
       doubles=_PERF_DOUBLES, longs=["competition_id", "season_id"])
def player_performance(spark, d):
    return _performance(spark, d)


@query(
    "trained_marts_agree",
    ["K2", "K3", "K12", "G9"],
    with_tables(
        """SELECT count(*) AS n_rows, count(DISTINCT player_id) AS players, sum(total_minutes) AS minutes, true AS label_of_longest_season,
                  true AS marts_agree, true AS counts_agree FROM season""",
        "season",
    ),
    doubles=["minutes"],
    digits=3,
)
def trained_marts_agree(spark, d):
    """Both player marts and the report on trained archetypes: every row has its player's label of the longest season."""
    run = base.Run(spark, d, "season", "trained")
    clusters = materialize(marts.player_clusters(run.season, run.trained, run.trained_loadings), "clusters")
    performance = marts.player_performance(run.season, run.trained, run.scores)
    longest = F.struct(F.col("total_minutes"), -F.col("competition_id"), -F.col("season_id"))
    best = run.trained.groupBy("player_id").agg(F.max_by("archetype", longest).alias("label"))
    grain = ["player_id", "competition_id", "season_id"]
    rows = clusters.join(best, "player_id", "left").join(
        performance.select(*grain, F.col("cluster_label").alias("other")), grain, "left"
    )
    counted = reports.archetype_distribution(run.trained).agg(F.sum("seasons") == run.trained.agg(F.count(F.lit(1))).scalar()).scalar()
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("player_id").alias("players"), F.sum("total_minutes").alias("minutes"),
        F.bool_and(F.col("cluster_label") == F.col("label")).alias("label_of_longest_season"),
        F.bool_and(F.col("cluster_label") == F.col("other")).alias("marts_agree"),
    ).withColumn("counts_agree", counted)


@query("trained_player_clusters", ["K2", "G6", "G8", "G9"], None)
def trained_player_clusters(spark, d):
    run = base.Run(spark, d, "season", "trained")
    trained = run.trained
    return marts.player_clusters(run.season, trained, run.trained_loadings)


@query("trained_league_summary", ["K12", "K14"], None)
def trained_league_summary(spark, d):
    run = base.Run(spark, d, "season", "trained")
    return reports.league_summary(materialize(reports.competition_archetypes(run.trained, run.season), "counts"))


@query(
    "refreshed_marts",
    ["L6"],
    with_tables(
        """SELECT * FROM (VALUES ('player_clusters', 2, true), ('player_performance', 2, true), ('team_comparison', 1, false)) AS t(mart, builds, rebuilt_last),
           (SELECT count(*) AS n_seasons FROM season)""",
        "season",
    ),
    longs=["builds"],
)
def refreshed_marts(spark, d):
    """Two runs over stored marts: at first all are built, then new assignments rebuild the two that read them."""
    run = base.Run(spark, d, "season", "match_stats", "assignments")
    stored: dict[str, list] = {}
    builders = {
        "player_clusters": lambda: marts.player_clusters(run.season, run.assignments, run.loadings),
        "player_performance": lambda: marts.player_performance(run.season, run.assignments, run.scores),
        "team_comparison": lambda: marts.team_comparison(teams.team_season_stats(run.match_stats), run.form),
    }
    inputs = {"player_clusters": ["assignments"], "player_performance": ["assignments", "scores"], "team_comparison": ["match_stats"]}

    def store(name, df):
        stored.setdefault(name, []).append(materialize(df, name))

    refresh(builders, store, ["assignments", "scores", "match_stats"], inputs)
    last = refresh(builders, store, ["assignments"], inputs)
    counts = [(name, len(tables), name in last) for name, tables in stored.items()]
    seasons = stored["player_clusters"][-1].agg(F.count(F.lit(1))).scalar()
    return spark.createDataFrame(counts, "mart string, builds int, rebuilt_last boolean").withColumn("n_seasons", seasons)


@query(
    "team_comparison",
    ["K4"],
    with_tables(
        """SELECT s.team, s.competition_id, s.competition_name, s.season_id, s.season_name, matches_played, wins, draws, losses, total_points,
                  total_xg AS seasonal_total_xg, avg_xg_per_match AS seasonal_avg_xg, avg_possession_share AS seasonal_avg_possession,
                  s.total_pressures AS seasonal_total_pressures, avg_pressures_per_match AS seasonal_avg_pressures,
                  rolling_avg_xg AS latest_rolling_xg, rolling_avg_points AS latest_rolling_points,
                  rolling_avg_possession_pct AS latest_rolling_possession, rolling_avg_pressures AS latest_rolling_pressures,
                  rolling_avg_pass_completion_pct AS latest_rolling_pass_accuracy
           FROM (SELECT team, competition_id, competition_name, season_id, season_name, count(*) AS matches_played,
                        count(*) FILTER (pts = 3) AS wins, count(*) FILTER (pts = 1) AS draws, count(*) FILTER (pts = 0) AS losses, sum(pts)::BIGINT AS total_points,
                        sum(total_xg) AS total_xg, avg(total_xg) AS avg_xg_per_match, avg(possession_share) AS avg_possession_share,
                        sum(total_pressures)::BIGINT AS total_pressures, avg(total_pressures) AS avg_pressures_per_match
                 FROM (SELECT *, CASE WHEN side || '_win' = match_result THEN 3 WHEN match_result = 'draw' THEN 1 ELSE 0 END AS pts FROM match_stats)
                 GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 10) s
           LEFT JOIN (SELECT * FROM form QUALIFY row_number() OVER (PARTITION BY team, competition_id, season_id ORDER BY match_date DESC, match_id DESC) = 1) f
           USING (team, competition_id, season_id)""",
        "match_stats", "form",
    ),
    doubles=["seasonal_total_xg", "seasonal_avg_xg", "seasonal_avg_possession", "seasonal_avg_pressures", "latest_rolling_xg",
             "latest_rolling_points", "latest_rolling_possession", "latest_rolling_pressures", "latest_rolling_pass_accuracy"],
    longs=["competition_id", "season_id"],
)
def team_comparison(spark, d):
    run = base.Run(spark, d, "match_stats")
    return marts.team_comparison(teams.team_season_stats(run.match_stats), run.form)


_SHORT = teams.FORM_SHORT
_FEATURE_DOUBLES = [f"{s}_{v}" for s in ("home", "away") for v in _SHORT.values()] + ["h2h_home_win_pct"]


@query(
    "match_features",
    ["K5", "E1", "E6"],
    with_tables(
        f"""SELECT m.match_id, m.match_date, m.competition_id, m.competition_name, m.season_name, m.home_team, m.away_team, m.match_result,
                   {", ".join(f"h.{c} AS home_{v}" for c, v in _SHORT.items())}, {", ".join(f"a.{c} AS away_{v}" for c, v in _SHORT.items())},
                   h2h_home_wins::DOUBLE / nullif(h2h_total_matches, 0) AS h2h_home_win_pct
            FROM stg_matches m JOIN form h ON h.match_id = m.match_id AND h.team = m.home_team AND h.side = 'home'
            JOIN form a ON a.match_id = m.match_id AND a.team = m.away_team AND a.side = 'away' LEFT JOIN h2h x ON x.match_id = m.match_id""",
        "stg_matches", "form", "h2h",
    ),
    doubles=_FEATURE_DOUBLES,
    longs=["competition_id"],
    texts=["match_date"],
)
def match_features(spark, d):
    run = base.Run(spark, d)
    return teams.match_features(run.stg_matches, run.form)


# --- analyst questions ----------------------------------------------------------------------------------


@query(
    "weighted_xg_rate",
    ["K6"],
    with_tables(
        "SELECT player_id, min(player_name) AS player_name, sum(total_minutes) AS total_minutes, sum(total_xg) / nullif(sum(total_minutes), 0) * 90 AS xg_per_90 FROM season GROUP BY 1",
        "season",
    ),
    doubles=["total_minutes", "xg_per_90"],
)
def weighted_xg_rate(spark, d):
    return marts.weighted_rate(base.Run(spark, d).season, "total_xg", "xg_per_90")


def _top_label_sql(label: str, total: str, n: int) -> str:
    return f"""WITH {_BEST}, {_PERF} SELECT player_id, min(player_name) AS player_name, sum(total_minutes) AS total_minutes,
        sum({total}) / nullif(sum(total_minutes), 0) * 90 AS rate FROM perf WHERE cluster_label = '{label}' GROUP BY 1 ORDER BY round(rate, 9) DESC, player_id LIMIT {n}"""


for _name, _label, _total in (
    ("top_defensive_anchors", "Defensive Anchor", "total_interceptions"),
    ("top_creative_playmakers", "Creative Playmaker", "total_passes_completed"),
    ("top_pressing_forwards", "Pressing Forward", "total_pressures"),
):

    def _build(spark, d, label=_label, total=_total):
        return marts.top_by_label(_performance(spark, d), label, total, "rate", 10)

    query(_name, ["K7"], with_tables(_top_label_sql(_label, _total, 10), *_PERF_NEEDS), doubles=["total_minutes", "rate"])(_build)

    def _build_trained(spark, d, label=_label, total=_total):
        run = base.Run(spark, d, "season", "trained")
        return marts.top_by_label(marts.player_performance(run.season, run.trained, run.scores), label, total, "rate", 10)

    query(f"trained_{_name}", ["K7"], None)(_build_trained)


@query(
    "elite_players_in_league",
    ["K8"],
    with_tables(
        f"""WITH {_BEST}, {_PERF} SELECT DISTINCT player_id, player_name, performance_quadrant, consistency_score FROM perf
            WHERE performance_quadrant = 'Elite' AND competition_name = 'Premier League'""",
        *_PERF_NEEDS,
    ),
    doubles=["consistency_score"],
)
def elite_players_in_league(spark, d):
    return marts.quadrant_players(_performance(spark, d), "Elite", "Premier League")


@query(
    "player_cluster_lookup",
    ["K9"],
    with_tables(
        f"""WITH {_BEST} SELECT s.player_id, s.player_name, s.competition_name, s.season_name, coalesce(b.cluster_label, 'Unknown') AS cluster_label
            FROM season s LEFT JOIN best b USING (player_id) WHERE s.player_name ILIKE '%player 1%'""",
        "season", "assignments",
    ),
)
def player_cluster_lookup(spark, d):
    run = base.Run(spark, d, "season")
    return marts.player_cluster(marts.player_clusters(run.season, run.assignments, run.loadings), "PLAYER 1")


@query("trained_cluster_lookup", ["K9"], None)
def trained_cluster_lookup(spark, d):
    run = base.Run(spark, d, "season", "trained")
    return marts.player_cluster(marts.player_clusters(run.season, run.trained, run.trained_loadings), "PLAYER 1")


@query(
    "midfield_passes_by_league",
    ["K10"],
    with_tables(
        f"""SELECT competition_name, count(*) AS player_seasons, sum(total_passes_completed) / nullif(sum(total_minutes), 0) * 90 AS rate
            FROM season WHERE {POSITION_CASE} = 'CM' AND competition_name IN ('La Liga', 'Premier League') GROUP BY 1""",
        "season",
    ),
    doubles=["rate"],
)
def midfield_passes_by_league(spark, d):
    return marts.compare_competitions(base.Run(spark, d).season, "total_passes_completed", "CM", ["La Liga", "Premier League"])


@query(
    "pressure_shift",
    ["K11"],
    with_tables(
        """SELECT count(*) AS players, avg(c) AS club_mean, avg(n) AS national_mean, avg(n - c) AS mean_shift
           FROM (SELECT player_id, avg(pressures_per_90) FILTER (NOT is_international) AS c, avg(pressures_per_90) FILTER (is_international) AS n
                 FROM club_national GROUP BY 1) WHERE c IS NOT NULL AND n IS NOT NULL""",
        "club_national",
    ),
    doubles=["club_mean", "national_mean", "mean_shift"],
)
def pressure_shift(spark, d):
    return marts.shift(base.Run(spark, d).club_national, "pressures_per_90")


@query(
    "capped_preview",
    ["K17"],
    """SELECT 50 AS shown, 'showing the first 50 rows' AS note, (SELECT count(*) FROM orders) AS n_orders,
              (SELECT sum(o_orderkey) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50)) AS key_sum""",
    longs=["shown", "key_sum"],
)
def capped_preview(spark, d):
    orders = read_table(spark, d, "orders")
    rows, note = marts.preview(orders.orderBy("o_orderkey"))
    return orders.agg(F.count(F.lit(1)).alias("n_orders")).select(F.lit(len(rows)).alias("shown"), F.lit(note).alias("note"), "n_orders",
                                                                F.lit(sum(r["o_orderkey"] for r in rows)).alias("key_sum"))


# --- report aggregates ------------------------------------------------------------------------------------


@query("archetype_distribution", ["K12"], with_tables("SELECT archetype, count(*) AS seasons FROM assignments GROUP BY 1", "assignments"))
def archetype_distribution(spark, d):
    return reports.archetype_distribution(base.Run(spark, d).assignments)


_COUNTS = f"""SELECT competition_name, archetype, count(*) AS seasons FROM assignments JOIN season USING ({_GRAIN})
    WHERE archetype <> 'Goalkeeper' AND competition_name IN {in_list(TOP5_COMPETITIONS)} GROUP BY 1, 2"""


@query("competition_archetypes", ["K12"], with_tables(_COUNTS, "assignments", "season"))
def competition_archetypes(spark, d):
    run = base.Run(spark, d, "season")
    return reports.competition_archetypes(run.assignments, run.season)


_OVERVIEW = """SELECT (SELECT count(*) FROM raw_matches) AS n_matches, (SELECT count(*) FROM raw_events) AS n_events,
    (SELECT count(*) FROM raw_lineups) AS n_lineups, (SELECT count(DISTINCT competition_id) FROM assignments) AS n_competitions"""
_OVERVIEW_NEEDS = ("raw_matches", "raw_events", "raw_lineups", "assignments")


@query("data_overview", ["K13"], with_tables(_OVERVIEW, *_OVERVIEW_NEEDS))
def data_overview(spark, d):
    run = base.Run(spark, d)
    return reports.data_overview(run.raw_matches, run.raw_events, run.raw_lineups, run.assignments)


_LEAGUE = f"""WITH c AS ({_COUNTS}), t AS (
        SELECT competition_name, sum(seasons)::BIGINT AS total, coalesce(sum(seasons) FILTER (archetype = 'Low Activity'), 0)::DOUBLE / sum(seasons) AS share,
               coalesce(sum(seasons) FILTER (archetype = 'Pressing Forward'), 0)::BIGINT AS pressing FROM c GROUP BY 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY competition_name ORDER BY seasons DESC, archetype) AS k FROM c),
    w AS (SELECT t.*, a.archetype AS a1, a.seasons AS n1, b.archetype AS a2, coalesce(b.seasons, 0) AS n2
          FROM t JOIN r a ON a.competition_name = t.competition_name AND a.k = 1 LEFT JOIN r b ON b.competition_name = t.competition_name AND b.k = 2)
    SELECT CASE competition_name WHEN '1. Bundesliga' THEN 'Bundesliga' ELSE competition_name END AS competition,
           a1 || ' (' || n1 || ')' AS largest, coalesce(a2 || ' (' || n2 || ')', '') AS second_largest,
           CASE WHEN total = (SELECT max(total) FROM t) THEN 'Highest volume. ' || a1 || 's lead'
                WHEN share = (SELECT max(share) FROM t) THEN 'Most Low Activity share among top five'
                WHEN total = (SELECT min(total) FROM t) AND (SELECT count(*) FROM t) = 5 AND pressing >= 70
                     THEN 'Smallest top-five sample. More Pressing Forward (' || pressing || ')'
                WHEN abs(n1 - n2) <= greatest(5, floor(total * 0.05)) THEN 'Near-even top two clusters'
                ELSE 'Similar anchor vs low-activity mix' END AS notable_pattern,
           list_position(['La Liga', 'Serie A', 'Ligue 1', 'Premier League', '1. Bundesliga'], competition_name)::BIGINT AS sort_key
    FROM w"""


@query("league_summary", ["K14"], with_tables(_LEAGUE, "assignments", "season"))
def league_summary(spark, d):
    run = base.Run(spark, d, "season")
    return reports.league_summary(materialize(reports.competition_archetypes(run.assignments, run.season), "counts"))


@query(
    "report_metrics",
    ["K15"],
    with_tables(
        f"""SELECT o.*, round(n_events / 1000000, 1) AS n_events_millions,
                   (SELECT count(*) FROM assignments) AS n_player_seasons,
                   (SELECT count(*) FROM assignments WHERE archetype <> 'Goalkeeper') AS n_outfield_player_seasons,
                   (SELECT count(*) FROM assignments WHERE archetype = 'Goalkeeper') AS n_goalkeeper_seasons, q.*,
                   pct_club_specialist + pct_international_specialist AS pct_single_context_specialist, 270::BIGINT AS min_minutes
            FROM ({_OVERVIEW}) o, (SELECT count(*) AS n_dual_context_players,
                {", ".join(f"100.0::DOUBLE * count(*) FILTER (performance_quadrant = '{q}') / count(*) AS pct_{n}" for q, n in
                    (("Elite", "elite"), ("Club Specialist", "club_specialist"), ("International Specialist", "international_specialist"), ("Underperformer", "underperformer")))}
                FROM scores) q""",
        *_OVERVIEW_NEEDS, "scores",
    ),
    doubles=["n_events_millions", "pct_elite", "pct_club_specialist", "pct_international_specialist", "pct_underperformer", "pct_single_context_specialist"],
)
def report_metrics(spark, d):
    run = base.Run(spark, d, "season")
    overview = reports.data_overview(run.raw_matches, run.raw_events, run.raw_lineups, run.assignments)
    return reports.report_metrics(
        reports.archetype_distribution(run.assignments), consistency.quadrant_distribution(run.scores), overview
    )


@query("outcome_model_score", ["K18"], None)
def outcome_model_score(spark, d):
    run = base.Run(spark, d)
    features = materialize(teams.match_features(run.stg_matches, run.form), "features")
    columns = [f"{s}_{v}" for s in ("home", "away") for v in _SHORT.values()] + ["h2h_home_win_pct"]
    _, scored = marts.fit_outcome(features, columns, "1999-12-31")
    return marts.brier(scored)


@query(
    "outcome_model_rows",
    ["K18"],
    with_tables(
        """SELECT count(*) AS n, true AS sums_to_one, true AS beats_uniform_guess FROM stg_matches m
           JOIN form h ON h.match_id = m.match_id AND h.team = m.home_team AND h.side = 'home'
           JOIN form a ON a.match_id = m.match_id AND a.team = m.away_team AND a.side = 'away' WHERE m.match_date > DATE '1999-12-31'""",
        "stg_matches", "form",
    ),
)
def outcome_model_rows(spark, d):
    """Every later match gets three probabilities that sum to one, better than guessing."""
    run = base.Run(spark, d)
    features = materialize(teams.match_features(run.stg_matches, run.form), "features")
    columns = [f"{s}_{v}" for s in ("home", "away") for v in _SHORT.values()] + ["h2h_home_win_pct"]
    scored = materialize(marts.fit_outcome(features, columns, "1999-12-31")[1], "scored")
    total = F.col("p_home_win") + F.col("p_draw") + F.col("p_away_win")
    sums = scored.agg(F.bool_and(F.abs(total - 1) < 1e-9)).scalar()
    return marts.brier(scored).select(
        "n", sums.alias("sums_to_one"), (F.col("brier") < F.col("brier_uniform")).alias("beats_uniform_guess")
    )
