"""Club against national team, statistics, and archetypes."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.constants import CLIP_QUANTILE, COMPETITION_LABEL_ORDER, COMPETITION_LABELS, FEATURES, K_RANGE, POSITION_ORDER, QUADRANTS
from touchline.operators import neighbours, statistics
from touchline.operators.clustering import silhouettes
from touchline.plans import archetypes, consistency, marts, players
from touchline.session import materialize
from touchline.sources.readers import read_table
from touchline.workload import base
from touchline.workload.q_aggregates import CONTEXT_EVENTS_SQL, CONTEXT_MINUTES_SQL
from touchline.workload.registry import query
from touchline.workload.tables_sql import LEAGUE_CASE, POSITION_CASE, case_map, in_list, with_tables

# --- scores ------------------------------------------------------------------------------------------


@query(
    "weighted_feature_totals",
    ["H1"],
    with_tables(
        f"""SELECT player_id, feature, sum(value) * weight AS weighted FROM (
               UNPIVOT (SELECT player_id, {", ".join(FEATURES)} FROM season) ON {", ".join(FEATURES)} INTO NAME feature VALUE value)
            JOIN weights USING (feature) GROUP BY player_id, feature, weight""",
        "season", "weights",
    ),
    doubles=["weighted"],
)
def weighted_feature_totals(spark, d):
    from touchline.operators.reshape import unpivot_present

    weights = consistency.feature_weights(base.loadings(spark))
    sums = unpivot_present(base.Run(spark, d).season, ["player_id"], FEATURES).groupBy("player_id", "feature").agg(F.sum("value").alias("v"))
    return sums.join(weights, on="feature").select("player_id", "feature", (F.col("v") * F.col("weight")).alias("weighted"))


_SCORES = """player_id, player_name, club_performance_score, national_performance_score, consistency_score,
    performance_quadrant, club_minutes, national_minutes"""
_SCORE_DOUBLES = ["club_performance_score", "national_performance_score", "consistency_score", "club_minutes", "national_minutes"]


@query("performance_scores", ["H2", "H3", "H4"],
       with_tables("SELECT player_id, club_performance_score, national_performance_score, consistency_score FROM scored", "scored"),
       doubles=["club_performance_score", "national_performance_score", "consistency_score"])
def performance_scores(spark, d):
    return base.Run(spark, d).wide_scores.select("player_id", "club_performance_score", "national_performance_score", "consistency_score")


@query("consistency_scores", ["H5", "H6", "O3"], with_tables(f"SELECT {_SCORES} FROM scores", "scores"), doubles=_SCORE_DOUBLES)
def consistency_scores(spark, d):
    return base.Run(spark, d).scores


_DELTAS = [f"delta_{f}" for f in FEATURES]


def _weight(f: str) -> str:
    return f"(SELECT weight FROM weights WHERE feature = '{f}')"


_CONTRIB = {f: f"abs(delta_{f}) * {_weight(f)}" for f in FEATURES}


@query(
    "gap_table",
    ["H7"],
    with_tables(
        f"""SELECT player_id, player_name, performance_gap, {", ".join(_DELTAS)}, {", ".join(f"{e} AS contrib_{f}" for f, e in _CONTRIB.items())},
                   {" + ".join(_CONTRIB.values())} AS total_weighted_gap FROM gaps""",
        "gaps", "weights",
    ),
    doubles=["performance_gap", "total_weighted_gap", *_DELTAS, *[f"contrib_{f}" for f in FEATURES]],
)
def gap_table(spark, d):
    return base.Run(spark, d).gaps


@query(
    "feature_importance",
    ["H8"],
    with_tables(
        f"""SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS rank,
                   round(100.0::DOUBLE * importance / sum(importance) OVER (), 2) AS pct_of_total FROM (
            {" UNION ALL ".join(f"SELECT '{f}' AS feature, avg(abs(delta_{f})) AS mean_abs_delta_z, avg(delta_{f}) AS mean_delta_z, avg({_CONTRIB[f]}) AS importance FROM gaps" for f in FEATURES)})""",
        "gaps", "weights",
    ),
    doubles=["mean_abs_delta_z", "mean_delta_z", "importance", "pct_of_total"],
)
def feature_importance(spark, d):
    return consistency.feature_importance(base.Run(spark, d).gaps)


def _specialist(f: str) -> str:
    club, nat = (f"FILTER (performance_quadrant = '{q}')" for q in QUADRANTS[1:3])
    return f"""SELECT '{f}' AS feature, avg(delta_{f}) {club} AS club_mean_dz, avg(delta_{f}) {nat} AS nat_mean_dz,
        avg({_CONTRIB[f]}) {club} AS club_importance, avg({_CONTRIB[f]}) {nat} AS nat_importance FROM gaps"""


@query(
    "specialist_separation",
    ["H9"],
    with_tables(
        f"""SELECT *, nat_mean_dz - club_mean_dz AS difference, row_number() OVER (ORDER BY abs(nat_mean_dz - club_mean_dz) DESC, feature) AS rank_separation
            FROM ({" UNION ALL ".join(_specialist(f) for f in FEATURES)})""",
        "gaps", "weights",
    ),
    doubles=["club_mean_dz", "nat_mean_dz", "club_importance", "nat_importance", "difference"],
)
def specialist_separation(spark, d):
    run = base.Run(spark, d, "club_national")
    return consistency.specialist_compare(run.gaps, run.scores)


@query(
    "club_specialists",
    ["H10"],
    with_tables(
        """SELECT player_id, club_performance_score - national_performance_score AS specialist_score FROM scores
           WHERE performance_quadrant = 'Club Specialist' ORDER BY specialist_score DESC, player_id LIMIT 5""",
        "scores",
    ),
    doubles=["specialist_score"],
)
def club_specialists(spark, d):
    return consistency.specialist_top(base.Run(spark, d).scores, "Club Specialist", 5).select("player_id", "specialist_score")


_SHIFT = ("xg_per_90", "shots_per_90", "passes_per_90", "carries_att_third_per_90", "carries_per_90", "passes_att_third_per_90",
          "pressures_per_90", "pass_completion_pct")


@query(
    "context_shift_score",
    ["H11"],
    with_tables(
        f"""SELECT player_id, raw_gap, w AS minutes_weight, raw_gap * w AS context_shift_score FROM (
               SELECT c.player_id, {" + ".join(f"coalesce(n.{m}, 0) - coalesce(c.{m}, 0)" for m in _SHIFT)} AS raw_gap,
                      2 * n.total_minutes * c.total_minutes / ((n.total_minutes + c.total_minutes) * greatest(n.total_minutes, c.total_minutes)) AS w
               FROM eligible c JOIN eligible n ON n.player_id = c.player_id AND n.is_international AND NOT c.is_international)""",
        "eligible",
    ),
    doubles=["raw_gap", "minutes_weight", "context_shift_score"],
)
def context_shift_score(spark, d):
    from touchline.operators.reshape import two_context_wide

    rows = consistency.eligible(base.Run(spark, d).club_national)
    wide = two_context_wide(rows, ["player_id"], "is_international", [*_SHIFT, "total_minutes"], delta=None)
    return consistency.context_shift(wide.withColumnsRenamed({"club_total_minutes": "club_minutes", "nat_total_minutes": "national_minutes"}))


@query(
    "quadrant_distribution",
    ["H12", "K15"],
    with_tables(
        """SELECT performance_quadrant AS quadrant, count(*) AS players, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct
           FROM scores GROUP BY 1""",
        "scores",
    ),
    doubles=["pct"],
)
def quadrant_distribution(spark, d):
    return consistency.quadrant_distribution(base.Run(spark, d).scores)


@query(
    "notable_players",
    ["H13"],
    with_tables(
        """SELECT player_id, performance_quadrant, (abs(club_performance_score) + abs(national_performance_score)) / 2 AS notable_score FROM scores
           QUALIFY row_number() OVER (PARTITION BY performance_quadrant ORDER BY notable_score DESC, player_id) <= 10""",
        "scores",
    ),
    doubles=["notable_score"],
)
def notable_players(spark, d):
    return consistency.notable(base.Run(spark, d).scores).select("player_id", "performance_quadrant", "notable_score")


def _enriched(spark, d):
    run = base.Run(spark, d, "player_match")
    return consistency.enrich(run.scores, run.player_match, run.stg_matches, tuple(COMPETITION_LABELS))


_ENRICHED = f"""
    WITH r AS (SELECT p.player_id, p.position_name, m.competition_name, p.minutes_played FROM player_match_stats p JOIN stg_matches m USING (match_id)
               WHERE NOT m.is_international AND m.competition_name IN {in_list(COMPETITION_LABELS)}),
    pp AS (SELECT player_id, position_name AS primary_position FROM r WHERE position_name NOT IN ('', 'Unknown') GROUP BY 1, 2
           QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY sum(minutes_played) DESC, primary_position) = 1),
    pc AS (SELECT player_id, competition_name AS primary_competition_name FROM r GROUP BY 1, 2
           QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY sum(minutes_played) DESC, primary_competition_name) = 1),
    e AS (SELECT s.*, primary_position, primary_competition_name, {POSITION_CASE.replace('position_name', 'primary_position')} AS position_group,
                 {LEAGUE_CASE.replace('competition_name', 'primary_competition_name')} AS competition_label
          FROM scores s LEFT JOIN (SELECT * FROM pp LEFT JOIN pc USING (player_id)) USING (player_id))"""
_NEEDS = ("scores", "player_match_stats", "stg_matches")


@query(
    "enriched_scores",
    ["H14"],
    with_tables(f"{_ENRICHED} SELECT player_id, primary_position, primary_competition_name, position_group, competition_label FROM e", *_NEEDS),
)
def enriched_scores(spark, d):
    return _enriched(spark, d).select("player_id", "primary_position", "primary_competition_name", "position_group", "competition_label")


def _by_sql(key: str, order) -> str:
    place = case_map(key, {v: str(i + 1) for i, v in enumerate(order)})
    return f"""{_ENRICHED} SELECT {key}, count(DISTINCT player_id) AS n_players, avg(consistency_score) AS mean_consistency,
        stddev_samp(consistency_score) AS std_consistency, median(consistency_score) AS median_consistency, ({place})::BIGINT AS sort_key
        FROM e WHERE {key} IS NOT NULL GROUP BY 1"""


_BY_DOUBLES = ["mean_consistency", "std_consistency", "median_consistency"]


@query("consistency_by_position", ["H15"], with_tables(_by_sql("position_group", POSITION_ORDER), *_NEEDS), doubles=_BY_DOUBLES)
def consistency_by_position(spark, d):
    return consistency.consistency_by(_enriched(spark, d), "position_group", POSITION_ORDER)


@query("consistency_by_league", ["H15"], with_tables(_by_sql("competition_label", COMPETITION_LABEL_ORDER), *_NEEDS), doubles=_BY_DOUBLES)
def consistency_by_league(spark, d):
    return consistency.consistency_by(_enriched(spark, d), "competition_label", COMPETITION_LABEL_ORDER)


_Q = {q: f"count(*) FILTER (performance_quadrant = '{q}')" for q in QUADRANTS}
_QPCT = ", ".join(f'round(100.0::DOUBLE * {e} / count(*), 1) AS "{q}"' for q, e in _Q.items())
_QBEST = "greatest(" + ", ".join(f'"{q}"' for q in QUADRANTS) + ")"
_QWHICH = " ".join(f"WHEN \"{q}\" = {_QBEST} THEN '{q}'" for q in QUADRANTS)


@query(
    "quadrant_mix_by_league",
    ["H16"],
    with_tables(
        f"""{_ENRICHED} SELECT *, CASE {_QWHICH} END AS dominant, {_QBEST} AS dominant_pct
            FROM (SELECT competition_label, {_QPCT} FROM e WHERE competition_label IS NOT NULL GROUP BY 1)""",
        *_NEEDS,
    ),
    doubles=[f'"{q}"' for q in QUADRANTS] + ["dominant_pct"],
)
def quadrant_mix_by_league(spark, d):
    return consistency.quadrant_mix(_enriched(spark, d), "competition_label")


_EVENT_COLUMNS = players.CONTEXT_EVENT_COLUMNS
_CONTEXT_TABLE = f"""
    SELECT c.*, t.total_minutes, t.match_count, t.position_name, passes_completed::DOUBLE / nullif(passes, 0) AS pass_completion_pct,
           {", ".join(f"CASE WHEN total_minutes > 0 AND {c} IS NOT NULL THEN {c} / total_minutes * 90 ELSE 0 END AS {c}_p90" for c in _EVENT_COLUMNS)}
    FROM ({CONTEXT_EVENTS_SQL}) c JOIN ({CONTEXT_MINUTES_SQL}) t ON t.player_name = c.player AND t.context = c.context"""
_CONTEXT_DOUBLES = ["xg", "total_minutes", "pass_completion_pct"] + [f"{c}_p90" for c in _EVENT_COLUMNS]
_CONTEXT_NEEDS = ("stg_events", "stg_lineups", "stg_matches")


def _context_table(spark, d):
    return players.player_context_table(base.Run(spark, d).stg_events, base.Run(spark, d).stg_lineups, base.Run(spark, d).stg_matches)


@query("player_context_table", ["H17"], with_tables(_CONTEXT_TABLE, *_CONTEXT_NEEDS), doubles=_CONTEXT_DOUBLES)
def player_context_table(spark, d):
    return _context_table(spark, d)


_DUAL = f"""WITH t AS ({_CONTEXT_TABLE}), e AS (SELECT * FROM t WHERE total_minutes >= 270),
    dual AS (SELECT * FROM e WHERE player IN (SELECT player FROM e GROUP BY 1 HAVING count(DISTINCT context) = 2))"""


@query(
    "context_delta_summary",
    ["H18", "D12"],
    with_tables(
        f"""{_DUAL}, w AS (SELECT {", ".join(f"n.{c}_p90 - c.{c}_p90 AS d_{c}" for c in ("xg", "shots", "passes"))}
               FROM dual c JOIN dual n ON n.player = c.player AND c.context = 'Club' AND n.context = 'National')
            {" UNION ALL ".join(f"SELECT '{c}_p90' AS metric, count(d_{c}) AS players, avg(d_{c}) AS mean_delta, count(*) FILTER (d_{c} > 0) / count(d_{c}) AS share_up FROM w" for c in ("xg", "shots", "passes"))}""",
        *_CONTEXT_NEEDS,
    ),
    doubles=["mean_delta", "share_up"],
)
def context_delta_summary(spark, d):
    metrics = ["xg_p90", "shots_p90", "passes_p90"]
    wide = consistency.context_deltas(players.eligible_in_both(_context_table(spark, d)), metrics)
    return consistency.delta_summary(wide, metrics)


@query(
    "top_national_players",
    ["K16"],
    with_tables(
        f"""{_DUAL} SELECT player, xg_p90, total_minutes FROM dual WHERE context = 'National'
            ORDER BY round(xg_p90, 9) DESC, player LIMIT 15""",
        *_CONTEXT_NEEDS,
    ),
    doubles=["xg_p90", "total_minutes"],
)
def top_national_players(spark, d):
    table = players.eligible_in_both(_context_table(spark, d))
    return players.top_players(table, "xg_p90", 15, context="National").select("player", "xg_p90", "total_minutes")


# --- statistics ---------------------------------------------------------------------------------------


def _chi_sql(source: str, row: str, column: str, by: str = "") -> str:
    k = f"{by}, " if by else ""
    same = f"PARTITION BY {by}" if by else ""
    part = f"PARTITION BY {by}," if by else "PARTITION BY"
    cells = f"SELECT {k}{row} AS r, {column} AS c, count(*) AS o FROM {source} WHERE {row} IS NOT NULL AND {column} IS NOT NULL GROUP BY ALL"
    margins = f"""SELECT *, sum(o) OVER ({part} r)::DOUBLE AS tr, sum(o) OVER ({part} c)::DOUBLE AS tc, sum(o) OVER ({same})::DOUBLE AS n FROM ({cells})"""
    chi = f"""SELECT {k}max(n)::BIGINT AS n, max(n) * (sum(o * o / (tr * tc)) - 1) AS chi2, (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS dof,
        least(count(DISTINCT r), count(DISTINCT c)) - 1 AS small FROM ({margins}) {f"GROUP BY {by}" if by else ""}"""
    return f"SELECT {k}n, chi2, dof, sqrt(chi2 / (n * small)) AS cramers_v FROM ({chi})"


@query(
    "segment_priority_chi2",
    ["I1", "I2"],
    f"""SELECT *, exp(-chi2 / 2) * list_sum([power(chi2 / 2, i) / factorial(i::INT) FOR i IN range(8)]) AS p_value
        FROM ({_chi_sql("orders JOIN customer ON c_custkey = o_custkey", "c_mktsegment", "o_orderpriority")})""",
    doubles=["chi2", "cramers_v", "p_value"],
)
def segment_priority_chi2(spark, d):
    orders = read_table(spark, d, "orders").selectExpr("o_custkey AS c_custkey", "o_orderpriority")
    rows = orders.join(read_table(spark, d, "customer").select("c_custkey", "c_mktsegment"), on="c_custkey")
    return statistics.chi2(rows, "c_mktsegment", "o_orderpriority")


def _roles(spark, d):
    from touchline.functions.labels import competition_label, position_group

    run = base.Run(spark, d, "season")
    named = run.season.join(
        run.assignments.select("player_id", "competition_id", "season_id", "cluster"),
        on=["player_id", "competition_id", "season_id"],
    )
    return named.select(
        "player_id", competition_label("competition_name").alias("league"), position_group("position_name").alias("position_group"), "cluster"
    ).filter(F.col("position_group").isNotNull() & F.col("league").isNotNull())


_ROLES = f"""(SELECT player_id, {LEAGUE_CASE} AS league, {POSITION_CASE} AS position_group, cluster
    FROM season JOIN assignments USING (player_id, competition_id, season_id)
    WHERE {LEAGUE_CASE} IS NOT NULL AND {POSITION_CASE} IS NOT NULL)"""


@query("roles_by_league_chi2", ["I3"], with_tables(_chi_sql(_ROLES, "position_group", "cluster", "league"), "season", "assignments"),
       doubles=["chi2", "cramers_v"])
def roles_by_league_chi2(spark, d):
    return statistics.chi2(_roles(spark, d), "position_group", "cluster", ["league"], p_value=False)


@query(
    "role_deviation",
    ["I4"],
    with_tables(
        f"""WITH r AS (SELECT * FROM {_ROLES}),
            pooled AS (SELECT position_group, cluster, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY position_group), 1) AS pct FROM r GROUP BY 1, 2),
            own AS (SELECT league, position_group, cluster, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY league, position_group), 1) AS pct FROM r GROUP BY 1, 2, 3)
            SELECT g.position_group, max(round(abs(coalesce(o.pct, 0) - p.pct), 1)) AS max_abs_pct_point_deviation
            FROM (SELECT DISTINCT league, position_group FROM r) g JOIN pooled p USING (position_group)
            LEFT JOIN own o ON o.league = g.league AND o.position_group = g.position_group AND o.cluster = p.cluster GROUP BY 1""",
        "season", "assignments",
    ),
    doubles=["max_abs_pct_point_deviation"],
)
def role_deviation(spark, d):
    return statistics.max_deviation(_roles(spark, d), "position_group", "cluster", "league")


_U_OF = """placed AS (SELECT {first} AS f, rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2 AS rk,
               count(*) OVER (PARTITION BY {value}) AS t FROM {rows}),
    s AS (SELECT count(*) FILTER (f) AS n_first, count(*) FILTER (NOT f) AS n_second, sum(rk) FILTER (f) AS ranks,
                 sum(t * t - 1)::DOUBLE AS ties, count(*)::DOUBLE AS n FROM placed)
    SELECT n_first, n_second, ranks - n_first * (n_first + 1) / 2 AS u,
           greatest(abs(ranks - n_first * (n_first + 1) / 2 - n_first * n_second / 2) - 0.5, 0)
             / sqrt(n_first::DOUBLE * n_second / 12 * ((n + 1) - ties / (n * (n - 1)))) AS z FROM s"""
_U = "WITH " + _U_OF.format(first="event_type = 'click'", value="value", rows="events WHERE event_type IN ('click', 'purchase')")


def _u_test(spark, d, slices=None):
    rows = read_table(spark, d, "events").filter(F.col("event_type").isin("click", "purchase"))
    return statistics.mann_whitney(rows, F.col("event_type") == "click", "value", p_value=False, slices=slices)


@query("click_purchase_u_test", ["I5"], _U, doubles=["u", "z"])
def click_purchase_u_test(spark, d):
    return _u_test(spark, d)


@query("click_purchase_u_test_sliced", ["I5"], _U, doubles=["u", "z"])
def click_purchase_u_test_sliced(spark, d):
    """Same result with the sorted values cut into slices."""
    return _u_test(spark, d, 30)


@query(
    "defender_forward_u_test",
    ["I5", "H15"],
    with_tables(
        f"{_ENRICHED}, " + _U_OF.format(first="position_group IN ('CB', 'FB')", value="consistency_score",
                                        rows="e WHERE position_group IN ('CB', 'FB', 'FW') AND consistency_score IS NOT NULL"),
        *_NEEDS,
    ),
    doubles=["u", "z"],
    digits=4,
)
def defender_forward_u_test(spark, d):
    rows = materialize(_enriched(spark, d).filter(F.col("position_group").isin("CB", "FB", "FW")), "enriched")
    return statistics.mann_whitney(rows, F.col("position_group").isin("CB", "FB"), "consistency_score", p_value=False)


@query(
    "role_summary",
    ["I6"],
    with_tables(
        f"""SELECT metric, value FROM (UNPIVOT (
                SELECT count(*)::VARCHAR AS player_season_rows, count(DISTINCT player_id)::VARCHAR AS distinct_players,
                       count(DISTINCT cluster)::VARCHAR AS n_clusters FROM {_ROLES})
            ON player_season_rows, distinct_players, n_clusters INTO NAME metric VALUE value)""",
        "season", "assignments",
    ),
)
def role_summary(spark, d):
    facts = _roles(spark, d).agg(
        F.count(F.lit(1)).alias("player_season_rows"), F.count_distinct("player_id").alias("distinct_players"),
        F.count_distinct("cluster").alias("n_clusters"),
    )
    return statistics.text_summary(facts, ["player_season_rows", "distinct_players", "n_clusters"])


# --- archetypes ---------------------------------------------------------------------------------------

_IDS = "player_id, competition_id, season_id"


def _scaled_sql() -> str:
    med = ", ".join(f"median({f}) AS {f}" for f in FEATURES)
    imp = ", ".join(f"coalesce(o.{f}, m.{f}) AS {f}" for f in FEATURES)
    cap = ", ".join(f"quantile_cont({f}::DOUBLE, {CLIP_QUANTILE}::DOUBLE) AS {f}" for f in FEATURES)
    clip = ", ".join(f"least(i.{f}, c.{f}) AS {f}" for f in FEATURES)
    std = ", ".join(
        f"(k.{f} - avg(k.{f}) OVER ()) / CASE WHEN stddev_pop(k.{f}) OVER () = 0 THEN 1 ELSE stddev_pop(k.{f}) OVER () END AS {f}" for f in FEATURES
    )
    return f"""WITH o AS (SELECT * FROM season WHERE position_name <> 'Goalkeeper'), m AS (SELECT {med} FROM o),
        i AS (SELECT {_IDS}, {imp} FROM o, m), c AS (SELECT {cap} FROM i), k AS (SELECT {_IDS}, {clip} FROM i, c)
        SELECT {_IDS}, {std} FROM k"""


def _scaled(spark, d):
    outfield, _ = archetypes.split_goalkeepers(archetypes.cluster_features(base.Run(spark, d).season))
    return archetypes.preprocess(outfield)


@query("scaled_features", ["G1", "G2", "G3", "G4", "G5"], with_tables(_scaled_sql(), "season"),
       doubles=list(FEATURES), longs=["competition_id", "season_id"])
def scaled_features(spark, d):
    return _scaled(spark, d).select("player_id", "competition_id", "season_id", *FEATURES)


@query(
    "goalkeeper_rows",
    ["G10"],
    with_tables(
        """SELECT player_id, competition_id, season_id, -1::BIGINT AS cluster, 'Goalkeeper' AS archetype, NULL::DOUBLE AS pc1
           FROM season WHERE position_name = 'Goalkeeper'""",
        "season",
    ),
    longs=["competition_id", "season_id"],
)
def goalkeeper_rows(spark, d):
    _, keepers = archetypes.split_goalkeepers(base.Run(spark, d).season)
    return archetypes.goalkeeper_rows(keepers).select("player_id", "competition_id", "season_id", "cluster", "archetype", "pc1")


@query("trained_archetypes", ["G6", "G8", "G9", "F14"], None)
def trained_archetypes(spark, d):
    return archetypes.assign_archetypes(base.Run(spark, d).season)[0]


@query("trained_loadings", ["G6", "G7"], None)
def trained_loadings(spark, d):
    scaled = _scaled(spark, d)
    return archetypes.pca_loadings(scaled, archetypes.fit_pca(scaled))


def _covariance_sql() -> str:
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, covar_samp({a}, {b}) AS cov FROM x" for a in FEATURES for b in FEATURES)
    return f"WITH x AS ({_scaled_sql()}) {pairs}"


@query("loadings_covariance", ["G6", "G7"], with_tables(_covariance_sql(), "season"), doubles=["cov"], digits=5)
def loadings_covariance(spark, d):
    """The covariance of the features, rebuilt from all loadings and explained shares of a fitted model."""
    scaled = materialize(_scaled(spark, d), "scaled")
    model = archetypes.fit_pca(scaled, variance=1.1)
    total = scaled.agg(sum((F.var_samp(c) for c in FEATURES), F.lit(0.0)).alias("total"))
    loads = archetypes.pca_loadings(scaled, model)
    shares = spark.createDataFrame([(f"PC{i + 1}", v) for i, v in enumerate(model.explained)], "component string, share double")
    left = loads.join(shares, "component").select("component", F.col("feature").alias("a"), (F.col("loading") * F.col("share")).alias("x"))
    right = loads.select("component", F.col("feature").alias("b"), F.col("loading").alias("y"))
    sums = left.join(right, "component").groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("part"))
    return sums.select("a", "b", (F.col("part") * total.scalar()).alias("cov"))


def _embedding_columns(spark, d):
    rows = read_table(spark, d, "embeddings")
    names = [f"e{i}" for i in range(64)]
    return rows.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), names


@query("embedding_clusters", ["G6", "G8", "G11"], None)
def embedding_clusters(spark, d):
    """Clusters found without the labels, against the labels."""
    rows, names = _embedding_columns(spark, d)
    scaled = archetypes.preprocess(rows, names)
    model = archetypes.fit_pca(scaled, names)
    vectors = materialize(archetypes.component_vectors(archetypes.project(scaled, model), model.n_components), "vectors")
    clustered = archetypes.fit_kmeans(vectors, 10).assign(vectors, "_v")
    return clustered.groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query("cluster_count_scan", ["G11"], None)
def cluster_count_scan(spark, d):
    """All published numbers of clusters, ten starts each."""
    scaled = _scaled(spark, d)
    model = archetypes.fit_pca(scaled)
    return archetypes.k_scan(materialize(archetypes.project(scaled, model), "projected"), model.n_components, K_RANGE)


_PROFILE = FEATURES


@query(
    "cluster_profile",
    ["G12"],
    with_tables(
        f"""SELECT p.*, {", ".join(f"(mean_{c} - avg(mean_{c}) OVER ()) / nullif(stddev_pop(mean_{c}) OVER (), 0) AS z_{c}" for c in _PROFILE)}, u.position_name
            FROM (SELECT cluster, count(*) AS size, {", ".join(f"avg({c}) AS mean_{c}" for c in _PROFILE)}
                  FROM season JOIN assignments USING ({_IDS}) GROUP BY 1) p
            JOIN (SELECT cluster, position_name FROM season JOIN assignments USING ({_IDS}) GROUP BY 1, 2
                  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, position_name) = 1) u USING (cluster)""",
        "season", "assignments",
    ),
    doubles=[f"{p}_{c}" for p in ("mean", "z") for c in _PROFILE],
    longs=["cluster"],
)
def cluster_profile(spark, d):
    keys = ["player_id", "competition_id", "season_id"]
    run = base.Run(spark, d, "season")
    named = run.season.join(run.assignments.select(*keys, "cluster"), on=keys)
    return archetypes.cluster_profile(named, "cluster", _PROFILE, "position_name")


@query(
    "component_scores",
    ["G13"],
    with_tables(
        f"""SELECT {_IDS}, sum(z * loading) FILTER (component = 'PC1') AS pc1, sum(z * loading) FILTER (component = 'PC2') AS pc2
            FROM (SELECT {_IDS}, feature, (value - avg(value) OVER (PARTITION BY feature)) / nullif(stddev_samp(value) OVER (PARTITION BY feature), 0) AS z
                  FROM (UNPIVOT (SELECT {_IDS}, {", ".join(FEATURES)} FROM season) ON {", ".join(FEATURES)} INTO NAME feature VALUE value))
            JOIN loadings USING (feature) GROUP BY 1, 2, 3""",
        "season", "loadings",
    ),
    doubles=["pc1", "pc2"],
    longs=["competition_id", "season_id"],
)
def component_scores(spark, d):
    return marts.season_coordinates(base.Run(spark, d).season, base.loadings(spark))


@query(
    "nearest_vectors",
    ["G14"],
    """SELECT v.vec_id, sqrt(list_sum([power(v.embedding[i]::DOUBLE - t.embedding[i]::DOUBLE, 2) FOR i IN range(1, 65)])) AS distance
       FROM embeddings v, (SELECT * FROM embeddings WHERE vec_id = 7) t WHERE v.vec_id <> 7 AND v.label = t.label
       ORDER BY distance, v.vec_id LIMIT 10""",
    doubles=["distance"],
)
def nearest_vectors(spark, d):
    rows, names = _embedding_columns(spark, d)
    return archetypes.similar_players(rows, "vec_id", 7, names, 10, same="label").select("vec_id", "distance")




@query(
    "trained_archetype_totals",
    ["G6", "G8", "G9", "G10"],
    with_tables(
        """SELECT count(*) AS n_rows, count(*) FILTER (position_name = 'Goalkeeper') AS n_keepers, 5::BIGINT AS n_clusters, 6::BIGINT AS n_labels,
                  count(*) FILTER (position_name <> 'Goalkeeper') AS n_placed, sum(total_minutes) AS minutes FROM season""",
        "season",
    ),
    doubles=["minutes"],
    digits=3,
)
def trained_archetype_totals(spark, d):
    """What must hold for any trained model: everyone is placed once, all clusters and labels occur."""
    rows = archetypes.assign_archetypes(base.Run(spark, d, "season").season)[0]
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("cluster") == -1).alias("n_keepers"),
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        F.count_distinct("archetype").alias("n_labels"),
        F.count_if(F.col("pc1").isNotNull() & F.col("pc2").isNotNull()).alias("n_placed"),
        F.sum("total_minutes").alias("minutes"),
    )


def _spread_sql(n: int) -> str:
    return ", ".join(f"var_pop(embedding[{i + 1}]::DOUBLE)" for i in range(n))


@query(
    "component_variances",
    ["G6"],
    f"""SELECT 64::BIGINT AS n_components, list_sum([{_spread_sql(64)}]) AS total_variance, 1.0::DOUBLE AS explained,
               0.0::DOUBLE AS largest_mean FROM embeddings""",
    doubles=["total_variance", "explained", "largest_mean"],
)
def component_variances(spark, d):
    """A full PCA of the raw vectors keeps the total variance, and its scores have mean zero around the centre."""
    rows, names = _embedding_columns(spark, d)
    kept = materialize(rows, "vectors")
    model = archetypes.fit_pca(kept, names)
    projected = archetypes.project(kept, model)
    means = kept.agg(*[F.avg(n).alias(n) for n in names])
    centre = archetypes.project(means, model).select(F.col("components").alias("c"))
    stats = projected.agg(
        *[F.var_pop(F.element_at("components", i + 1)).alias(f"v{i}") for i in range(64)],
        F.array(*[F.avg(F.element_at("components", i + 1)) for i in range(64)]).alias("m"),
    ).withColumn("c", centre.scalar())
    total = sum((F.col(f"v{i}") for i in range(64)), F.lit(0.0))
    off = F.array_max(F.transform(F.arrays_zip("m", "c"), lambda x: F.abs(x["m"] - x["c"])))
    return stats.select(
        F.lit(64).alias("n_components"), total.alias("total_variance"),
        F.lit(sum(model.explained)).alias("explained"), off.alias("largest_mean"),
    )


@query(
    "cluster_partition",
    ["G8", "G11"],
    "SELECT count(*) AS n, 10::BIGINT AS clusters, true AS every_row_has_its_nearest_centre FROM embeddings",
)
def cluster_partition(spark, d):
    """K-Means gives every vector to its nearest centre."""
    rows, names = _embedding_columns(spark, d)
    vectors = materialize(rows.withColumn("_v", F.array(*names)), "vectors")
    model = archetypes.fit_kmeans(vectors, 10)
    clustered = model.assign(vectors, "_v")
    distances = []
    for centre in model.points:
        total = F.lit(0.0)
        for n, c in zip(names, centre):
            total = total + (F.col(n) - F.lit(float(c))) * (F.col(n) - F.lit(float(c)))
        distances.append(total)
    near = clustered.withColumn("_d", F.array(*distances)).withColumn(
        "_ok", F.element_at("_d", F.col("cluster") + 1) <= F.array_min("_d") + 1e-9
    )
    return near.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cluster").alias("clusters"),
        F.bool_and("_ok").alias("every_row_has_its_nearest_centre"),
    )


@query(
    "embedding_silhouette",
    ["G11"],
    """WITH s AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
                  ORDER BY (vec_id * 7919) % 1000003, vec_id LIMIT 2000),
            sums AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS total, count(*) AS n
                     FROM s a, s b GROUP BY 1, 2, 3),
            parts AS (SELECT vec_id, max(n) FILTER (label = other) AS size, max(total) FILTER (label = other) AS own,
                             min(total / n) FILTER (label <> other) AS near FROM sums GROUP BY vec_id),
            means AS (SELECT CASE WHEN size > 1 THEN own / (size - 1) END AS own, near FROM parts)
       SELECT count(*) AS n_rows, avg(CASE WHEN own IS NULL THEN 0 ELSE (near - own) / greatest(near, own) END) AS silhouette FROM means""",
    doubles=["silhouette"],
)
def embedding_silhouette(spark, d):
    """How well the given labels part the vectors, on the published number of sampled rows."""
    rows = read_table(spark, d, "embeddings")
    order = [(F.col("vec_id") * 7919) % 1000003, F.col("vec_id")]
    return silhouettes(rows, "embedding", ["label"], order).select("n_rows", "silhouette")


@query(
    "similar_vectors",
    ["G14"],
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
            pairs AS (SELECT a.vec_id AS "query", b.vec_id AS "key", list_distance(a.e, b.e) AS distance
                      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
       SELECT *, row_number() OVER (PARTITION BY "query" ORDER BY distance, "key") AS "rank" FROM pairs
       QUALIFY "rank" <= 10""",
    doubles=["distance"],
    digits=5,
)
def similar_vectors(spark, d):
    """Ten nearest vectors of every twentieth one, out of all, by pivots."""
    rows = read_table(spark, d, "embeddings")
    index = neighbours.build_index(rows, "vec_id", "embedding")
    return neighbours.nearest(index, rows.where("vec_id % 20 = 0"), "vec_id", "embedding", 10).drop("compared")
