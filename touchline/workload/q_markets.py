"""Prediction markets and national teams."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.constants import RATING_BLOCK
from touchline.operators.windows import as_of_join
from touchline.plans import international, markets
from touchline.session import materialize
from touchline.sources.readers import read_table
from touchline.workload import base, feeds
from touchline.workload.registry import query
from touchline.workload.tables_sql import in_list, with_tables

_STATS = """SELECT event_slug, count(*) AS market_count, sum(volume) AS total_volume, min(created_at)::TIMESTAMP AS first_start,
    max(end_date)::TIMESTAMP AS last_end FROM markets GROUP BY 1"""


@query("market_events", ["J1"], with_tables(_STATS, "markets"), doubles=["total_volume"], texts=["first_start", "last_end"])
def market_events(spark, d):
    return markets.event_stats(feeds.markets(spark, d))


_SUMMARY = """SELECT m.market_id, question, event_slug, category, volume, active, closed, coalesce(token_count, 0) AS token_count,
    coalesce(trade_count, 0) AS trade_count, first_trade, last_trade FROM markets m
    LEFT JOIN (SELECT market_id, count(*) AS token_count FROM tokens GROUP BY 1) USING (market_id)
    LEFT JOIN (SELECT market_id, count(*) AS trade_count, min("timestamp") AS first_trade, max("timestamp") AS last_trade FROM trades GROUP BY 1) USING (market_id)"""


@query("market_summary", ["J2"], with_tables(_SUMMARY, "markets", "tokens", "trades"), doubles=["volume"], texts=["first_trade", "last_trade"])
def market_summary(spark, d):
    return markets.market_summary(feeds.markets(spark, d), feeds.tokens(spark, d), feeds.trades(spark, d))


@query(
    "market_totals",
    ["J3"],
    with_tables(
        """SELECT count(*) AS markets, count(*) FILTER (active) AS active_markets, count(*) FILTER (closed) AS closed_markets,
                  sum(volume) AS total_volume, median(volume) AS median_volume FROM markets""",
        "markets",
    ),
    doubles=["total_volume", "median_volume"],
    digits=2,
)
def market_totals(spark, d):
    return markets.market_totals(feeds.markets(spark, d))


@query(
    "markets_by_month",
    ["J4", "D30"],
    with_tables("SELECT date_trunc('month', created_at)::TIMESTAMP AS month, count(*) AS n FROM markets GROUP BY 1", "markets"),
    texts=["month"],
)
def markets_by_month(spark, d):
    return markets.monthly(feeds.markets(spark, d), "created_at", [F.count(F.lit(1)).alias("n")])


@query(
    "top_markets",
    ["J4", "F2"],
    with_tables("SELECT market_id, volume, ln(1 + volume) AS log_volume FROM markets ORDER BY volume DESC, market_id LIMIT 15", "markets"),
    doubles=["volume", "log_volume"],
)
def top_markets(spark, d):
    return markets.top_by_volume(feeds.markets(spark, d)).select("market_id", "volume", F.log1p("volume").alias("log_volume"))


@query(
    "market_volume_histogram",
    ["J4", "D23"],
    with_tables("SELECT floor(log10(greatest(volume, 1)) / 0.25)::BIGINT AS bin, count(*) AS n FROM markets GROUP BY 1", "markets"),
)
def market_volume_histogram(spark, d):
    return markets.volume_histogram(feeds.markets(spark, d))


@query(
    "tokens_per_market",
    ["J5"],
    with_tables("SELECT tokens, count(*) AS markets FROM (SELECT market_id, count(*) AS tokens FROM tokens GROUP BY 1) GROUP BY 1", "tokens"),
)
def tokens_per_market(spark, d):
    return markets.tokens_per_market(feeds.tokens(spark, d))


@query(
    "common_outcomes",
    ["J5"],
    with_tables("SELECT outcome, count(*) AS n FROM tokens GROUP BY 1 ORDER BY n DESC, outcome LIMIT 10", "tokens"),
)
def common_outcomes(spark, d):
    return markets.common_outcomes(feeds.tokens(spark, d))


@query(
    "trade_stats",
    ["J6"],
    with_tables(
        """SELECT side, count(*) AS trade_count, sum(size) AS total_size, round(avg(price), 4) AS avg_price, round(min(price), 4) AS min_price,
                  round(max(price), 4) AS max_price FROM trades GROUP BY 1""",
        "trades",
    ),
    doubles=["total_size", "avg_price", "min_price", "max_price"],
    digits=4,
)
def trade_stats(spark, d):
    return markets.trade_stats(feeds.trades(spark, d))


@query(
    "monthly_trades",
    ["J7"],
    with_tables(
        """SELECT date_trunc('month', "timestamp")::TIMESTAMP AS month, count(*) AS num_trades, round(sum(size), 0) AS total_size FROM trades GROUP BY 1""",
        "trades",
    ),
    doubles=["total_size"],
    texts=["month"],
)
def monthly_trades(spark, d):
    return markets.monthly_trades(feeds.trades(spark, d))


@query(
    "top_takers",
    ["J8"],
    with_tables(
        "SELECT taker_address, count(*) AS trades, round(sum(size), 2) AS total_size FROM trades GROUP BY 1 ORDER BY total_size DESC, taker_address LIMIT 15",
        "trades",
    ),
    doubles=["total_size"],
    digits=2,
)
def top_takers(spark, d):
    return markets.top_takers(feeds.trades(spark, d))


@query(
    "repaired_odds_times",
    ["J9"],
    with_tables(
        """SELECT event_id, make_timestamp(epoch_ms("timestamp") * 1000000) AS "timestamp" FROM odds""",
        "odds",
    ),
    texts=['"timestamp"'],
)
def repaired_odds_times(spark, d):
    return markets.fix_epoch(feeds.odds(spark, d)).select("event_id", "timestamp")


@query(
    "price_check",
    ["J10"],
    with_tables(
        """SELECT count(*) AS rows, count(*) FILTER (price < 0) AS below, count(*) FILTER (price > 1) AS above, min(price) AS min_price, max(price) AS max_price FROM odds""",
        "odds",
    ),
    doubles=["min_price", "max_price"],
)
def price_check(spark, d):
    return markets.price_check(feeds.odds(spark, d))


@query(
    "clamped_prices",
    ["J10"],
    with_tables("SELECT token_id, avg(least(1, greatest(0, price))) AS mean_price FROM odds GROUP BY 1", "odds"),
    doubles=["mean_price"],
)
def clamped_prices(spark, d):
    return markets.clamp_price(feeds.odds(spark, d)).groupBy("token_id").agg(F.avg("price").alias("mean_price"))


@query(
    "busiest_market_odds",
    ["J11"],
    with_tables(
        f"""WITH s AS ({_SUMMARY}) SELECT event_id, token_id, price FROM odds
            WHERE market_id = (SELECT market_id FROM s WHERE market_id IN (SELECT market_id FROM odds) ORDER BY trade_count DESC, market_id LIMIT 1)""",
        "markets", "tokens", "trades", "odds",
    ),
    doubles=["price"],
)
def busiest_market_odds(spark, d):
    odds = feeds.odds(spark, d)
    summary = markets.market_summary(feeds.markets(spark, d), feeds.tokens(spark, d), feeds.trades(spark, d))
    quoted = summary.join(odds.select("market_id"), on="market_id", how="left_semi")
    return markets.odds_series(odds, quoted).select("event_id", "token_id", "price")


@query(
    "slug_prefix_volume",
    ["J12"],
    with_tables(
        f"""SELECT regexp_extract(event_slug, '^([a-z]+)-', 1) AS competition_prefix, sum(total_volume) AS total_volume, count(*) AS events
            FROM ({_STATS}) WHERE regexp_extract(event_slug, '^([a-z]+)-', 1) <> '' GROUP BY 1 ORDER BY total_volume DESC, competition_prefix LIMIT 15""",
        "markets",
    ),
    doubles=["total_volume"],
    digits=2,
)
def slug_prefix_volume(spark, d):
    return markets.slug_prefix_volume(markets.event_stats(feeds.markets(spark, d)))


@query(
    "url_prefixes",
    ["J12"],
    """SELECT regexp_extract(url, '^([a-z]+)', 1) AS scheme, regexp_extract(url, '//([^/]+)', 1) AS host, count(*) AS n FROM pages GROUP BY 1, 2""",
)
def url_prefixes(spark, d):
    from touchline.functions.text import regex_group

    pages = read_table(spark, d, "pages").select("url")
    return pages.groupBy(regex_group("url", "^([a-z]+)").alias("scheme"), regex_group("url", "//([^/]+)").alias("host")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "linked_markets",
    ["J13"],
    with_tables(
        f"""SELECT event_slug, m.match_id, m.home_team, m.away_team, m.match_date, market_count, total_volume
            FROM ({_STATS}) s JOIN (
                SELECT *, substr(home_team, 6)::INT AS t, substr(away_team, 6)::INT AS a FROM stg_matches) m
            ON s.event_slug = (['lal', 'epl', 'bun', 'sea', 'fl1', 'wcup', 'euro', 'copa'])[m.competition_id] || '-'
               || chr(97 + t // 676) || chr(97 + t // 26 % 26) || chr(97 + t % 26) || '-' || chr(97 + a // 676) || chr(97 + a // 26 % 26) || chr(97 + a % 26)
               || '-' || strftime(m.match_date, '%Y-%m-%d')""",
        "markets", "stg_matches",
    ),
    doubles=["total_volume"],
    texts=["match_date"],
)
def linked_markets(spark, d):
    matches = base.Run(spark, d).stg_matches
    codes = dict(zip(feeds.COMPETITION_CODES, feeds.COMPETITIONS))
    return markets.link_markets(markets.event_stats(feeds.markets(spark, d)), matches, codes, feeds.team_codes(matches))


_DAY = "substr(source_slug, -2)::INT"
_NOISY = f"""SELECT source_slug, p[1] AS competition,
        CASE WHEN {_DAY} % 7 = 3 THEN p[2][1] || 'x' || p[2][3] ELSE p[2] END AS home,
        CASE WHEN {_DAY} % 5 = 2 THEN p[3][1:2] || 'q' ELSE p[3] END AS away,
        (p[4] || '-' || p[5] || '-' || p[6])::DATE + CASE WHEN {_DAY} % 11 = 4 THEN 1 ELSE 0 END AS day
    FROM (SELECT event_slug AS source_slug, string_split(event_slug, '-') AS p FROM ({_STATS})) WHERE len(p) = 6"""
_CODE = "chr(97 + {0} // 676) || chr(97 + {0} // 26 % 26) || chr(97 + {0} % 26)"
_CODED = f"""SELECT *, (['lal', 'epl', 'bun', 'sea', 'fl1', 'wcup', 'euro', 'copa'])[competition_id] AS competition,
        {_CODE.format("substr(home_team, 6)::INT")} AS h, {_CODE.format("substr(away_team, 6)::INT")} AS a FROM stg_matches"""
_NEAR = f"""SELECT source_slug, levenshtein(home, h) + levenshtein(away, a) AS wrong_letters, abs(match_date - day) AS days_off,
        match_id, home_team, away_team, match_date
    FROM ({_NOISY}) n JOIN ({_CODED}) m USING (competition)
    WHERE abs(match_date - day) <= 1 AND levenshtein(home, h) <= 1 AND levenshtein(away, a) <= 1
    QUALIFY row_number() OVER (PARTITION BY source_slug ORDER BY wrong_letters, days_off, match_id, home_team, away_team) = 1"""
_TRUE = f"""SELECT event_slug AS source_slug, match_id FROM ({_STATS}) s JOIN ({_CODED}) m
    ON event_slug = competition || '-' || h || '-' || a || '-' || strftime(match_date, '%Y-%m-%d')"""


def _near_links(spark, d):
    matches = base.Run(spark, d, "stg_matches").stg_matches
    codes = dict(zip(feeds.COMPETITION_CODES, feeds.COMPETITIONS))
    teams = feeds.team_codes(matches)
    stats = materialize(feeds.misspelled(markets.event_stats(feeds.markets(spark, d))), "event-stats")
    truth = markets.link_markets(stats.drop("event_slug").withColumnRenamed("source_slug", "event_slug"), matches, codes, teams)
    return markets.link_markets_near(stats, matches, codes, teams, key="source_slug"), truth.withColumnRenamed("event_slug", "source_slug")


@query(
    "near_linked_markets",
    ["J13"],
    with_tables(_NEAR, "markets", "stg_matches"),
    longs=["wrong_letters", "days_off"],
    texts=["match_date"],
)
def near_linked_markets(spark, d):
    """Events whose slugs have wrong letters and days, each with its best match."""
    return _near_links(spark, d)[0]


@query(
    "near_link_quality",
    ["J13"],
    with_tables(
        f"""SELECT count(t.match_id) AS events, count(n.match_id) AS links, count(*) FILTER (n.match_id = t.match_id) AS right_links,
                   right_links / count(t.match_id) AS recall, right_links / count(n.match_id) AS precision
            FROM ({_TRUE}) t FULL JOIN ({_NEAR}) n USING (source_slug)""",
        "markets", "stg_matches",
    ),
    doubles=["recall", "precision"],
)
def near_link_quality(spark, d):
    links, truth = _near_links(spark, d)
    return markets.link_quality(links, truth, "source_slug")


@query(
    "edge_scan",
    ["J14", "C9"],
    with_tables(
        f"""SELECT p.event_id, p.token_id, probability, o.price, probability - o.price AS edge
           FROM (SELECT event_id, user_id * {feeds.MARKETS} * 10 + event_id % 2 AS token_id, ts + INTERVAL 1 HOUR AS at, 0.5::DOUBLE AS probability FROM events WHERE event_type = 'view') p
           ASOF LEFT JOIN (SELECT token_id, make_timestamp(epoch_ms("timestamp") * 1000000) AS at, max(least(1, greatest(0, price))) AS price FROM odds GROUP BY 1, 2) o
           ON o.token_id = p.token_id AND o.at <= p.at""",
        "odds",
    ),
    doubles=["probability", "price", "edge"],
)
def edge_scan(spark, d):
    predictions = read_table(spark, d, "events").filter("event_type = 'view'").selectExpr(
        "event_id", f"user_id * {feeds.MARKETS} AS market_id", f"user_id * {feeds.MARKETS} * 10 + event_id % 2 AS token_id",
        "cast(ts AS timestamp) + INTERVAL 1 HOUR AS predicted_at", "0.5D AS probability",
    )
    return markets.edge_scan(predictions, markets.fix_epoch(feeds.odds(spark, d))).select("event_id", "token_id", "probability", "price", "edge")


# --- national teams -----------------------------------------------------------------------------------

_TOP = ", ".join(f"list_avg(list_sort(list({c}) FILTER ({c} IS NOT NULL), 'DESC')[1:11]) AS top11_{c}" for c in ("overall", *RATING_BLOCK))
STRENGTH = f"""SELECT intl_team, year, count(DISTINCT player_id) AS n_players, avg(overall) AS mean_overall, count(*) FILTER (overall >= 75) AS depth_75,
    count(*) FILTER (was_world_cup_squad_member) AS wc_squad_n, max(overall) FILTER (primary_position = 'GK') AS gk_overall_max, {_TOP}
    FROM players_h GROUP BY 1, 2"""


@query("team_strength", ["J15", "E13"], with_tables(STRENGTH, "players_h"),
       doubles=["mean_overall", "top11_overall", *[f"top11_{c}" for c in RATING_BLOCK]])
def team_strength(spark, d):
    return international.team_strength(base.Run(spark, d).rated_players)


_MATCH_STRENGTH = f"""WITH s AS ({STRENGTH}), f AS (
    SELECT m.match_id, h.top11_overall AS home_top11, a.top11_overall AS away_top11, h.top11_overall - a.top11_overall AS top11_diff,
           h.depth_75 AS home_depth_75, a.depth_75 AS away_depth_75,
           (h.top11_overall IS NOT NULL AND a.top11_overall IS NOT NULL)::BIGINT AS has_squad_ratings, (home_score > away_score)::BIGINT AS home_win
    FROM results_now m LEFT JOIN s h ON h.intl_team = m.home_team AND h.year = year(m.date)
    LEFT JOIN s a ON a.intl_team = m.away_team AND a.year = year(m.date))"""
_FRAME = ["match_id", "home_top11", "away_top11", "top11_diff", "home_depth_75", "away_depth_75", "has_squad_ratings", "home_win"]


def _frame(spark, d):
    run = base.Run(spark, d)
    strength = international.team_strength(run.rated_players).withColumn("year", F.col("year").cast("int"))
    return international.match_strength(run.results_now, strength)


@query("match_strength", ["J16", "C6", "C10"], with_tables(f"{_MATCH_STRENGTH} SELECT * FROM f", "players_h", "results_now"),
       doubles=["home_top11", "away_top11", "top11_diff"])
def match_strength(spark, d):
    return _frame(spark, d).select(*_FRAME)


@query(
    "strength_win_correlation",
    ["I7"],
    with_tables(
        f"{_MATCH_STRENGTH} SELECT count(*) AS n, corr(top11_diff, home_win) AS corr FROM f WHERE top11_diff IS NOT NULL AND home_win IS NOT NULL",
        "players_h", "results_now",
    ),
    doubles=["corr"],
)
def strength_win_correlation(spark, d):
    return international.gap_win_correlation(_frame(spark, d))


@query(
    "outcome_mix",
    ["J16", "D20"],
    with_tables(
        """SELECT outcome_label, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM (
               SELECT CASE WHEN home_score > away_score THEN 'home_win' WHEN home_score < away_score THEN 'away_win' ELSE 'draw' END AS outcome_label
               FROM results WHERE home_score IS NOT NULL AND away_score IS NOT NULL) GROUP BY 1""",
        "results",
    ),
    doubles=["pct"],
)
def outcome_mix(spark, d):
    return international.outcome_mix(feeds.results(spark, d))


@query(
    "name_overlap",
    ["J18", "F4", "F5"],
    with_tables(
        """SELECT coalesce(a.t, b.t) AS team, a.t IS NOT NULL AS in_profiles, b.t IS NOT NULL AS in_results
           FROM (SELECT DISTINCT intl_team AS t FROM players_h) a
           FULL JOIN (SELECT home_team AS t FROM results UNION SELECT away_team FROM results) b ON a.t = b.t""",
        "players_h", "results",
    ),
)
def name_overlap(spark, d):
    return international.name_overlap(base.Run(spark, d).rated_players, feeds.results(spark, d))


@query("rankings_by_points", ["E12"], with_tables("SELECT team, rank_date, points, rank FROM ranked", "ranked"),
       doubles=["points"], texts=["rank_date"])
def rankings_by_points(spark, d):
    return base.Run(spark, d).ranked.select("team", "rank_date", "points", "rank")


_RANKED = """SELECT m.match_id, h.rank AS home_fifa_rank, a.rank AS away_fifa_rank, h.points AS home_fifa_points, a.points AS away_fifa_points,
    h.confederation AS home_confederation, a.confederation AS away_confederation, a.rank - h.rank AS fifa_rank_diff, h.confederation = a.confederation AS same_confederation
    FROM results_now m ASOF LEFT JOIN ranked h ON h.team = m.home_team AND h.rank_date <= m.date
    ASOF LEFT JOIN ranked a ON a.team = m.away_team AND a.rank_date <= m.date"""
_RANK_COLUMNS = ["match_id", "home_fifa_rank", "away_fifa_rank", "home_fifa_points", "away_fifa_points",
                 "home_confederation", "away_confederation", "fifa_rank_diff", "same_confederation"]


@query("rank_features", ["J19", "C9"], with_tables(_RANKED, "results_now", "ranked"), doubles=["home_fifa_points", "away_fifa_points"])
def rank_features(spark, d):
    run = base.Run(spark, d, "ranked", "results_now")
    return international.rank_features(run.results_now, run.ranked).select(*_RANK_COLUMNS)


@query(
    "ratings_by_nation",
    ["D39"],
    with_tables(
        """SELECT year, nationality, count(*) AS n, round(avg(overall), 1) AS mean_ovr, round(avg(overall) FILTER (primary_position = 'GK'), 1) AS mean_gk
           FROM players WHERE nationality IN """ + in_list(feeds.PROFILE_NAMES[1:5]) + " GROUP BY 1, 2",
        "players",
    ),
    doubles=["mean_ovr", "mean_gk"],
)
def ratings_by_nation(spark, d):
    return international.ratings_by_nation(feeds.players(spark, d), feeds.PROFILE_NAMES[1:5])


@query(
    "rating_profile",
    ["D41"],
    with_tables(
        f"""SELECT primary_position, count(*) AS n, {", ".join(f"round(avg({c}), 1) AS {c}" for c in (*RATING_BLOCK, "overall"))} FROM players GROUP BY 1""",
        "players",
    ),
    doubles=[*RATING_BLOCK, "overall"],
)
def rating_profile(spark, d):
    return international.rating_profile(feeds.players(spark, d))


@query(
    "last_rank_before_match_sliced",
    ["C9"],
    with_tables(
        """SELECT m.match_id, r.rank FROM results_now m ASOF LEFT JOIN ranked r ON r.team = m.home_team AND r.rank_date <= m.date""",
        "results_now", "ranked",
    ),
)
def last_rank_before_match_sliced(spark, d):
    run = base.Run(spark, d, "ranked", "results_now")
    right = run.ranked.select(F.col("team").alias("home_team"), "rank_date", "rank")
    return as_of_join(run.results_now, right, ["home_team"], "date", "rank_date", ["rank"], slices=40).select("match_id", "rank")


