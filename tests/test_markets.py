"""Markets on every order, and links of misspelled slugs."""

import datetime as dt

from touchline.plans import markets
from touchline.sources.readers import read_table
from touchline.workload import feeds


def test_every_order_has_its_markets_tokens_and_trades(spark, folder):
    orders = {r[0] for r in read_table(spark, folder, "orders").select("o_orderkey").collect()}
    rows = feeds.markets(spark, folder).select("market_id", "event_slug").collect()
    assert {r.market_id // feeds.MARKETS for r in rows} == orders and len(rows) == feeds.MARKETS * len(orders)
    ids = {r.market_id for r in rows}
    assert {r[0] for r in feeds.tokens(spark, folder).select("market_id").distinct().collect()} == ids
    assert {r[0] for r in feeds.trades(spark, folder).select("market_id").distinct().collect()} <= ids


DAY = dt.date(2024, 3, 1)


def tables(spark):
    matches = [
        (1, DAY, "La Liga", "Ajax", "Bilbao"), (2, DAY, "La Liga", "Ajax", "Betis"), (3, DAY + dt.timedelta(1), "La Liga", "Ajax", "Bilbao"),
        (4, DAY, "Serie A", "Ajax", "Bilbao"), (5, DAY, "La Liga", "Cadiz", "Cadis"), (6, DAY, "La Liga", "Cadis", "Cadiz"),
    ]
    codes = [("Ajax", "aja"), ("Bilbao", "bil"), ("Betis", "bet"), ("Cadiz", "cad"), ("Cadis", "cas")]
    return (
        spark.createDataFrame(matches, "match_id long, match_date date, competition_name string, home_team string, away_team string"),
        spark.createDataFrame(codes, "team string, code string"),
    )


def linked(spark, slugs, **more):
    matches, codes = tables(spark)
    stats = spark.createDataFrame([(i, s) for i, s in enumerate(slugs)], "event long, event_slug string")
    out = markets.link_markets_near(stats, matches, {"lal": "La Liga", "sea": "Serie A"}, codes, key="event", **more)
    return {r.event: (r.match_id, r.wrong_letters, r.days_off) for r in out.collect()}


def test_best_match_of_each_slug(spark):
    slugs = [
        "lal-aja-bil-2024-03-01",  # as written
        "lal-axa-bil-2024-03-01",  # one wrong letter
        "lal-axa-bix-2024-03-01",  # one on each side
        "lal-xxa-bil-2024-03-01",  # two on one side
        "lal-aja-bet-2024-02-29",  # a day early
        "lal-aja-bil-2024-02-28",  # two days early
        "lal-aja-bxl-2024-03-02",  # the right day wins over the nearer letters being equal
        "sea-aja-bil-2024-03-01", "xyz-aja-bil-2024-03-01", "lal-winner-2024", "lal-aja-bil-2024-13-01", None,
        "lal-ca?-cas-2024-03-01", "lal-cax-cax-2024-03-01",
    ]
    got = linked(spark, slugs)
    assert got == {0: (1, 0, 0), 1: (1, 1, 0), 2: (1, 2, 0), 4: (2, 0, 1), 6: (3, 1, 0), 7: (4, 0, 0), 13: (5, 2, 0)}


def test_more_days_and_no_rows(spark):
    assert linked(spark, ["lal-aja-bil-2024-02-28"], days=2) == {0: (1, 0, 2)}
    assert linked(spark, []) == {}


def test_quality_of_links(spark):
    links = spark.createDataFrame([("a", 1), ("b", 2), ("c", 9)], "slug string, match_id long")
    truth = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4), ("e", 5)], "slug string, match_id long")
    row = markets.link_quality(links, truth, "slug").first()
    assert (row.events, row.links, row.right_links, row.recall, row.precision) == (4, 3, 1, 0.25, 1 / 3)


def test_planted_misspellings_are_linked(spark, folder):
    from touchline.workload.q_markets import near_link_quality

    row = near_link_quality(spark, folder).first()
    assert row.events > 500 and row.recall > 0.95 and row.precision > 0.95


def test_near_links_broadcast_no_side_that_grows(spark):
    """The exploded sides used to be broadcast because their stored size is small."""
    matches, codes = tables(spark)
    stats = spark.createDataFrame([(1, "lal-axa-bil-2024-03-01")], "event long, event_slug string")
    near = markets.link_markets_near(stats, matches, {"lal": "La Liga"}, codes, key="event")
    exact = markets.link_markets(stats.selectExpr("event_slug", "1L AS market_count", "1D AS total_volume"), matches, {"lal": "La Liga"}, codes)
    for plan in (near, exact):
        text = plan._jdf.queryExecution().sparkPlan().toString()
        # the two joins with the team list only
        assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 2


def test_repeated_fixtures_link_to_their_first_match(spark):
    matches, codes = tables(spark)
    again = matches.union(matches.selectExpr("match_id + 10", "match_date", "competition_name", "home_team", "away_team"))
    again = again.union(matches.filter("match_id = 4").selectExpr("NULL", "match_date", "competition_name", "home_team", "away_team"))
    stats = spark.createDataFrame([(1, "lal-axa-bil-2024-03-01"), (2, "sea-aja-bil-2024-03-01")], "event long, event_slug string")
    out = markets.link_markets_near(stats, again, {"lal": "La Liga", "sea": "Serie A"}, codes, key="event")
    assert {r.event: r.match_id for r in out.collect()} == {1: 1, 2: None}
