"""Prediction markets: summaries, activity, repairs, linking to matches, model edge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.labels import lookup
from touchline.functions.rates import clamp
from touchline.functions.text import slug_parts, slug_prefix
from touchline.operators.aggregates import count_by, exact_percentiles
from touchline.operators.windows import as_of_join


def event_stats(markets: DataFrame) -> DataFrame:
    return markets.groupBy("event_slug").agg(
        F.count(F.lit(1)).alias("market_count"),
        F.sum("volume").alias("total_volume"),
        F.min("created_at").alias("first_start"),
        F.max("end_date").alias("last_end"),
    )


def market_summary(markets: DataFrame, tokens: DataFrame, trades: DataFrame) -> DataFrame:
    """Token and trade counts with first and last trade; both sides are summed before the joins."""
    per_market_tokens = tokens.groupBy("market_id").agg(F.count(F.lit(1)).alias("token_count"))
    per_market_trades = trades.groupBy("market_id").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.min("timestamp").alias("first_trade"),
        F.max("timestamp").alias("last_trade"),
    )
    base = markets.select("market_id", "question", "event_slug", "category", "volume", "active", "closed")
    return (
        base.join(per_market_tokens, on="market_id", how="left")
        .join(per_market_trades, on="market_id", how="left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("token_count", "trade_count")})
    )


def market_totals(markets: DataFrame) -> DataFrame:
    middle = exact_percentiles(markets, ["volume"], [0.5]).agg(F.first("value")).scalar()
    return markets.agg(
        F.count(F.lit(1)).alias("markets"),
        F.count_if("active").alias("active_markets"),
        F.count_if("closed").alias("closed_markets"),
        F.sum("volume").alias("total_volume"),
    ).withColumn("median_volume", middle)


def monthly(df: DataFrame, ts: str, aggs: Sequence, name: str = "month") -> DataFrame:
    return df.groupBy(F.date_trunc("month", F.col(ts)).alias(name)).agg(*aggs)


def volume_histogram(markets: DataFrame, bin_width: float = 0.25) -> DataFrame:
    """Markets per bin of log10 volume, volumes below 1 counting as 1."""
    logged = F.log10(F.greatest(F.col("volume"), F.lit(1.0)))
    return markets.groupBy(F.floor(logged / bin_width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def top_by_volume(markets: DataFrame, n: int = 15) -> DataFrame:
    return markets.orderBy(F.desc("volume"), "market_id").limit(n)


def tokens_per_market(tokens: DataFrame) -> DataFrame:
    """How many markets have 1, 2, 3 … outcome tokens."""
    per_market = count_by(tokens, ["market_id"], "tokens")
    return count_by(per_market, ["tokens"], "markets")


def common_outcomes(tokens: DataFrame, n: int = 10) -> DataFrame:
    return count_by(tokens, ["outcome"], "n").orderBy(F.desc("n"), "outcome").limit(n)


def trade_stats(trades: DataFrame) -> DataFrame:
    return trades.groupBy("side").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.round(F.sum("size"), 2).alias("total_size"),
        F.round(F.avg("price"), 4).alias("avg_price"),
        F.round(F.min("price"), 4).alias("min_price"),
        F.round(F.max("price"), 4).alias("max_price"),
    )


def monthly_trades(trades: DataFrame) -> DataFrame:
    return monthly(trades, "timestamp", [F.count(F.lit(1)).alias("num_trades"), F.round(F.sum("size"), 0).alias("total_size")])


def top_takers(trades: DataFrame, n: int = 15) -> DataFrame:
    """Largest takers by size. A blank address is one taker, summed map-side like the others."""
    sums = trades.groupBy("taker_address").agg(
        F.count(F.lit(1)).alias("trades"), F.round(F.sum("size"), 2).alias("total_size")
    )
    return sums.orderBy(F.desc("total_size"), "taker_address").limit(n)


def fix_epoch(odds: DataFrame, column: str = "timestamp", before: str = "1971-01-01") -> DataFrame:
    """Repairs times whose epoch seconds were read as milliseconds; sane times stay."""
    stored = F.col(column).cast("timestamp")
    broken = stored < F.lit(before).cast("timestamp")
    return odds.withColumn(column, F.when(broken, F.timestamp_seconds(F.unix_millis(stored))).otherwise(stored))


def price_check(odds: DataFrame, column: str = "price") -> DataFrame:
    return odds.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(column) < 0).alias("below"),
        F.count_if(F.col(column) > 1).alias("above"),
        F.min(column).alias("min_price"),
        F.max(column).alias("max_price"),
    )


def clamp_price(odds: DataFrame, column: str = "price") -> DataFrame:
    return odds.withColumn(column, clamp(column, 0.0, 1.0))


def odds_series(odds: DataFrame, summary: DataFrame) -> DataFrame:
    """Odds of the most traded market by token and time."""
    key = F.struct(F.col("trade_count"), (-F.col("market_id")).alias("first"))
    busiest = summary.agg(F.max_by("market_id", key)).scalar()
    return odds.filter(F.col("market_id") == busiest).orderBy("token_id", "timestamp")


def slug_prefix_volume(stats: DataFrame, n: int = 15) -> DataFrame:
    sums = (
        stats.withColumn("competition_prefix", slug_prefix("event_slug"))
        .filter(F.col("competition_prefix").isNotNull())
        .groupBy("competition_prefix")
        .agg(F.sum("total_volume").alias("total_volume"), F.count(F.lit(1)).alias("events"))
    )
    return sums.orderBy(F.desc("total_volume"), "competition_prefix").limit(n)


def _parsed_slugs(stats: DataFrame, competitions: Mapping[str, str], slug: str = "event_slug") -> DataFrame:
    parsed = stats.select("*", *[e.alias(n) for n, e in slug_parts(slug).items()])
    return parsed.filter(F.col("slug_date").isNotNull()).withColumn("competition_name", lookup("competition_code", competitions))


def _coded_sides(matches: DataFrame, team_codes: DataFrame) -> DataFrame:
    sides = matches.select("match_id", "match_date", "competition_name", "home_team", "away_team")
    for side in ("home", "away"):
        codes = team_codes.select(F.col("team").alias(f"{side}_team"), F.col("code").alias(f"{side}_code"))
        # the team list is the small side, whatever the sizes are taken to be
        sides = sides.join(F.broadcast(codes), on=f"{side}_team", how="inner")
    return sides


def link_markets(
    stats: DataFrame, matches: DataFrame, competitions: Mapping[str, str], team_codes: DataFrame
) -> DataFrame:
    """Event slugs matched to matches by competition, both team codes and date.

    ``competitions`` maps a slug code to a competition name; ``team_codes`` has
    (team, code). All four parts are equality keys of one join, whose sides
    both grow with the matches and are never sent whole to one place.
    """
    parsed = _parsed_slugs(stats, competitions)
    keyed = _coded_sides(matches, team_codes).withColumnRenamed("match_date", "slug_date")
    on = ["competition_name", "home_code", "away_code", "slug_date"]
    return parsed.join(keyed.hint("merge"), on=on, how="inner").select(
        "event_slug", "match_id", "home_team", "away_team", F.col("slug_date").alias("match_date"), "market_count", "total_volume"
    )


def _blanked(code: str) -> Column:
    """The three patterns of a code with one letter left open; codes with at most one wrong letter share one."""
    letter = [F.substring(code, i, 1) for i in (1, 2, 3)]
    return F.array(*[F.concat(*[F.lit("?") if i == k else letter[i] for i in range(3)]) for k in range(3)])


def link_markets_near(
    stats: DataFrame,
    matches: DataFrame,
    competitions: Mapping[str, str],
    team_codes: DataFrame,
    key: str = "event_slug",
    slug: str = "event_slug",
    days: int = 1,
) -> DataFrame:
    """The best match of each event whose slug may be misspelled.

    Either code may have one wrong letter, and the date may be ``days`` off.
    Candidates meet on competition, date and both codes with one letter left
    open, so blocks hold alike codes of one day and competition only. The match with the fewest wrong
    letters wins, then the nearest date, then the smallest id. ``key`` names
    an event; events without a match have no row, nor have slugs of another
    form. Two teams with one code both count. Of the matches of two teams on
    one day the smallest id stands for all, and equal codes meet in one block,
    not in three.
    """
    parsed = _parsed_slugs(stats.select(F.col(key).alias("event"), F.col(slug).alias("slug")), competitions, "slug")
    near = F.explode(F.sequence(F.date_sub("slug_date", days), F.date_add("slug_date", days)))
    asked = parsed.select("event", "competition_name", "slug_date", F.col("home_code").alias("home"), F.col("away_code").alias("away"), near.alias("match_date"))
    asked = asked.withColumn("home_key", F.explode(_blanked("home"))).withColumn("away_key", F.explode(_blanked("away")))
    fixture = ["competition_name", "match_date", "home_team", "away_team"]
    first = F.min(F.struct("match_id")).getField("match_id").alias("match_id")
    sides = _coded_sides(matches.groupBy(*fixture).agg(first), team_codes).withColumn("home_key", F.explode(_blanked("home_code")))
    sides = sides.withColumn("away_key", F.explode(_blanked("away_code")))
    # both sides grow on the way, so their stored sizes must not make one of them a broadcast
    met = asked.join(sides.hint("merge"), on=["competition_name", "match_date", "home_key", "away_key"], how="inner")
    for code in ("home", "away"):
        met = met.filter((F.col(code) != F.col(f"{code}_code")) | F.startswith(F.col(f"{code}_key"), F.lit("?")))
    wrong = F.levenshtein("home", "home_code") + F.levenshtein("away", "away_code")
    best = F.struct(
        wrong.alias("wrong_letters"), F.abs(F.datediff("match_date", "slug_date")).alias("days_off"),
        "match_id", "home_team", "away_team", "match_date",
    )
    return met.groupBy(F.col("event").alias(key)).agg(F.min(best).alias("_best")).select(key, "_best.*")


def link_quality(links: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Events, links, right links, and their recall and precision against known links of ``key`` to ``match_id``."""
    known = truth.select(F.col(key), F.col("match_id").alias("_true"))
    both = known.join(links.select(key, "match_id"), on=key, how="full")
    right = F.count_if(F.col("match_id") == F.col("_true"))
    return both.agg(
        F.count("_true").alias("events"),
        F.count("match_id").alias("links"),
        right.alias("right_links"),
        F.try_divide(right, F.count("_true")).alias("recall"),
        F.try_divide(right, F.count("match_id")).alias("precision"),
    )


def edge_scan(predictions: DataFrame, odds: DataFrame) -> DataFrame:
    """Model probability minus the newest market price at or before prediction time.

    ``predictions`` has (market_id, token_id, predicted_at, probability).
    """
    clean = clamp_price(odds).select("market_id", "token_id", "timestamp", "price")
    joined = as_of_join(predictions, clean, ["market_id", "token_id"], "predicted_at", "timestamp", ["price"])
    return joined.withColumn("edge", F.col("probability") - F.col("price"))
