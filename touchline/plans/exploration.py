"""First-look reports over raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import MAX_MATCH_MINUTES, SEED
from touchline.functions.labels import context_label, labelled_bins
from touchline.functions.text import clock_minutes, minutes_played
from touchline.operators.aggregates import count_by, density_grid, histogram, share_of_all
from touchline.operators.joins import orphans
from touchline.operators.quality import failing
from touchline.operators.reshape import union_checks

MINUTE_EDGES = (0, 15, 30, 45, 60, 75, 90, 105, 120)


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    n = F.count(F.lit(1))
    return union_checks([df.agg(n.alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()])


def rows_per_season(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of a match-keyed table per competition and season, counted per match first."""
    per_match = count_by(rows, ["match_id"], "_n")
    meta = matches.select("match_id", "competition_name", "season_name")
    return per_match.join(meta, on="match_id", how="inner").groupBy("competition_name", "season_name").agg(F.sum("_n").alias("n"))


def type_share(events: DataFrame, column: str = "event_type") -> DataFrame:
    return share_of_all(count_by(events, [column]), "n")


def shot_summary(events: DataFrame) -> DataFrame:
    shots = events.filter((F.col("event_type") == "Shot") & F.col("shot_xg").isNotNull())
    return shots.agg(
        F.count(F.lit(1)).alias("n_shots_with_xg"),
        F.round(F.avg("shot_xg"), 4).alias("mean_xg"),
        F.round(F.stddev_samp("shot_xg"), 4).alias("sd_xg"),
        F.min("shot_xg").alias("min_xg"),
        F.max("shot_xg").alias("max_xg"),
    )


def xg_histogram(events: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(events.filter(F.col("event_type") == "Shot"), "shot_xg", 0.0, 1.0, bins)


def shot_grid(events: DataFrame, cells: int = 30) -> DataFrame:
    shots = events.filter((F.col("event_type") == "Shot") & F.col("shot_xg").isNotNull())
    return density_grid(shots, "location_x", "location_y", 120.0, 80.0, cells, cells)


def stint_minutes(lineups: DataFrame) -> DataFrame:
    """Minutes of each entry when both clock values are known, limited to 0..120."""
    start, end = (clock_minutes(c, stoppage=True) for c in ("from_time", "to_time"))
    span = minutes_played(start, end, floor_at_zero=True, default_from=False)
    return lineups.withColumn("minutes_played", F.when(span > MAX_MATCH_MINUTES, F.lit(MAX_MATCH_MINUTES)).otherwise(span))


def minute_bins(minutes: DataFrame) -> DataFrame:
    label = labelled_bins("minutes_played", MINUTE_EDGES, closed_last=2)
    return minutes.groupBy(label.alias("min_bin")).agg(F.count(F.lit(1)).alias("n"))


def landscape(matches: DataFrame) -> DataFrame:
    """Matches, seasons and date span per competition and context."""
    return matches.groupBy("competition_name", context_label("is_international").alias("context")).agg(
        F.count_distinct("match_id").alias("matches"),
        F.count_distinct("season_name").alias("seasons"),
        F.min("match_date").alias("earliest"),
        F.max("match_date").alias("latest"),
    )


def goal_distribution(matches: DataFrame) -> DataFrame:
    return count_by(matches.withColumn("total_goals", F.col("home_score") + F.col("away_score")), ["total_goals"], "n")


def xg_leaders(events: DataFrame, n: int = 20) -> DataFrame:
    shots = events.filter((F.col("event_type") == "Shot") & F.col("shot_xg").isNotNull())
    teams = shots.groupBy("team").agg(
        F.count(F.lit(1)).alias("shots"),
        F.round(F.sum("shot_xg"), 2).alias("total_xg"),
        F.round(F.avg("shot_xg"), 4).alias("avg_xg_per_shot"),
    )
    return teams.orderBy(F.desc("total_xg"), "team").limit(n)


def pass_leaders(events: DataFrame, min_passes: int = 500, n: int = 20) -> DataFrame:
    """Best pass completion among teams with more than ``min_passes`` passes."""
    passes = events.filter(F.col("event_type") == "Pass")
    teams = passes.groupBy("team").agg(
        F.count(F.lit(1)).alias("total_passes"), F.count_if(F.col("pass_outcome").isNull()).alias("completed")
    )
    rated = teams.filter(F.col("total_passes") > min_passes).withColumn(
        "completion_pct", F.round(F.col("completed") * 100.0 / F.col("total_passes"), 1)
    )
    return rated.orderBy(F.desc("completion_pct"), "team").limit(n)


def tempo(events: DataFrame, last_minute: int = 95) -> DataFrame:
    return count_by(events.filter(F.col("period").isin(1, 2) & (F.col("minute") <= last_minute)), ["minute"], "events")


def tracking_coverage(frames: DataFrame) -> DataFrame:
    return frames.agg(
        F.count_distinct("event_uuid").alias("tracked_events"),
        F.count_distinct("match_id").alias("tracked_matches"),
        F.count_if("actor").alias("actor_rows"),
        F.count_if("keeper").alias("keeper_rows"),
        F.count_if("teammate").alias("teammate_rows"),
    )


def sample_rows(df: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """n random rows, the same for the same rows however files are split.

    Rows are drawn by a hash of all columns and of their number among equal
    rows, so repeated rows are drawn one by one. Only hashes below a bound that
    about n rows meet are ordered; with its margin of ten standard deviations a
    shortfall is practically impossible.
    """
    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    # equal rows are one row with a count, and one of several thousands at most
    spread = counts.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(_copies - 1) div 4096"))))
    ends = F.least(F.col("_copies"), (F.col("_block") + 1) * 4096)
    rows = spread.withColumn("_copy", F.explode(F.sequence(F.col("_block") * 4096 + 1, ends)))
    total = df.count()
    share = (n + 10 * n**0.5 + 100) / max(total, 1)
    draw = F.xxhash64(F.lit(seed), "_copy", *df.columns)
    pool = rows if share >= 1 else rows.filter(draw < F.lit(int(-(2**63) + share * 2**64)))
    return pool.orderBy(draw).limit(n).select(*df.columns)


def describe(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string, nullable boolean")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def quality_report(matches: DataFrame, events: DataFrame, lineups: DataFrame) -> DataFrame:
    """Eleven checks over the three raw tables, all checks of one table in one pass."""

    def lines(df: DataFrame, tests: dict) -> DataFrame:
        one = df.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests.values())])
        cells = [F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("failures")) for i, name in enumerate(tests)]
        return one.select(F.inline(F.array(*cells)))

    def null(c: str):
        return F.col(c).isNull()

    return union_checks(
        [
            lines(
                events,
                {
                    "events: match_id NULL": null("match_id"),
                    "shots with NULL xg": (F.col("event_type") == "Shot") & null("shot_xg"),
                },
            ),
            lines(
                lineups,
                {
                    "lineups: match_id NULL": null("match_id"),
                    "lineups NULL from_time": null("from_time"),
                    "lineups NULL to_time": null("to_time"),
                    "lineups NULL player_name": null("player_name"),
                    "lineups NULL position_name": null("position_name"),
                },
            ),
            lines(matches, {"matches NULL home_score": null("home_score"), "matches NULL away_score": null("away_score")}),
            failing(orphans(events.select("match_id"), matches, ["match_id"]), F.lit(True), "events orphan match_id"),
            failing(orphans(lineups.select("match_id"), matches, ["match_id"]), F.lit(True), "lineups orphan match_id"),
        ]
    )
