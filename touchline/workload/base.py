"""Derived tables shared by the registered queries, built with the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.constants import ARCHETYPES, GOALKEEPER
from touchline.operators.joins import rename_in_force
from touchline.plans import archetypes, consistency, international, players, staging, teams
from touchline.session import joined_where_they_lie, materialize
from touchline.workload import feeds
from touchline.workload.tables_sql import LOADINGS


def loadings(spark: SparkSession) -> DataFrame:
    """A given loading table, so that scores can be checked by SQL."""
    return spark.createDataFrame(LOADINGS, "component string, feature string, loading double")


def _assignments(run: Run) -> DataFrame:
    """Archetypes by a fixed rule instead of a trained model, so that marts can be checked by SQL."""
    keeper = F.coalesce(F.col("position_name") == GOALKEEPER, F.lit(False))
    number = ((F.col("player_id") + F.col("competition_id") * 3 + F.col("season_id")) % 5).cast("int")
    names = F.array(*[F.lit(a) for a in ARCHETYPES])
    return run.season.select(
        "player_id", "player_name", "competition_id", "season_id", "total_minutes",
        F.when(keeper, F.lit(-1)).otherwise(number).alias("cluster"),
        F.when(keeper, F.lit(GOALKEEPER)).otherwise(F.element_at(names, number + 1)).alias("archetype"),
    )


def _trained(run: Run) -> DataFrame:
    """Archetypes of a trained model; its loadings become ``trained_loadings``."""
    rows, run._made["trained_loadings"], _ = archetypes.assign_archetypes(run.season)
    return rows


def _results_now(run: Run) -> DataFrame:
    """International results with today's team names."""
    names = feeds.former_names(run.spark, run.folder)
    out = feeds.results(run.spark, run.folder)
    for side in ("home_team", "away_team"):
        out = rename_in_force(out, names, side, "date")
    return out


TABLES: dict[str, Callable[[Run], DataFrame]] = {
    "raw_matches": lambda r: feeds.raw_matches(r.spark, r.folder),
    "raw_events": lambda r: feeds.raw_events(r.spark, r.folder),
    "raw_lineups": lambda r: feeds.raw_lineups(r.spark, r.folder),
    "stg_matches": lambda r: staging.matches(r.raw_matches),
    "stg_events": lambda r: staging.events(r.raw_events, r.stg_matches),
    "stg_lineups": lambda r: staging.lineups(r.raw_lineups, r.stg_matches),
    "player_match": lambda r: players.player_match_stats(r.stg_lineups, r.stg_events),
    "season": lambda r: players.player_season_stats(r.player_match, r.stg_matches),
    "contexts": lambda r: players.context_per90(players.context_totals(r.player_match, r.stg_matches)),
    "club_national": lambda r: players.club_vs_national(r.player_match, r.stg_matches),
    "match_stats": lambda r: teams.match_stats(r.stg_events, r.stg_matches),
    "form": lambda r: teams.rolling_form(r.match_stats),
    "assignments": _assignments,
    "trained": _trained,
    "trained_loadings": lambda r: (r.trained, r._made["trained_loadings"])[1],
    "loadings": lambda r: loadings(r.spark),
    "weights": lambda r: consistency.feature_weights(r.loadings),
    "wide_scores": lambda r: consistency.with_consistency(
        consistency.score_wide(consistency.eligible(r.club_national), r.weights)
    ),
    "scores": lambda r: consistency.consistency_scores(r.club_national, r.loadings),
    "gaps": lambda r: consistency.gap_table(r.wide_scores, r.weights),
    "results_now": _results_now,
    "rated_players": lambda r: international.with_team(feeds.players(r.spark, r.folder)),
    "ranked": lambda r: international.ranked(feeds.rankings(r.spark, r.folder)),
}


class Run:
    """The derived tables of one query run.

    A table that a query reads more than once is named in ``stored``: it is
    then computed once and written to the shared folder.
    """

    def __init__(self, spark: SparkSession, folder: str, *stored: str):
        self.spark, self.folder = spark, folder
        self._stored, self._made = set(stored), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._made:
            df = TABLES[name](self)
            if name in self._stored:
                with joined_where_they_lie(self.spark):
                    df = materialize(df, name)
            self._made[name] = df
        return self._made[name]
