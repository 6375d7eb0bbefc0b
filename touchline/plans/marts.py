"""Analytics tables and the analyst questions asked of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import FEATURES
from touchline.functions.labels import label_contains, position_group
from touchline.functions.rates import per90
from touchline.operators.aggregates import count_by
from touchline.operators.reshape import unpivot_present
from touchline.operators.standardize import component_scores, zscores_long
from touchline.operators.windows import top_n
from touchline.plans.teams import FORM_SHORT, latest_form

SIDE_STATS = {
    "total_xg": "xg",
    "possession_share": "possession_proxy",
    "pass_completion_pct": "pass_completion_pct",
    "total_shots": "shots",
    "total_pressures": "total_pressures",
    "total_carries": "total_carries",
}
SEASON_GRAIN = ("player_id", "competition_id", "season_id")


def match_analysis(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """Every match with both sides' statistics; matches without any are kept.

    Both sides come from one aggregation over the team rows, hence one join.
    """

    def side(name: str, column: str):
        return F.max(F.when(F.col("side") == name, F.col(column)))

    wide = stats.groupBy("match_id").agg(
        *[side(s, c).alias(f"{s}_{n}") for s in ("home", "away") for c, n in SIDE_STATS.items()]
    )
    base = matches.select(
        "match_id", "match_date", "competition_id", "competition_name", "season_id", "season_name",
        "home_team", "away_team", "home_score", "away_score", "match_result",
    )
    return base.join(wide, on="match_id", how="left")


def best_season_label(assignments: DataFrame, season: DataFrame) -> DataFrame:
    """One archetype per player: that of the season with most minutes."""
    minutes = season.select(*SEASON_GRAIN, F.col("total_minutes").alias("_minutes"))
    joined = assignments.select(*SEASON_GRAIN, "cluster", "archetype").join(minutes, on=list(SEASON_GRAIN), how="inner")
    order = [F.desc("_minutes"), F.asc("competition_id"), F.asc("season_id")]
    return top_n(joined, ["player_id"], order, 1).select(
        "player_id", F.col("cluster").alias("cluster_id"), F.col("archetype").alias("cluster_label")
    )


def season_label(assignments: DataFrame) -> DataFrame:
    """The archetype of each season itself (three-key variant)."""
    return assignments.select(
        *SEASON_GRAIN, F.col("cluster").alias("cluster_id"), F.col("archetype").alias("cluster_label")
    )


def _labelled(season: DataFrame, assignments: DataFrame, per_season: bool) -> DataFrame:
    if per_season:
        out = season.join(season_label(assignments), on=list(SEASON_GRAIN), how="left")
    else:
        out = season.join(best_season_label(assignments, season), on="player_id", how="left")
    return out.withColumns(
        {
            "cluster_id": F.coalesce("cluster_id", F.lit(-1)),
            "cluster_label": F.coalesce("cluster_label", F.lit("Unknown")),
        }
    )


def season_coordinates(season: DataFrame, loadings: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """PC1 and PC2 per player-season from sample z-scores over all players, keepers included."""
    long = unpivot_present(season, SEASON_GRAIN, features)
    scored = zscores_long(long, features)
    return component_scores(scored, loadings, SEASON_GRAIN, ("PC1", "PC2"), features)


def player_clusters(season: DataFrame, assignments: DataFrame, loadings: DataFrame, per_season: bool = False) -> DataFrame:
    coordinates = season_coordinates(season, loadings)
    return (
        _labelled(season, assignments, per_season)
        .join(coordinates, on=list(SEASON_GRAIN), how="left")
        .select(
            "player_id", "player_name", "competition_id", "competition_name", "season_id", "season_name",
            "total_minutes", "cluster_id", "cluster_label", "pc1", "pc2", *FEATURES, "goals_per_90", "assists_per_90",
        )
    )


PERFORMANCE_COLUMNS = (
    "total_goals", "total_assists", "total_shots", "total_xg", "total_passes_attempted", "total_passes_completed",
    "pass_completion_pct", "total_pressures", "total_tackles", "total_interceptions", "total_carries",
    "total_duels", "total_aerial_duels", "goals_per_90", "assists_per_90", "shots_per_90", "xg_per_90",
    "xg_per_shot", "pressures_per_90", "tackles_per_90", "interceptions_per_90", "carries_per_90",
    "duels_per_90", "aerial_duels_per_90",
)


def player_performance(season: DataFrame, assignments: DataFrame, scores: DataFrame, per_season: bool = False) -> DataFrame:
    consistency = scores.select(
        "player_id", "club_performance_score", "national_performance_score", "consistency_score", "performance_quadrant"
    )
    return (
        _labelled(season, assignments, per_season)
        .join(consistency, on="player_id", how="left")
        .select(
            "player_id", "player_name", "competition_id", "competition_name", "season_id", "season_name",
            "total_minutes", "cluster_id", "cluster_label", *PERFORMANCE_COLUMNS,
            "club_performance_score", "national_performance_score", "consistency_score", "performance_quadrant",
        )
    )


def team_comparison(season: DataFrame, form: DataFrame) -> DataFrame:
    """Team seasons next to the form before their last match."""
    names = {c: f"latest_{short}" for c, short in FORM_SHORT.items()}
    recent = latest_form(form).withColumnsRenamed(names)
    renamed = season.withColumnsRenamed(
        {
            "total_xg": "seasonal_total_xg",
            "avg_xg_per_match": "seasonal_avg_xg",
            "avg_possession_share": "seasonal_avg_possession",
            "total_pressures": "seasonal_total_pressures",
            "avg_pressures_per_match": "seasonal_avg_pressures",
        }
    )
    return renamed.join(recent, on=["team", "competition_id", "season_id"], how="left")


# --- analyst questions -----------------------------------------------------------------------


def weighted_rate(performance: DataFrame, total: str, name: str, keys: Sequence[str] = ("player_id",)) -> DataFrame:
    """Rate over all seasons: Σ total ÷ Σ minutes × 90, never a mean of season rates."""
    sums = performance.groupBy(*keys).agg(
        F.min("player_name").alias("player_name"), F.sum(total).alias("_t"), F.sum("total_minutes").alias("total_minutes")
    )
    return sums.withColumn(name, per90("_t", "total_minutes")).drop("_t")


def top_by_label(performance: DataFrame, label: str, total: str, name: str, n: int) -> DataFrame:
    """n players of an archetype with the highest weighted rate."""
    pool = weighted_rate(performance.filter(F.col("cluster_label") == label), total, name)
    return pool.orderBy(F.desc_nulls_last(name), "player_id").limit(n)


def quadrant_players(performance: DataFrame, quadrant: str, competition: str | None = None) -> DataFrame:
    rows = performance.filter(F.col("performance_quadrant") == quadrant)
    if competition:
        rows = rows.filter(F.col("competition_name") == competition)
    return rows.select("player_id", "player_name", "performance_quadrant", "consistency_score").distinct()


def player_cluster(clusters: DataFrame, fragment: str) -> DataFrame:
    found = clusters.filter(label_contains("player_name", fragment))
    return found.select("player_id", "player_name", "competition_name", "season_name", "cluster_label")


def compare_competitions(season: DataFrame, total: str, group: str, competitions: Sequence[str], name: str = "rate") -> DataFrame:
    """Minutes-weighted rate of a position group in each of the named competitions."""
    rows = season.withColumn("position_group", position_group("position_name")).filter(
        (F.col("position_group") == group) & F.col("competition_name").isin(*competitions)
    )
    sums = rows.groupBy("competition_name").agg(
        F.count(F.lit(1)).alias("player_seasons"), F.sum(total).alias("_t"), F.sum("total_minutes").alias("_m")
    )
    return sums.select("competition_name", "player_seasons", per90("_t", "_m").alias(name))


def shift(contexts: DataFrame, metric: str) -> DataFrame:
    """Mean club value, mean national value and mean shift over players of both contexts."""
    flag = F.col("is_international")
    per_player = contexts.groupBy("player_id").agg(
        F.avg(F.when(~flag, F.col(metric))).alias("_club"), F.avg(F.when(flag, F.col(metric))).alias("_nat")
    )
    both = per_player.filter(F.col("_club").isNotNull() & F.col("_nat").isNotNull())
    return both.agg(
        F.count(F.lit(1)).alias("players"),
        F.avg("_club").alias("club_mean"),
        F.avg("_nat").alias("national_mean"),
        F.avg(F.col("_nat") - F.col("_club")).alias("mean_shift"),
    )


def preview(df: DataFrame, cap: int = 50) -> tuple[list, str]:
    """Rows to show and a note when there are more: reads one row beyond the cap."""
    rows = df.limit(cap + 1).collect()
    note = f"showing the first {cap} rows" if len(rows) > cap else ""
    return rows[:cap], note


# --- outcome model -----------------------------------------------------------------------------

OUTCOMES = ("home_win", "draw", "away_win")


def fit_outcome(features: DataFrame, columns: Sequence[str], train_until: str) -> tuple[object, DataFrame]:
    """Three-way outcome model on matches up to a date; returns (model, scored later matches)."""
    train = features.filter(F.col("match_date") <= F.lit(train_until).cast("date"))
    test = features.filter(F.col("match_date") > F.lit(train_until).cast("date"))
    filled = [f"_f_{c}" for c in columns]
    stages = Pipeline(
        stages=[
            StringIndexer(inputCol="match_result", outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="skip"),
            Imputer(inputCols=list(columns), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="_x"),
            LogisticRegression(featuresCol="_x", labelCol="_label", family="multinomial", regParam=0.01, maxIter=50),
        ]
    )
    model = stages.fit(train)
    names = model.stages[0].labels
    scored = model.transform(test).withColumn("_p", vector_to_array("probability"))
    out = scored.select(
        *features.columns, *[F.element_at("_p", i + 1).alias(f"p_{name}") for i, name in enumerate(names)]
    )
    return model, out


def brier(scored: DataFrame, label: str = "match_result", outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    """Mean squared distance between the probabilities and the outcome, and the uniform guess."""
    error = F.lit(0.0)
    for o in outcomes:
        gap = F.col(f"p_{o}") - (F.col(label) == o).cast("double")
        error = error + gap * gap
    n = len(outcomes)
    uniform = (1 - 1 / n) ** 2 + (n - 1) / n**2
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(error).alias("brier"), F.lit(uniform).alias("brier_uniform"))

