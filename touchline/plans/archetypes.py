"""Playing-style archetypes: preprocessing, PCA, K-Means, profiles, similar players."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import (
    ARCHETYPES,
    CLIP_QUANTILE,
    FEATURES,
    GOALKEEPER,
    N_CLUSTERS,
    N_STARTS,
    PCA_VARIANCE,
    SEED,
)
from touchline.operators.clustering import Centres, best_of, fit_many, silhouettes
from touchline.operators.standardize import clip_upper, impute_median, standardize
from touchline.operators.windows import dominant
from touchline.session import materialize

IDS = ("player_id", "player_name", "competition_id", "season_id", "total_minutes")


def cluster_features(season: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return season.select(*IDS, "position_name", *features)


def split_goalkeepers(df: DataFrame, position: str = "position_name") -> tuple[DataFrame, DataFrame]:
    """(outfield, goalkeepers); a player without position counts as outfield."""
    keeper = F.coalesce(F.col(position) == GOALKEEPER, F.lit(False))
    return df.filter(~keeper), df.filter(keeper)


def preprocess(
    df: DataFrame, features: Sequence[str] = FEATURES, clip: float = CLIP_QUANTILE, skip_clip: Sequence[str] = ()
) -> DataFrame:
    """Median imputation, upper clip, then standardising by the population sd.

    Needs three passes over the features, so they are written once first.
    """
    kept = materialize(df, "features")
    return standardize(clip_upper(impute_median(kept, features), features, clip, skip_clip), features)


@dataclass
class StyleModel:
    features: tuple[str, ...]
    pca: PCAModel
    n_components: int
    signs: list[float]
    kmeans: Centres | None = None

    @property
    def explained(self) -> list[float]:
        return [float(v) for v in self.pca.explainedVariance]


def assemble(df: DataFrame, features: Sequence[str], output: str = "_x") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error").transform(df)


def fit_pca(scaled: DataFrame, features: Sequence[str] = FEATURES, variance: float = PCA_VARIANCE) -> StyleModel:
    """All components, and the smallest number that explains the wanted share of variance.

    Component signs are fixed so that the largest loading is positive.
    """
    model = PCA(k=len(features), inputCol="_x", outputCol="_pc").fit(assemble(scaled, features))
    total, n = 0.0, len(features)
    for i, share in enumerate(model.explainedVariance, start=1):
        total += float(share)
        if total >= variance:
            n = i
            break
    matrix = model.pc.toArray()
    signs = [1.0 if max(matrix[:, j], key=abs) >= 0 else -1.0 for j in range(matrix.shape[1])]
    return StyleModel(tuple(features), model, n, signs)


def project(scaled: DataFrame, model: StyleModel) -> DataFrame:
    """Adds the component array ``components`` with fixed signs."""
    with_pc = model.pca.transform(assemble(scaled, model.features)).withColumn("_raw", vector_to_array("_pc"))
    fixed = F.array(*[F.element_at("_raw", i + 1) * F.lit(s) for i, s in enumerate(model.signs)])
    return with_pc.withColumn("components", fixed).drop("_x", "_pc", "_raw")


def pca_loadings(df: DataFrame, model: StyleModel) -> DataFrame:
    """Long table (component, feature, loading) of the kept components: model-sized."""
    matrix = model.pca.pc.toArray()
    rows = [
        (f"PC{j + 1}", feature, float(matrix[i, j] * model.signs[j]))
        for j in range(model.n_components)
        for i, feature in enumerate(model.features)
    ]
    return df.sparkSession.createDataFrame(rows, "component string, feature string, loading double")


def component_vectors(projected: DataFrame, n: int) -> DataFrame:
    return projected.withColumn("_v", F.slice("components", 1, n))


def fit_kmeans(vectors: DataFrame, k: int = N_CLUSTERS, starts: int = N_STARTS, seed: int = SEED) -> Centres:
    """Best of several starts by cost; all starts share their passes over the vectors."""
    return best_of(fit_many(vectors, [k], starts, seed))


def label_rules(profile: DataFrame) -> DataFrame:
    """Archetype per cluster from its standardised centroid.

    In turn the clusters left over are ranked: most defending is the anchor,
    least overall activity is low activity, most pressing and shooting is the
    pressing forward, most dribbling is the winger, and the rest are playmakers.
    Works on one row per cluster.
    """
    rules = (
        ("Defensive Anchor", ("clearances_per_90", "interceptions_per_90", "blocks_per_90"), 1),
        ("Low Activity", tuple(c for c in FEATURES if c.endswith("_per_90")), -1),
        ("Pressing Forward", ("pressures_per_90", "shots_per_90", "xg_per_90"), 1),
        ("Creative Winger", ("dribbles_per_90", "carries_per_90"), 1),
        ("Creative Playmaker", ("passes_per_90", "passes_att_third_per_90"), 1),
    )
    left = {r["cluster"]: r.asDict() for r in profile.collect()}
    named: list[tuple[int, str]] = []
    for label, columns, sign in rules:
        if not left:
            break
        pick = max(sorted(left), key=lambda c: sign * sum(left[c][x] or 0.0 for x in columns if x in left[c]))
        named.append((int(pick), label))
        del left[pick]
    named += [(int(c), f"Cluster {c}") for c in sorted(left)]
    return profile.sparkSession.createDataFrame(named, "cluster int, archetype string")


def fixed_labels(df: DataFrame) -> DataFrame:
    """Cluster id → archetype by the fixed list, for ids from an already checked run."""
    names = F.array(*[F.lit(a) for a in ARCHETYPES])
    return df.withColumn("archetype", F.try_element_at(names, F.col("cluster") + 1))


def goalkeeper_rows(keepers: DataFrame) -> DataFrame:
    """Goalkeepers stay out of the clustering: id −1, own label, no coordinates."""
    none = F.lit(None).cast("double")
    return keepers.select(
        *IDS, F.lit(-1).alias("cluster"), F.lit(GOALKEEPER).alias("archetype"), none.alias("pc1"), none.alias("pc2")
    )


def assign_archetypes(
    season: DataFrame,
    features: Sequence[str] = FEATURES,
    k: int = N_CLUSTERS,
    variance: float = PCA_VARIANCE,
    starts: int = N_STARTS,
    labels: str = "rules",
) -> tuple[DataFrame, DataFrame, StyleModel]:
    """(assignments, loadings, model) for all player-seasons, goalkeepers included."""
    outfield, keepers = split_goalkeepers(season.select(*IDS, "position_name", *features))
    scaled = preprocess(outfield, features)
    model = fit_pca(scaled, features, variance)
    projected = materialize(project(scaled, model), "projected")
    vectors = materialize(component_vectors(projected, model.n_components), "vectors")
    model.kmeans = fit_kmeans(vectors, k, starts)
    clustered = model.kmeans.assign(vectors, "_v").drop("_v")
    clustered = materialize(clustered, "clustered")
    if labels == "rules":
        profile = clustered.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in features])
        named = clustered.join(F.broadcast(label_rules(profile)), on="cluster", how="left")
    else:
        named = fixed_labels(clustered)
    assignments = named.select(
        *IDS,
        "cluster",
        "archetype",
        F.element_at("components", 1).alias("pc1"),
        F.element_at("components", 2).alias("pc2"),
    ).unionByName(goalkeeper_rows(keepers))
    return assignments, pca_loadings(season, model), model


def k_scan(projected: DataFrame, n_components: int, ks: Sequence[int], starts: int = N_STARTS, seed: int = SEED, sample: int = 2000) -> DataFrame:
    """Best cost of all starts and its silhouette on true distances, per number of clusters.

    All fits share their passes; the silhouettes are those of the published
    number of rows, taken in the order of a hash of the vector.
    """
    vectors = materialize(component_vectors(projected, n_components), "vectors")
    fitted = fit_many(vectors, ks, starts, seed)
    best = {k: best_of(fitted, k) for k in ks}
    order = [F.xxhash64("_v"), F.col("_v")]
    labelled = materialize(vectors.select("_v").orderBy(*order).limit(sample), "sampled-vectors")
    for k in ks:
        labelled = best[k].assign(labelled, "_v", f"k{k}")
    labelled = materialize(labelled, "labelled-vectors")
    judged = silhouettes(labelled, "_v", [f"k{k}" for k in ks], order, sample)
    costs = projected.sparkSession.createDataFrame([(f"k{k}", k, best[k].cost) for k in ks], "label string, k int, inertia double")
    return costs.join(judged, "label").select("k", "inertia", "silhouette")


def cluster_profile(df: DataFrame, key: str, features: Sequence[str], position: str | None = None) -> DataFrame:
    """Size, mean and z-scored mean per feature and usual position of each cluster.

    The z-scores compare clusters with each other (population sd).
    """
    means = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"mean_{c}") for c in features])
    stats = means.agg(
        F.struct(
            *[F.avg(f"mean_{c}").alias(f"m_{c}") for c in features],
            *[F.stddev_pop(f"mean_{c}").alias(f"s_{c}") for c in features],
        )
    ).scalar()
    scored = means.withColumn("_s", stats).select(
        *means.columns,
        *[
            F.try_divide(F.col(f"mean_{c}") - F.col(f"_s.m_{c}"), F.nullif(F.col(f"_s.s_{c}"), F.lit(0.0))).alias(f"z_{c}")
            for c in features
        ],
    )
    if position is None:
        return scored
    return scored.join(dominant(df, [key], position).drop("weight"), on=key, how="left")


def similar_players(scaled: DataFrame, key: str, wanted: object, features: Sequence[str], n: int, same: str | None = None) -> DataFrame:
    """n rows nearest to one player in feature space, optionally within the same cluster.

    The one wanted row comes in as a scalar value, so the table is read in
    place and only n rows per task are kept.
    """
    columns = [*features, *([same] if same else [])]
    target = scaled.filter(F.col(key) == wanted).agg(
        F.min_by(F.struct(*columns), F.struct(*[F.col(c) for c in columns])).alias("_t")
    )
    joined = scaled.filter(F.col(key) != wanted).withColumn("_t", target.scalar())
    if same:
        joined = joined.filter(F.col(same) == F.col(f"_t.{same}"))
    distance = F.lit(0.0)
    for c in features:
        gap = F.col(c) - F.col(f"_t.{c}")
        distance = distance + gap * gap
    return joined.withColumn("distance", F.sqrt(distance)).drop("_t").orderBy("distance", key).limit(n)
