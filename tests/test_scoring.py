"""Scores, quadrants, shift score, preprocessing, clustering."""

import random

import pytest
from pyspark.sql import functions as F

from touchline.constants import ARCHETYPES, FEATURES
from touchline.operators import standardize
from touchline.plans import archetypes, consistency, reports

Z = [f"z_{f}" for f in FEATURES]
EVEN = [("PC1", f, 1.0) for f in FEATURES]


def loadings(spark, rows=EVEN):
    return spark.createDataFrame(rows, "component string, feature string, loading double")


def contexts(spark, players):
    """{id: (club z list, national z list)}; a None side is left out."""
    rows = []
    for pid, (club, national) in players.items():
        for flag, z, minutes in ((False, club, 500.0), (True, national, 400.0)):
            if z is not None:
                rows.append((pid, f"P{pid}", flag, minutes, *[None if v is None else float(v) for v in z]))
    return spark.createDataFrame(rows, "player_id int, player_name string, is_international boolean, total_minutes double, " + ", ".join(f"{c} double" for c in Z))


def score(spark, players, rows=EVEN):
    return {r["player_id"]: r for r in consistency.consistency_scores(contexts(spark, players), loadings(spark, rows)).collect()}


def test_quadrants(spark):
    got = score(spark, {1: ([4] * 13, [4] * 13), 2: ([4] * 13, [0] * 13), 3: ([0] * 13, [4] * 13), 4: ([0] * 13, [0] * 13)})
    assert [got[i]["performance_quadrant"] for i in (1, 2, 3, 4)] == ["Elite", "Club Specialist", "International Specialist", "Underperformer"]


def test_dot_product(spark):
    z = [-1 + 2 * i / 12 for i in range(13)]
    rows = [("PC1", f, float(i + 1)) for i, f in enumerate(FEATURES)] + [("PC2", f, -1.0) for f in FEATURES]
    total = sum(i + 2 for i in range(13))
    got = score(spark, {1: (z, [0] * 13)}, rows)[1]
    assert got["club_performance_score"] == pytest.approx(sum(v * (i + 2) / total for i, v in enumerate(z)))
    assert got["national_performance_score"] == 0.0


def test_missing_z_counts_as_zero(spark):
    got = score(spark, {1: ([0] * 13, [None] + [1] * 12)})[1]
    assert got["national_performance_score"] == pytest.approx(12 / 13)


def test_consistency_formula_and_order(spark):
    scored = consistency.consistency_scores(contexts(spark, {1: ([1.5] * 13, [1.5] * 13), 2: ([2] * 13, [0] * 13)}), loadings(spark))
    assert [(r["player_id"], pytest.approx(r["consistency_score"])) for r in scored.collect()] == [(2, -1.0), (1, 1.0)]
    assert scored.columns == ["player_id", "player_name", "club_performance_score", "national_performance_score",
                              "consistency_score", "performance_quadrant", "club_minutes", "national_minutes"]


def test_median_tie_is_high(spark):
    got = score(spark, {1: ([3] * 13, [3] * 13), 2: ([1] * 13, [1] * 13), 3: ([2] * 13, [2] * 13)})
    assert got[3]["performance_quadrant"] == "Elite"


def test_single_context_left_out(spark):
    assert set(score(spark, {1: ([1] * 13, [1] * 13), 2: ([1] * 13, None)})) == {1}


def test_weights_sum_to_one_and_fail_on_gaps(spark):
    weights = consistency.feature_weights(loadings(spark, EVEN + [("PC2", f, -2.0) for f in FEATURES[:3]]))
    assert weights.agg(F.sum("weight")).first()[0] == pytest.approx(1.0)
    with pytest.raises(Exception, match="lack some features"):
        consistency.feature_weights(loadings(spark, EVEN[1:])).collect()
    with pytest.raises(Exception, match="all loadings are zero"):
        consistency.feature_weights(loadings(spark, [("PC1", f, 0.0) for f in FEATURES])).collect()


def test_shift_weight(spark):
    wide = spark.createDataFrame([(1, 1.0, 3.0, 300.0, 300.0), (2, 0.0, None, 3000.0, 300.0), (3, 0.0, 0.0, 0.0, 0.0)],
                                 "player_id int, club_x double, nat_x double, club_minutes double, national_minutes double")
    got = {r["player_id"]: r for r in consistency.context_shift(wide, ["x"]).collect()}
    assert got[1]["minutes_weight"] == 1.0 and got[1]["context_shift_score"] == 2.0
    assert got[2]["minutes_weight"] == pytest.approx(0.181818, abs=1e-6) and got[2]["raw_gap"] == 0.0
    assert got[3]["minutes_weight"] is None


def outfield(spark, n, seed=42, high=5.0, start=0, change=None):
    rng = random.Random(seed)
    rows = [[start + i, f"P{start + i}", 1, 1, rng.uniform(270, 3000), "Left Back", *[rng.uniform(0, high) for _ in FEATURES]] for i in range(n)]
    if change:
        change(rows)
    schema = "player_id int, player_name string, competition_id int, season_id int, total_minutes double, position_name string, "
    return spark.createDataFrame([tuple(r) for r in rows], schema + ", ".join(f"{f} double" for f in FEATURES))


def test_preprocess_scales_and_fills(spark):
    def drop(rows):
        rows[0][6] = None
        rows[5][8] = None

    scaled = archetypes.preprocess(outfield(spark, 30, change=drop))
    stats = scaled.agg(*[F.avg(f).alias(f"m_{f}") for f in FEATURES], *[F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES],
                       *[F.count_if(F.col(f).isNull()).alias(f"n_{f}") for f in FEATURES]).first()
    assert all(abs(stats[f"m_{f}"]) < 1e-10 and abs(stats[f"s_{f}"] - 1) < 1e-10 and stats[f"n_{f}"] == 0 for f in FEATURES)


def test_clip_makes_outliers_equal(spark):
    def spike(value):
        def change(rows):
            rows[0][6] = value
        return change

    # the cap interpolates towards the outlier, so the two runs agree only up to scale
    a, b = (archetypes.preprocess(outfield(spark, 50, change=spike(v))).filter("player_id = 0").first()["xg_per_90"] for v in (1_000_000.0, 999_999.0))
    assert a == pytest.approx(b, abs=1e-3)


def test_constant_feature_becomes_zero(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id int, x double")
    assert [r["x"] for r in standardize.standardize(df, ["x"]).collect()] == [0.0, 0.0]


def test_missing_position_is_outfield(spark):
    df = spark.createDataFrame([(1, None), (2, "Goalkeeper"), (3, "Left Back")], "id int, position_name string")
    out, keepers = archetypes.split_goalkeepers(df)
    assert {r["id"] for r in out.collect()} == {1, 3} and {r["id"] for r in keepers.collect()} == {2}


def test_archetypes(spark):
    keepers = outfield(spark, 10, 99, 2.0, 1000).withColumn("position_name", F.lit("Goalkeeper"))
    assignments, loads, model = archetypes.assign_archetypes(outfield(spark, 100).unionByName(keepers), starts=3)
    rows = assignments.collect()
    assert len(rows) == 110 and assignments.columns == ["player_id", "player_name", "competition_id", "season_id", "total_minutes", "cluster", "archetype", "pc1", "pc2"]
    field = [r for r in rows if r["cluster"] >= 0]
    assert {r["cluster"] for r in field} == {0, 1, 2, 3, 4} and {r["archetype"] for r in field} == set(ARCHETYPES)
    assert all(r["pc1"] is not None and r["pc2"] is not None for r in field)
    gk = [r for r in rows if r["cluster"] == -1]
    assert {r["player_id"] for r in gk} == set(range(1000, 1010)) and all(r["archetype"] == "Goalkeeper" and r["pc1"] is None for r in gk)
    assert loads.select("feature").distinct().count() == 13
    shares = model.explained
    assert sum(shares[: model.n_components]) >= 0.8 > sum(shares[: model.n_components - 1])
    assert sum(shares) == pytest.approx(1.0)


def test_fixed_labels(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "cluster int")
    assert tuple(r["archetype"] for r in archetypes.fixed_labels(df).orderBy("cluster").collect()) == ARCHETYPES


def test_no_keepers(spark):
    empty = outfield(spark, 5).limit(0)
    assert archetypes.goalkeeper_rows(empty).count() == 0


# --- published numbers ---------------------------------------------------------------------------------

# fixed values: published counts
ARCHETYPE_SEASONS = [("Creative Playmaker", 807), ("Creative Winger", 463), ("Defensive Anchor", 1470), ("Goalkeeper", 290), ("Low Activity", 1963), ("Pressing Forward", 766)]
LEAGUE_SEASONS = {
    "La Liga": (163, 96, 304, 167, 139),
    "Premier League": (65, 42, 169, 163, 102),
    "Ligue 1": (107, 77, 175, 148, 84),
    "1. Bundesliga": (70, 57, 145, 121, 83),
    "Serie A": (89, 43, 138, 240, 82),
}
NAMES = ("Creative Playmaker", "Creative Winger", "Defensive Anchor", "Low Activity", "Pressing Forward")
QUADRANT_PLAYERS = [("Club Specialist", 88), ("Elite", 157), ("International Specialist", 88), ("Underperformer", 156)]


def test_league_summary(spark):
    rows = [(league, name, n) for league, counts in LEAGUE_SEASONS.items() for name, n in zip(NAMES, counts)]
    counts = spark.createDataFrame(rows, "competition_name string, archetype string, seasons long")
    got = {r["competition"]: tuple(r)[1:4] for r in reports.league_summary(counts).collect()}
    assert got == {
        "La Liga": ("Defensive Anchor (304)", "Low Activity (167)", "Highest volume. Defensive Anchors lead"),
        "Serie A": ("Low Activity (240)", "Defensive Anchor (138)", "Most Low Activity share among top five"),
        "Ligue 1": ("Defensive Anchor (175)", "Low Activity (148)", "Near-even top two clusters"),
        "Premier League": ("Defensive Anchor (169)", "Low Activity (163)", "Near-even top two clusters"),
        "Bundesliga": ("Defensive Anchor (145)", "Low Activity (121)", "Smallest top-five sample. More Pressing Forward (83)"),
    }


def test_report_metrics(spark):
    archetype = spark.createDataFrame(ARCHETYPE_SEASONS, "archetype string, seasons long")
    quadrant = spark.createDataFrame(QUADRANT_PLAYERS, "quadrant string, players long")
    overview = spark.createDataFrame([(3464, 12188949, 165820, 11)], "n_matches long, n_events long, n_lineups long, n_competitions long")
    got = reports.report_metrics(archetype, quadrant, overview).first()
    assert (got["n_player_seasons"], got["n_outfield_player_seasons"], got["n_goalkeeper_seasons"]) == (5759, 5469, 290)
    assert got["n_dual_context_players"] == 489 and got["n_events_millions"] == 12.2
    assert got["pct_elite"] == pytest.approx(100 * 157 / 489)
    assert got["pct_single_context_specialist"] == pytest.approx(100 * 176 / 489)
