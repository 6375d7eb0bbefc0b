"""Analyst questions on trained archetypes, recomputed in plain Python from the trained rows and the seasons."""

from collections import defaultdict

import pytest

from touchline.plans import marts
from touchline.workload import base

QUESTIONS = [
    ("Defensive Anchor", "total_interceptions"),
    ("Creative Playmaker", "total_passes_completed"),
    ("Pressing Forward", "total_pressures"),
]


@pytest.fixture(scope="module")
def run(spark, folder):
    return base.Run(spark, folder, "player_match", "season", "trained")


@pytest.fixture(scope="module")
def labels(run):
    """Label of each player's longest season."""
    best = {}
    for r in run.trained.collect():
        key = (-r.total_minutes, r.competition_id, r.season_id)
        if r.player_id not in best or key < best[r.player_id][0]:
            best[r.player_id] = (key, r.archetype)
    return {player: label for player, (_, label) in best.items()}


@pytest.mark.parametrize(("label", "total"), QUESTIONS)
def test_top_players_of_a_trained_label(run, labels, label, total):
    sums = defaultdict(lambda: [0.0, 0.0])
    for r in run.season.select("player_id", total, "total_minutes").collect():
        if labels.get(r.player_id) == label:
            sums[r.player_id][0] += r[total] or 0
            sums[r.player_id][1] += r.total_minutes or 0
    want = sorted((-t / m * 90 if m else 0.0 for t, m in sums.values()))[:10]
    performance = marts.player_performance(run.season, run.trained, run.scores)
    rows = marts.top_by_label(performance, label, total, "rate", 10).collect()
    assert [r.rate or 0.0 for r in rows] == pytest.approx([-x for x in want])
    assert rows and all(labels[r.player_id] == label for r in rows)


def test_lookup_gives_trained_labels(run, labels):
    clusters = marts.player_clusters(run.season, run.trained, run.trained_loadings)
    found = marts.player_cluster(clusters, "PLAYER 1").collect()
    names = run.season.select("player_name").collect()
    assert len(found) == sum("player 1" in (r.player_name or "").lower() for r in names) > 0
    assert all(r.cluster_label == labels[r.player_id] for r in found)
