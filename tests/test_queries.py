"""Registered queries against DuckDB on the smallest tables, and invariants of the model tables.

A representative part runs by default; TOUCHLINE_ALL=1 runs every query.
"""

import math
import os

import pytest
from pyspark.sql import functions as F

from touchline.workload import all_queries
from touchline.workload.base import Run

duckdb = pytest.importorskip("duckdb")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
DEFAULT = (
    "stg_events", "stg_lineups", "player_match_stats", "player_season_stats", "match_features", "club_vs_national",
    "consistency_scores", "match_analysis", "team_comparison", "player_clusters", "scaled_features", "rank_features",
    "segment_priority_chi2", "edge_scan", "linked_markets", "live_form", "quality_report", "part_files",
)
CHOSEN = [n for n, q in all_queries().items() if q.sql and (os.environ.get("TOUCHLINE_ALL") or n in DEFAULT)]


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows_as_sql(spark, folder, duck, name):
    q = all_queries()[name]
    df = q.build(spark, folder)
    names = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    result = duck.execute(q.sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    theirs = sorted((tuple(row[columns.index(c)] for c in names) for row in result.fetchall()), key=key)
    assert ours == theirs
    assert not any(isinstance(v, float) and math.isnan(v) for row in ours for v in row)


def test_every_query_has_a_distinct_name_and_coverage():
    queries = all_queries()
    assert len(queries) > 150
    assert all(q.covers for q in queries.values())


@pytest.mark.parametrize("name", ["head_to_head", "match_features", "rank_features", "player_clusters", "linked_markets", "club_vs_national"])
def test_no_pairwise_joins(spark, folder, name, capsys):
    all_queries()[name].build(spark, folder).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_is_pruned(spark, folder, capsys):
    all_queries()["scan_pruned"].build(spark, folder).explain()
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,25.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_invariants(spark, folder):
    run = Run(spark, folder, "stg_matches", "match_stats", "player_match")
    shares = run.match_stats.groupBy("match_id").agg(F.sum("possession_share").alias("s")).filter("abs(s - 1) > 1e-9")
    assert shares.count() == 0
    rates = run.stg_matches.groupBy("match_result").count()
    assert sum(r["count"] for r in rates.collect()) == run.stg_matches.count()
    from touchline.plans.teams import match_features, rolling_form, team_season_stats

    seasons = team_season_stats(run.match_stats, min_matches=1)
    assert seasons.filter("wins + draws + losses <> matches_played").count() == 0
    features = match_features(run.stg_matches, rolling_form(run.match_stats))
    assert features.count() == features.select("match_id").distinct().count()
    from touchline.operators.standardize import zscores
    from touchline.plans.players import FEATURES, context_per90, context_totals

    rates = context_per90(context_totals(run.player_match, run.stg_matches))
    means = zscores(rates, FEATURES, ["is_international"]).groupBy("is_international").agg(*[F.avg(f"z_{f}").alias(f) for f in FEATURES])
    assert all(v is None or abs(v) < 1e-9 for r in means.collect() for v in r[1:])
