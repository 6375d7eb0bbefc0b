"""Times the full model run and standalone queries; prints one JSON line.

The model run stores each table once, like a daily refresh, and later tables
read the stored ones. Standalone queries start from the given files.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

STANDALONE = (
    "player_match_events",
    "quality_report",
    "event_type_share",
    "xg_leaders",
    "tempo",
    "head_to_head",
    "market_summary",
    "trade_stats",
    "monthly_trades",
    "top_takers",
    "linked_markets",
    "team_strength",
    "rank_features",
    "segment_priority_chi2",
    "click_purchase_u_test",
    "last_click_before_purchase",
    "rolling_spend",
    "rolling_spend_hot_groups",
    "tempo_windows",
)


def model_run(spark, folder):
    """(name, job) for every table of the model run, in order."""
    from touchline.plans import archetypes, consistency, marts, reports, teams
    from touchline.session import materialize
    from touchline.workload.base import Run

    stored = ("stg_matches", "stg_events", "stg_lineups", "player_match", "season", "club_national", "match_stats", "form",
              "trained", "scores", "wide_scores")
    run = Run(spark, folder, *stored)
    for name in stored:
        yield f"build_{name}", lambda name=name: getattr(run, name)
    tables = {
        "team_comparison": lambda: marts.team_comparison(teams.team_season_stats(run.match_stats), run.form),
        "match_features": lambda: teams.match_features(run.stg_matches, run.form),
        "match_analysis": lambda: marts.match_analysis(run.stg_matches, run.match_stats),
        "player_clusters": lambda: marts.player_clusters(run.season, run.trained, run.trained_loadings),
        "player_performance": lambda: marts.player_performance(run.season, run.trained, run.scores),
        "feature_importance": lambda: consistency.feature_importance(consistency.gap_table(run.wide_scores, run.weights)),
        "league_summary": lambda: reports.league_summary(reports.competition_archetypes(run.trained, run.season)),
        "scaled_features": lambda: archetypes.preprocess(archetypes.split_goalkeepers(archetypes.cluster_features(run.season))[0]),
    }
    for name, build in tables.items():
        yield f"build_{name}", lambda name=name, build=build: materialize(build(), name)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from touchline.session import build_session
    from touchline.workload import all_queries

    shared = tempfile.TemporaryDirectory(prefix="bench-", ignore_cleanup_errors=True)
    settings = {
        "spark.checkpoint.dir": shared.name,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("touchline-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()

    def run_query(name: str) -> None:
        registered[name].build(spark, folder).write.format("noop").mode("overwrite").save()

    run_query("event_type_share")
    times: dict[str, float] = {}
    jobs = [*model_run(spark, folder), *[(name, lambda name=name: run_query(name)) for name in STANDALONE]]
    for name, job in jobs:
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    shared.cleanup()
    print(
        json.dumps(
            {
                "metric": "total wall time of the model run and standalone queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
