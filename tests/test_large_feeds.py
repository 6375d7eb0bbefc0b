"""Large tables are dealt by match while their rows are narrow."""

import re

import pytest
from pyspark.sql import functions as F

from touchline import session
from touchline.operators import quality
from touchline.plans import players, staging
from touchline.workload import all_queries, base, feeds


@pytest.fixture
def large(spark, monkeypatch):
    """Any table counts as large, and no side of a join is small."""
    monkeypatch.setattr(feeds, "SMALL_BYTES", 0)
    monkeypatch.setattr(feeds, "TASK_BYTES", 10_000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_cross_no_exchange_once_they_are_wide(spark, folder, large):
    text = plan(base.Run(spark, folder).stg_events)
    assert text.index("Generate explode") < text.index("Exchange hashpartitioning(l_orderkey")
    assert text.count("Exchange") == 2


def test_dealt_rows_are_the_same(spark, folder, monkeypatch):
    plain = [f(spark, folder) for f in (feeds.raw_events, feeds.raw_lineups)]
    monkeypatch.setattr(feeds, "SMALL_BYTES", 0)
    for small, f in zip(plain, (feeds.raw_events, feeds.raw_lineups)):
        dealt = f(spark, folder)
        assert dealt.exceptAll(small).count() == 0 and dealt.count() == small.count()


@pytest.mark.parametrize("name", ["raw_player_season", "raw_player_context", "player_features"])
def test_typed_events_are_joined_where_they_lie(spark, folder, monkeypatch, large, name):
    stored = []

    def spy(df, label, keep=players.materialize):
        stored.append(plan(df))
        return keep(df, label)

    monkeypatch.setattr(players, "materialize", spy)
    rows = {tuple(r) for r in all_queries()[name].build(spark, folder).collect()}
    assert "hashpartitioning(id" not in stored[0] and "hashpartitioning(match_id#" not in stored[0].split("Generate explode")[0]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    monkeypatch.undo()
    assert rows == {tuple(r) for r in all_queries()[name].build(spark, folder).collect()} and rows


@pytest.mark.parametrize("name", ["goalkeeper_rows", "pressure_shift", "context_totals_agree"])
def test_lineups_and_their_events_are_joined_where_they_lie(spark, folder, monkeypatch, large, name):
    stored = {}

    def spy(df, label, keep=players.materialize):
        stored[label] = plan(df)
        return keep(df, label)

    monkeypatch.setattr(players, "materialize", spy)
    rows = {tuple(r) for r in all_queries()[name].build(spark, folder).collect()}
    text = stored["season-rows" if name == "goalkeeper_rows" else "context-rows"]
    assert "hashpartitioning(l_orderkey" in text and not re.search(r"hashpartitioning\(match_id#\w+, player_name", text)
    monkeypatch.undo()
    assert len(rows) == all_queries()[name].build(spark, folder).count() > 0


def test_fan_out_counts_lineups_and_events_where_they_lie(spark, folder, monkeypatch, large):
    stored = []

    def spy(df, label, keep=players.materialize):
        stored.append(plan(df))
        return keep(df, label)

    monkeypatch.setattr(quality, "materialize", spy, raising=False)
    got = all_queries()["lineup_fan_out"].build(spark, folder).collect()
    assert "hashpartitioning(l_orderkey" in stored[0] and not re.search(r"hashpartitioning\(match_id#\w+, player_name", stored[0])
    monkeypatch.undo()
    run = base.Run(spark, folder)
    before, after = run.stg_lineups.count(), run.player_match.count()
    assert [tuple(r) for r in got] == [(before, after, after - before)]


def test_contexts_are_summed_by_match_where_the_rows_lie(spark, folder, monkeypatch, large):
    """A player listed twice in a match has one match; the stored sums exchange neither rows nor match ids again."""
    run = base.Run(spark, folder)
    want = {
        (r["player_id"], r["player_name"], r["is_international"]): (r["n"], round(r["m"], 6), r["s"])
        for r in players.with_match(run.player_match, run.stg_matches)
        .groupBy("player_id", "player_name", "is_international")
        .agg(F.count_distinct("match_id").alias("n"), F.sum("minutes_played").alias("m"), F.sum("shots").alias("s"))
        .collect()
    }
    got = players.context_totals(run.player_match, run.stg_matches, 0.0)
    assert "match_id" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan(got)))
    assert want and want == {
        (r["player_id"], r["player_name"], r["is_international"]): (r["matches_played"], round(r["total_minutes"], 6), r["total_shots"])
        for r in got.collect()
    }


def test_season_sums_are_dealt_by_the_size_of_their_rows(spark, folder, monkeypatch, large):
    stored = {}

    def spy(df, label, keep=players.materialize):
        stored[label] = plan(df)
        return keep(df, label)

    rows = {tuple(r) for r in base.Run(spark, folder).season.collect()}
    monkeypatch.setattr(players, "materialize", spy)
    monkeypatch.setattr(session, "TASK_BYTES", 2_000)
    assert {tuple(r) for r in base.Run(spark, folder).season.collect()} == rows and rows
    text = stored["season-totals"]
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(player_id#.*?, (\d+)\)", text)]
    assert len(dealt) == text.count("Exchange") == 2 and min(dealt) > 8
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


@pytest.mark.parametrize("name", ["refreshed_marts", "trained_marts_agree"])
def test_marts_do_not_store_and_exchange_wide_player_rows(spark, folder, monkeypatch, name):
    labels = []

    def spy(df, label, keep=base.materialize):
        labels.append(label)
        return keep(df, label)

    monkeypatch.setattr(base, "materialize", spy)
    assert all_queries()[name].build(spark, folder).count() > 0
    assert "season" in labels and "player_match" not in labels


def test_typed_events_are_written_and_read_by_match(spark, folder, large):
    """Neither written nor read back events are exchanged once they are wide, and the rows are those of the plain files."""
    found = all_queries()["stg_events_typed"].build(spark, folder)
    text = plan(found)
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(match_id" in text and "Bucketed: true" in text
    want = all_queries()["stg_events"].build(spark, folder)
    assert found.dtypes == want.dtypes and found.exceptAll(want).count() == want.exceptAll(found).count() == 0 < found.count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_matches_beyond_the_type_of_an_id_are_no_actions(spark, folder):
    raw = feeds.raw_events(spark, folder).limit(50).withColumn("match_id", F.lit(5).cast("int")).withColumn("player", F.lit("a"))
    ids = spark.createDataFrame([(2**32 + 5,), (None,)], "match_id long")
    assert staging.events(raw, ids).count() == 0
    assert staging.events(raw, ids.union(spark.createDataFrame([(5,), (5,)], "match_id long"))).count() == 50
    assert staging.events(raw.withColumn("match_id", F.lit(None).cast("int")), ids).count() == 0


def test_flat_stints_are_dealt_by_all_their_keys(spark, folder):
    text = plan(all_queries()["stg_lineups_flat"].build(spark, folder))
    assert "hashpartitioning(from_time" in text and "REPARTITION_BY_NUM" not in text


def test_the_upsert_stream_takes_one_batch_for_each_feed(spark, folder, monkeypatch, large):
    """However many tasks the staged events lie in, the table is merged once for each of the five feeds."""
    from touchline.streaming.versions import VersionedTable

    merged = []

    def spy(self, batch, *args, keep=VersionedTable.merge, **more):
        merged.append(batch.inputFiles())
        return keep(self, batch, *args, **more)

    monkeypatch.setattr(VersionedTable, "merge", spy)
    rows = all_queries()["upserted_match_events"].build(spark, folder).count()
    assert 1 < len(merged) <= 5 and rows == base.Run(spark, folder).stg_events.select("event_id").distinct().count()
