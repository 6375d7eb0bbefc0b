"""Streams fed file by file give the batch answer; replays change nothing; late rows are kept."""

import pytest
from pyspark.sql import functions as F

from touchline.operators.windows import top_n
from touchline.sources.readers import read_table
from touchline.streaming import jobs
from touchline.streaming.tables import KeyedTable, keep_last_rule, upsert_rule


@pytest.fixture
def events(spark, folder):
    return read_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def write_files(events, path, n=4):
    """One write per part; the oldest part comes last, as late data."""
    for i in [*range(1, n), 0]:
        events.filter(F.pmod(F.floor(F.col("event_id") / 50), F.lit(n)) == i).coalesce(1).write.mode("append").parquet(path)


def test_ingest_keeps_a_cursor(spark, events, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    events.limit(100).coalesce(1).write.parquet(src)
    for _ in range(2):
        jobs.ingest_new(jobs.file_stream(spark, src, events.schema), out, ckpt)
    assert spark.read.parquet(out).count() == 100
    events.limit(30).coalesce(1).write.mode("append").parquet(src)
    jobs.ingest_new(jobs.file_stream(spark, src, events.schema), out, ckpt)
    assert spark.read.parquet(out).count() == 130


def test_upsert(spark, events, tmp_path):
    src = str(tmp_path / "src")
    write_files(events, src)
    table = KeyedTable(str(tmp_path / "t"), ("user_id",), 4)
    stream = jobs.file_stream(spark, src, events.schema, files_per_batch=1).select("user_id", "event_type", "event_id", "ts")
    jobs.upsert_stream(stream, table, ["event_id"], ["ts"], str(tmp_path / "ckpt"))
    got = table.rows(spark, stream.schema)
    assert got.count() == events.select("event_id").distinct().count()
    before = sorted(r["event_id"] for r in got.collect())
    batch = events.select("user_id", "event_type", "event_id", "ts").limit(40)
    table.merge(batch, 1000, upsert_rule(["event_id"], [F.desc("ts")]))
    table.merge(batch, 1000, upsert_rule(["event_id"], [F.desc("ts")]))
    assert sorted(r["event_id"] for r in table.rows(spark, stream.schema).collect()) == before


def test_changed_row_wins_and_late_row_stays(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), 4)
    rule = upsert_rule(["id"], [F.desc("v")])
    schema = "id int, v string"
    table.merge(spark.createDataFrame([(1, "a"), (2, "b")], schema), 0, rule)
    table.merge(spark.createDataFrame([(2, "c"), (0, "late")], schema), 1, rule)
    got = sorted(tuple(r) for r in table.rows(spark, spark.createDataFrame([], schema).schema).collect())
    assert got == [(0, "late"), (1, "a"), (2, "c")]


SCHEMA = "id int, v string"


def replace_rows(current, batch):
    return upsert_rule(["id"], [F.desc("v")])(current, batch)


def stored(spark, table):
    return sorted(tuple(r) for r in table.rows(spark, spark.createDataFrame([], SCHEMA).schema).collect())


def test_interrupted_merge_is_finished_on_replay(spark, tmp_path):
    """A batch whose merge was staged but not copied is copied, not merged again."""
    table = KeyedTable(str(tmp_path / "t"), ("id",), 2)
    table.merge(spark.createDataFrame([(1, "a")], SCHEMA), 0, replace_rows, "s")
    staged = spark.createDataFrame([(1, "staged")], SCHEMA).withColumn("_bucket", table._bucket())
    staged.write.parquet(f"{table.path}/staged/s.1.1")
    table.merge(spark.createDataFrame([(1, "other")], SCHEMA), 1, replace_rows, "s")
    assert stored(spark, table) == [(1, "staged")]
    assert not (tmp_path / "t" / "staged").exists()
    table.merge(spark.createDataFrame([(1, "again")], SCHEMA), 1, replace_rows, "s")
    assert stored(spark, table) == [(1, "staged")]


def test_staged_merge_is_done_anew_after_another_one(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), 1)
    table.merge(spark.createDataFrame([(1, "a")], SCHEMA), 0, replace_rows, "s")
    table.merge(spark.createDataFrame([(2, "b")], SCHEMA), 0, replace_rows, "other")
    old = spark.createDataFrame([(1, "x")], SCHEMA).withColumn("_bucket", table._bucket())
    old.write.parquet(f"{table.path}/staged/s.1.1")
    table.merge(spark.createDataFrame([(1, "c")], SCHEMA), 1, replace_rows, "s")
    assert stored(spark, table) == [(1, "c"), (2, "b")]


def test_batch_ids_that_restart_lose_nothing(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), 2)
    for batch_id, rows in ((0, [(1, "a")]), (1, [(1, "b")]), (0, [(2, "new")])):
        table.merge(spark.createDataFrame(rows, SCHEMA), batch_id, replace_rows)
    assert stored(spark, table) == [(1, "b"), (2, "new")]


def test_an_older_batch_of_a_stream_is_refused(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), 2)
    for batch_id in (3, 4):
        table.merge(spark.createDataFrame([(batch_id, "a")], SCHEMA), batch_id, replace_rows, "s")
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(9, "old")], SCHEMA), 3, replace_rows, "s")
    assert stored(spark, table) == [(3, "a"), (4, "a")]


def test_two_streams_and_a_fresh_checkpoint_share_a_table(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), 2)
    for name, row in (("one", (1, "a")), ("two", (2, "b"))):
        spark.createDataFrame([row], SCHEMA).write.parquet(str(tmp_path / name))
        stream = jobs.file_stream(spark, str(tmp_path / name), SCHEMA)
        for checkpoint in ("c1", "c2"):
            jobs.upsert_stream(stream, table, ["id"], ["v"], str(tmp_path / f"{name}-{checkpoint}"))
    assert stored(spark, table) == [(1, "a"), (2, "b")]


def test_form_over_more_than_a_thousand_matches(spark, tmp_path):
    rows = spark.range(1501).selectExpr("1 AS team", "id AS match", "id AS day", "cast(id AS double) AS x")
    table = KeyedTable(str(tmp_path / "t"), ("team",), 2)
    table.merge(rows, 0, keep_last_rule(["team"], ["team", "match"], ["day"], 1501))
    got = jobs.form_now(table.rows(spark, rows.schema), "team", ["day"], {"form": "x"}).first()
    assert (got["last_day"], got["form"]) == (1500, 749.5)


def test_late_rows_are_counted(spark, tmp_path):
    source, schema = str(tmp_path / "src"), "ts timestamp, k string"
    for day in ("2024-01-10", "2024-01-11", "2024-01-01"):
        spark.sql(f"SELECT timestamp '{day} 12:00:00' AS ts, 'a' AS k").coalesce(1).write.mode("append").parquet(source)
    counts = jobs.tempo_stream(jobs.file_stream(spark, source, schema, files_per_batch=1), "ts", ["k"], "1 hour", "1 day")
    table = KeyedTable(str(tmp_path / "t"), ("k",), 1)
    assert jobs.tempo_table(counts, table, ["k"], str(tmp_path / "ckpt")) == 1
    assert table.rows(spark, counts.schema).count() == 2


def test_form_state(spark, events, tmp_path):
    src = str(tmp_path / "src")
    write_files(events, src)
    stream = jobs.file_stream(spark, src, events.schema, files_per_batch=1).select("user_id", "event_id", "ts", "value")
    table = KeyedTable(str(tmp_path / "t"), ("user_id",), 4)
    jobs.form_state(stream, table, "user_id", "event_id", ["ts", "event_id"], 5, str(tmp_path / "ckpt"))
    got = jobs.form_now(table.rows(spark, stream.schema), "user_id", ["ts", "event_id"], {"form": "value"})
    last = top_n(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 6, rank="k").filter("k > 1")
    expected = {r["user_id"]: r["form"] for r in last.groupBy("user_id").agg(F.avg("value").alias("form")).collect()}
    assert {r["user_id"]: r["form"] for r in got.collect()} == pytest.approx(expected)


def test_keep_last_counts_a_row_once(spark):
    schema = "team int, match int, day int, x int"
    rule = keep_last_rule(["team"], ["team", "match"], ["day", "match"], 2)
    old = spark.createDataFrame([(1, 1, 1, 10), (1, 2, 2, 20)], schema)
    new = spark.createDataFrame([(1, 2, 2, 21), (1, 0, 0, 5)], schema)
    assert sorted(tuple(r) for r in rule(old, new).collect()) == [(1, 1, 1, 10), (1, 2, 2, 21)]


def test_tempo(spark, events, tmp_path):
    src = str(tmp_path / "src")
    events.coalesce(1).write.parquet(src)
    counts = jobs.tempo_stream(jobs.file_stream(spark, src, events.schema), "ts", ["event_type"], "1 day", "30 days")
    table = KeyedTable(str(tmp_path / "t"), ("event_type",), 4)
    jobs.tempo_table(counts, table, ["event_type"], str(tmp_path / "ckpt"))
    batch = events.groupBy(F.window("ts", "1 day").getField("start").alias("w"), "event_type").count()
    assert sorted(tuple(r) for r in table.rows(spark, counts.schema).collect()) == sorted(tuple(r) for r in batch.collect())
