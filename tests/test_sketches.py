"""Sketches merged day by day against exact answers."""

import pytest
from pyspark.sql import functions as F

from touchline.operators.sketches import estimates, merge_rule, merged, sketches
from touchline.streaming.versions import VersionedTable


@pytest.fixture(scope="module")
def rows(spark):
    out = spark.range(60_000).select(
        (F.col("id") % 7).alias("day"),
        F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user"),
        F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1_000_000)) / 1e6).alias("value"),
        F.lit("clash").alias("column"),
    )
    return out.withColumn("value", F.when(F.col("day") == 3, F.lit(float("nan"))).otherwise(F.col("value"))).drop("column").cache()


def rank(rows, q):
    known = rows.where("value IS NOT NULL AND NOT isnan(value)")
    return known.where(F.col("value") <= q).count() / known.count()


def test_days_merged_are_near_the_whole(spark, rows):
    days = sketches(rows, ["day"], ["user", "value"], ["value"]).cache()
    got = {r.column: r for r in estimates(merged(days, []), [], [0.1, 0.5, 0.9]).collect()}
    assert got["user"].n == 60_000 and got["user"].quantiles is None
    exact = rows.select("user").distinct().count()
    assert abs(got["user"].n_distinct / exact - 1) < 4 * 1.04 / 2**6
    assert got["value"].n == rows.where("value IS NOT NULL AND NOT isnan(value)").count()
    for p, q in zip((0.1, 0.5, 0.9), got["value"].quantiles):
        assert abs(rank(rows, q) - p) < 0.0165
    whole = {r.column: r for r in estimates(merged(sketches(rows, [], ["user"]), []), []).collect()}
    assert got["user"].n_distinct == whole["user"].n_distinct


def test_batches_of_a_table_give_the_same_as_one_batch(spark, rows, tmp_path):
    keys = ["day"]
    table = VersionedTable(str(tmp_path), ("day", "column"), merge_rule(keys), 4, 3)
    for k in range(5):
        some = rows.where(F.pmod(F.xxhash64(F.lit(2), "user", "day"), F.lit(5)) == k)
        table.merge(sketches(some, keys, ["user"], ["value"]), k, stream="s")
    schema = sketches(rows, keys, ["user"], ["value"]).schema
    got = {(r.day, r.column): r for r in estimates(table.rows(spark, schema), keys, [0.5]).collect()}
    exact = {r.day: r for r in rows.groupBy("day").agg(F.count_distinct("user").alias("u"), F.count("user").alias("n")).collect()}
    assert len(got) == 14
    for day, r in exact.items():
        assert got[day, "user"].n == r.n and abs(got[day, "user"].n_distinct / r.u - 1) < 4 * 1.04 / 2**6
    assert got[3, "value"].n == 0 and got[3, "value"].quantiles is None


def test_few_values_are_exact_and_none_give_no_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 9.0), (2, None, None)], "g int, s string, x double")
    got = {r.column: r for r in estimates(merged(sketches(df, ["g"], ["s"], ["x"]), []), [], [0.0, 1.0]).collect()}
    assert (got["s"].n, got["s"].n_distinct) == (3, 2)
    assert (got["x"].n, got["x"].quantiles) == (3, [1.0, 9.0])
    assert sketches(df.limit(0), ["g"], ["s"], ["x"]).count() == 0


def test_sample_draws_repeated_rows_one_by_one(spark):
    from touchline.plans.exploration import sample_rows

    df = spark.createDataFrame([(1, "same")] * 9000 + [(i, "other") for i in range(1000)], "a int, b string").repartition(6)
    got = sample_rows(df, 500)
    assert got.columns == ["a", "b"]
    n = {r.b: r["count"] for r in got.groupBy("b").count().collect()}
    assert sum(n.values()) == 500 and 400 < n["same"] < 490
    assert sorted(map(tuple, sample_rows(df.repartition(2), 500).collect())) == sorted(map(tuple, got.collect()))
    assert sample_rows(df, 20_000).count() == 10_000
    assert sample_rows(df.limit(0), 5).count() == 0
