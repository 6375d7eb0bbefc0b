"""Ordered operators: sliced results equal plain windows, and hand-worked cases."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators import aggregates, slices, standardize, windows
from touchline.operators.statistics import chi2, chi2_tail, mann_whitney


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; many share a time."""
    return spark.range(600).selectExpr(
        "id", "if(id % 3 = 0, id % 7, 99) AS k", "cast(id * 7919 % 50 AS int) AS t", "cast(id * 31 % 17 AS double) AS v"
    )


@pytest.mark.parametrize("n_slices", [60, 10, None])
def test_rolling_means(spark, skewed, n_slices):
    frame = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-5, -1)
    plain = skewed.withColumn("m", F.avg("v").over(frame))
    got = windows.rolling_means(skewed, ["k"], ["t", "id"], {"m": "v"}, 5, n_slices)
    assert rows(got.select("id", "m"), "id") == rows(plain.select("id", "m"), "id")


@pytest.mark.parametrize("n_slices", [60, 10, None])
def test_running_totals(spark, skewed, n_slices):
    frame = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    plain = skewed.withColumn("s", F.coalesce(F.sum("v").over(frame), F.lit(0)))
    got = windows.running_totals(skewed, ["k"], ["t", "id"], {"s": "v"}, n_slices)
    assert rows(got.select("id", "s"), "id") == rows(plain.select("id", "s"), "id")


@pytest.mark.parametrize("n_slices", [20, None])
def test_rank_by(spark, skewed, n_slices):
    plain = skewed.withColumn("rank", F.rank().over(Window.partitionBy("k").orderBy(F.desc("v"))).cast("long"))
    got = windows.rank_by(skewed, ["k"], "v", slices=n_slices)
    assert rows(got.select("id", "rank"), "id") == rows(plain.select("id", "rank"), "id")


@pytest.mark.parametrize("n_slices", [30, None])
def test_as_of_join(spark, skewed, n_slices):
    left = skewed.filter("id % 2 = 0").select("id", "k", "t")
    right = skewed.filter("id % 5 = 1").select("k", F.col("t").alias("rt"), "v")
    got = windows.as_of_join(left, right, ["k"], "t", "rt", ["v"], n_slices)
    pool = {}
    for k, t, v in right.collect():
        pool.setdefault(k, []).append((t, v))
    expected = []
    for i, k, t in left.orderBy("id").collect():
        hits = [x for x in pool.get(k, []) if x[0] <= t]
        best = max(hits) if hits else (None, None)
        expected.append((i, k, t, best[0], best[1]))
    assert rows(got, "id") == expected


@pytest.mark.parametrize("accuracy", [20, 50_000])
def test_exact_percentiles(spark, skewed, accuracy):
    plain = skewed.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.99))).alias("p"))
    expected = {(r["k"], p): v for r in plain.collect() for p, v in zip((0.1, 0.5, 0.99), r["p"])}
    got = aggregates.exact_percentiles(skewed, ["v"], [0.1, 0.5, 0.99], ["k"], accuracy)
    assert {(r["k"], r["p"]): pytest.approx(r["value"]) for r in got.collect()} == expected


def test_slices_cover_and_order(spark, skewed):
    cut = slices.in_slices(skewed, ["k"], ["t", "id"], 15)
    spans = cut.groupBy(slices.SLICE).agg(F.min(F.struct("k", "t", "id")).alias("lo"), F.max(F.struct("k", "t", "id")).alias("hi"), F.count(F.lit(1)).alias("n"))
    ordered = spans.orderBy(slices.SLICE).collect()
    assert len(ordered) > 10 and sum(r["n"] for r in ordered) == 600
    assert all(a["hi"] < b["lo"] for a, b in zip(ordered, ordered[1:]))


def test_many_heavy_groups_are_all_cut(spark):
    """3,000 heavy groups in ranges of their own: every one is cut, no slice is much larger than the others."""
    df = spark.range(240_000).selectExpr("id", "id % 3000 AS k", "id % 3000 * 1000 + cast(id / 3000 AS int) AS t", "1D AS v")
    cut = slices.in_slices(df, ["k"], ["t"], 6000)
    sizes = cut.groupBy("k", slices.SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 80
    assert cut.groupBy(slices.SLICE).count().agg(F.max("count")).first()[0] <= 200
    assert sizes.groupBy("k").count().filter("count > 1").count() > 2000


def test_row_numbers_of_a_sorted_whole(spark, skewed):
    got = windows.with_rank(skewed, [F.desc("v"), F.asc("id")], "place", 20).orderBy("place").collect()
    want = sorted(skewed.collect(), key=lambda r: (-r["v"], r["id"]))
    assert [(r["id"], r["place"]) for r in got] == [(r["id"], i + 1) for i, r in enumerate(want)]


def test_null_keys_and_missing_values_rank(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None), (3, "a", 1.0), (4, None, 5.0), (5, None, 2.0)], "id int, k string, v double")
    means = windows.rolling_means(df, ["k"], ["id"], {"m": "v"}, 2, 5)
    assert {r["id"]: r["m"] for r in means.collect()} == {1: None, 2: 2.0, 3: None, 4: 2.0, 5: 5.0}
    ranked = windows.rank_by(df.filter("k IS NULL").withColumn("k", F.lit("x")), ["k"], "v")
    assert {r["id"]: r["rank"] for r in ranked.collect()} == {1: 2, 2: None, 4: 1, 5: 2}


def test_null_order_values_go_first(spark):
    df = spark.sql("SELECT id, 1 AS k, if(id < 5, NULL, id) AS t, 1D AS v FROM range(60)")
    frame = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-3, -1)
    got = windows.rolling_means(df, ["k"], ["t", "id"], {"m": "id"}, 3, 9)
    plain = df.withColumn("m", F.avg("id").over(frame))
    assert rows(got.select("id", "m"), "id") == rows(plain.select("id", "m"), "id")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9), st.integers(-5, 5)), min_size=1, max_size=60), st.integers(2, 12))
def test_rolling_any_table(spark, data, limit):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], "id int, k int, t int, v int")
    frame = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-2, -1)
    got = windows.rolling_means(df, ["k"], ["t", "id"], {"m": "v"}, 2, limit)
    plain = df.withColumn("m", F.avg("v").over(frame))
    assert rows(got.select("id", "m"), "id") == rows(plain.select("id", "m"), "id")


def test_rolling_form_by_hand(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 3, 5, 6, 7)]
    df = spark.createDataFrame([(i + 1, day, "T", float(i + 1)) for i, day in enumerate(days)], "match_id int, day date, team string, x double")
    got = windows.rolling_means(df, ["team"], ["day", "match_id"], {"m": "x"}, 5)
    means = {r["match_id"]: r["m"] for r in got.collect()}
    assert means[1] is None and means[2] == 1.0 and means[6] == 3.0 and means[7] == 4.0


def test_head_to_head_by_hand(spark):
    d = dt.date
    df = spark.createDataFrame(
        [(1, d(2024, 1, 1), "A", "B", "home_win"), (2, d(2024, 2, 1), "B", "A", "home_win"), (3, d(2024, 3, 1), "A", "B", "draw"),
         (4, d(2024, 3, 1), "B", "A", "away_win"), (5, d(2024, 4, 1), "A", "C", "draw")],
        "match_id int, day date, home string, away string, result string",
    )
    got = {r[0]: (r[1], r[2], r[3]) for r in windows.prior_meetings(df, "match_id", "day", "home", "away", "result").collect()}
    assert got == {1: (0, 0, None), 2: (1, 0, 0.0), 3: (2, 1, 0.5), 4: (2, 1, 0.5), 5: (0, 0, None)}


def test_top_mean_ignores_missing(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 5, 2), ("A", 3, 4), ("B", 7, None)], "k string, x int, y int")
    got = {r["k"]: (r["top2_x"], r["top2_y"]) for r in windows.top_mean(df, ["k"], ["x", "y"], 2, "top2_").collect()}
    assert got == {"A": (4.0, 3.0), "B": (7.0, None)}


def test_group_limit_is_pushed_below_the_shuffle(spark, skewed, capsys):
    windows.top_n(skewed, ["k"], [F.desc("v"), F.asc("id")], 3).explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


def test_context_zscores(spark):
    df = spark.createDataFrame([(1, False, 1.0, 5.0), (2, False, 2.0, 5.0), (3, False, 3.0, 5.0), (4, True, 9.0, 1.0)], "id int, nat boolean, x double, y double")
    got = {r["id"]: (r["z_x"], r["z_y"]) for r in standardize.zscores(df, ["x", "y"], ["nat"]).collect()}
    assert got == {1: (-1.0, None), 2: (0.0, None), 3: (1.0, None), 4: (None, None)}


def test_chi2_tail(spark):
    got = spark.createDataFrame([(3.841459, 1.0), (9.487729, 4.0), (0.0, 3.0), (25.0, 10.0)], "x double, dof double").select(chi2_tail("x", "dof"))
    values = [r[0] for r in got.collect()]
    assert values[0] == pytest.approx(0.05, abs=1e-6) and values[1] == pytest.approx(0.05, abs=1e-6)
    assert values[2] == 1.0 and values[3] == pytest.approx(0.005345505, abs=1e-8)


def test_chi2_against_spark_ml(spark, skewed):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = skewed.selectExpr("cast(k AS double) AS a", "cast(v % 4 AS double) AS b")
    ours = chi2(df, "a", "b").first()
    theirs = ChiSquareTest.test(VectorAssembler(inputCols=["a"], outputCol="x").transform(df), "x", "b", True).first()
    assert ours["chi2"] == pytest.approx(theirs["statistic"])
    assert ours["dof"] == theirs["degreesOfFreedom"]
    assert ours["p_value"] == pytest.approx(theirs["pValue"], abs=1e-9)


@pytest.mark.parametrize("n_slices", [12, None])
def test_mann_whitney_by_pairs(spark, skewed, n_slices):
    got = mann_whitney(skewed, F.col("k") == 99, "v", slices=n_slices).first()
    first = [r["v"] for r in skewed.filter("k = 99").collect()]
    second = [r["v"] for r in skewed.filter("k <> 99").collect()]
    u = sum((a > b) + 0.5 * (a == b) for a in first for b in second)
    assert got["u"] == u and (got["n_first"], got["n_second"]) == (len(first), len(second))
    assert 0 < got["p_value"] <= 1


@pytest.mark.parametrize("slices", [None, 7])
def test_several_as_of_lookups_in_one_pass(spark, slices, tmp_path):
    import random

    from touchline.operators.windows import as_of_join, as_of_join_many

    rng = random.Random(5)
    teams = ["a", "b", "c", None]
    left = [(i, rng.choice(teams), rng.choice(teams), rng.randrange(60), "x") for i in range(400)]
    right = [(rng.choice(teams[:3] if rng.random() < 0.9 else ["hot"]), rng.randrange(60), rng.randrange(9)) for _ in range(90)]
    lhs = spark.createDataFrame(left, "id int, home string, away string, t int, rank string").repartition(3)
    rhs = spark.createDataFrame(right, "team string, at int, rank int")
    got = as_of_join_many(lhs, rhs, ["id"], {"h_": "home", "a_": "away"}, "team", "t", "at", ["rank"], slices)
    want = lhs.withColumnRenamed("rank", "kept")
    for prefix, side in (("h_", "home"), ("a_", "away")):
        named = rhs.withColumnRenamed("team", side)
        want = as_of_join(want, named, [side], "t", "at", ["rank"]).withColumnsRenamed({"at": f"{prefix}at", "rank": f"{prefix}rank"})
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(map(tuple, want.collect()), key=lambda r: r[0])
    assert got.columns == ["id", "home", "away", "t", "rank", "h_at", "h_rank", "a_at", "a_rank"]
    assert as_of_join_many(lhs.limit(0), rhs, ["id"], {"h_": "home"}, "team", "t", "at", ["rank"], slices).count() == 0
