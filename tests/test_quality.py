"""Each check with a failing and a passing table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.operators import joins, quality
from touchline.sources import readers, writers


@pytest.fixture(scope="module")
def bad(spark):
    return spark.createDataFrame([(1, "a", 0.5), (1, None, 1.5), (2, "z", None)], "id int, kind string, x double")


@pytest.fixture(scope="module")
def good(spark):
    return spark.createDataFrame([(1, "a", 0.5), (2, "b", 1.0)], "id int, kind string, x double")


def failures(df):
    return sum(r["failures"] for r in df.collect())


def test_checks(spark, bad, good):
    parent = spark.createDataFrame([(1,)], "id int")
    both = spark.createDataFrame([(1,), (2,)], "id int")
    checks = {
        1: lambda d: quality.unique(d, ["id"], "u"),
        2: lambda d: quality.not_null(d, ["kind", "x"], "t"),
        3: lambda d: quality.accepted(d, "kind", ["a", "b"], "a"),
        4: lambda d: quality.in_range(d, "x", 0.0, 1.0, "r"),
    }
    assert {k: failures(c(bad)) for k, c in checks.items()} == {1: 1, 2: 2, 3: 1, 4: 1}
    assert {k: failures(c(good)) for k, c in checks.items()} == {1: 0, 2: 0, 3: 0, 4: 0}
    assert failures(quality.relationship(bad, "id", parent, "id", "f")) == 1
    assert failures(quality.relationship(good, "id", both, "id", "f")) == 0
    assert failures(quality.unique(bad, ["id", "kind"], "combo")) == 0
    assert quality.assert_rows(bad, F.col("x").between(0, 1)).count() == 1
    assert quality.assert_rows(good, F.col("x").between(0, 1)).count() == 0


def test_required_columns(good):
    assert quality.require_columns(good, ["id"]) is good
    with pytest.raises(ValueError, match="missing columns"):
        quality.require_columns(good, ["id", "nope"])


def test_fan_out(good, bad):
    assert tuple(quality.fan_out(good, bad).first()) == (2, 3, 1)


@pytest.mark.parametrize("age, status", [(3, "pass"), (8, "warn"), (31, "error")])
def test_freshness(spark, age, status):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 10),)], "day date")
    today = F.lit(dt.date(2024, 1, 10) + dt.timedelta(days=age))
    assert quality.freshness(df, "day", today).first()["status"] == status


def test_totals_compare(spark, good):
    other = good.withColumn("x", F.col("x") * 2)
    rows = {r["kind"]: r["diff_x"] for r in quality.compare_totals(good, other, ["kind"], ["x"]).collect()}
    assert rows == {"a": -0.5, "b": -1.0}


def test_one_to_one(spark, good, bad):
    left = good.select("id", "kind")
    assert joins.one_to_one(left, good.select("id", "x"), ["id"]).count() == 2
    with pytest.raises(Exception, match="join key repeats"):
        joins.one_to_one(left, bad.select("id", "x"), ["id"]).collect()


def test_rename_in_force(spark):
    d = dt.date
    df = spark.createDataFrame([("Old", d(2000, 1, 1)), ("Old", d(2020, 1, 1)), ("New", d(2000, 1, 1))], "team string, day date")
    names = spark.createDataFrame([("New", "Old", d(1990, 1, 1), d(2010, 1, 1))], "current string, former string, start_date date, end_date date")
    got = sorted(tuple(r) for r in joins.rename_in_force(df, names, "team", "day").collect())
    assert got == [("New", d(2000, 1, 1)), ("New", d(2000, 1, 1)), ("Old", d(2020, 1, 1))]


def test_landing_replaces_only_its_day(spark, good, tmp_path):
    root = str(tmp_path / "land")
    writers.land(good, root, "t", "2024-01-01")
    writers.land(good, root, "t", "2024-01-02")
    writers.land(good.limit(1), root, "t", "2024-01-02")
    got = {str(r[0]): r[1] for r in spark.read.parquet(f"{root}/t").groupBy("load_date").count().collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 1}


def test_report_export_has_no_size_limit(spark, tmp_path):
    writers.export_summary(spark.range(20_000).repartition(3), str(tmp_path / "x"))
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).count() == 20_000
    writers.export_summary(spark.range(50).repartition(3), str(tmp_path / "y"), one_file=True)
    assert len(list((tmp_path / "y").glob("part-*"))) == 1


def test_csv_dates(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("date,home_team,away_team,home_score,away_score,tournament,city,country,neutral\n2024-02-29,A,B,1,,Cup,X,Y,TRUE\n")
    row = readers.read_results(spark, str(path)).first()
    assert row["date"] == dt.date(2024, 2, 29) and row["away_score"] is None and row["neutral"] is True
