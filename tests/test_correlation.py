"""Correlations of values that never vary."""

import math

import pytest

from touchline.operators.aggregates import corr_matrix
from touchline.plans.international import gap_win_correlation


def frame(spark, rows):
    return spark.createDataFrame(rows, "top11_diff double, home_win int")


def test_a_constant_gap_has_no_correlation(spark):
    row = gap_win_correlation(frame(spark, [(0.1, 1), (0.1, 0), (0.1, 1), (None, 1), (2.0, None)]).repartition(3)).first()
    assert row.n == 3 and math.isnan(row["corr"])
    row = gap_win_correlation(frame(spark, [(0.5, 1), (1.5, 1), (2.5, None)])).first()
    assert row.n == 2 and math.isnan(row["corr"])


def test_correlation_of_rows_that_have_both(spark):
    row = gap_win_correlation(frame(spark, [(1.0, 0), (2.0, 1), (3.0, 1), (None, 0), (9.0, None)])).first()
    assert row.n == 3 and row["corr"] == pytest.approx(0.8660254037844387)
    assert tuple(gap_win_correlation(frame(spark, [])).first()) == (0, None)


def test_matrix_with_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 1.0), (4.0, 5.0, -1.0)], "a double, b double, c double")
    got = {(r.a, r.b): r["corr"] for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "c"] == pytest.approx(-1.0) and math.isnan(got["a", "b"]) and math.isnan(got["b", "c"])
