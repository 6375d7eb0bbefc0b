"""Nearest rows by pivots are those of a full scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import neighbours
from touchline.operators.neighbours import build_index, nearest, nearest_rows

SCHEMA = "id long, v array<double>, band string, key string"


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist(), "clash", "k") for i, v in enumerate(x)] + [(9999, None, "", "")], SCHEMA).repartition(4)


def plain(x, wanted, n, others=True):
    out = {}
    for q in wanted:
        gaps = np.sqrt(((x - x[q]) ** 2).sum(1))
        out[q] = [i for i in sorted(range(len(x)), key=lambda i: (gaps[i], i)) if i != q or not others][:n]
    return out


def answers(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append(r["key"])
    return out


@pytest.fixture(scope="module")
def spots(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 20, (12, 3))[rng.integers(0, 12, 2500)] + rng.normal(0, 1, (2500, 3))
    x = np.round(x, 3)
    x[100:110] = x[50]  # ties
    return x, build_index(frame(spark, x), "id", "v", pivots=8, bands=40)


def test_answers_equal_a_full_scan_and_few_rows_are_compared(spark, spots):
    x, index = spots
    wanted = list(range(0, 2500, 25))
    queries = frame(spark, x).where(F.col("id").isin(wanted))
    got = nearest(index, queries, "id", "v", 10).collect()
    want = plain(x, wanted, 10)
    for q, keys in answers(got).items():
        gaps = np.sqrt(((x - x[q]) ** 2).sum(1))
        assert np.allclose(gaps[keys], gaps[want[q]]) and len(keys) == 10
    assert answers(got)[50] == want[50]
    assert np.mean([r["compared"] for r in got]) < 0.2 * len(x)


def test_other_queries_more_places_than_rows_and_none(spark, spots):
    x, index = spots
    far = spark.createDataFrame([(-1, [500.0, 0.0, 0.0]), (-2, None)], "id long, v array<double>")
    got = answers(nearest(index, far, "id", "v", 3, others_only=False).collect())
    gaps = np.sqrt(((x - [500, 0, 0]) ** 2).sum(1))
    assert got == {-1: np.lexsort((np.arange(len(x)), gaps))[:3].tolist()}
    few = x[:6]
    assert answers(nearest_rows(frame(spark, few), "id", "v", [0, 3], 20, pivots=4).collect()) == plain(few, [0, 3], 20)
    assert nearest_rows(frame(spark, few).limit(0), "id", "v", [1], 2).count() == 0


def test_blocks_keep_the_nearest_rows_alone(spark, spots, monkeypatch):
    """Pieces and query groups far smaller than the bands give the same, and no row for every compared pair is written."""
    x, index = spots
    wanted = list(range(0, 2500, 50))
    queries = frame(spark, x).where(F.col("id").isin(wanted))
    want = nearest(index, queries, "id", "v", 10).collect()
    written = []

    def spy(df, label, keep=neighbours.materialize):
        out = keep(df, label)
        if label == "compared":
            written.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "materialize", spy)
    monkeypatch.setattr(neighbours, "PIECE_ROWS", 40)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 7)
    assert sorted(nearest(index, queries, "id", "v", 10).collect()) == sorted(want)
    monkeypatch.setattr(neighbours, "PIECE_ROWS", 4096)
    assert sorted(nearest(index, queries, "id", "v", 10).collect()) == sorted(want)
    assert written[1] < sum({r["query"]: r["compared"] for r in want}.values()) / 3


def test_repeated_rows_and_keys_each_count(spark):
    x = np.array([[0.0], [1.0], [2.0], [4.0], [8.0]])
    rows = frame(spark, x).unionAll(frame(spark, x))
    got = nearest(build_index(rows, "id", "v", pivots=2), frame(spark, x).where("id = 0"), "id", "v", 3).collect()
    assert [(r["key"], r["distance"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1.0), (1, 1.0), (2, 2.0)]
