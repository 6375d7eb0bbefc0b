"""K-Means with many starts in shared passes, and silhouettes, against other implementations."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from touchline.operators import clustering
from touchline.operators.clustering import assign, best_of, fit_many, silhouettes


def blobs(n, centres, dims, spread, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 10, (centres, dims))
    return middle[rng.integers(0, centres, n)] + rng.normal(0, spread, (n, dims))


def frame(spark, x, parts=4):
    return spark.createDataFrame([(i, v.tolist(), "other") for i, v in enumerate(x)], "id long, _v array<double>, cost string").repartition(parts).cache()


def cost_of(x, points):
    return ((x[:, None] - points[None]) ** 2).sum(2).min(1).sum()


@pytest.fixture(scope="module")
def fitted(spark):
    x = blobs(3000, 6, 5, 2.5)
    df = frame(spark, x)
    return x, df, fit_many(df, range(2, 11), 10, 42)


def test_all_sets_of_a_scan_share_their_passes(fitted):
    x, _, sets = fitted
    assert [(c.k, c.start) for c in sets] == [(k, s) for k in range(2, 11) for s in range(10)]
    assert len({c.passes for c in sets}) == 1
    # ten draws at most, and the longest of ninety fits, instead of all fits' iterations
    assert sets[0].passes <= 10 + 101
    for c in sets:
        assert c.cost == pytest.approx(cost_of(x, c.points), rel=1e-9)
        near = ((x[:, None] - c.points[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[near == i].mean(0) if (near == i).any() else p for i, p in enumerate(c.points)])
        assert np.abs(moved - c.points).max() < 1e-3


def test_best_cost_is_that_of_as_many_single_fits(fitted):
    x, df, sets = fitted
    vectors = df.select(array_to_vector("_v").alias("features")).cache()
    for k in (3, 6):
        single = min(KMeans(k=k, seed=i, maxIter=100).fit(vectors).summary.trainingCost for i in range(10))
        assert best_of(sets, k).cost <= single * 1.0001


def test_costs_fall_with_more_clusters(fitted):
    costs = [best_of(fitted[2], k).cost for k in range(2, 11)]
    assert all(a >= b for a, b in zip(costs, costs[1:]))


def test_assignment_in_expressions(fitted):
    x, df, sets = fitted
    best = best_of(sets, 6)
    near = ((x[:, None] - best.points[None]) ** 2).sum(2).argmin(1)
    assert {r.id: r.cluster for r in best.assign(df, "_v").collect()} == dict(enumerate(near.tolist()))


def test_few_distinct_vectors_nulls_and_none(spark):
    x = np.array([[1.0, 2.0], [3.0, 4.0]] * 20)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, _v array<double>")
    best = best_of(fit_many(df, [5], 2, 1))
    assert sorted(best.points.tolist()) == [[1.0, 2.0], [3.0, 4.0]] and best.cost == 0
    assert fit_many(df.limit(0), [3], 2, 1) == []
    tie = assign(spark.createDataFrame([(0, [0.0])], "id long, _v array<double>"), "_v", np.array([[1.0], [-1.0]]))
    assert tie.first().cluster == 0


def plain_silhouette(x, labels):
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        inside = gaps[i, same].sum() / (same.sum() - 1)
        other = min(gaps[i, labels == k].mean() for k in set(labels) if k != own)
        out.append((other - inside) / max(inside, other) if max(inside, other) else 0.0)
    return float(np.mean(out))


def test_silhouettes_equal_brute_force(spark):
    x = np.concatenate((blobs(300, 4, 3, 4.0), np.zeros((2, 3))))
    rng = np.random.default_rng(1)
    labels = np.array([rng.integers(0, 4, len(x)), rng.integers(5, 7, len(x)), np.full(len(x), 3)])
    labels[0][7] = 9  # alone in its cluster
    rows = [(i, x[i].tolist(), *[int(v[i]) for v in labels]) for i in range(len(x))] + [(900, None, 0, 0, 0), (901, [1.0] * 3, None, 5, 3)]
    df = spark.createDataFrame(rows, "id long, v array<double>, a int, b int, c int").repartition(5)
    got = {r.label: (r.n_rows, r.silhouette) for r in silhouettes(df, "v", ["a", "b", "c"], [F.col("id")]).collect()}
    assert got["a"] == (302, pytest.approx(plain_silhouette(x, labels[0]), abs=1e-12))
    assert got["b"] == (302, pytest.approx(plain_silhouette(x, labels[1]), abs=1e-12))
    assert got["c"] == (302, None)
    got = silhouettes(df, "v", ["a"], [F.desc("id")], 50).first()
    some = np.arange(302)[-50:]
    assert (got.n_rows, got.silhouette) == (50, pytest.approx(plain_silhouette(x[some], labels[0][some]), abs=1e-12))
    assert silhouettes(df.limit(0), "v", ["a"], [F.col("id")]).first().silhouette is None


class Shared:
    def __init__(self, value):
        self.value = value


def test_sums_of_many_sets_are_matrix_products_over_small_blocks():
    """Sets of several sizes, rows at equal distances and centres that occur twice: the first among equals takes a row."""
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (5000, 3)).astype(float)
    sets = {j: rng.integers(-3, 4, (k, 3)).astype(float) for j, k in enumerate([4, 2, 7, 4, 1, 7])}
    sets[3][2] = sets[3][0]
    column = pa.array(x.tolist(), pa.list_(pa.float64()))
    blocks = list(clustering._packed([pa.record_batch([column], ["v"])]))
    assert max(b.column(0)[0].as_buffer().size for b in blocks) <= clustering.ROWS * 3 * 8 < x.nbytes
    found = {(r["job"], r["cluster"]): (r["n"], r["sums"]) for b in clustering._sums(Shared(sets), 3)(blocks) for r in b.to_pylist()}
    costs = {r["job"]: r["cost"] for b in clustering._costs(Shared(sets), 3)(blocks) for r in b.to_pylist()}
    assert sorted(found) == [(j, c) for j, p in sets.items() for c in range(len(p))]
    for j, p in sets.items():
        near = ((x[:, None] - p[None]) ** 2).sum(2).argmin(1)
        for c in range(len(p)):
            assert found[j, c] == (int((near == c).sum()), pytest.approx(x[near == c].sum(0).tolist()))
        assert costs[j] == pytest.approx(cost_of(x, p))
