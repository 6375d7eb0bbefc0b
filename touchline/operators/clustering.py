"""K-Means for many starts and numbers of clusters in the same passes, and silhouettes on true distances.

A pass reads the vectors once for all centre sets together: each task sums the
vectors of every (set, cluster), Spark adds these sums up, and the new centres
come to the driver (sets x clusters x dimensions numbers). Sets that have
settled drop out of later passes; the last pass adds up the costs of all. The
first centres are drawn the same way, one centre of every set a pass, each row
with a chance in proportion to its squared distance from the set's centres so
far. Sums are matrix products over small blocks of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import materialize, share_code

#: rows whose distances are held at once: those from several hundred centres still fit a core's cache
ROWS = 1024


@dataclass
class Centres:
    """One fitted centre set; ``passes`` over the vectors is shared by all sets of a fit."""

    k: int
    start: int
    points: np.ndarray
    cost: float
    passes: int

    def assign(self, df: DataFrame, vector: str, output: str = "cluster") -> DataFrame:
        """Adds the number of the nearest centre, the first one among equals."""
        return assign(df, vector, self.points, output)


#: terms of distances written out as one compiled expression; more would exceed the size of a JVM method
COMPILED_TERMS = 160


def assign(df: DataFrame, vector: str, points: np.ndarray, output: str = "cluster") -> DataFrame:
    """Adds the number of the nearest of ``points``, the first one among equals; null for a null vector."""

    def squared(point: np.ndarray) -> Column:
        if points.size > COMPILED_TERMS:
            gaps = F.zip_with(vector, F.lit(point.tolist()), lambda a, b: (a - b) * (a - b))
            return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)
        total = F.lit(0.0)
        for j, x in enumerate(point.tolist()):
            gap = F.col(vector)[j] - F.lit(x)
            total = total + gap * gap
        return total

    near = df.withColumn("_gaps", F.array(*[squared(p) for p in points]))
    return near.withColumn(output, (F.array_position("_gaps", F.array_min("_gaps")) - 1).cast("int")).drop("_gaps")


def _matrices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    for batch in batches:
        column = batch.column(0)
        if len(column):
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
            for at in range(0, len(x), rows):
                yield x[at : at + rows]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as blocks of plain numbers, which later passes take as they lie."""
    for x in _matrices(batches, ROWS):
        yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x, np.float64).tobytes()], pa.binary())], ["block"])


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column(0):
            yield np.frombuffer(block.as_buffer()).reshape(-1, dims)


def _draws(shared, seed: int, step: int):
    """For each set the row of the partition that wins the race for its next centre."""

    def run(batches):
        sets = shared.value
        rng = np.random.default_rng([seed, step, TaskContext.get().partitionId()])
        best: dict[int, tuple[float, np.ndarray]] = {}
        # all sets have as many centres so far: the first of every set, then the second ones ...
        points = np.array(list(sets.values())).transpose(1, 0, 2).reshape(step * len(sets), -1) if step else None
        for x in _matrices(batches, ROWS):
            own = (x * x).sum(1)
            arrival = rng.exponential(size=(len(x), len(sets))).T
            weight = np.ones(arrival.shape)
            if points is not None:
                gaps = own - 2 * (points @ x.T) + (points * points).sum(1)[:, None]
                weight = np.maximum(gaps.reshape(step, len(sets), -1).min(0), 0)
            # rounding leaves a little distance between equal vectors
            weight = np.where(weight > 1e-12 * np.maximum(own, 1e-300), weight, 0.0)
            with np.errstate(divide="ignore"):
                time = arrival / weight
            for i, (key, first) in enumerate(zip(sets, time.argmin(1).tolist(), strict=True)):
                if np.isfinite(time[i, first]) and (key not in best or time[i, first] < best[key][0]):
                    best[key] = (float(time[i, first]), x[first].copy())
        columns = [list(best), [t for t, _ in best.values()], [v.tolist() for _, v in best.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.list_(pa.float64())), strict=True)], ["job", "time", "point"])

    return run


def _by_size(sets: dict[int, np.ndarray]) -> list[tuple[list[int], np.ndarray]]:
    """Sets of as many centres together: their numbers, and the first centre of each, then the second ones ..."""
    sizes = sorted({len(p) for p in sets.values()})
    groups = [[j for j, p in sets.items() if len(p) == k] for k in sizes]
    return [(jobs, np.array([sets[j] for j in jobs]).transpose(1, 0, 2)) for jobs in groups]


def _nearest(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Ones where a centre (of k) is the nearest one of its set, for each row, the first one among equals: k x sets x rows."""
    k, sets, dims = points.shape
    flat = points.reshape(-1, dims)
    # a row's own length is the same for all centres
    gaps = ((-2 * flat) @ x.T + (flat * flat).sum(1)[:, None]).reshape(k, sets, len(x))
    near = (gaps == gaps.min(0)).astype(np.float64)
    if (near.sum(0) != 1).any():
        near = (np.arange(k)[:, None, None] == gaps.argmin(0)).astype(np.float64)
    return near


def _sums(shared, dims: int):
    """Of each (set, cluster) of the partition: rows and sums of the vectors."""

    def run(batches):
        groups = _by_size(shared.value)
        totals = [np.zeros((points.shape[0] * points.shape[1], dims + 1)) for _, points in groups]
        for x in _blocks(batches, dims):
            counted = np.column_stack((x, np.ones(len(x))))
            for total, (_, points) in zip(totals, groups, strict=True):
                total += _nearest(x, points).reshape(len(total), -1) @ counted
        for total, (jobs, points) in zip(totals, groups, strict=True):
            cluster, at = np.divmod(np.arange(len(total), dtype=np.int32), len(jobs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(jobs, np.int32)[at]), pa.array(cluster), pa.array(total[:, -1].astype(np.int64)), pa.array(total[:, :-1].tolist(), pa.list_(pa.float64()))],
                ["job", "cluster", "n", "sums"],
            )

    return run


def _costs(shared, dims: int):
    """Of each set of the partition: squared distances of the vectors from their centres."""

    def run(batches):
        groups = _by_size(shared.value)
        costs = {j: 0.0 for jobs, _ in groups for j in jobs}
        for x in _blocks(batches, dims):
            for jobs, points in groups:
                near = _nearest(x, points).argmax(0)
                for i, j in enumerate(jobs):
                    off = x - points[near[i], i]
                    costs[j] += float((off * off).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(costs), pa.int32()), pa.array(list(costs.values()), pa.float64())], ["job", "cost"])

    return run


def fit_many(vectors: DataFrame, ks: Sequence[int], starts: int, seed: int, vector: str = "_v", max_iter: int = 100, tol: float = 1e-4) -> list[Centres]:
    """A centre set for each number of clusters and start, fitted in the same passes over ``vectors``.

    ``vector`` is a column of double arrays of one length, stored before since
    it is read again and again; null vectors are left out. A set is done when no
    centre moves by more than ``tol``. Fewer distinct vectors than clusters
    give fewer centres; no vectors give no sets.
    """
    spark = vectors.sparkSession
    share_code(spark)
    column = vectors.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("v"))
    jobs = [(k, s) for k in ks for s in range(starts)]
    sets: dict[int, list[np.ndarray]] = {j: [] for j in range(len(jobs))}
    passes = 0
    for step in range(max(ks)):
        growing = {j: np.array(points) for j, points in sets.items() if len(points) == step < jobs[j][0]}
        if not growing:
            break
        shared = spark.sparkContext.broadcast(growing)
        drawn = column.mapInArrow(_draws(shared, seed, step), "job int, time double, point array<double>")
        for r in drawn.groupBy("job").agg(F.min_by("point", "time").alias("point")).collect():
            sets[r.job].append(np.array(r.point))
        shared.unpersist()
        passes += 1

    active = {j: np.array(points) for j, points in sets.items() if points}
    if not active:
        return []
    dims = next(iter(active.values())).shape[1]
    blocks = materialize(column.mapInArrow(_packed, "block binary"), "vector-blocks")
    done: dict[int, np.ndarray] = {}
    for _ in range(max_iter):
        if not active:
            break
        shared = spark.sparkContext.broadcast(active)
        added = blocks.mapInArrow(_sums(shared, dims), "job int, cluster int, n long, sums array<double>").groupBy("job", "cluster")
        rows = added.agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(dims)]).collect()
        shared.unpersist()
        passes += 1
        moved = {j: p.copy() for j, p in active.items()}
        for r in rows:
            if r.n:
                moved[r.job][r.cluster] = np.array(r[3 : 3 + dims]) / r.n
        for j in list(active):
            if np.sqrt(((moved[j] - active[j]) ** 2).sum(1)).max() <= tol:
                done[j] = active.pop(j)
            else:
                active[j] = moved[j]
    done |= active
    shared = spark.sparkContext.broadcast(done)
    summed = blocks.mapInArrow(_costs(shared, dims), "job int, cost double").groupBy("job").agg(F.sum("cost").alias("cost"))
    costs = {r.job: r.cost for r in summed.collect()}
    shared.unpersist()
    return [Centres(jobs[j][0], jobs[j][1], points, costs[j], passes + 1) for j, points in sorted(done.items())]


def best_of(fitted: Sequence[Centres], k: int | None = None) -> Centres:
    """The cheapest set, the first start among equals."""
    return min((c for c in fitted if k is None or c.k == k), key=lambda c: (c.cost, c.start))


def _silhouettes(shared, names: Sequence[str]):
    def run(batches):
        points, labels = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            gaps = np.empty((len(x), len(points)))
            for at in range(0, len(points), 256):
                off = x[:, None, :] - points[None, at : at + 256]
                gaps[:, at : at + 256] = np.sqrt((off * off).sum(2))
            out = []
            for name in names:
                kinds, code = np.unique(labels[name], return_inverse=True)
                size = np.bincount(code)
                sums = np.column_stack([gaps[:, code == c].sum(1) for c in range(len(kinds))])
                own = np.searchsorted(kinds, batch.column(name).to_numpy(zero_copy_only=False))
                row = np.arange(len(x))
                if len(kinds) < 2:
                    out.append(pa.nulls(len(x), pa.float64()))
                    continue
                inside = sums[row, own] / np.maximum(size[own] - 1, 1)
                means = sums / size
                means[row, own] = np.inf
                other = means.min(1)
                top = np.maximum(inside, other)
                value = np.divide(other - inside, top, out=np.zeros(len(x)), where=top > 0)
                out.append(pa.array(np.where(size[own] > 1, value, 0.0)))
            yield pa.RecordBatch.from_arrays(out, list(names))

    return run


def silhouettes(df: DataFrame, vector: str, labels: Sequence[str], order: Sequence[Column], sample: int = 2000) -> DataFrame:
    """``label, n_rows, silhouette``: mean silhouette by Euclidean distances, for each label column.

    Over the first ``sample`` rows by ``order`` that have a vector and all
    labels: so many rows, and no more, are broadcast, and each task sums its
    rows' distances from them by cluster. A cluster of one row counts as 0;
    fewer than two clusters give null.
    """
    chosen = df.where(F.col(vector).isNotNull()).dropna(subset=list(labels))
    rows = chosen.orderBy(*order).limit(sample).select(F.col(vector).cast("array<double>").alias("v"), *[F.col(c).cast("long").alias(c) for c in labels])
    held = rows.collect()
    spark = df.sparkSession
    share_code(spark)
    if not held:
        return spark.createDataFrame([(c, 0, None) for c in labels], "label string, n_rows long, silhouette double")
    points = np.array([r.v for r in held])
    shared = spark.sparkContext.broadcast((points, {c: np.array([r[c] for r in held]) for c in labels}))
    dealt = spark.createDataFrame(held, rows.schema).repartition(spark.sparkContext.defaultParallelism)
    scored = dealt.mapInArrow(_silhouettes(shared, labels), ", ".join(f"{c} double" for c in labels))
    means = scored.agg(F.count(F.lit(1)).alias("n_rows"), *[F.avg(c).alias(c) for c in labels])
    return means.unpivot(["n_rows"], list(labels), "label", "silhouette").select("label", "n_rows", "silhouette")
