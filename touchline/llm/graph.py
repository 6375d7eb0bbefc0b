"""Connected components of links, by large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import materialize


class Forest:
    """Union by the smaller number, with path halving."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(p, p)
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _thin(batches):
    """Links of one batch at a time as stars around the smallest node: never more, and the same components."""
    for rows in batches:
        forest = Forest()
        for x, y in zip(rows.column("a").to_pylist(), rows.column("b").to_pylist(), strict=True):
            forest.join(x, y)
        out = [(x, r) for x in list(forest.up) if (r := forest.find(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node with a link to another.

    Each round points the larger neighbours of a node at its smallest
    neighbour, then the smaller ones; the number of rounds grows with the
    logarithm of the size. Rounds are written to the shared folder. Links with
    a null end are ignored.
    """
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    edges = materialize(edges.mapInArrow(_thin, "a long, b long").distinct(), "links")
    while True:
        nodes = edges.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionAll(
            edges.select("b", F.lit(0), F.lit(1))
        )
        seen = nodes.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
        if seen.where((F.col("child") > 1) | ((F.col("child") > 0) & (F.col("parent") > 0))).isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        both = edges.unionAll(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of some links of a boolean matrix that connect the same rows and columns as all of them."""
    n, m = linked.shape
    total = int(linked.sum())
    if total <= 4 * (n + m):
        return np.nonzero(linked)
    rows, columns = [], []
    new_row, new_column = linked.any(1), linked.any(0)
    while new_row.any():
        wave = np.array([np.argmax(new_row)])
        new_row[wave] = False
        while len(wave):
            near = linked[wave] & new_column
            hit = np.flatnonzero(near.any(0))
            rows.append(wave[near[:, hit].argmax(0)])
            columns.append(hit)
            new_column[hit] = False
            near = linked[:, hit] & new_row[:, None]
            wave = np.flatnonzero(near.any(1))
            rows.append(wave)
            columns.append(hit[near[wave].argmax(1)] if len(wave) else wave)
            new_row[wave] = False
    return np.concatenate(rows), np.concatenate(columns)
