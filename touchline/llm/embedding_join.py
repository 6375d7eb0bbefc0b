"""Epsilon grid order join of vectors by cosine.

Unit vectors whose cosine is at least c are at most sqrt(2 - 2c) = eps apart.
Equal vectors are one class. Classes are rotated to principal directions,
ordered by their eps-wide grid cells on the leading ones, and cut into blocks
of consecutive rows with bounding boxes. The sequence is joined with itself
recursively: intervals of blocks, then blocks, then runs of rows inside a task;
wherever two boxes are more than eps apart everything below is skipped.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.graph import components, spanning
from touchline.llm.tables import query, table
from touchline.session import materialize

LEADING = 8
BLOCK = 4096
RUN = 512
FAN_OUT = 16
#: boxes come from rounded sums; this much more than eps is still joined
SLACK = 1e-6


def _rows(batches):
    """Key of the raw vector, or null where it links with nothing."""
    for rows in batches:
        column = rows.column("vector")
        kind = column.type.value_type.to_pandas_dtype()
        keys, raws = [], []
        for known, v in zip(rows.column("vec_id").is_valid().to_pylist(), column, strict=True):
            ok = known and v.is_valid and v.values is not None and len(v.values) and not v.values.null_count
            x = np.asarray(v.values.to_numpy(zero_copy_only=False), kind) + kind(0) if ok else None
            ok = ok and bool(np.isfinite(x).all()) and bool(np.any(x))
            raws.append(x.tobytes() if ok else None)
            keys.append(hashlib.blake2b(raws[-1], digest_size=16).digest() if ok else None)
        yield pa.RecordBatch.from_arrays([rows.column("vec_id"), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())], ["vec_id", "key", "raw"])


def unit(raws: list[bytes], kind: str, width: int) -> np.ndarray:
    """Vectors of length one in double precision, shorter ones filled up with zeros; scaled first so that nothing over- or underflows."""
    x = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), kind).reshape(len(raws), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _moments(kind: str, width: int):
    def run(batches):
        total, n = None, 0
        for rows in batches:
            if rows.num_rows:
                x = unit(rows.column("raw").to_pylist(), kind, width)
                x = np.column_stack((np.ones(len(x)), x))
                total, n = (0 if total is None else total) + x.T @ x, n + len(x)
        if n:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    return run


def principal(classes: DataFrame, kind: str, width: int) -> np.ndarray:
    """Directions by falling variance, as columns; from sums over all vectors."""
    sums = classes.select("raw").mapInArrow(_moments(kind, width), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    cells = sums.orderBy("i", "j").collect()  # (dimensions + 1)^2 / 2 numbers
    d = max(c.j for c in cells) + 1
    m = np.zeros((d, d))
    for c in cells:
        m[c.i, c.j] = m[c.j, c.i] = c.v
    mean = m[0, 1:] / m[0, 0]
    _, directions = np.linalg.eigh(m[1:, 1:] / m[0, 0] - np.outer(mean, mean))
    return directions[:, ::-1]


def _placed(kind: str, width: int, axes: np.ndarray, eps: float):
    def run(batches):
        for rows in batches:
            if rows.num_rows:
                at = unit(rows.column("raw").to_pylist(), kind, width) @ axes
                cells = pa.array(np.floor(at / eps).astype(np.int32).tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("node", "n", "raw")] + [cells], ["node", "n", "raw", "cells"])

    return run


def _blocks(kind: str, width: int, axes: np.ndarray, size: int):
    """Rows in grid order to blocks with bounding boxes on the leading directions."""

    def block(k: int, held: list[tuple]):
        at = unit([h[2] for h in held], kind, width) @ axes
        nodes, ns, raws = zip(*held, strict=True)
        row = (TaskContext.get().partitionId(), k, list(nodes), list(ns), [len(r) for r in raws], b"".join(raws), at.min(0).tolist(), at.max(0).tolist())
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types, strict=True)], names)

    def run(batches):
        held, k = [], 0
        for rows in batches:
            held += zip(*(rows.column(c).to_pylist() for c in ("node", "n", "raw")), strict=True)
            while len(held) >= size:
                yield block(k, held[:size])
                held, k = held[size:], k + 1
        if held:
            yield block(k, held)

    names = ["part", "nth", "nodes", "ns", "sizes", "raws", "low", "high"]
    longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
    types = [pa.int32(), pa.int32(), longs, longs, pa.list_(pa.int32()), pa.binary(), doubles, doubles]
    return run


BLOCK_SCHEMA = "part int, nth int, nodes array<long>, ns array<long>, sizes array<int>, raws binary, low array<double>, high array<double>"


def _gap(dims: int):
    """Squared distance of the boxes of ``a`` and ``b``."""
    parts = [F.greatest(F.lit(0.0), F.col("a_low")[j] - F.col("b_high")[j], F.col("b_low")[j] - F.col("a_high")[j]) for j in range(dims)]
    total = F.lit(0.0)
    for p in parts:
        total = total + p * p
    return total


def near_blocks(boxes: DataFrame, n: int, eps: float, dims: int) -> DataFrame:
    """Pairs ``a <= b`` of blocks whose boxes come within eps, from the whole sequence down."""
    levels = max(1, math.ceil(math.log(max(n, 2), FAN_OUT)))
    spark = boxes.sparkSession
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")

    def at_level(level: int, side: str) -> DataFrame:
        width = FAN_OUT**level
        lows = [F.min(F.col("low")[j]).alias(f"l{j}") for j in range(dims)]
        highs = [F.max(F.col("high")[j]).alias(f"h{j}") for j in range(dims)]
        grouped = boxes.groupBy(F.floor(F.col("block") / width).cast("long").alias(f"{side}_node")).agg(*lows, *highs)
        return grouped.select(
            f"{side}_node",
            F.floor(F.col(f"{side}_node") / FAN_OUT).cast("long").alias(f"{side}_above"),
            F.array(*[f"l{j}" for j in range(dims)]).alias(f"{side}_low"),
            F.array(*[f"h{j}" for j in range(dims)]).alias(f"{side}_high"),
        )

    for level in range(levels - 1, -1, -1):
        down = pairs.join(at_level(level, "a"), F.col("a") == F.col("a_above")).join(at_level(level, "b"), F.col("b") == F.col("b_above"))
        down = down.where((F.col("a_node") <= F.col("b_node")) & (_gap(dims) <= (eps + SLACK) ** 2))
        pairs = materialize(down.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "near-blocks")
    return pairs


def _leaf(kind: str, width: int, axes: np.ndarray, cosine: float, eps: float):
    """Links of two blocks: a weight for each class that has any, and enough links to connect them."""

    def runs_of(x: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        at = x @ axes
        cuts = range(0, len(x), RUN)
        return [(i, min(i + RUN, len(x)), at[i : i + RUN].min(0), at[i : i + RUN].max(0)) for i in cuts]

    def run(batches):
        for rows in batches:
            for row in rows.to_pylist():
                same = row["a"] == row["b"]
                ra, rb = np.array(row["a_nodes"]), np.array(row["b_nodes"])
                sa, sb = np.array(row["a_sizes"]), np.array(row["b_sizes"])
                na, nb = np.array(row["a_ns"]), np.array(row["b_ns"])
                x = unit(_split(row["a_raws"], sa), kind, width)
                y = x if same else unit(_split(row["b_raws"], sb), kind, width)
                wa, wb = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
                ends: list[tuple[np.ndarray, np.ndarray]] = []
                for i0, i1, low, high in runs_of(x):
                    for j0, j1, low2, high2 in runs_of(y):
                        if same and j0 < i0:
                            continue
                        gap = np.maximum(0, np.maximum(low - high2, low2 - high))
                        if gap @ gap > (eps + SLACK) ** 2:
                            continue
                        linked = (x[i0:i1] @ y[j0:j1].T >= cosine) & (sa[i0:i1, None] == sb[j0:j1])
                        if same and i0 == j0:
                            linked = np.triu(linked, 1)
                        if linked.any():
                            wa[i0:i1] += linked @ nb[j0:j1]
                            wb[j0:j1] += na[i0:i1] @ linked
                            i, j = spanning(linked)
                            ends.append((ra[i0 + i], rb[j0 + j]))
                weights = [(r, w) for r, w in ((ra, wa), (rb, wb)) if w.any()]
                node = np.concatenate([np.zeros(0, np.int64), *(r[w > 0] for r, w in weights), *(a for a, _ in ends)])
                weight = np.concatenate([np.zeros(0, np.int64), *(w[w > 0] for _, w in weights)])
                other = np.concatenate([np.zeros(0, np.int64), *(b for _, b in ends)])
                columns = [pa.array(node), pa.array(np.append(weight, np.zeros(len(other), np.int64)))]
                columns.append(pa.array(np.append(np.zeros(len(weight), np.int64), other), mask=np.arange(len(node)) < len(weight)))
                yield pa.RecordBatch.from_arrays(columns, ["node", "weight", "other"])

    return run


def _split(raws: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [raws[b - n : b] for b, n in zip(ends, sizes.tolist(), strict=True)]


def link_by_cosine(vectors: DataFrame, cosine: float, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link when their cosine in double precision is ``cosine`` or more,
    whatever other columns say. A vector that is null, empty, zero, or holds a
    null or non-finite component, and a row with a null key, links with nothing:
    no links, a component of its own, kept (null key: null component, not kept).
    Vectors of unequal lengths link with nothing of another length. Equal
    vectors are linked by way of their class. Every row is a vector of its own:
    rows that share a key count as links of one another where their vectors
    link, and ``kept`` is true for each row whose key is the smallest of its
    component. An empty table gives no rows.
    """
    kind = {"float": "f4", "double": "f8"}[vectors.schema[vector].dataType.elementType.typeName()]
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    chosen = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    rows = materialize(chosen.mapInArrow(_rows, "vec_id long, key binary, raw binary"), "vectors")
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("raw").alias("raw"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    n, width = classes.agg(F.count(F.lit(1)), F.max(F.octet_length("raw"))).first()
    if not n:
        return alone
    axes = principal(classes, kind, width)[:, :LEADING]
    dims = axes.shape[1]
    spark = vectors.sparkSession
    placed = classes.mapInArrow(_placed(kind, width, axes, eps), "node long, n long, raw binary, cells array<int>")
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // BLOCK))
    ordered = placed.repartitionByRange(parts, "cells", "node").sortWithinPartitions("cells", "node")
    blocks = materialize(ordered.select("node", "n", "raw").mapInArrow(_blocks(kind, width, axes, BLOCK), BLOCK_SCHEMA), "vector-blocks")
    sizes = blocks.groupBy("part").count().orderBy("part").collect()  # one number for each partition
    starts = np.concatenate(([0], np.cumsum([s["count"] for s in sizes]))).tolist()
    first = spark.createDataFrame([(s.part, b) for s, b in zip(sizes, starts, strict=False)], "part int, first long")
    blocks = materialize(blocks.join(first, "part").withColumn("block", F.col("first") + F.col("nth")).drop("part", "nth", "first"), "vector-blocks")
    pairs = near_blocks(blocks.select("block", "low", "high"), starts[-1], eps, dims)
    turned = (F.col("a") + F.col("b")) % 2 == 1
    pairs = pairs.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))
    for side in ("a", "b"):
        pairs = pairs.join(blocks.select(F.col("block").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("nodes", "ns", "sizes", "raws"))), side)
    found = materialize(pairs.mapInArrow(_leaf(kind, width, axes, cosine, eps), "node long, weight long, other long"), "vector-links")
    weights = found.where("other IS NULL").groupBy("node").agg(F.sum("weight").alias("weight"))
    whole = components(found.where("other IS NOT NULL"), "node", "other").select(F.col("node").alias("of"), "component")
    members = classes.select("key", "node", "first", "n").join(whole, F.col("node") == F.col("of"), "left").drop("of")
    members = materialize(members.withColumn("component", F.coalesce("component", "node")), "vector-members")
    smallest = members.groupBy("component").agg(F.min("first").alias("smallest"))
    known = members.join(weights.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").join(smallest, "component")
    known = known.select("key", (F.coalesce("weight", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.col("smallest").alias("component_id"))
    linked = rows.where("key IS NOT NULL").select("vec_id", "key").join(known, "key")
    linked = linked.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return linked.unionByName(alone.where(F.col("key").isNull()))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9
), reach(node, via) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.via = l.a
)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = v.vec_id
JOIN (SELECT node, min(via) AS component_id FROM reach GROUP BY node) ON node = v.vec_id
"""


@query("op3_grid_order_join", OP3_SQL)
def op3(spark, folder):
    return link_by_cosine(table(spark, folder, "embeddings"), 0.9)
