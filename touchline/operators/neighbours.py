"""Exact nearest rows of many queries by an index of pivots.

Every row is kept with its nearest pivot and its distance from it, in bands of
equal width. A row can only be within t of a query if its distance from the
pivot differs from the query's by at most t, so a query looks into those bands
alone. The bound t comes from the counts of the bands, then from the rows of the
bands around the query itself; it never falls below the distance of the n-th
nearest row, so the answer is that of a full scan.

Rows and queries meet in blocks: bands next to each other at a pivot form pieces
of some ``PIECE_ROWS`` rows, wider bands are dealt over several, and queries come
in groups of some ``QUERY_ROWS``. A block keeps the nearest rows of each query
only, so what is written grows with queries x pieces, not with compared pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.clustering import best_of, fit_many
from touchline.operators.windows import top_n
from touchline.session import materialize, share_code

#: sums of squares are rounded; so much more than the bound is still looked at
SLACK = 1e-9
#: rows and queries of one block, and the distances held at once in it
PIECE_ROWS = 4096
QUERY_ROWS = 2048
HELD = 1 << 20


@dataclass
class PivotIndex:
    """``rows`` (``key, vector, pivot, gap, band``), stored; ``counts`` has the rows of each (pivot, band)."""

    rows: DataFrame
    counts: DataFrame
    points: np.ndarray
    width: float


def _distance(a: Column | str, b: Column | str) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap))


def _gaps(vector: str, points: np.ndarray) -> Column:
    return F.array(*[_distance(vector, F.lit(p.tolist())) for p in points])


def build_index(df: DataFrame, key: str, vector: str, pivots: int = 16, bands: int = 64, seed: int = 1) -> PivotIndex:
    """Pivots are the centres of one K-Means fit; rows without a vector are left out.

    ``bands`` is the number of bands of the widest pivot. ``vector`` is an array of doubles of one length.
    """
    rows = materialize(df.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")), "vectors")
    fitted = fit_many(rows, [pivots], 1, seed, "vector", max_iter=10)
    if not fitted:
        empty = rows.select("*", F.lit(0).alias("pivot"), F.lit(0.0).alias("gap"), F.lit(0).cast("long").alias("band"))
        return PivotIndex(empty, empty.groupBy("pivot", "band").agg(F.count(F.lit(1)).alias("n")), np.zeros((0, 0)), 1.0)
    points = best_of(fitted).points
    near = rows.withColumn("_gaps", _gaps("vector", points)).withColumn("gap", F.array_min("_gaps"))
    near = near.select("key", "vector", (F.array_position("_gaps", F.col("gap")) - 1).cast("int").alias("pivot"), "gap")
    near = materialize(near, "pivot-gaps")
    width = max(near.agg(F.max("gap")).first()[0] / bands, 1e-300)
    banded = near.withColumn("band", F.floor(F.col("gap") / width).cast("long"))
    # one row for each pivot and band
    counts = materialize(banded.groupBy("pivot", "band").agg(F.count(F.lit(1)).alias("n")), "pivot-bands")
    return PivotIndex(banded, counts, points, width)


def _pieces(index: PivotIndex) -> DataFrame:
    """``pivot, band, first, dealt``: a band's rows are dealt over so many pieces from ``first`` on."""
    # one row for each pivot and band
    before = Window.partitionBy("pivot").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    return index.counts.select(
        "pivot", "band",
        F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / PIECE_ROWS).cast("long").alias("first"),
        F.ceil(F.col("n") / PIECE_ROWS).cast("long").alias("dealt"),
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(len(column), -1)


def _block(held: pa.Table, asked: pa.Table, n: int, skip_own: bool) -> pa.Table:
    """The ``n`` nearest rows of each query among those within its bound, ties to the smallest key.

    ``looked``, on the first row of a query, is the number of rows within its
    bound; the key is null where they were all its own.
    """
    held = held.take(pc.sort_indices(held, sort_keys=[("key", "ascending")], null_placement="at_start"))
    keys, x = held["key"].to_pylist(), _matrix(held["vector"])
    gap, band, squares = held["gap"].to_numpy(), held["band"].to_numpy(), (x * x).sum(1)
    places: dict = {}
    for i, key in enumerate(keys):
        places.setdefault(key, []).append(i)
    names, q = asked["query"].to_pylist(), _matrix(asked["asked"])
    start, low, high = (asked[c].to_numpy() for c in ("from", "low", "high"))
    within = np.nan_to_num(asked["within"].to_numpy().astype(float), nan=np.inf)
    columns: tuple[list, ...] = ([], [], [], [])
    step = max(1, HELD // len(x))
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        met = (band >= low[part, None]) & (band <= high[part, None]) & (np.abs(start[part, None] - gap) <= within[part, None])
        own_squares = (q[part] * q[part]).sum(1)
        rough = squares - 2 * (q[part] @ x.T) + own_squares[:, None]
        # by so much may the rough squares be wrong: whatever may be near enough is measured exactly
        off = 1e-11 * (squares.max() + own_squares)
        for i, name in enumerate(names[part]):
            looked = int(met[i].sum())
            if skip_own:
                met[i, places.get(name, []) + places.get(None, [])] = False
            near = np.flatnonzero(met[i])
            if len(near) > n:
                squared = rough[i, near]
                near = near[squared <= np.partition(squared, n - 1)[n - 1] + 2 * off[i]]
            gaps = np.sqrt(((q[at + i] - x[near]) ** 2).sum(1))
            best = np.argsort(gaps, kind="stable")[:n]
            rows = [(keys[j], d) for j, d in zip(near[best].tolist(), gaps[best].tolist(), strict=True)]
            for k, (key, distance) in enumerate(rows or [(None, None)] * (looked > 0)):
                for column, value in zip(columns, (name, key, distance, 0 if k else looked), strict=True):
                    column.append(value)
    types = (asked.schema.field("query").type, held.schema.field("key").type, pa.float64(), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query", "key", "distance", "looked"])


def _in_blocks(index: PivotIndex, asked: DataFrame, groups: int, n: int, skip_own: bool) -> DataFrame:
    """``query, key, distance, looked`` of the nearest rows of every block.

    ``asked`` has ``query, asked, pivot, from, low, high, within``: the bands to
    look into at a pivot, and the bound, null for none.
    """
    share_code(asked.sparkSession)
    pieces = _pieces(index)
    dealt = index.rows.join(F.broadcast(pieces), ["pivot", "band"])
    piece = F.col("first") + F.pmod(F.xxhash64("key"), F.col("dealt"))
    part = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
    held = dealt.select("pivot", piece.alias("piece"), part, "key", "vector", "gap", "band")

    listed = pieces.groupBy("pivot").agg(F.collect_list(F.struct("band", "first", (F.col("first") + F.col("dealt") - 1).alias("last"))).alias("spans"))
    wanted = F.filter("spans", lambda s: s["band"].between(F.col("low"), F.col("high")))
    near = asked.join(F.broadcast(listed), "pivot").withColumn("_wanted", wanted).where(F.size("_wanted") > 0)
    ends = F.sequence(F.array_min("_wanted.first"), F.array_max("_wanted.last"))
    met = near.select(
        "pivot", F.explode(ends).alias("piece"), F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int").alias("part"),
        "query", "asked", "from", "low", "high", "within",
    )

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if rows.num_rows and queries.num_rows:
            return _block(rows, queries, n, skip_own)
        return pa.schema([queries.schema.field("query"), rows.schema.field("key"), ("distance", pa.float64()), ("looked", pa.int64())]).empty_table()

    kinds = {"query": met.schema["query"].dataType, "key": held.schema["key"].dataType, "distance": T.DoubleType(), "looked": T.LongType()}
    schema = T.StructType([T.StructField(c, t) for c, t in kinds.items()])
    keys = ["pivot", "piece", "part"]
    return held.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(run, schema)


def nearest(index: PivotIndex, queries: DataFrame, key: str, vector: str, n: int, others_only: bool = True) -> DataFrame:
    """``query, key, distance, rank, compared`` of the ``n`` rows nearest to each query, ties to the smallest key.

    With ``others_only`` rows with the query's own key are left out. ``compared``
    is the number of rows whose distance from the query was computed. Query keys
    tell queries apart; queries without a vector have no rows.
    """
    asked = queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("asked"))
    if not len(index.points):
        return asked.limit(0).select(
            "query", F.col("query").alias("key"), F.lit(0.0).alias("distance"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("compared")
        )
    width = index.width
    places = n + 1 if others_only else n
    spread = asked.select("query", "asked", F.posexplode(_gaps("asked", index.points)).alias("pivot", "from"))
    spread = materialize(spread, "query-gaps")

    # bands by how far their rows can be at most, until they hold enough rows; there are pivots x bands of them at most
    reach = spread.select("query", "pivot", "from").join(F.broadcast(index.counts), "pivot")
    steps = reach.select("query", F.struct((F.col("from") + (F.col("band") + 1) * width).alias("most"), "n").alias("step"))
    listed = steps.groupBy("query").agg(F.array_sort(F.collect_list("step")).alias("steps"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("at"))
    found = F.aggregate(
        "steps",
        start,
        lambda acc, step: F.when(acc["n"] >= places, acc).otherwise(F.struct((acc["n"] + step["n"]).alias("n"), step["most"].alias("at"))),
    )
    bounds = listed.select("query", F.when(found["n"] >= places, found["at"]).alias("counted"))

    # rows of the bands around the query at its nearest pivot
    groups = -(-spread.where("pivot = 0").count() // QUERY_ROWS) or 1
    home = F.floor(F.col("from") / width)
    own = top_n(spread, ["query"], [F.asc("from"), F.asc("pivot")], 1)
    own = own.withColumns({"low": home - 1, "high": home + 1, "within": F.lit(None).cast("double")})
    tried = _in_blocks(index, own.where("low IS NOT NULL"), groups, places, False)
    tried = top_n(tried, ["query"], [F.asc("distance")], places)
    tried = tried.groupBy("query").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_at"))
    tried = tried.select("query", F.when(F.col("_n") >= places, F.col("_at")).alias("tried"))

    # without enough rows in all bands together every band is looked into
    bound = F.least("tried", "counted") * (1 + SLACK) + SLACK
    widest = index.counts.groupBy("pivot").agg(F.max("band").alias("last"))
    looked = spread.join(bounds, "query").join(tried, "query", "left").withColumn("within", bound).join(F.broadcast(widest), "pivot")
    low = F.greatest(F.lit(0).cast("long"), F.coalesce(F.floor((F.col("from") - F.col("within")) / width).cast("long"), F.lit(0).cast("long")))
    high = F.least(F.col("last"), F.coalesce(F.floor((F.col("from") + F.col("within")) / width).cast("long"), F.col("last")))
    looked = looked.withColumns({"low": low, "high": high}).where("low <= high")
    met = materialize(_in_blocks(index, looked.drop("last"), groups, n, others_only), "compared")
    compared = met.groupBy("query").agg(F.sum("looked").alias("compared"))
    chosen = met.where(F.col("distance").isNotNull())
    ranked = top_n(chosen, ["query"], [F.asc("distance"), F.asc("key")], n, "rank")
    return ranked.join(compared, "query").select("query", "key", "distance", "rank", "compared")


def nearest_rows(df: DataFrame, key: str, vector: str, wanted: Sequence[object], n: int, **options) -> DataFrame:
    """The ``n`` rows nearest to each of the named ones."""
    index = build_index(df, key, vector, **options)
    return nearest(index, df.where(F.col(key).isin(list(wanted))), key, vector, n)
