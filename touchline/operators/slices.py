"""Ordered work over groups of any size, in slices of about equal size.

A window needs all rows of a group in one task. Here rows are range-partitioned
by group and order instead: every partition holds a contiguous stretch, light
groups share one, heavy groups span several, each with cuts of its own. Rows are
stored once with the number of their stretch, which makes (group, slice) the
window group. Only the last group of a slice can go on in the next one, so what
operators carry over (the last rows, a running total, the last match) is at
most one small record for each slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import materialize

SLICE = "_slice"


def in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], slices: int | None = None) -> DataFrame:
    """The rows, stored, with ``_slice``: stretches of the order by ``keys`` and ``order``, numbered along it.

    Rows equal in both stay together. Without ``slices`` their number follows
    the session's shuffle partitions and the size of the data.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in [*keys, *order]]
    ranged = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return materialize(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def last_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the group that stands last in each slice, the only one that may go on."""
    if not keys:
        return rows
    last = rows.groupBy(SLICE).agg(F.max(F.struct(*keys)).alias("_last")).withColumnRenamed(SLICE, "_of")
    # one row for each slice
    same = [F.col(k).eqNullSafe(F.col(f"_last.{k}")) for k in keys]
    test = F.col(SLICE) == F.col("_of")
    for s in same:
        test = test & s
    return rows.join(last, test, "left_semi")


def going_on(ends: DataFrame, rows: DataFrame, keys: Sequence[str], states: Sequence[str]) -> DataFrame:
    """The last groups' states, and a row without state for the slice after each, where the group may go on."""
    # one row for each slice
    steps = rows.select(SLICE).distinct()
    steps = steps.select(F.col(SLICE).alias("_of"), F.lead(SLICE).over(Window.orderBy(SLICE)).alias("_next"))
    after = ends.join(steps.filter(F.col("_next").isNotNull()), F.col(SLICE) == F.col("_of"))
    after = after.select(*keys, F.col("_next").alias(SLICE), *[F.lit(None).cast(ends.schema[c].dataType).alias(c) for c in states])
    both = ends.select(*keys, SLICE, *states).unionByName(after)
    return both.groupBy(*keys, SLICE).agg(*[F.max(c).alias(c) for c in states])
