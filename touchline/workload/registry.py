"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]

DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def nudge(digits: int) -> float:
    """Moves values off the exact half-way points, where the last bit of a sum would decide."""
    return 0.013 * 10.0**-digits


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Comparable output: whole numbers as long, fractions rounded, dates and times as text."""
    columns = []
    for field in df.schema.fields:
        kind, c = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("byte", "short", "integer"):
            c = c.cast("long")
        elif kind in ("double", "float"):
            c = F.round(c.cast("double") + nudge(digits), digits) + F.lit(0.0)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(
    name: str,
    covers: Sequence[str],
    sql: str | None = None,
    doubles: Sequence[str] = (),
    longs: Sequence[str] = (),
    texts: Sequence[str] = (),
    digits: int = DIGITS,
):
    """Registers a builder; the named columns of the SQL get the same final types as ``tidy`` gives."""
    casts = [f"round(CAST({c} AS DOUBLE) + {nudge(digits)!r}::DOUBLE, {digits}) + 0.0 AS {c}" for c in doubles]
    casts += [f"CAST({c} AS BIGINT) AS {c}" for c in longs]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in texts]
    if sql is not None and casts:
        sql = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql}) AS answer"

    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query name repeats: {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(build(spark, folder), digits)

        REGISTRY[name] = Query(name, tuple(covers), run, sql)
        return build

    return add
