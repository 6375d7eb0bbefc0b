"""Reading the given tables, and the registry of this subpackage's queries."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


#: most bytes of text that Spark hands to a Python worker at once
BATCH_BYTES = 8 << 20
#: Python workers live on between tasks: they give large arrays back at once instead of keeping them for the next
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
    "MALLOC_ARENA_MAX": "2",
}


def share_package(spark: SparkSession) -> None:
    """Prepares a session for the operators here.

    Python workers look for this package where the driver found it (on a
    cluster: also in --py-files), return freed memory, and get Arrow batches of
    bounded size.
    """
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    number, unit = re.match(r"(\d+)([kmgt]?)", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (here, known)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed_texts(docs: DataFrame, key: str, text: str, rest: Sequence[str] = ()) -> DataFrame:
    """``doc_id, text`` and, if any are named, other columns as the struct ``rest``, where no name can clash."""
    more = [F.struct(*[docs[c] for c in rest]).alias("rest")] if rest else []
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"), *more)


def with_rest(schema: str, chosen: DataFrame) -> StructType:
    """The schema, followed by ``rest`` if ``chosen`` has it."""
    out = StructType.fromDDL(schema)
    return out.add(chosen.schema["rest"]) if "rest" in chosen.columns else out


def rest_of(rows) -> list:
    return [rows.column("rest")] if "rest" in rows.schema.names else []


#: words of 64 bits in a sift: never more than so many rows are broadcast
SIFT_WORDS = 1 << 17


def sifted(rows: DataFrame, key: str, wanted: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``maybe``: false only where ``key`` is surely not in ``column`` of ``wanted``.

    The keys wanted become one bit each of a bitmap of fixed size, so rows that
    nobody wants need no shuffle; a bitmap that fills up just sifts less.
    """
    place = lambda c: F.shiftright(F.xxhash64(c), 6).bitwiseAND(F.lit(SIFT_WORDS - 1))
    mask = F.expr(f"shiftleft(1L, cast(xxhash64({column}) & 63 AS INT))")
    words = wanted.select(place(column).alias("sift_word"), mask.alias("mask")).groupBy("sift_word").agg(F.bit_or("mask").alias("sift_bits"))
    out = rows.withColumn("sift_word", place(key)).join(F.broadcast(words), "sift_word", "left")
    bit = F.xxhash64(key).bitwiseAND(F.lit(63)).cast("int")
    return out.withColumn("maybe", F.coalesce(F.getbit("sift_bits", bit) == 1, F.lit(False))).drop("sift_word", "sift_bits")
