"""Reading tables: Parquet parts, CSV with dates, catalog tables, seeds, cached summaries."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.text import null_if_token
from touchline.sources.schemas import SCHEMAS


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """Parquet table stored as one file ``name.parquet`` or as many parts below it."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def read_raw(spark: SparkSession, folder: str, name: str, by: str | None = None, buckets: int = 0) -> DataFrame:
    """A known input table with its explicit schema; ``by`` and ``buckets`` are those of ``write_bucketed``, if it wrote the files."""
    if by is None:
        return read_table(spark, folder, name, SCHEMAS[name])
    entry = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {entry} ({SCHEMAS[name]}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}/{name}.parquet'"
    )
    rows = spark.table(entry)
    # the files are named now
    spark.sql(f"DROP TABLE {entry}")
    return rows


def read_csv(spark: SparkSession, path: str, schema: str, dates: Sequence[str] = ()) -> DataFrame:
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.withColumns({c: F.to_date(F.col(c)) for c in dates}) if dates else df


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SCHEMAS["results"], ["date"])


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    return read_csv(spark, path, SCHEMAS[name])


SUMMARIES = ("archetype_distribution", "competition_archetype_counts", "quadrant_distribution", "data_overview")


def read_summaries(spark: SparkSession, folder: str, names: Sequence[str] = SUMMARIES) -> dict[str, DataFrame]:
    """Report tables from earlier CSV exports instead of from source."""
    return {n: read_csv(spark, f"{folder}/{n}", SCHEMAS[n]) for n in names}


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def query_files(spark: SparkSession, path: str, sql: str) -> DataFrame:
    """SQL over Parquet files in place; ``{src}`` stands for the files."""
    return spark.sql(sql.replace("{src}", f"parquet.`{path}`"))


# --- shaping what was read -----------------------------------------------------------------


def clean_name(name: str) -> str:
    """Dots, spaces and dashes to underscores; a leading digit gets ``col_`` before it."""
    out = re.sub(r"[.\s\-]", "_", name)
    return f"col_{out}" if out[:1].isdigit() else out


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def _leaves(kind: T.DataType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
    if isinstance(kind, T.StructType):
        return [leaf for f in kind.fields for leaf in _leaves(f.dataType, (*path, f.name))]
    return [path]


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested record columns as ``parent_child`` columns, to any depth."""
    columns: list[Column] = []
    for field in df.schema.fields:
        for path in _leaves(field.dataType, (field.name,)):
            columns.append(F.col(".".join(f"`{p}`" for p in path)).alias("_".join(clean_name(p) for p in path)))
    return df.select(*columns)


def null_tokens(df: DataFrame) -> DataFrame:
    """Text that stands for a missing value becomes NULL in every string column."""
    return df.select(
        *[
            null_if_token(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def drop_dup_columns(df: DataFrame) -> DataFrame:
    """Keeps the first of several columns with one name, ignoring case."""
    numbered = df.toDF(*[f"{i}_" for i in range(len(df.columns))])
    seen: dict[str, str] = {}
    for i, name in enumerate(df.columns):
        if name.lower() not in {n.lower() for n in seen.values()}:
            seen[f"{i}_"] = name
    return numbered.select(*[F.col(k).alias(v) for k, v in seen.items()])


def adapt(df: DataFrame, wanted: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Wanted columns by {name: (type, other names it may have)}; a typed NULL where none is there."""
    columns = []
    for name, (kind, others) in wanted.items():
        found = next((c for c in (name, *others) if c in df.columns), None)
        columns.append((F.col(found) if found else F.lit(None)).cast(kind).alias(name))
    return df.select(*columns)
