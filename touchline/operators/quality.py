"""Data-quality checks. Each gives one row (check, failures); 0 failures is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import joined_where_they_lie, materialize


def _result(df: DataFrame, name: str, failures: Column) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("long").alias("failures")).select(
        F.lit(name).alias("check"), "failures"
    )


def failing(df: DataFrame, bad: Column, name: str) -> DataFrame:
    """Rows where the predicate marks a failure; NULL is not a failure."""
    return _result(df, name, F.count_if(bad))


def assert_rows(df: DataFrame, ok: Column) -> DataFrame:
    """The rows that break a rule; expected to be empty."""
    return df.filter(~ok)


def unique(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Number of keys held by more than one row; rows with a missing key are not tested."""
    present = df.select(*columns).dropna(how="any") if len(columns) == 1 else df.select(*columns)
    repeated = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return _result(repeated, name, F.count_if(F.col("_n") > 1))


def not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """One row per column, all from one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{table}.{c} not null") for c in columns])
    return one.unpivot([], [f"`{table}.{c} not null`" for c in columns], "check", "failures")


def accepted(df: DataFrame, column: str, values: Sequence[object], name: str) -> DataFrame:
    return failing(df, F.col(column).isNotNull() & ~F.col(column).isin(*values), name)


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str) -> DataFrame:
    """Rows with a key that the parent table lacks.

    Keys are counted before the join, so one very frequent key is one row.
    """
    keys = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    missing = keys.join(parent.select(F.col(parent_column).alias("_key")), on="_key", how="left_anti")
    return _result(missing, name, F.sum("_n"))


def in_range(df: DataFrame, column: str, lo: float | None, hi: float | None, name: str) -> DataFrame:
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (F.col(column) < lo)
    if hi is not None:
        bad = bad | (F.col(column) > hi)
    return failing(df, bad, name)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same table, or an error naming the missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def compare_totals(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Totals per key from two builds of one table, with their difference."""
    left = a.groupBy(*keys).agg(*[F.sum(c).alias(f"a_{c}") for c in columns])
    right = b.groupBy(*keys).agg(*[F.sum(c).alias(f"b_{c}") for c in columns])
    joined = left.join(right, on=list(keys), how="full")
    return joined.select(
        *keys, *[x for c in columns for x in (f"a_{c}", f"b_{c}")],
        *[(F.col(f"a_{c}") - F.col(f"b_{c}")).alias(f"diff_{c}") for c in columns],
    )


def fan_out(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a join, counted at once: tables that lie by some of its columns are not exchanged by all."""
    n_before = before.agg(F.count(F.lit(1)).alias("rows_before"))
    n_after = after.agg(F.count(F.lit(1))).scalar()
    with joined_where_they_lie(before.sparkSession):
        counted = materialize(n_before.withColumn("rows_after", n_after), "fan-out")
    return counted.withColumn("extra_rows", F.col("rows_after") - F.col("rows_before"))


def freshness(df: DataFrame, column: str, today: Column | None = None, warn_days: int = 7, error_days: int = 30) -> DataFrame:
    """Age in days of the newest date, with pass, warn or error."""
    now = F.current_date() if today is None else today
    age = F.date_diff(now, F.to_date("newest"))
    status = F.when(age > error_days, "error").when(age > warn_days, "warn").otherwise("pass")
    return df.agg(F.max(column).alias("newest")).select(
        F.to_date("newest").alias("newest"), age.alias("age_days"), status.alias("status")
    )
