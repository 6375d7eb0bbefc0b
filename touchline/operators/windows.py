"""Ordered and ranked operators: form, latest rows, top-n, running totals, as-of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.slices import SLICE, going_on, in_slices, last_groups


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per group. Spark prunes to n rows per task before the shuffle."""
    name = rank or "_place"
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn(name, place).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per group by the order columns."""
    return top_n(df, keys, [F.desc(c) for c in order], 1)


def dominant(df: DataFrame, keys: Sequence[str], category: str, weight: str | None = None) -> DataFrame:
    """Heaviest category per group, ties to the first name. Sums before it ranks."""
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    sums = df.filter(F.col(category).isNotNull()).groupBy(*keys, category).agg(amount.alias("weight"))
    return top_n(sums, keys, [F.desc("weight"), F.asc(category)], 1)


def both_ends(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """n largest and n smallest rows, each row once."""
    known = df.filter(F.col(by).isNotNull())
    high = known.orderBy(F.desc(by), F.asc(tie)).limit(n)
    low = known.orderBy(F.asc(by), F.asc(tie)).limit(n)
    return high.unionByName(low).distinct()


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank", slices: int | None = None) -> DataFrame:
    """Place of every row in the sorted whole, counted slice by slice. ``order`` must be a total order."""
    rows = in_slices(df, [], order, slices)
    sizes = rows.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_size"))
    # one row for each slice
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(SLICE).alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    placed = rows.withColumn("_place", F.row_number().over(Window.partitionBy(SLICE).orderBy(*order)))
    found = placed.join(starts, F.col(SLICE) == F.col("_of"))
    return found.withColumn(name, (F.col("_start") + F.col("_place")).cast("int")).select(*df.columns, name)


def top_mean(df: DataFrame, keys: Sequence[str], columns: Sequence[str], n: int, prefix: str) -> DataFrame:
    """Mean of the n largest values per group, for every column, in one shuffle.

    The values are unpivoted so that each (group, column) is an own small
    ranking, pruned to n rows per task before the shuffle.
    """
    long = df.select(*keys, *columns).unpivot(list(keys), list(columns), "_metric", "_value")
    best = top_n(long.filter(F.col("_value").isNotNull()), [*keys, "_metric"], [F.desc("_value")], n)
    return best.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("_metric") == c, F.col("_value"))).alias(f"{prefix}{c}") for c in columns]
    )


def _attach(rows: DataFrame, carried: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Adds what each slice's first group carries over; other groups get null."""
    right = carried.select(F.col(SLICE).alias("_of"), *[F.col(k).alias(f"_of_{k}") for k in keys], *names)
    test = F.col(SLICE) == F.col("_of")
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(right, test, "left").drop("_of", *[f"_of_{k}" for k in keys])


def rolling_means(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, str],
    n: int,
    slices: int | None = None,
) -> DataFrame:
    """Mean of each measure over the previous ``n`` rows of the group, current row left out.

    ``order`` must be a total order within the group.
    """
    rows = in_slices(df, keys, order, slices)
    kept = list(dict.fromkeys([*order, *measures.values()]))
    groups = [*keys, SLICE]
    ends = last_groups(rows.select(*groups, *[c for c in kept if c not in groups]), keys)
    tail = (
        top_n(ends, groups, [F.desc(c) for c in order], n)
        .groupBy(*groups)
        .agg(F.sort_array(F.collect_list(F.struct(*kept))).alias("_tail"))
    )
    # n earlier slices of a group hold n rows of it, or all there are
    marks = going_on(tail, rows, keys, ["_tail"])
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(-n, -1)
    lead = (
        marks.select(*groups, F.flatten(F.collect_list("_tail").over(before)).alias("_carried"))
        .filter(F.size("_carried") > 0)
        .select(*groups, F.explode(F.slice("_carried", F.greatest(F.size("_carried") - n + 1, F.lit(1)), n)).alias("_row"))
        .select(*groups, *[F.col(f"_row.{c}").alias(c) for c in kept if c not in groups], F.lit(True).alias("_lead"))
    )
    together = rows.withColumn("_lead", F.lit(False)).unionByName(lead, allowMissingColumns=True)
    frame = Window.partitionBy(*groups).orderBy(*order).rowsBetween(-n, -1)
    means = together.select("*", *[F.avg(c).over(frame).alias(name) for name, c in measures.items()])
    return means.filter(~F.col("_lead")).drop("_lead", SLICE)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str],
    slices: int | None = None,
) -> DataFrame:
    """Sum of each column over all earlier rows of the group (0 for the first row).

    ``order`` must be a total order within the group.
    """

    def earlier(rows: DataFrame, groups: Sequence[str], by: Sequence[str], names: Mapping[str, str]) -> DataFrame:
        frame = Window.partitionBy(*groups).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select("*", *[F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(out) for out, c in names.items()])

    rows = in_slices(df, keys, order, slices)
    groups = [*keys, SLICE]
    inside = earlier(rows, groups, order, {f"_in_{out}": c for out, c in sums.items()})
    before = [f"_before_{out}" for out in sums]
    ends = last_groups(rows, keys).groupBy(*groups).agg(*[F.sum(c).alias(f"_sum_{out}") for out, c in sums.items()])
    offsets = earlier(going_on(ends, rows, keys, [f"_sum_{o}" for o in sums]), keys, [SLICE], {f"_before_{out}": f"_sum_{out}" for out in sums})
    joined = _attach(inside, offsets, keys, before)
    return joined.select(
        *df.columns,
        *[(F.coalesce(F.col(f"_before_{out}"), F.lit(0)) + F.col(f"_in_{out}")).alias(out) for out in sums],
    )


def rank_by(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank", slices: int | None = None) -> DataFrame:
    """Rank by descending value per group; ties share the lowest rank, a missing value has none.

    Ranks distinct values by how many rows lie above, then joins the ranks
    back, so no task holds more than the distinct values of one slice.
    """
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")).withColumn("_down", -F.col(value))
    above = running_totals(counts, keys, ["_down"], {"_above": "_n"}, slices)
    ranks = above.select(*keys, value, (F.col("_above") + 1).alias(name))
    ranked = known.join(ranks, on=[*keys, value], how="left").select(*df.columns, name)
    unknown = df.filter(F.col(value).isNull()).withColumn(name, F.lit(None).cast("long"))
    return ranked.unionByName(unknown)


def _events(right: DataFrame, keys: Sequence[str], right_time: str, payload: Sequence[str]) -> DataFrame:
    """``_hit``, the time and payload of the right rows of each time; the largest payload of one time wins."""
    carried = F.struct(F.col(right_time), *[F.col(c) for c in payload])
    return (
        right.select(*keys, F.col(right_time).alias("_time"), carried.alias("_hit"))
        .groupBy(*keys, "_time")
        .agg(F.max("_hit").alias("_hit"))
        .withColumn("_side", F.lit(0))
    )


def _answered(query: DataFrame, event: DataFrame, keys: Sequence[str], slices: int | None) -> DataFrame:
    """The query rows with ``_found``, the newest hit at or before their ``_time``."""
    order = ["_time", "_side"]
    rows = in_slices(query.withColumn("_side", F.lit(1)).unionByName(event, allowMissingColumns=True), keys, order, slices)
    groups = [*keys, SLICE]
    upto = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_found", F.last("_hit", ignorenulls=True).over(upto))
    # the time comes first in the payload, so the largest is the newest
    ends = last_groups(rows, keys).groupBy(*groups).agg(F.max("_hit").alias("_end"))
    marks = going_on(ends, rows, keys, ["_end"])
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = marks.select(*groups, F.last("_end", ignorenulls=True).over(earlier).alias("_start"))
    both = _attach(found, starts, keys, ["_start"]).withColumn("_found", F.coalesce("_found", "_start"))
    return both.filter("_side = 1")


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    slices: int | None = None,
) -> DataFrame:
    """For each left row, the payload of the newest right row at or before its time.

    Both sides are stacked and the last right payload is carried forward in
    time order. Right rows come first at equal times; of several at one time
    the largest payload wins. No pair of rows is ever formed.
    """
    event = _events(right, keys, right_time, payload)
    both = _answered(left.withColumn("_time", F.col(left_time)), event, keys, slices)
    return both.select(*left.columns, *[F.col(f"_found.{c}").alias(c) for c in [right_time, *payload]])


def as_of_join_many(
    left: DataFrame,
    right: DataFrame,
    row_key: Sequence[str],
    lookups: Mapping[str, str],
    right_key: str,
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    slices: int | None = None,
) -> DataFrame:
    """As-of lookups of several left columns in one right table, with one range exchange for all of them.

    ``lookups`` maps a prefix to the left column whose value is looked up in
    ``right_key``; its results are named by prefix and column. A left row is
    stacked once for each lookup, but only the first copy carries its columns;
    the answers meet again by ``row_key``, which must tell left rows apart.
    """
    event = _events(right.withColumnRenamed(right_key, "_key"), ["_key"], right_time, payload)
    copies = F.array(*[F.struct(F.lit(i).alias("of"), left[c].alias("key")) for i, c in enumerate(lookups.values())])
    key_names = [f"_row_{i}" for i in range(len(row_key))]
    asked = left.select(
        *[left[c].alias(n) for c, n in zip(row_key, key_names, strict=True)],
        left[left_time].alias("_time"),
        F.struct(*[left[c] for c in left.columns]).alias("_left"),
        F.explode(copies).alias("_copy"),
    )
    asked = asked.withColumns({"_key": F.col("_copy.key"), "_lookup": F.col("_copy.of")}).drop("_copy")
    asked = asked.withColumn("_left", F.when(F.col("_lookup") == 0, F.col("_left")))
    both = _answered(asked, event, ["_key"], slices)
    met = both.groupBy(*key_names).agg(
        F.first("_left", ignorenulls=True).alias("_left"),
        *[F.max(F.when(F.col("_lookup") == i, F.col("_found"))).alias(f"_found_{i}") for i in range(len(lookups))],
    )
    return met.select(
        *[F.col("_left")[c].alias(c) for c in left.columns],
        *[F.col(f"_found_{i}")[c].alias(f"{prefix}{c}") for i, prefix in enumerate(lookups) for c in [right_time, *payload]],
    )


def prior_meetings(
    matches: DataFrame, match_id: str, day: str, home: str, away: str, result: str
) -> DataFrame:
    """Earlier meetings of the two sides and how many the home side won, per match.

    Meetings are folded to one row per pair and day before the running count,
    so a pair never holds more rows than there are days. Same-day meetings do
    not count for each other.
    """
    first, second = F.least(home, away), F.greatest(home, away)
    won_first = ((F.col(result) == "home_win") & (F.col(home) == first)) | (
        (F.col(result) == "away_win") & (F.col(away) == first)
    )
    won_second = ((F.col(result) == "home_win") & (F.col(home) == second)) | (
        (F.col(result) == "away_win") & (F.col(away) == second)
    )
    keyed = matches.withColumns({"_first": first, "_second": second})
    days = keyed.groupBy("_first", "_second", day).agg(
        F.count(F.lit(1)).alias("_met"), F.count_if(won_first).alias("_won1"), F.count_if(won_second).alias("_won2")
    )
    earlier = Window.partitionBy("_first", "_second").orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    history = days.select(
        "_first",
        "_second",
        day,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_met", "_won1", "_won2")],
    )
    wins = F.when(F.col(home) == F.col("_first"), F.col("_won1_before")).otherwise(F.col("_won2_before"))
    return keyed.join(history, on=["_first", "_second", day], how="inner").select(
        match_id,
        F.col("_met_before").alias("h2h_total_matches"),
        wins.alias("h2h_home_wins"),
        F.try_divide(wins, F.col("_met_before")).alias("h2h_home_win_pct"),
    )
