"""Column builders for labels, flags and lookups over small fixed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.constants import (
    BROAD_POSITIONS,
    COMPETITION_LABELS,
    INTERNATIONAL_COMPETITIONS,
    POSITION_GROUPS,
)
from touchline.functions.text import col


def lookup(c: str | Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Value of a fixed table, evaluated inside the projection (no join)."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(entries, col(c))
    return found if default is None else F.coalesce(found, default)


def match_result(home: str | Column, away: str | Column) -> Column:
    """home_win, away_win, or draw; a missing score is a draw, as in the staged matches."""
    h, a = col(home), col(away)
    return F.when(h > a, "home_win").when(h < a, "away_win").otherwise("draw")


def is_international(c: str | Column) -> Column:
    return col(c).isin(*INTERNATIONAL_COMPETITIONS)


def context_label(flag: str | Column) -> Column:
    return F.when(col(flag), "National").otherwise("Club")


def context_flag(c: str | Column) -> Column:
    """True for national, False for club, from bool, 0/1 or text; other values fail the job."""
    text = F.lower(F.trim(col(c).cast("string")))
    return (
        F.when(text.isin("true", "1", "t", "yes", "national"), F.lit(True))
        .when(text.isin("false", "0", "f", "no", "club"), F.lit(False))
        .otherwise(
            F.raise_error(F.concat(F.lit("not a context flag: "), F.coalesce(text, F.lit("NULL")))).cast("boolean")
        )
    )


def position_group(c: str | Column) -> Column:
    """GK/CB/FB/CM/AM/FW; unknown positions give NULL."""
    return lookup(F.trim(col(c)), POSITION_GROUPS)


def broad_position(c: str | Column) -> Column:
    """Goalkeeper/Defender/Midfielder/Forward, else 'Unknown'."""
    return lookup(c, BROAD_POSITIONS, F.lit("Unknown"))


def competition_label(c: str | Column) -> Column:
    return lookup(c, COMPETITION_LABELS)


def sort_key(c: str | Column, order: Sequence[str]) -> Column:
    """1-based place in a fixed display order; NULL when not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), col(c)), F.lit(0))


def country_name(c: str | Column, aliases: Mapping[str, str]) -> Column:
    """Crosswalk spelling, unmatched names kept."""
    return lookup(c, aliases, col(c))


def label_contains(c: str | Column, fragment: str) -> Column:
    """Case-insensitive contains; NULL counts as no match."""
    return F.coalesce(F.contains(F.lower(col(c)), F.lit(fragment.lower())), F.lit(False))


def points(side: str | Column, result: str | Column) -> Column:
    """3 for a win, 1 for a draw, 0 for a loss, seen from one side."""
    s, r = col(side), col(result)
    return F.when(r == F.concat(s, F.lit("_win")), 3).when(r == "draw", 1).otherwise(0)


def side_result(side: str | Column, result: str | Column) -> Column:
    s, r = col(side), col(result)
    return F.when(r == F.concat(s, F.lit("_win")), "win").when(r == "draw", "draw").otherwise("loss")


def labelled_bins(c: str | Column, edges: Sequence[float], closed_last: int = 0) -> Column:
    """Text label ``lo-hi`` of the bin holding the value; missing values give 'null'.

    Bins are half-open; the ``closed_last``-th from the end also takes its
    upper edge, as the published minutes table does for 90-105.
    """
    value = col(c)
    out = F.when(value.isNull(), "null")
    pairs = list(zip(edges[:-1], edges[1:]))
    for i, (lo, hi) in enumerate(pairs[:-1]):
        inside = value <= hi if closed_last and i == len(pairs) - closed_last else value < hi
        out = out.when(inside, f"{lo}-{hi}")
    lo, hi = pairs[-1]
    return out.otherwise(f"{lo}-{hi}")
