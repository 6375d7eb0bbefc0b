"""Column builders for dirty text: missing tokens, clocks, coordinates, slugs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.constants import FULL_MATCH_MINUTES, MAX_MATCH_MINUTES, NULL_TOKENS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c: str | Column) -> Column:
    """NULL where the text only stands for a missing value."""
    value = col(c)
    return F.when(~value.isin(*NULL_TOKENS), value)


def regex_group(c: str | Column, pattern: str, group: int = 1) -> Column:
    """Like ``regexp_extract`` but NULL, not '', when nothing matches."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def parse_location(c: str | Column) -> tuple[Column, Column]:
    """x and y from text such as ``[61.0, 40.1]``."""
    text = col(c)
    x = regex_group(text, r"\[(-?[\d.]+)")
    y = regex_group(text, r"\s+(-?[\d.]+)\]")
    return x.try_cast("double"), y.try_cast("double")


def location_xy(c: str | Column) -> tuple[Column, Column]:
    """x and y from an array column, out-of-range positions giving NULL."""
    pair = col(c)
    return F.try_element_at(pair, F.lit(1)), F.try_element_at(pair, F.lit(2))


def clock_minutes(c: str | Column, hms: bool = False, stoppage: bool = False) -> Column:
    """Minutes from clock text.

    ``MM:SS`` always; ``H:MM:SS`` with ``hms``; ``90+3:30`` with ``stoppage``.
    Anything else is NULL.
    """
    text = F.trim(col(c))
    parts = F.split(text, ":")
    n = F.size(parts)

    def part(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i)).try_cast("double")

    clean = null_if_token(text).isNotNull() & (F.lower(text) != "nan")
    out = F.when(clean & (n == 2), part(1) + part(2) / 60)
    if hms:
        out = out.when(clean & (n == 3), part(1) * 60 + part(2) + part(3) / 60)
    if stoppage:
        rest = F.split(F.regexp_replace(text, r"^[^+]*\+", ""), ":")
        added = F.coalesce(F.try_element_at(rest, F.lit(1)).try_cast("double"), F.lit(0.0))
        seconds = F.coalesce(F.try_element_at(rest, F.lit(2)).try_cast("double"), F.lit(0.0))
        out = F.when(clean & text.contains("+"), FULL_MATCH_MINUTES + added + seconds / 60).otherwise(out)
    return out


def minutes_played(
    start: Column, end: Column, floor_at_zero: bool = False, default_from: bool = True
) -> Column:
    """Minutes between two clock values: a missing start is 0, a missing end a full match."""
    first = F.coalesce(start, F.lit(0.0)) if default_from else start
    last = F.coalesce(end, F.lit(FULL_MATCH_MINUTES)) if default_from else end
    span = F.when(last > MAX_MATCH_MINUTES, F.lit(MAX_MATCH_MINUTES)).otherwise(last) - first
    return F.when(span < 0, F.lit(0.0)).otherwise(span) if floor_at_zero else span


def event_type_key(c: str | Column) -> Column:
    """Trimmed lower-case type from plain text or from JSON ``{"name": …}``."""
    raw = col(c)
    name = F.when(F.trim(raw).startswith("{"), F.get_json_object(raw, "$.name"))
    return F.lower(F.trim(F.coalesce(F.nullif(name, F.lit("")), raw)))


def season_year(c: str | Column) -> Column:
    """Leading four digits of a season label as a number."""
    return regex_group(c, r"^(\d{4})").try_cast("int")


def slug_parts(c: str | Column) -> dict[str, Column]:
    """Fields of ``{competition}-{home3}-{away3}-{yyyy-mm-dd}``; NULL for other slugs."""
    pattern = r"^([a-z0-9]+)-([a-z0-9]{3})-([a-z0-9]{3})-(\d{4}-\d{2}-\d{2})$"
    return {
        "competition_code": regex_group(c, pattern, 1),
        "home_code": regex_group(c, pattern, 2),
        "away_code": regex_group(c, pattern, 3),
        "slug_date": regex_group(c, pattern, 4).try_cast("date"),
    }


def slug_prefix(c: str | Column) -> Column:
    return regex_group(c, r"^([a-z]+)-")
