"""Dates as sources write them. What can't be read is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tried in this order.
FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "d MMM yyyy HH:mm:ss", "d MMM yyyy", "MMM d, yyyy", "yyyy-MM", "yyyy")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def parse_published(text: Column) -> Column:
    """The first format that fits; a weekday in front and a zone name behind are passed over."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3}, ", ""), r" (GMT|UTC|[+-]0000)$", "")
    return F.coalesce(*(F.try_to_timestamp(bare, F.lit(f)) for f in FORMATS))


def from_parts(year: Column, month: Column | None = None, day: Column | None = None) -> Column:
    """A date from its parts; a missing month or day is the first; a part out of range gives null."""
    whole = lambda c: F.coalesce(c.try_cast("int"), F.lit(1)) if c is not None else F.lit(1)
    return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year.try_cast("int"), whole(month), whole(day)), F.lit("yyyy-MM-dd"))


def month_number(name: Column) -> Column:
    """From a number or an English name, whole or its first three letters."""
    known = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(F.trim(name), 1, 3)))
    return F.coalesce(name.try_cast("int"), F.when(known > 0, known.cast("int")))


def from_date_parts(parts: Column) -> Column:
    """From an array of year, month, day."""
    return from_parts(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.try_cast("double"))
