"""Parsers for single fields of a record line, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TONE_PARTS
from .text import to_float, to_int, trim_ws


def part(parts: Column, i: int) -> Column:
    """i-th piece of a split string; missing pieces are empty strings."""
    return F.coalesce(F.get(parts, F.lit(i)), F.lit(""))


def parse_date(c: Column) -> Column:
    """``yyyyMMddHHmmss`` (first 14) or ``yyyyMMdd`` (first 8) as TIMESTAMP_NTZ.

    A value of 14 or more characters never falls back to its first eight.
    """

    def num(start: int, length: int) -> Column:
        return F.substring(c, start, length).try_cast("int")

    zero = F.lit(0)
    full = F.substring(c, 1, 14).rlike("^[0-9]{14}$") & (num(13, 2) < 60)
    day = F.substring(c, 1, 8).rlike("^[0-9]{8}$")
    year_ok = num(1, 4) >= 1
    return F.when(
        F.length(c) >= 14,
        F.when(
            full & year_ok,
            F.try_make_timestamp_ntz(
                num(1, 4), num(5, 2), num(7, 2), num(9, 2), num(11, 2), num(13, 2)
            ),
        ),
    ).when(
        F.length(c) >= 8,
        F.when(
            day & year_ok,
            F.try_make_timestamp_ntz(num(1, 4), num(5, 2), num(7, 2), zero, zero, zero),
        ),
    )


def parse_list(c: Column, delimiter: str = ";") -> Column:
    """Stripped, non-empty items of a delimited list."""
    pieces = F.split(c, re.escape(delimiter))
    return F.filter(F.transform(pieces, trim_ws), lambda x: x != "")


def collection_id(c: Column) -> Column:
    return F.coalesce(to_int(c), F.lit(0).cast("bigint"))


def _with_numbers(p: Column) -> Column:
    """Pieces of a location with its four numbers, each parsed once."""
    return F.struct(
        p.alias("p"),
        to_int(part(p, 0)).alias("kind"),
        to_float(part(p, 5)).alias("lat"),
        to_float(part(p, 6)).alias("lon"),
        to_int(part(p, 8)).alias("offset"),
    )


def _location_ok(s: Column) -> Column:
    """Every number is either absent or well formed."""
    ok = F.lit(True)
    for i, name in ((0, "kind"), (5, "lat"), (6, "lon"), (8, "offset")):
        ok = ok & (s[name].isNotNull() | (part(s["p"], i) == ""))
    return ok


def _location_struct(s: Column) -> Column:
    p = s["p"]
    return F.struct(
        F.coalesce(s["kind"], F.lit(0).cast("bigint")).alias("location_type"),
        part(p, 1).alias("full_name"),
        part(p, 2).alias("country_code"),
        part(p, 3).alias("adm1_code"),
        part(p, 4).alias("adm2_code"),
        s["lat"].alias("latitude"),
        s["lon"].alias("longitude"),
        part(p, 7).alias("feature_id"),
        s["offset"].alias("char_offset"),
    )


def parse_locations(c: Column) -> Column:
    """``;``-separated locations; empty ones and those with a bad number are left out."""
    pieces = F.transform(parse_list(c), lambda x: F.split(x, "#"))
    numbered = F.filter(F.transform(pieces, _with_numbers), _location_ok)
    return F.transform(numbered, _location_struct)


def parse_location(c: Column) -> Column:
    """One ``#``-separated location, or null when empty or any number is bad."""
    items = F.filter(F.array(c), lambda x: x != "")
    numbered = F.transform(F.transform(items, lambda x: F.split(x, "#")), _with_numbers)
    return F.get(F.transform(F.filter(numbered, _location_ok), _location_struct), F.lit(0))


def tone_numbers(c: Column) -> Column:
    """Up to seven numbers of a tone field; empty parts are 0, bad ones null."""
    parts = F.slice(F.split(c, ","), 1, 7)
    return F.transform(parts, lambda x: F.when(x == "", F.lit(0.0)).otherwise(to_float(x)))


def tone_overflow(numbers: Column) -> Column:
    """All numbers are well formed but the word count is infinite."""
    count = F.get(numbers, F.lit(6))
    infinite = count.isin(float("inf"), float("-inf"))
    return F.coalesce(infinite, F.lit(False)) & ~F.exists(numbers, F.isnull)


def tone_of(numbers: Column) -> Column:
    """Six numbers and a word count.

    Any bad number gives all zeros (an empty field is one empty part); a word
    count that is not a number likewise; an infinite one gives null.
    """

    def number(i: int) -> Column:
        return F.coalesce(F.get(numbers, F.lit(i)), F.lit(0.0))

    zeros = F.struct(
        *[F.lit(0.0).alias(n) for n in TONE_PARTS], F.lit(0).cast("bigint").alias("word_count")
    )
    values = F.struct(
        *[number(i).alias(n) for i, n in enumerate(TONE_PARTS)],
        number(6).try_cast("bigint").alias("word_count"),
    )
    return (
        F.when(F.exists(numbers, F.isnull) | F.isnan(number(6)), zeros)
        .when(tone_overflow(numbers), F.lit(None))
        .otherwise(values)
    )


def parse_tone(c: Column) -> Column:
    return tone_of(tone_numbers(c))


def year_month(date_str: Column) -> Column:
    return F.when(F.length(date_str) >= 6, F.substring(date_str, 1, 6))


def month_partition(date_str: Column) -> Column:
    return F.coalesce(year_month(date_str), F.lit("unknown"))
