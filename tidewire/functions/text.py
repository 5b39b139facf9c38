"""Text and number parsing with the exact grammar the feed's readers expect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character counted as white space when stripping.
WHITESPACE = "".join(
    map(
        chr,
        [
            0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
            0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
            0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)

# The same class for splitting on runs of white space.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

_DIGITS = r"[0-9]+(_[0-9]+)*"
INT_FORM = rf"^[+-]?{_DIGITS}$"
FLOAT_FORM = (
    rf"(?i)^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?$"
    r"|^[+-]?(inf|infinity|nan)$"
)


def trim_ws(c: Column) -> Column:
    """Strip white space of any kind on both sides (no regular expression)."""
    return F.btrim(c, F.lit(WHITESPACE))


def words(c: Column) -> Column:
    """Tokens between runs of white space."""
    return F.filter(F.split(c, WHITESPACE_RUN), lambda w: w != "")


def to_int(c: Column) -> Column:
    """Integer, or null for anything that is not one (or leaves 64 bits)."""
    t = trim_ws(c)
    return F.when(t.rlike(INT_FORM), F.replace(t, F.lit("_"), F.lit("")).try_cast("bigint"))


def to_float(c: Column) -> Column:
    """Double, or null.  Suffixed literals such as ``1.5f`` are refused."""
    t = trim_ws(c)
    digits = F.replace(F.lower(t), F.lit("_"), F.lit(""))
    # a sign before "nan" means nothing, and a cast would not take it
    for signed in ("-nan", "+nan"):
        digits = F.replace(digits, F.lit(signed), F.lit("nan"))
    return F.when(t.rlike(FLOAT_FORM), digits.try_cast("double"))
