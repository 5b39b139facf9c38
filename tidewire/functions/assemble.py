"""One embedding text per record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import words

UNKNOWN_TEXT = "Unknown event"
MIN_TEXT_LENGTH = 10


def tone_label(tone_value: Column) -> Column:
    # Spark sorts NaN above every number; here it counts as neutral
    return (
        F.when(F.isnan(tone_value), F.lit("neutral"))
        .when(tone_value > 2, F.lit("positive"))
        .when(tone_value < -2, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def _listing(label: str, items: Column, top: int, drop_empty: bool = False) -> Column:
    head = F.slice(items, 1, top)
    if drop_empty:
        head = F.filter(head, lambda x: x != "")
    return F.when(F.size(items) > 0, F.concat(F.lit(label + ": "), F.array_join(head, ", ")))


def assemble_text(
    themes: Column,
    persons: Column,
    organizations: Column,
    location_names: Column,
    tone_value: Column,
    has_tone: Column,
    source: Column,
) -> Column:
    """The text that is embedded: labelled parts joined by `` | ``."""
    text = F.concat_ws(
        " | ",
        _listing("Themes", themes, 20),
        _listing("People", persons, 5),
        _listing("Organizations", organizations, 5),
        # the cut comes before empty names are dropped; the label stays
        _listing("Locations", location_names, 5, drop_empty=True),
        F.when(has_tone, F.concat(F.lit("Tone: "), tone_label(tone_value))),
        F.when(source != "", F.concat(F.lit("Source: "), source)),
    )
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(UNKNOWN_TEXT))


def text_of_record() -> Column:
    """``assemble_text`` over the usual record columns."""
    return assemble_text(
        F.col("themes"),
        F.col("persons"),
        F.col("organizations"),
        F.transform("locations", lambda x: x["full_name"]),
        F.col("tone.tone"),
        F.col("tone").isNotNull(),
        F.col("source_common_name"),
    )


def text_hash(text: Column) -> Column:
    return F.md5(text)


def token_count(text: Column) -> Column:
    return F.size(words(text))


def not_trivial(text: Column) -> Column:
    return F.length(text) > MIN_TEXT_LENGTH
