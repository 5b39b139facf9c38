"""Record lines -> typed records, rejects and counts.

The line is split once; every nested field is one more column of the same
projection, so a consumer that selects three columns pays for three parsers.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fields as fx
from ..functions.text import trim_ws
from ..schemas import FIELDS, LOCATION, MIN_FIELDS, POSITION, STRINGS, TONE
from ..sources.tables import stored_side

NESTED = ["themes", "locations", "persons", "organizations", "tone"]
LINE_HEAD = 200
MAX_ERRORS = 1000
OVERFLOW_MESSAGE = "cannot convert float infinity to integer"


def _at(name: str) -> Column:
    return fx.part(F.col("_f"), POSITION[name])


def line_kind(value: Column) -> Column:
    """blank, error (under five fields), skipped (no record id or no document
    id) or parsed.

    Looks at the first five fields only, so that sorting lines out and counting
    them never splits a line.
    """

    def up_to(n: int) -> Column:
        return F.substring_index(value, "\t", n)

    return (
        F.when(trim_ws(value) == "", F.lit("blank"))
        .when(up_to(MIN_FIELDS - 1) == value, F.lit("error"))
        .when(
            (trim_ws(up_to(POSITION["gkg_record_id"] + 1)) == "")
            | (trim_ws(F.substring_index(up_to(POSITION["document_id"] + 1), "\t", -1)) == ""),
            F.lit("skipped"),
        )
        .otherwise(F.lit("parsed"))
    )


def _pieces(value: str) -> Column:
    return F.split(F.rtrim(F.col(value), F.lit("\r\n")), "\t")


def record_columns(fields_to_parse: Iterable[str] | None = None) -> list[Column]:
    """Columns of a typed record over ``_f`` and ``_tone_numbers``; unselected
    nested fields stay empty."""
    chosen = set(NESTED) if not fields_to_parse else set(fields_to_parse)
    empty = F.array().cast(STRINGS)
    numbers = F.col("_tone_numbers")
    date_str = trim_ws(_at("date"))

    def strings(name: str) -> Column:
        return (fx.parse_list(_at(name)) if name in chosen else empty).alias(name)

    locations = fx.parse_locations(_at("v2_enhanced_locations"))
    tone = fx.tone_of(numbers)
    if "locations" not in chosen:
        locations = F.lit(None).cast(_type_of("locations"))
        locations = F.coalesce(locations, F.array().cast(_type_of("locations")))
    errors = F.array().cast(STRINGS)
    if "tone" in chosen:
        errors = F.when(fx.tone_overflow(numbers), F.array(F.lit(OVERFLOW_MESSAGE))).otherwise(
            errors
        )
    else:
        tone = F.lit(None).cast(_type_of("tone"))
    return [
        trim_ws(_at("gkg_record_id")).alias("gkg_record_id"),
        fx.parse_date(date_str).alias("date"),
        date_str.alias("date_str"),
        fx.collection_id(_at("source_collection_id")).alias("source_collection_id"),
        trim_ws(_at("source_common_name")).alias("source_common_name"),
        trim_ws(_at("document_id")).alias("document_id"),
        strings("themes"),
        locations.alias("locations"),
        strings("persons"),
        strings("organizations"),
        tone.alias("tone"),
        # all 27 fields: missing ones empty, surplus ones cut off
        F.map_from_arrays(
            F.split(F.lit(" ".join(FIELDS)), " "),
            F.slice(F.concat("_f", F.array_repeat(F.lit(""), len(FIELDS))), 1, len(FIELDS)),
        ).alias("raw"),
        errors.alias("parse_errors"),
        fx.year_month(date_str).alias("year_month"),
    ]


def _type_of(name: str) -> T.DataType:
    return {"locations": T.ArrayType(LOCATION), "tone": TONE}[name]


def parse_records(
    lines: DataFrame,
    fields_to_parse: Iterable[str] | None = None,
    value: str = "value",
    keep_invalid: bool = False,
) -> DataFrame:
    """Typed records of all well-formed lines, other input columns carried along.

    Without ``keep_invalid`` records lacking an id are left out, as a reader of
    the feed expects.
    """
    carried = [c for c in lines.columns if c != value]
    kind = line_kind(F.col(value))
    kinds = ["parsed", "skipped"] if keep_invalid else ["parsed"]
    pieces = lines.where(kind.isin(kinds)).select(
        *carried, _pieces(value).alias("_f"), (kind == "parsed").alias("is_valid")
    )
    numbered = pieces.withColumn("_tone_numbers", fx.tone_numbers(_at("v2_tone")))
    return numbered.select(*carried, *record_columns(fields_to_parse), "is_valid")


def raw_field(name: str, raw: str = "raw") -> Column:
    """Unparsed text of a field; an unknown name gives an empty string."""
    return F.coalesce(F.try_element_at(F.col(raw), F.lit(name)), F.lit(""))


def reject_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Malformed lines with message and line head (the error callback's data)."""
    carried = [F.col(c) for c in lines.columns if c != value]
    return (
        lines.where(line_kind(F.col(value)) == "error")
        .select(
            *carried,
            # Fixed value: the message reads as the reference's.
            F.concat(
                F.lit("Too few fields: "),
                F.size(_pieces(value)).cast("string"),
                F.lit(f", expected at least {MIN_FIELDS}"),
            ).alias("message"),
            F.substring(value, 1, LINE_HEAD).alias("line_head"),
        )
    )


def parse_stats(
    lines: DataFrame, by: Iterable[str] = ("source_file",), value: str = "value"
) -> DataFrame:
    """Lines, records, errors and skipped per file; blank lines count in lines only."""
    kind = F.col("_kind")
    return (
        lines.withColumn("_kind", line_kind(F.col(value)))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("lines_processed"),
            F.count_if(kind == "parsed").alias("records_parsed"),
            F.count_if(kind == "error").alias("errors"),
            F.count_if(kind == "skipped").alias("skipped"),
        )
    )


def failed_files(
    lines: DataFrame,
    max_errors: int = MAX_ERRORS,
    skip_malformed: bool = True,
    by: str = "source_file",
    value: str = "value",
) -> DataFrame:
    """Files that fail as a whole, with the error count and message.

    Counting folds before the shuffle, so a file holding most lines is no burden.
    """
    kind = line_kind(F.col(value))
    bad = kind == "error"
    if not skip_malformed:
        # then a record whose tone overflows is an error of its file as well
        tone = fx.part(_pieces(value), POSITION["v2_tone"])
        bad = bad | (
            kind.isin("parsed", "skipped") & fx.tone_overflow(fx.tone_numbers(tone))
        )
        max_errors = 1
    return (
        lines.withColumn("_bad", bad)
        .groupBy(by)
        .agg(F.count_if("_bad").alias("errors"))
        .where(F.col("errors") >= max_errors)
        # Fixed value: the message reads as the reference's.
        .withColumn("message", F.lit(f"Max errors ({max_errors}) exceeded"))
    )


def drop_failed_files(
    lines: DataFrame,
    max_errors: int = MAX_ERRORS,
    skip_malformed: bool = True,
    by: str = "source_file",
    value: str = "value",
) -> DataFrame:
    """Lines of the files that do not fail (nothing of a failed file is kept).

    The names of failed files are stored and counted first: where they are few,
    as they should be, no line is shuffled to drop them.
    """
    failed = failed_files(lines, max_errors, skip_malformed, by, value).select(by)
    return lines.join(stored_side(failed), by, "left_anti")


def project_parsed(records: DataFrame, *carried: str) -> DataFrame:
    """The stored subset of a record."""
    return records.select(
        "gkg_record_id",
        "date_str",
        "source_common_name",
        "document_id",
        "themes",
        "persons",
        "organizations",
        F.transform(
            "locations",
            lambda x: F.struct(
                x["full_name"].alias("full_name"), x["country_code"].alias("country_code")
            ),
        ).alias("locations"),
        F.when(
            F.col("tone").isNotNull(), F.struct(F.col("tone.tone").alias("tone"))
        ).alias("tone"),
        *carried,
    )


def partition_batches(
    records: DataFrame,
    batch_size: int = 1000,
    identity: Iterable[str] = ("gkg_record_id", "document_id"),
    date_str: str = "date_str",
    slice_digits: int = 3,
) -> DataFrame:
    """The batches of at most ``batch_size`` records within each month.

    One row per ``partition_key`` (year and month, or unknown), ``batch_no`` and
    record identity, with the number of its copies in that batch.  All batches
    of a month are full but the last.  Reading order means nothing in a
    distributed read, so records are ordered by the MD5 slice of their identity
    columns, then by these columns.

    No month is ever sorted in one task: a month is cut into 16^slice_digits
    slices, each slice is numbered on its own and shifted by the size of the
    slices before it.  Equal identities are one counted row until the end, so
    a record repeated any number of times is no hot spot either.
    """
    identity = list(identity)
    key = fx.month_partition(F.col(date_str))
    digest = F.md5(F.concat_ws("\t", *[F.col(c) for c in identity]))
    counted = (
        records.select(
            key.alias("partition_key"),
            F.substring(digest, 1, slice_digits).alias("_slice"),
            *identity,
        )
        .groupBy("partition_key", "_slice", *identity)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sizes = counted.groupBy("partition_key", "_slice").agg(F.sum("_n").alias("_size"))
    before = W.partitionBy("partition_key").orderBy("_slice")
    # at most 16^slice_digits rows per month enter this window
    offsets = sizes.select(
        "partition_key",
        "_slice",
        (F.sum("_size").over(before) - F.col("_size")).alias("_offset"),
    )
    within = W.partitionBy("partition_key", "_slice").orderBy(*identity)
    placed = counted.withColumn("_end", F.sum("_n").over(within)).join(
        offsets, ["partition_key", "_slice"]
    )
    size = F.lit(batch_size)
    first = F.col("_offset") + F.col("_end") - F.col("_n")
    last = F.col("_offset") + F.col("_end") - 1
    spread = placed.select(
        "partition_key",
        *identity,
        first.alias("_first"),
        last.alias("_last"),
        F.explode(
            F.sequence(
                F.floor(first / size).cast("bigint"), F.floor(last / size).cast("bigint")
            )
        ).alias("batch_no"),
    )
    begin = F.greatest(F.col("_first"), F.col("batch_no") * size)
    end = F.least(F.col("_last"), (F.col("batch_no") + 1) * size - 1)
    return spread.select(
        "partition_key", "batch_no", *identity, (end - begin + 1).alias("n_copies")
    )
