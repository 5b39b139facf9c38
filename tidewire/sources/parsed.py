"""Stored parsed records, as Parquet or JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import trim_ws
from ..operators.records import parse_records, project_parsed
from ..schemas import PARSED_STORED, SHORT_LOCATION, SHORT_TONE, STRINGS
from ..session import path_exists
from .tables import read_partitions, replace_partitions, small_side, stored_side

PARSED_PARTITIONS = ["date_partition", "source_file"]


def write_parsed(
    rows: DataFrame, path: str, emptied: DataFrame | None = None, fmt: str = "parquet"
) -> None:
    """Replace the stored rows of every file found in ``rows``.

    A day is a folder of files, so writing one file of a day again leaves the
    day's other files alone.  Files in ``emptied`` (date_partition, source_file)
    were read again and gave no row; they lose what was stored for them.
    """
    names = [f.name for f in PARSED_STORED.fields]
    if "line_number" not in rows.columns:
        rows = rows.withColumn("line_number", F.lit(None).cast("bigint"))
    replace_partitions(rows.select(names), path, PARSED_PARTITIONS, emptied, fmt)


def read_parsed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], PARSED_STORED)
    if fmt == "json":
        return parsed_from_json(read_json_lines(spark, path))
    return spark.read.schema(PARSED_STORED).parquet(path)


def read_parsed_of(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Stored rows of the given stored list of files (date_partition, source_file)."""
    dates = files.select("date_partition").distinct().collect()
    rows = read_partitions(spark, path, PARSED_STORED, [r.asDict() for r in dates])
    return rows.join(small_side(files.select("source_file").distinct()), "source_file", "left_semi")


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a JSON store with the partition columns of their folder."""
    return spark.read.schema("value string, date_partition string, source_file string").text(path)


# ---------------------------------------------------------------- JSON reader


def _kind(v: Column) -> Column:
    """JSON type name of a variant: OBJECT, ARRAY, STRING, BOOLEAN, VOID, or a number's."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")


def _string(doc: Column, key: str) -> Column:
    return F.coalesce(F.try_variant_get(doc, f"$.{key}", "string"), F.lit("")).alias(key)


def _strings(doc: Column, key: str) -> Column:
    found = F.try_variant_get(doc, f"$.{key}", "array<string>")
    return F.coalesce(found, F.array().cast(STRINGS)).alias(key)


def _location(v: Column) -> Column:
    """An object with names and codes, or a bare value taken as the name."""
    kind = F.coalesce(_kind(v), F.lit("VOID"))
    name = (
        F.when(kind == "OBJECT", F.coalesce(F.try_variant_get(v, "$.full_name", "string"), F.lit("")))
        .when(kind == "VOID", F.lit("None"))
        .when(kind.isin("STRING") | _is_number(kind), F.try_variant_get(v, "$", "string"))
        .otherwise(F.to_json(v))
    )
    code = F.when(
        kind == "OBJECT", F.coalesce(F.try_variant_get(v, "$.country_code", "string"), F.lit(""))
    ).otherwise(F.lit(""))
    return F.struct(name.alias("full_name"), code.alias("country_code"))


def _tone(v: Column) -> Column:
    """Object, number or anything else; empty and zero values count as absent."""
    kind = F.coalesce(_kind(v), F.lit("VOID"))
    number = F.try_variant_get(v, "$", "double")
    text = F.to_json(v)
    absent = (
        (kind == "VOID")
        | (_is_number(kind) & (number == 0))
        | text.isin("{}", "[]", '""', "false")
    )
    value = (
        F.when(kind == "OBJECT", F.coalesce(F.try_variant_get(v, "$.tone", "double"), F.lit(0.0)))
        .when(_is_number(kind), number)
        .when(kind == "BOOLEAN", F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return F.when(~absent, F.struct(value.alias("tone")))


def parsed_from_json(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parsed records from JSON lines.

    Broken lines and lines that are not objects are skipped, missing keys get
    defaults.
    """
    carried = [F.col(c) for c in lines.columns if c != value]
    docs = lines.where(trim_ws(F.col(value)) != "").select(
        *carried, F.try_parse_json(value).alias("_doc")
    )
    doc = F.col("_doc")
    docs = docs.where(doc.isNotNull() & (_kind(doc) == "OBJECT"))
    locations = F.coalesce(
        F.try_variant_get(doc, "$.locations", "array<variant>"), F.array().cast("array<variant>")
    )
    rows = docs.select(
        _string(doc, "gkg_record_id"),
        _string(doc, "date_str"),
        _string(doc, "source_common_name"),
        _string(doc, "document_id"),
        _strings(doc, "themes"),
        _strings(doc, "persons"),
        _strings(doc, "organizations"),
        F.transform(locations, _location).cast(f"array<{SHORT_LOCATION.simpleString()}>").alias(
            "locations"
        ),
        _tone(F.try_variant_get(doc, "$.tone", "variant")).cast(SHORT_TONE).alias("tone"),
        F.try_variant_get(doc, "$.line_number", "bigint").alias("line_number"),
        *carried,
    )
    return rows


# ---------------------------------------------------------------- parsed or raw


def fresh_records(raw_lines: DataFrame, like: DataFrame) -> DataFrame:
    """Raw lines parsed into the columns of the stored records ``like``."""
    carried = [c for c in raw_lines.columns if c != "value" and c in like.columns]
    fresh = project_parsed(parse_records(raw_lines), *carried)
    absent = [c for c in like.columns if c not in fresh.columns]
    return fresh.select(
        "*", *[F.lit(None).cast(like.schema[c].dataType).alias(c) for c in absent]
    ).select(like.columns)


def parsed_or_raw(
    parsed: DataFrame, raw_lines: DataFrame, key: str = "source_file"
) -> DataFrame:
    """Stored records, plus a fresh parse of the files nothing is stored for."""
    stored = stored_side(parsed.select(key).distinct())
    missing = raw_lines.join(stored, key, "left_anti")
    return parsed.unionByName(fresh_records(missing, parsed))
