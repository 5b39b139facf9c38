"""Master file lists: one ``size md5 url`` line per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import to_int, trim_ws, words

# The names of the lists, each kept below the landing folder.
LIST_FILES = {
    "gkg": "lists/gkg.txt",
    "gkg_v2": "lists/gkg_v2.txt",
    "events": "lists/events.txt",
}


def list_path(landing: str, source: str) -> str:
    if source not in LIST_FILES:
        raise ValueError(f"Unknown source: {source}. Valid: {list(LIST_FILES)}")
    return f"{landing.rstrip('/')}/{LIST_FILES[source]}"


def parse_file_info(lines: DataFrame, value: str = "value") -> DataFrame:
    """File facts of every well-formed line; other lines give no row."""
    parts = lines.select(words(F.col(value)).alias("_p")).where(F.size("_p") == 3)
    sized = parts.select(
        F.get("_p", F.lit(2)).alias("file_url"),
        to_int(F.get("_p", F.lit(0))).alias("file_size_bytes"),
        F.get("_p", F.lit(1)).alias("checksum_md5"),
    ).where(F.col("file_size_bytes").isNotNull())
    name = sized.withColumn("_name", urls.url_filename(F.col("file_url")))
    return name.select(
        "file_url",
        "file_size_bytes",
        "checksum_md5",
        urls.date_partition(F.col("_name")).alias("date_partition"),
        urls.file_type(F.col("_name")).alias("file_type"),
    )


def has_file_type(kind: str | None, c: str = "file_type") -> Column:
    """Equality; a file of no known type never passes a set filter."""
    if not kind:
        return F.lit(True)
    return F.coalesce(F.col(c) == kind, F.lit(False))


def in_list_dates(
    date_min: str | None = None, date_max: str | None = None, c: str = "date_partition"
) -> Column:
    """Inclusive bounds; files without a date pass."""
    ok = F.lit(True)
    if date_min:
        ok = ok & (F.col(c) >= date_min)
    if date_max:
        ok = ok & (F.col(c) <= date_max)
    return F.col(c).isNull() | ok


def filter_file_list(
    files: DataFrame,
    file_type_filter: str | None = None,
    date_min: str | None = None,
    date_max: str | None = None,
) -> DataFrame:
    return files.where(has_file_type(file_type_filter) & in_list_dates(date_min, date_max))


def read_file_list(
    spark: SparkSession,
    landing: str,
    source: str = "gkg",
    file_type_filter: str | None = None,
    date_min: str | None = None,
    date_max: str | None = None,
) -> DataFrame:
    """A named list below ``landing``, parsed and filtered."""
    lines = spark.read.text(list_path(landing, source)).where(trim_ws(F.col("value")) != "")
    return filter_file_list(parse_file_info(lines), file_type_filter, date_min, date_max)
