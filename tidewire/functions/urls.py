"""What a file's URL says about it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_filename(url: Column) -> Column:
    """Last segment of the URL's path (parameters, query and fragment cut off)."""
    path = F.regexp_replace(url, r"(?s)[?#].*$", "")
    # "scheme://host" alone has no path, hence no file name
    path = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?s);.*$", "")


def date_partition(filename: Column) -> Column:
    """First run of eight digits, else null."""
    return F.nullif(F.regexp_extract(filename, r"([0-9]{8})", 1), F.lit(""))


def file_type(filename: Column) -> Column:
    name = F.lower(filename)
    return (
        F.when(name.contains(".gkg."), F.lit("gkg"))
        .when(name.contains(".export."), F.lit("export"))
        .when(name.contains(".mentions."), F.lit("mentions"))
    )


def landing_year(filename: Column) -> Column:
    return F.coalesce(F.substring(date_partition(filename), 1, 4), F.lit("unknown"))


def landing_month(filename: Column) -> Column:
    return F.coalesce(F.substring(date_partition(filename), 5, 2), F.lit("unknown"))
