"""Raw record lines from text files, byte strings or in-memory text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import url_filename

# A line ends at \n, \r\n or \r, as in a file opened in text mode.
LINE_END = r"\r\n|\n|\r"


def read_record_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of delimited files with the name of the file they came from.

    The text source splits big files, so a line's number is not known here;
    the archive path has it.
    """
    return spark.read.text(path).select(
        F.make_valid_utf8("value").alias("value"),
        url_filename(F.col("_metadata.file_path")).alias("source_file"),
    )


def lines_of_text(texts: DataFrame, content: str = "content") -> DataFrame:
    """Lines of whole texts held in a column, numbered from 1.

    A final line end opens no further line.
    """
    carried = [F.col(c) for c in texts.columns if c != content]
    # plain replacements and a one-character separator: no regular expression runs over the text
    unified = F.replace(F.replace(F.make_valid_utf8(F.col(content)), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    body = F.when(F.endswith(unified, F.lit("\n")), F.left(unified, F.length(unified) - 1)).otherwise(unified)
    return (
        texts.where(F.length(content) > 0)
        .select(*carried, F.posexplode(F.split(body, "\n")).alias("_pos", "value"))
        .select(*carried, (F.col("_pos") + 1).cast("bigint").alias("line_number"), "value")
    )
