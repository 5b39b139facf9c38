"""Incremental twins of parsing and embedding.

Progress lives in the checkpoint, so a restarted query goes on where it stopped;
``availableNow`` turns a scheduled run into a catch-up batch.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import urls
from ..operators.embed import Embedder, embed_records, first_of_id, one_per_id, rank_of
from ..operators.records import parse_records, project_parsed
from ..schemas import PARSED_STORED
from ..session import hadoop_path, remove_path, scratch_path
from ..sources.parsed import write_parsed
from ..sources.vectors import VectorTable, cut_lists, folder_month, new_records, vec_row_shape

# Bytes of a folder name that file systems take, less the column's name and a margin.
FOLDER_NAME = 200


def landed_name(spark: SparkSession, landing: str) -> Column:
    """A file's path below ``landing`` as in its URL, so that files of one name in several folders stay apart.

    A file directly in ``landing`` has its base name, one that lies elsewhere
    (``landing`` being a pattern) its whole path.  The folder of a path too long
    for the name of a stored partition is replaced by its MD5.
    """
    fs, root = hadoop_path(spark, landing)
    above = fs.makeQualified(root).toUri().getRawPath().rstrip("/") + "/"
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    below = F.when(F.startswith(path, F.lit(above)), F.substring(path, len(above) + 1, 1 << 30)).otherwise(path)
    escaped = F.octet_length(F.regexp_replace(below, "[^A-Za-z0-9._-]", "%XXX"))
    short = F.concat(F.md5(F.regexp_replace(below, "(?s)/[^/]*$", "")), F.lit("/"), F.element_at(F.split(below, "/"), -1))
    return F.when((escaped > FOLDER_NAME) & below.contains("/"), short).otherwise(below)


def stream_lines(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files as they arrive below ``landing``."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing).select(
        F.make_valid_utf8("value").alias("value"),
        landed_name(spark, landing).alias("source_file"),
    )


def stream_records(
    spark: SparkSession,
    landing: str,
    fields_to_parse: Iterable[str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The batch parser over arriving lines."""
    return parse_records(stream_lines(spark, landing, max_files), fields_to_parse)


def stream_ingest(
    spark: SparkSession,
    landing: str,
    parsed_path: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Parse what has arrived since the last run into the parsed store.

    A batch replaces what is stored for its files, as a batch run does, so a
    repeated batch changes nothing.  Files are told apart by their path below
    ``landing``; a batch run knows base names only, so the two can write one
    store where files lie directly in ``landing``.
    """
    rows = project_parsed(stream_records(spark, landing, max_files=max_files), "source_file")
    date = F.coalesce(urls.date_partition(urls.url_filename(F.col("source_file"))), F.lit("unknown"))
    stored = rows.withColumns(
        {"line_number": F.lit(None).cast("bigint"), "date_partition": date}
    ).select([f.name for f in PARSED_STORED.fields])

    def write(batch: DataFrame, _batch_id: int) -> None:
        write_parsed(batch, parsed_path)

    return (
        stored.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_embed(
    spark: SparkSession,
    parsed_path: str,
    table: VectorTable,
    embedder: Embedder,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Embed newly parsed records once, and keep for each id the record the batch run keeps.

    Each id's rank (its record's place in :func:`first_of_id`) is stored in the id
    index; a later record that ranks before the stored one replaces its row (merge
    by id), so any order of arrival ends with the batch's rows.  A batch that is
    run again after a failure finds its ids stored with equal rank and adds
    nothing, whatever its number.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        # the best record of each id in the batch, against the rank stored with the id
        best = one_per_id(cut_lists(batch), *first_of_id()).withColumn("_rank", rank_of())
        stored = table.ranks_among(best).select("gkg_record_id", F.col("rank").alias("_stored"), F.lit(True).alias("_there"))
        # new ids, and stored ones whose record ranks behind this one; a stored id of unknown rank stays
        taken = best.join(stored, "gkg_record_id", "left").where(
            F.col("_there").isNull() | F.coalesce(F.col("_rank") < F.col("_stored"), F.lit(False)))
        path = scratch_path(spark, "stream-batch")
        taken.write.parquet(path)  # the batch is evaluated once
        chosen = spark.read.schema(taken.schema).parquet(path)
        better = chosen.where(F.col("_there").isNotNull()).select("gkg_record_id")
        if better.limit(1).count():
            table.delete_by_ids(better)  # merge by id: a better-ranked record replaces the stored row
        month = chosen.drop("_stored", "_there").withColumn("_month", folder_month(F.col("date_str"))).hint("rebalance", "_month")
        table.append(vec_row_shape(embed_records(month, embedder)), chosen.select("gkg_record_id", F.col("_rank").alias("rank")))
        remove_path(spark, path)

    reader = spark.readStream.schema(PARSED_STORED).format("parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.load(parsed_path)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
