"""A whole run: sync, fetch, parse, embed, report.

Each step is one Spark job (or a few) over all files it concerns, reads its
input from a stored table and can be repeated: files are tracked in the event
log, parsed files replace their own partitions, stored ids are not embedded
again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import manifest as mf
from ..operators.embed import Embedder, embed_records, first_of_id, one_per_id, rank_of
from ..operators.records import MAX_ERRORS, parse_records, parse_stats, project_parsed
from ..schemas import RUN_STATS
from ..session import path_exists, remove_path, scratch_path, shuffles_dropped
from ..sources import archive, parsed
from ..sources.filelist import read_file_list
from ..sources.tables import small_side
from ..sources.vectors import VectorTable, cut_lists, folder_month, stored_among, vec_row_shape, vec_stats

FETCH_BATCH = 20_000  # files per fetch job; their paths pass through the driver
DEFAULT_DAYS = 30


@dataclass(frozen=True)
class FeedPaths:
    """Where a run keeps its data.  ``landing`` is filled by others."""

    root: str

    def _under(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self._under("landing")

    @property
    def embedded(self) -> str:
        """Which files have been embedded, and in which state."""
        return self._under("embedded-files")

    @property
    def archives(self) -> str:
        return self._under("landing/files")

    @property
    def manifest(self) -> str:
        return self._under("manifest")

    @property
    def raw(self) -> str:
        return self._under("raw")

    @property
    def parsed(self) -> str:
        return self._under("parsed")

    @property
    def vectors(self) -> str:
        return self._under("vectors")

    @property
    def runs(self) -> str:
        return self._under("runs")


def date_range(
    mode: str,
    now: datetime,
    date_from: str | None = None,
    date_to: str | None = None,
    days: int = DEFAULT_DAYS,
) -> tuple[str | None, str | None]:
    """Dates a run covers.  An incremental run ignores the given ones."""

    def day(t: datetime) -> str:
        return t.strftime("%Y%m%d")

    if mode == "incremental":
        return day(now - timedelta(days=1)), day(now)
    if mode == "backfill":
        return date_from or day(now - timedelta(days=days)), date_to or day(now)
    if mode == "embed_only":
        return date_from, date_to
    raise ValueError(f"Unknown mode: {mode}")


def completed_between(date_from: str | None, date_to: str | None) -> Column:
    """Inclusive bounds on a completed file's date; once a bound is set, files
    without a date drop out."""
    ok = F.lit(True)
    if date_from:
        ok = ok & F.coalesce(F.col("date_partition") >= date_from, F.lit(False))
    if date_to:
        ok = ok & F.coalesce(F.col("date_partition") <= date_to, F.lit(False))
    return ok


# ---------------------------------------------------------------- steps


def sync(
    spark: SparkSession,
    paths: FeedPaths,
    now: datetime,
    source: str = "gkg",
    file_type: str | None = "gkg",
    date_from: str | None = None,
    date_to: str | None = None,
) -> dict:
    """Track the files of a list that are not tracked yet (checksum included)."""
    log = mf.ManifestLog(spark, paths.manifest)
    files = read_file_list(spark, paths.landing, source, file_type, date_from, date_to)
    state = log.snapshot()
    stats = mf.sync_stats(files, state).first().asDict()
    log.append(mf.insert_ignore(files, state, now, log.next_seq()))
    log.drop_snapshots()
    return stats


def _due(state: DataFrame, landed: DataFrame, now: datetime) -> DataFrame:
    """Landed files to fetch, oldest first: pending ones, downloads that got
    stuck, and failures that may be tried again."""
    stuck = mf.stale_downloads(state, now)
    again = mf.retryable_files(state, limit=None)
    due = state.where(F.col("status") == "pending").unionByName(stuck).unionByName(again)
    one_path = landed.groupBy("source_file").agg(F.min(F.struct("path", "length")).alias("_file")).select(
        "source_file", "_file.path", "_file.length")
    return (
        due.withColumn("source_file", urls.url_filename(F.col("file_url")))
        .join(one_path, "source_file")
        .orderBy(F.asc_nulls_first("date_partition"), "created_at", "file_url")
        .select("file_url", "checksum_md5", "path", "length", "source_file")
    )


def _chunks(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while chunk := list(islice(rows, size)):
        yield chunk


def fetch(
    spark: SparkSession, paths: FeedPaths, now: datetime, max_files: int | None = None
) -> dict:
    """Unpack landed files that are due, ``FETCH_BATCH`` of them per job.

    A file that has not landed yet stays as it is.  Each file is tried once.
    """
    log = mf.ManifestLog(spark, paths.manifest)
    state, seq = log.snapshot(), log.next_seq()
    due = _due(state, archive.list_landed(spark, paths.archives), now)
    if max_files:
        due = due.limit(max_files)
    log.append(mf.reset_stale(state, now, seq=seq))
    done = {"files_downloaded": 0, "download_errors": 0}
    for chunk in _chunks(due.toLocalIterator(), FETCH_BATCH):
        seq += 2
        files = spark.createDataFrame(
            [(r["file_url"], r["checksum_md5"], r["source_file"]) for r in chunk],
            "file_url string, checksum_md5 string, source_file string",
        )
        log.append(mf.claim(files, now, seq - 1))
        pieces = scratch_path(spark, "fetched-pieces")
        archive.write_raw(
            archive.landed_lines(spark, [(r["path"], r["length"]) for r in chunk], pieces), paths.raw
        )
        remove_path(spark, pieces)
        names = files.select("source_file").distinct()
        checked = scratch_path(spark, "fetched")
        archive.checksum_join(
            archive.read_raw_of(spark, paths.raw, names), files.drop("source_file")
        ).write.parquet(checked)
        results = spark.read.schema(
            "file_url string, status string, file_size_bytes bigint, error_message string"
        ).parquet(checked)
        log.append(mf.update_status(results, state, now, seq))
        totals = results.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {r["status"]: r["n"] for r in totals}
        done["files_downloaded"] += counts.get("downloaded", 0)
        done["download_errors"] += counts.get("failed", 0)
        remove_path(spark, checked)
    log.drop_snapshots()
    return done


def parse_to_completed(
    spark: SparkSession,
    paths: FeedPaths,
    now: datetime,
    max_files: int | None = None,
    max_errors: int = MAX_ERRORS,
) -> dict:
    """Parse every downloaded file; each becomes completed with its count, or
    failed with its message.  Files without a date are left alone."""
    log = mf.ManifestLog(spark, paths.manifest)
    state = log.snapshot()
    todo = (
        mf.files_by_status(state.where(F.col("date_partition").isNotNull()), "downloaded", max_files)
        .select(
            "file_url",
            "date_partition",
            urls.url_filename(F.col("file_url")).alias("source_file"),
        )
    )
    # names and counts per file, written once and read by the steps below
    planned = scratch_path(spark, "parse-plan")
    todo.write.parquet(planned)
    files = spark.read.schema(
        "file_url string, date_partition string, source_file string"
    ).parquet(planned)
    if files.isEmpty():
        log.drop_snapshots()
        remove_path(spark, planned)
        return {"parsed_files": 0, "parse_errors": 0}
    raw = archive.read_raw_of(spark, paths.raw, files.select("source_file", "date_partition"))
    lines = raw.where(F.col("line_number") > 0).select(
        "source_file", "date_partition", "line_number", "value"
    )
    # the file's own row keeps a file without lines in the counts
    heads = raw.where(F.col("line_number") == 0).select("source_file")
    counted = scratch_path(spark, "parse-stats")
    (
        files.join(heads, "source_file", "left_semi")
        .join(parse_stats(lines), "source_file", "left")
        .na.fill(0, ["lines_processed", "records_parsed", "errors", "skipped"])
        .write.parquet(counted)
    )
    stats = spark.read.schema(
        "source_file string, file_url string, date_partition string, lines_processed bigint, "
        "records_parsed bigint, errors bigint, skipped bigint"
    ).parquet(counted)
    fails = F.col("errors") >= max_errors
    good = stats.where(~fails)
    failed_names = small_side(stats.where(fails).select("source_file"))
    records = parse_records(lines.join(failed_names, "source_file", "left_anti"))
    rows = project_parsed(records, "line_number", "date_partition", "source_file")
    parsed.write_parsed(rows, paths.parsed, good.where("records_parsed = 0"))
    outcome = stats.select(
        "file_url",
        F.when(fails, F.lit("failed")).otherwise(F.lit("completed")).alias("status"),
        F.when(~fails, F.col("records_parsed")).alias("record_count"),
        # Fixed value: the message reads as the reference's.
        F.when(fails, F.lit(f"Max errors ({max_errors}) exceeded")).alias("error_message"),
    )
    log.append(mf.update_status(outcome, state, now, log.next_seq()))
    sums = stats.agg(
        F.count_if(~fails).alias("parsed_files"), F.count_if(fails).alias("parse_errors")
    ).first()
    log.drop_snapshots()
    remove_path(spark, planned)
    remove_path(spark, counted)
    return sums.asDict()


def records_to_embed(spark: SparkSession, paths: FeedPaths, files: DataFrame) -> DataFrame:
    """Records of the given completed files (a stored list of source_file and
    date_partition): what is stored for them, or a fresh parse where nothing is.

    Which files need parsing is settled by name first, so raw lines are read
    for those alone.
    """
    stored = parsed.read_parsed_of(spark, paths.parsed, files)
    missing = files.join(stored.select("source_file").distinct(), "source_file", "left_anti")
    path = scratch_path(spark, "unparsed")
    missing.select("source_file", "date_partition").write.parquet(path)
    unparsed = spark.read.schema("source_file string, date_partition string").parquet(path)
    raw = archive.read_raw_of(spark, paths.raw, unparsed)
    lines = raw.where(F.col("line_number") > 0).select(
        "source_file", "date_partition", "line_number", "value"
    )
    return stored.unionByName(parsed.fresh_records(lines, stored))


def embed_incremental(records: DataFrame, table: VectorTable, embedder: Embedder) -> dict:
    """Embed and append the records whose id is not stored yet.

    Of several records with one id the earliest file counts, and in it the last
    line.
    """
    spark = records.sparkSession
    # the records are evaluated once: everything below reads this copy
    copy = scratch_path(spark, "intake")
    records = cut_lists(records)
    records.write.parquet(copy)
    records = spark.read.schema(records.schema).parquet(copy)
    path = scratch_path(spark, "stored-ids")
    with shuffles_dropped(spark):
        stored_among(records, table).write.parquet(path)  # the table's id index: filters, then its buckets
        seen = spark.read.schema("gkg_record_id string").parquet(path)
        skipped = records.select("gkg_record_id").join(seen, "gkg_record_id", "left_semi").count()
        fresh = one_per_id(
            records.join(seen, "gkg_record_id", "left_anti"),
            *first_of_id(),
        )
        # Few and well-sized files per month: Spark splits big months, joins small
        # ones.  Done before embedding, while rows are still narrow.
        month = fresh.withColumn("_month", folder_month(F.col("date_str"))).hint("rebalance", "_month")
        rows = vec_row_shape(embed_records(month, embedder))
        written = Observation("embedded")
        table.append(rows.observe(written, F.count(F.lit(1)).alias("n")), fresh.select("gkg_record_id", rank_of().alias("rank")))
    remove_path(spark, path)
    remove_path(spark, copy)
    return {"records_embedded": written.get["n"], "records_skipped": skipped}


def embed(
    spark: SparkSession,
    paths: FeedPaths,
    embedder: Embedder,
    date_from: str | None = None,
    date_to: str | None = None,
    max_files: int | None = None,
) -> dict:
    """Embed the records of completed files.  ``max_files`` counts files that no run has embedded in
    their present state, oldest first."""
    state = mf.ManifestLog(spark, paths.manifest).state()
    state = state.where(completed_between(date_from, date_to) & F.col("date_partition").isNotNull())
    if max_files and path_exists(spark, paths.embedded):
        done = spark.read.schema("file_url string, updated_at timestamp_ntz").parquet(paths.embedded)
        state = state.join(done, ["file_url", "updated_at"], "left_anti")
    chosen = mf.files_by_status(state, "completed", max_files).select(
        "date_partition", urls.url_filename(F.col("file_url")).alias("source_file"), "file_url", "updated_at")
    path = scratch_path(spark, "embed-plan")
    chosen.write.parquet(path)
    plan = spark.read.schema(
        "date_partition string, source_file string, file_url string, updated_at timestamp_ntz"
    ).parquet(path)
    files = plan.select("date_partition", "source_file")
    table = VectorTable(spark, paths.vectors, embedder.dimensions)
    counts = embed_incremental(records_to_embed(spark, paths, files), table, embedder)
    counts["files_embedded"] = files.count()
    plan.select("file_url", "updated_at").write.mode("append").parquet(paths.embedded)
    remove_path(spark, path)
    return counts


# ---------------------------------------------------------------- the run


def run(
    spark: SparkSession,
    paths: FeedPaths,
    mode: str,
    now: datetime,
    embedder: Embedder,
    date_from: str | None = None,
    date_to: str | None = None,
    days: int = DEFAULT_DAYS,
    limit: int | None = None,
    source: str = "gkg",
) -> DataFrame:
    """All steps; returns and stores one row of run statistics."""
    first, last = date_range(mode, now, date_from, date_to, days)
    stats: dict = {"run_started_at": now, "mode": mode, "date_from": first, "date_to": last}
    if mode != "embed_only":
        stats.update(sync(spark, paths, now, source, "gkg", first, last))
        stats.update(fetch(spark, paths, now, limit))
        stats.update(parse_to_completed(spark, paths, now, limit))
    stats.update(embed(spark, paths, embedder, first, last, limit))
    table = VectorTable(spark, paths.vectors, embedder.dimensions)
    final = vec_stats(table.read(), paths.vectors).first()
    stats.update({k: final[k] for k in ("total_records", "min_date", "max_date")})
    stats["run_ended_at"] = datetime.now(timezone.utc).replace(tzinfo=None)  # UTC, as the start
    row = spark.createDataFrame([tuple(stats.get(f.name) for f in RUN_STATS.fields)], RUN_STATS)
    row.write.mode("append").parquet(paths.runs)
    return row
