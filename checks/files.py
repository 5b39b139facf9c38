"""File lists and the file-state log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.operators import manifest as mf
from tidewire.session import scratch_path
from tidewire.sources import filelist

from . import inputs
from .records import INT, strip
from .registry import query

NOW = datetime(2024, 1, 31, 0, 0, 0)
DUCK_NOW = "TIMESTAMP '2024-01-31 00:00:00'"
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TIME = "'%Y-%m-%d %H:%M:%S.%f'"

FILES = f"""
file_lines AS ({inputs.duck(inputs.FILE_LINES)}),
parts AS (SELECT list_filter(regexp_split_to_array({strip('value')}, '\\s+'), lambda x: x <> '') AS p FROM file_lines),
named AS (SELECT p[3] AS file_url, CAST(p[1] AS BIGINT) AS file_size_bytes, p[2] AS checksum_md5,
    string_split(regexp_replace(p[3], '[?#].*$', ''), '/')[-1] AS name
  FROM parts WHERE len(p) = 3 AND regexp_full_match(p[1], {INT})),
files AS (SELECT file_url, file_size_bytes, checksum_md5,
    nullif(regexp_extract(name, '[0-9]{{8}}'), '') AS date_partition,
    CASE WHEN contains(lower(name), '.gkg.') THEN 'gkg' WHEN contains(lower(name), '.export.') THEN 'export'
      WHEN contains(lower(name), '.mentions.') THEN 'mentions' END AS file_type, name
  FROM named)"""
FILE_COLUMNS = "file_url, file_size_bytes, checksum_md5, date_partition, file_type"


def files(spark, sf):
    return filelist.parse_file_info(inputs.file_lines(spark, sf))


@query("parse_file_info", f"WITH {FILES} SELECT {FILE_COLUMNS} FROM files")
def parse_file_info(spark, sf):
    return files(spark, sf)


@query(
    "src_file_list",
    f"WITH {FILES} SELECT {FILE_COLUMNS} FROM files WHERE file_type = 'gkg' AND "
    "(date_partition IS NULL OR date_partition BETWEEN '20240301' AND '20240930')",
)
def src_file_list(spark, sf):
    landing = scratch_path(spark, "landing")
    inputs.file_lines(spark, sf).select("value").write.text(filelist.list_path(landing, "gkg_v2"))
    return filelist.read_file_list(spark, landing, "gkg_v2", "gkg", "20240301", "20240930")


PAGE_NAME = (
    "string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '/')[-1]"
)


@query("url_filename", f"SELECT page_id, url, {PAGE_NAME} AS filename FROM pages")
def url_filename(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return pages.select("page_id", "url", urls.url_filename(F.col("url")).alias("filename"))


@query(
    "date_partition",
    f"WITH {FILES} SELECT name, nullif(regexp_extract(name, '[0-9]{{8}}'), '') AS date_partition FROM named",
)
def date_partition(spark, sf):
    name = files(spark, sf).select(urls.url_filename(F.col("file_url")).alias("name"))
    return name.withColumn("date_partition", urls.date_partition(F.col("name")))


@query("file_type", f"WITH {FILES} SELECT name, file_type FROM files")
def file_type(spark, sf):
    name = files(spark, sf).select(urls.url_filename(F.col("file_url")).alias("name"))
    return name.withColumn("file_type", urls.file_type(F.col("name")))


@query("filter_file_type", f"WITH {FILES} SELECT {FILE_COLUMNS} FROM files WHERE file_type = 'export'")
def filter_file_type(spark, sf):
    return filelist.filter_file_list(files(spark, sf), "export")


@query(
    "filter_list_dates",
    f"WITH {FILES} SELECT {FILE_COLUMNS} FROM files WHERE date_partition IS NULL "
    "OR (date_partition >= '20240410' AND date_partition <= '20240820')",
)
def filter_list_dates(spark, sf):
    return filelist.filter_file_list(files(spark, sf), None, "20240410", "20240820")


# ---------------------------------------------------------------- log -> state

# Replays the log row by row: a window looks up the status just before a touch.
STATE = f"""
events_log AS ({inputs.duck(inputs.EVENTS)}),
walked AS (SELECT *, last_value(status IGNORE NULLS) OVER (PARTITION BY file_url ORDER BY event_ts, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events_log),
state AS (SELECT file_url,
    arg_max(status, (event_ts, seq)) FILTER (WHERE status IS NOT NULL) AS status,
    arg_max(record_count, (event_ts, seq)) FILTER (WHERE record_count IS NOT NULL) AS record_count,
    arg_max(file_size_bytes, (event_ts, seq)) FILTER (WHERE file_size_bytes IS NOT NULL) AS file_size_bytes,
    max(date_partition) AS date_partition,
    arg_max(checksum_md5, (event_ts, seq)) FILTER (WHERE checksum_md5 IS NOT NULL) AS checksum_md5,
    list_last(list(error_message ORDER BY event_ts, seq) FILTER (WHERE kind = 'status')) AS error_message,
    CAST(count(*) FILTER (WHERE kind = 'status' AND status = 'failed') AS INTEGER) AS retry_count,
    min(event_ts) AS created_at,
    max(event_ts) FILTER (WHERE kind <> 'touch' OR before = 'pending') AS updated_at
  FROM walked GROUP BY file_url)""".replace("list_last(", "list_extract(").replace(
    "FILTER (WHERE kind = 'status')) AS error_message",
    "FILTER (WHERE kind = 'status'), -1) AS error_message",
)
STATE_COLUMNS = (
    "file_url, status, record_count, file_size_bytes, date_partition, checksum_md5, error_message, "
    f"retry_count, strftime(created_at, {DUCK_TIME}) AS created_at, "
    f"strftime(updated_at, {DUCK_TIME}) AS updated_at"
)


def state(spark, sf):
    return mf.fold_state(inputs.event_log(spark, sf))


def shown(df):
    return df.withColumns({c: F.date_format(c, TIME) for c in ("created_at", "updated_at")})


@query("update_status", f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state")
def update_status(spark, sf):
    """State after all changes of the log."""
    return shown(state(spark, sf))


LATER = """known AS (SELECT file_url FROM state),
listed AS (SELECT 'http://feed.example/f' || CAST(c_custkey AS VARCHAR) || '.gkg.csv.zip' AS file_url,
  '202402' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') AS date_partition,
  CAST(round(c_acctbal) AS BIGINT) AS file_size_bytes FROM customer
  UNION ALL SELECT 'http://feed.example/f' || CAST(c_custkey AS VARCHAR) || '.gkg.csv.zip', '20240229', 0
  FROM customer WHERE c_nationkey < 5)"""


def listed(spark, sf):
    """A list of files in which some are tracked already and some come twice."""
    c = inputs.table(spark, sf, "customer")
    url = F.concat(F.lit("http://feed.example/f"), F.col("c_custkey").cast("string"), F.lit(".gkg.csv.zip"))
    day = F.concat(F.lit("202402"), F.lpad((1 + F.col("c_custkey") % 28).cast("string"), 2, "0"))
    once = c.select(
        url.alias("file_url"),
        day.alias("date_partition"),
        F.round("c_acctbal").cast("bigint").alias("file_size_bytes"),
        F.lit(None).cast("string").alias("checksum_md5"),
    )
    again = c.where("c_nationkey < 5").select(
        url.alias("file_url"),
        F.lit("20240229").alias("date_partition"),
        F.lit(0).cast("bigint").alias("file_size_bytes"),
        F.lit(None).cast("string").alias("checksum_md5"),
    )
    return once.unionByName(again)


@query(
    "insert_ignore",
    f"""WITH {STATE}, {LATER} SELECT file_url, 'discovered' AS kind, 'pending' AS status,
      arg_min(date_partition, (date_partition, file_size_bytes)) AS date_partition,
      arg_min(file_size_bytes, (date_partition, file_size_bytes)) AS file_size_bytes
    FROM listed WHERE file_url NOT IN (SELECT file_url FROM known) GROUP BY file_url""",
)
def insert_ignore(spark, sf):
    new = mf.insert_ignore(listed(spark, sf), state(spark, sf), NOW, seq=1)
    return new.select("file_url", "kind", "status", "date_partition", "file_size_bytes")


@query(
    "upsert_file",
    f"""WITH {STATE}, {LATER}, upserted AS (
      SELECT file_url, status, file_size_bytes, CASE WHEN status = 'pending' AND file_url IN
        (SELECT file_url FROM listed) THEN {DUCK_NOW} ELSE updated_at END AS updated_at FROM state
      UNION ALL SELECT file_url, 'pending', arg_min(file_size_bytes, (date_partition, file_size_bytes)), {DUCK_NOW}
      FROM listed WHERE file_url NOT IN (SELECT file_url FROM known) GROUP BY file_url)
    SELECT file_url, status, file_size_bytes, strftime(updated_at, {DUCK_TIME}) AS updated_at FROM upserted""",
)
def upsert_file(spark, sf):
    log = inputs.event_log(spark, sf)
    more = mf.upsert_file(listed(spark, sf), mf.fold_state(log), NOW, seq=1_000_000)
    return shown(mf.fold_state(log.unionByName(more))).select(
        "file_url", "status", "file_size_bytes", "updated_at"
    )


@query(
    "sync_stats",
    f"""WITH {STATE}, {LATER} SELECT count(*) AS total_scanned,
      count(DISTINCT file_url) FILTER (WHERE file_url NOT IN (SELECT file_url FROM known)) AS new_inserted,
      count(*) - count(DISTINCT file_url) FILTER (WHERE file_url NOT IN (SELECT file_url FROM known))
        AS already_tracked FROM listed""",
)
def sync_stats(spark, sf):
    return mf.sync_stats(listed(spark, sf), state(spark, sf))


# ---------------------------------------------------------------- reads


@query(
    "get_file",
    f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state WHERE file_url = 'http://feed.example/f8.gkg.csv.zip'",
)
def get_file(spark, sf):
    return shown(mf.get_file(state(spark, sf), "http://feed.example/f8.gkg.csv.zip"))


@query(
    "files_by_status",
    f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state WHERE status = 'completed' "
    "ORDER BY date_partition NULLS FIRST, created_at, file_url LIMIT 100",
)
def files_by_status(spark, sf):
    return shown(mf.files_by_status(state(spark, sf), "completed", limit=100))


@query(
    "retryable_files",
    f"WITH {STATE} SELECT {STATE_COLUMNS} FROM state WHERE status = 'failed' AND retry_count < 20 "
    "ORDER BY updated_at, file_url LIMIT 100",
)
def retryable_files(spark, sf):
    return shown(mf.retryable_files(state(spark, sf), limit=100, max_retries=20))


@query(
    "next_pending",
    f"""WITH {STATE}, due AS (SELECT * FROM state WHERE status = 'pending'
      ORDER BY date_partition NULLS FIRST, created_at, file_url LIMIT 10)
    SELECT {STATE_COLUMNS.replace('file_url, status', "file_url, 'downloading' AS status").replace('strftime(updated_at', f'strftime({DUCK_NOW}')} FROM due""",
)
def next_pending(spark, sf):
    return shown(mf.next_pending(state(spark, sf), NOW, 10))


@query(
    "reset_stale",
    f"""WITH {STATE} SELECT file_url, CASE WHEN status = 'downloading' AND updated_at < {DUCK_NOW} - INTERVAL 30 MINUTE
      THEN 'pending' ELSE status END AS status,
      strftime(CASE WHEN status = 'downloading' AND updated_at < {DUCK_NOW} - INTERVAL 30 MINUTE
      THEN {DUCK_NOW} ELSE updated_at END, {DUCK_TIME}) AS updated_at FROM state""",
)
def reset_stale(spark, sf):
    log = inputs.event_log(spark, sf)
    more = mf.reset_stale(mf.fold_state(log), NOW, seq=1_000_000)
    return shown(mf.fold_state(log.unionByName(more))).select("file_url", "status", "updated_at")


# ---------------------------------------------------------------- statistics


@query(
    "manifest_stats",
    f"""WITH {STATE} SELECT status, count(*) AS count, CAST(coalesce(sum(record_count), 0) AS BIGINT) AS records,
    CAST(coalesce(sum(file_size_bytes), 0) AS BIGINT) AS bytes FROM state GROUP BY status""",
)
def manifest_stats(spark, sf):
    return mf.manifest_stats(state(spark, sf))


@query(
    "manifest_totals",
    f"""WITH {STATE} SELECT count(*) AS total_files, CAST(coalesce(sum(record_count), 0) AS BIGINT) AS total_records,
    CAST(coalesce(sum(file_size_bytes), 0) AS BIGINT) AS total_bytes FROM state""",
)
def manifest_totals(spark, sf):
    return mf.manifest_totals(state(spark, sf))


@query(
    "manifest_date_range",
    f"WITH {STATE} SELECT min(date_partition) AS min_date, max(date_partition) AS max_date FROM state",
)
def manifest_date_range(spark, sf):
    return mf.manifest_date_range(state(spark, sf))


@query(
    "date_coverage",
    f"""WITH {STATE} SELECT date_partition, CAST(sum(record_count) AS BIGINT) AS records FROM state
    WHERE date_partition IS NOT NULL AND record_count IS NOT NULL GROUP BY date_partition""",
)
def date_coverage(spark, sf):
    return mf.date_coverage(state(spark, sf))


@query(
    "filter_completed_dates",
    f"WITH {STATE} SELECT file_url, date_partition FROM state WHERE status = 'completed' "
    "AND date_partition >= '20240105' AND date_partition <= '20240120'",
)
def filter_completed_dates(spark, sf):
    from tidewire.plans.feed_run import completed_between

    done = state(spark, sf).where(F.col("status") == "completed")
    return done.where(completed_between("20240105", "20240120")).select("file_url", "date_partition")
