"""Archives, streams and whole runs."""

from __future__ import annotations

import io
import re
import zipfile
from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from tidewire.plans import feed_run
from tidewire.schemas import PARSED_STORED
from tidewire.session import hadoop_path, remove_path, scratch_path, shuffles_dropped
from tidewire.sources import archive, filelist
from tidewire.sources.tables import partition_path
from tidewire.sources.vectors import VectorTable
from tidewire.streaming import feed

from . import inputs
from .records import BY_ID_SQL, PARSED_SQL, RECORDS, _text_folder, by_id, parsed_columns, records
from .registry import query
from .vectors import HASHING, TEXTS, VT, WIDTH

# ---------------------------------------------------------------- archives

ARCHIVE = """archives AS (SELECT doc_id, text, '2024' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '01-'
    || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 23 = 0 THEN '.gkg.csv' ELSE '.gkg.csv.zip' END AS source_file,
    CASE WHEN doc_id % 23 = 0 THEN 'plain' WHEN doc_id % 29 = 1 THEN 'empty' WHEN doc_id % 31 = 2 THEN 'broken'
      ELSE 'zip' END AS form FROM documents)"""


def archives(spark, sf):
    """Every document as a landed file: zipped, plain, without entry or damaged."""
    docs = inputs.documents(spark, sf)
    kind = (
        F.when(F.col("doc_id") % 23 == 0, "plain")
        .when(F.col("doc_id") % 29 == 1, "empty")
        .when(F.col("doc_id") % 31 == 2, "broken")
        .otherwise("zip")
    )
    day = F.concat(F.lit("2024"), F.lpad((1 + F.col("doc_id") % 12).cast("string"), 2, "0"), F.lit("01-"))
    suffix = F.when(F.col("doc_id") % 23 == 0, ".gkg.csv").otherwise(".gkg.csv.zip")

    def pack(text, form):
        if form == "plain":
            return text.encode()
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            if form != "empty":
                z.writestr(zipfile.ZipInfo("lines.csv"), text)
                z.writestr(zipfile.ZipInfo("other.csv"), "not read")
        return buffer.getvalue()[: 20 if form == "broken" else None]

    def run(batches):
        for b in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            content = [pack(t, f) for t, f in zip(b["text"].to_pylist(), b["form"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["source_file"], pa.array(content, pa.binary())], names=["source_file", "content"])

    named = docs.select(
        F.concat(day, F.col("doc_id").cast("string"), suffix).alias("source_file"),
        "text",
        kind.alias("form"),
    )
    packed = named.mapInArrow(run, "source_file string, content binary")
    return packed.withColumn("actual_md5", F.md5("content"))


@query(
    "src_archive",
    f"""WITH {ARCHIVE}, body AS (SELECT source_file, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS l
      FROM archives WHERE form IN ('zip', 'plain') AND length(text) > 0)
    SELECT source_file, CAST(i AS BIGINT) AS line_number, l[i] AS value, FALSE AS failed
    FROM (SELECT source_file, l, unnest(range(1, len(l) + 1)) AS i FROM body) AS x
    UNION ALL SELECT source_file, 0, NULL, form IN ('empty', 'broken') FROM archives""",
)
def src_archive(spark, sf):
    return archive.archive_lines(archives(spark, sf)).select(
        "source_file", "line_number", "value", F.col("error").isNotNull().alias("failed")
    )


@query(
    "checksum_join",
    f"""WITH {ARCHIVE} SELECT 'http://feed.example/' || source_file AS file_url,
      CASE WHEN form IN ('empty', 'broken') OR doc_id % 10 = 7 THEN 'failed' ELSE 'downloaded' END AS status
    FROM archives""",
)
def checksum_join(spark, sf):
    """Every tenth file is listed with a wrong checksum, every third with none."""
    unpacked = archive.archive_heads(archives(spark, sf))
    number = F.regexp_extract("source_file", r"-([0-9]+)\.", 1).cast("bigint")
    files = archives(spark, sf).select(
        F.concat(F.lit("http://feed.example/"), "source_file").alias("file_url"),
        F.when(number % 10 == 7, F.lit("0" * 32))
        .when(number % 3 == 0, F.lit(None))
        .otherwise(F.col("actual_md5"))
        .alias("checksum_md5"),
    )
    return archive.checksum_join(unpacked, files).select("file_url", "status")


# ---------------------------------------------------------------- streams


@query("src_record_stream", f"WITH {RECORDS} {BY_ID_SQL}")
def src_record_stream(spark, sf):
    out, mark = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-mark")
    arriving = feed.stream_records(spark, _text_folder(spark, sf), max_files=16)
    run = (
        arriving.drop("raw")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", mark)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return by_id(spark.read.schema(arriving.drop("raw").schema).parquet(out))


def _ingest(spark, sf):
    out = scratch_path(spark, "stream-parsed")
    feed.stream_ingest(
        spark, _text_folder(spark, sf), out, scratch_path(spark, "stream-mark"), max_files=16
    ).awaitTermination()
    return out


@query("stream_ingest", f"WITH {RECORDS} {PARSED_SQL} FROM recs")
def stream_ingest(spark, sf):
    return spark.read.schema(PARSED_STORED).parquet(_ingest(spark, sf)).select(*parsed_columns())


@query(
    "stream_embed",
    f"WITH {TEXTS} SELECT gkg_record_id, count(*) OVER () AS total FROM "
    "(SELECT DISTINCT gkg_record_id FROM texts WHERE length(text) > 10) AS t",
)
def stream_embed(spark, sf):
    """Two passes over the same records: the second adds nothing."""
    store = _ingest(spark, sf)
    table = VectorTable(spark, scratch_path(spark, "vectors"), WIDTH)
    for _ in range(2):
        feed.stream_embed(
            spark, store, table, HASHING, scratch_path(spark, "stream-mark"), max_files=200
        ).awaitTermination()
    found = table.scan("gkg_record_id")
    return found.withColumn("total", F.lit(found.count()).cast("bigint"))


# ---------------------------------------------------------------- whole runs

NOW = datetime(2024, 12, 31, 12, 0, 0)
_RUNS: dict[tuple[str, str], tuple[feed_run.FeedPaths, list]] = {}


def _land(spark, sf, paths):
    """The lines as landed files with dated names, one for each name, and the list of them.

    One source's files are listed with a wrong checksum.  A file has one writer, which is sent
    its lines in compressed pieces.
    """

    def pack(batches):
        for b in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            held = {}
            for value, name in zip(b["value"].to_pylist(), b["source_file"].to_pylist()):
                held.setdefault(name, []).append(value or "")
            texts = ["\n".join(lines).encode() for lines in held.values()]
            columns = [pa.array(list(held), pa.string()), pa.array(map(len, texts)), pa.array(map(archive.pack, texts))]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "n_bytes", "piece"])

    def unpack(batches):
        for b in batches:
            for n_bytes, piece in zip(b["n_bytes"].to_pylist(), b["piece"]):
                yield pa.RecordBatch.from_arrays([pa.array([archive.unpack(piece, n_bytes).decode()])], names=["value"])

    lines = inputs.fresh_lines(spark, sf).select("value", "source_file")
    names = [r["source_file"] for r in inputs.source_files(spark, sf).collect()]  # one row per file
    numbered = spark.createDataFrame(list(zip(names, range(len(names)))), "wanted string, file int")
    packed = lines.mapInArrow(pack, "name string, n_bytes bigint, piece binary")
    dealt = packed.join(F.broadcast(numbered), F.col("name").eqNullSafe(F.col("wanted")))
    written = scratch_path(spark, "landing")
    texts = dealt.repartitionById(max(1, len(names)), "file").select("n_bytes", "piece").mapInArrow(unpack, "value string")
    with shuffles_dropped(spark):
        texts.write.text(written)
    fs, root = hadoop_path(spark, written)
    fs.mkdirs(hadoop_path(spark, paths.archives)[1])
    for part in fs.listStatus(root):
        number = re.fullmatch(r"part-([0-9]{5,})-.*", part.getPath().getName())
        if number:
            name = names[int(number[1])]
            name = "__HIVE_DEFAULT_PARTITION__" if name is None else partition_path(spark, "", name=name).split("=", 1)[1]
            target = f"{paths.archives}/{name.removesuffix('.gkg.csv')}-00000.gkg.csv"
            fs.rename(part.getPath(), hadoop_path(spark, target)[1])
    remove_path(spark, written)
    landed = [(r["path"], r["length"]) for r in archive.list_landed(spark, paths.archives).collect()]
    pieces = scratch_path(spark, "landed-pieces")
    heads = archive.landed_heads(spark, landed, pieces)
    wrong = F.col("source_file").contains("-src7-")
    heads.select(
        F.concat_ws(
            " ",
            F.col("n_bytes").cast("string"),
            F.when(wrong, F.lit("0" * 32)).otherwise(F.col("actual_md5")),
            F.concat(F.lit("http://feed.example/"), F.col("source_file")),
        )
    ).write.text(filelist.list_path(paths.landing, "gkg"))
    remove_path(spark, pieces)


def _run_twice(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        paths = feed_run.FeedPaths(scratch_path(spark, "run"))
        _land(spark, sf, paths)
        stats = [
            feed_run.run(spark, paths, "backfill", NOW, HASHING, date_from="20240101")
            for _ in range(2)
        ]
        _RUNS[key] = (paths, stats)
    return _RUNS[key]


GOOD = f"{TEXTS}, good AS (SELECT * FROM texts WHERE source_file NOT LIKE '%-src7.%')"
FIRST = """firsts AS (SELECT * FROM good WHERE length(text) > 10 QUALIFY row_number() OVER (PARTITION BY gkg_record_id
  ORDER BY substr(source_file, 1, 8), source_file) = 1)"""


@query(
    "run_feed",
    f"""WITH {GOOD}, {FIRST}, r AS (SELECT count(*) AS n, min(nullif(substr(date_str, 1, 8), '')) AS min_date,
      max(nullif(substr(date_str, 1, 8), '')) AS max_date FROM firsts)
    SELECT 1 AS run, n AS records_embedded, 0 AS records_skipped, n AS total_records, min_date, max_date FROM r
    UNION ALL SELECT 2, 0, (SELECT count(*) FROM good), n, min_date, max_date FROM r""",
)
def run_feed(spark, sf):
    """Two full runs over the same landed files; the second adds nothing."""
    _, stats = _run_twice(spark, sf)
    rows = [s.withColumn("run", F.lit(i + 1)) for i, s in enumerate(stats)]
    return rows[0].unionByName(rows[1]).select(
        "run", "records_embedded", "records_skipped", "total_records", "min_date", "max_date"
    )


@query(
    "parse_to_completed",
    f"""WITH {RECORDS}, names AS (SELECT DISTINCT replace(source_file, '.gkg.csv', '') AS name FROM lines),
    counts AS (SELECT replace(source_file, '.gkg.csv', '') AS name, count(*) AS n FROM recs GROUP BY ALL)
    SELECT n.name, CASE WHEN n.name LIKE '%-src7' THEN 'failed' ELSE 'completed' END AS status,
      CASE WHEN n.name NOT LIKE '%-src7' THEN coalesce(c.n, 0) END AS records
    FROM names n LEFT JOIN counts c ON c.name = n.name""",
)
def parse_to_completed(spark, sf):
    """What the log says about the files after a run."""
    from tidewire.operators.manifest import ManifestLog

    paths, _ = _run_twice(spark, sf)
    state = ManifestLog(spark, paths.manifest).state()
    name = F.regexp_extract("file_url", r"/([^/]*)-[0-9]{5}\.gkg\.csv$", 1)
    return state.groupBy(name.alias("name"), "status").agg(F.sum("record_count").alias("records"))


RUN_COUNTERS = [
    "total_scanned", "new_inserted", "already_tracked", "files_downloaded", "download_errors", "parsed_files",
    "parse_errors", "files_embedded",
]


@query(
    "run_stats",
    f"""WITH {RECORDS}, names AS (SELECT DISTINCT source_file AS name FROM lines),
    c AS (SELECT count(*) AS n, count(*) FILTER (name LIKE '%-src7.%') AS bad FROM names),
    each AS (SELECT 1 AS run, n, n AS fresh, n - bad AS good, bad FROM c UNION ALL SELECT 2, n, 0, 0, bad FROM c)
    SELECT 'backfill' AS mode, '20240101' AS date_from, '20241231' AS date_to, n AS total_scanned,
      CAST(fresh AS BIGINT) AS new_inserted, CAST(n - fresh AS BIGINT) AS already_tracked,
      CAST(good AS BIGINT) AS files_downloaded, bad AS download_errors, CAST(good AS BIGINT) AS parsed_files,
      CAST(0 AS BIGINT) AS parse_errors, n - bad AS files_embedded FROM each""",
)
def run_stats(spark, sf):
    """The stored run rows: all files are new in the first run, in the second only failures are tried again."""
    paths, _ = _run_twice(spark, sf)
    return spark.read.parquet(paths.runs).select("mode", "date_from", "date_to", *RUN_COUNTERS)


@query(
    "embed_incremental",
    f"""WITH {VT}, {TEXTS}, fresh AS (SELECT DISTINCT gkg_record_id FROM texts WHERE length(text) > 10
      AND gkg_record_id NOT IN (SELECT gkg_record_id FROM vt))
    SELECT gkg_record_id, (SELECT count(*) FROM fresh) AS records_embedded,
      (SELECT count(*) FROM recs WHERE gkg_record_id IN (SELECT gkg_record_id FROM vt)) AS records_skipped
    FROM fresh""",
)
def embed_incremental(spark, sf):
    """The vector table holds some of the records already."""
    table = VectorTable(spark, scratch_path(spark, "vectors"), WIDTH)
    stored = inputs.vectors(spark, sf)
    table.append(stored)
    from tidewire.operators.records import project_parsed

    rows = project_parsed(records(spark, sf), "line_number", "source_file").withColumn(
        "date_partition", F.substring("source_file", 1, 8)
    )
    counts = feed_run.embed_incremental(rows, table, HASHING)
    added = table.scan("gkg_record_id").join(stored, "gkg_record_id", "left_anti")
    return added.withColumns({k: F.lit(v).cast("bigint") for k, v in counts.items()})
