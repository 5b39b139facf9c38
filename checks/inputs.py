"""Domain tables built from the driver tables.

The recipes are plain SQL that Spark and DuckDB read alike, so a query and its
SQL twin start from the same rows.  They are data, not operators: every row of
the driver table gives a row, with some rows malformed on purpose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.schemas import EVENT_LOG, VECTOR_STORED
from tidewire.session import scratch_path

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
VECTOR_WIDTH = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _two(expr: str) -> str:
    return f"lpad(CAST({expr} AS string), 2, '0')"


def spread(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table dealt over the tasks as a real feed would be: it may be one row group.

    Dealt by a hash of its rows, before anything wider is derived from them; dealing rows out in
    turn would sort them first.
    """
    t = table(spark, sf, name)
    return t.repartition(*t.columns)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, spread over the tasks."""
    return spread(spark, sf, "documents")


# ---------------------------------------------------------------- record lines

_ID = (
    "CASE WHEN doc_id % 41 = 7 THEN '  ' WHEN doc_id % 13 = 5 "
    "THEN 'R' || CAST(doc_id - 1 AS string) ELSE ' R' || CAST(doc_id AS string) || ' ' END"
)
_DATE = (
    "CASE WHEN doc_id % 17 = 3 THEN '2024' WHEN doc_id % 17 = 5 THEN '20240230000000' "
    f"WHEN doc_id % 17 = 6 THEN '2024' || {_two('1 + doc_id % 12')} || '07' "
    f"ELSE '2024' || {_two('1 + doc_id % 12')} || {_two('1 + doc_id % 28')} "
    f"|| {_two('doc_id % 24')} || {_two('doc_id % 60')} || '3015' END"
)
_COLLECTION = (
    "CASE WHEN doc_id % 19 = 2 THEN 'x' WHEN doc_id % 19 = 3 THEN '1.5' "
    "WHEN doc_id % 19 = 4 THEN ' 12 ' WHEN doc_id % 19 = 6 THEN '1_0' "
    "ELSE CAST(doc_id % 5 AS string) END"
)
_DOCUMENT = (
    "CASE WHEN doc_id % 43 = 9 THEN '' "
    "ELSE 'http://news.example/' || lang || '/' || CAST(doc_id AS string) END"
)
_BODY = "translate(text, chr(9) || chr(10) || chr(13), '   ')"
_THEMES = f"replace({_BODY}, ' ', ';')"
_LOCATIONS = (
    "CAST(1 + doc_id % 4 AS string) || '#City ' || CAST(doc_id % 50 AS string) || ', ' || lang "
    "|| '#' || upper(lang) || '#A1##' || CAST(doc_id % 180 - 90 AS string) || '.25#' "
    "|| CAST((doc_id * 7) % 360 - 180 AS string) || '.5#F' || CAST(doc_id AS string) || '#' "
    "|| CAST(n_chars AS string) || ';' "
    "|| CASE WHEN doc_id % 11 = 4 THEN '4#Nowhere#XX###abc#1' "
    "ELSE '4##C' || CAST(doc_id % 7 AS string) END || '; ;' "
    "|| CASE WHEN doc_id % 23 = 1 THEN '1.0#Bad#XX' "
    "ELSE ' #Land ' || CAST(doc_id % 9 AS string) || '#L' || CAST(doc_id % 9 AS string) || ' ' END"
)
_PERSONS = (
    "source || ' Person; Person ' || CAST(doc_id % 30 AS string) || ' ; ;' "
    "|| CASE WHEN doc_id % 2 = 0 THEN 'A;B;C;D;E;F;G;H;I;J;K' ELSE lang END"
)
_ORGANIZATIONS = (
    "CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Org ' || CAST(doc_id % 25 AS string) || ';Org ' "
    "|| CAST(doc_id % 4 AS string) END"
)
_TONE = (
    "CASE WHEN doc_id % 29 = 8 THEN '1.5,2,,x' WHEN doc_id % 29 = 9 THEN '' "
    "WHEN doc_id % 29 = 10 THEN '1,2,3,4,5,6,inf' WHEN doc_id % 29 = 11 THEN '1,2,3,4,5,6,nan' "
    "WHEN doc_id % 29 = 12 THEN '1.5f,2' "
    "ELSE CAST(n_chars % 131 - 65 AS string) || 'e-1,2,3.5,' || CAST(doc_id % 10 AS string) "
    "|| ',1e1,.5,' || CAST(n_chars AS string) END"
)

_COLUMNS = {
    0: _ID, 1: _DATE, 2: _COLLECTION, 3: "' ' || source || ' '", 4: _DOCUMENT, 7: _THEMES,
    10: _LOCATIONS, 11: _PERSONS, 13: _ORGANIZATIONS, 15: _TONE, 22: _BODY,
}


def _line(last: int) -> str:
    return " || chr(9) || ".join(f"({_COLUMNS.get(i, chr(39) * 2)})" for i in range(last))


LINES = f"""
SELECT doc_id AS line_number,
  CASE WHEN doc_id % 3 = 0 THEN '20240315-main.gkg.csv'
       ELSE '2024' || {_two('1 + doc_id % 12')} || '15-' || source || '.gkg.csv' END AS source_file,
  CASE WHEN doc_id % 37 = 5 THEN '  ' || chr(9) || chr(9) || ' '
       WHEN doc_id % 31 = 2 THEN 'short' || chr(9) || {_BODY}
       WHEN doc_id % 47 = 6 THEN {_line(27)} || chr(9) || 'more' || chr(9) || 'fields'
       WHEN doc_id % 53 = 4 THEN {_line(5)}
       ELSE {_line(27)} END AS value
FROM {{documents}}
"""

# ---------------------------------------------------------------- file list

_NAME = (
    f"'2024' || {_two('1 + page_id % 12')} || {_two('1 + page_id % 28')} "
    "|| lpad(CAST(page_id - CASE WHEN page_id % 19 = 2 THEN 84 ELSE 0 END AS string), 6, '0') "
    "|| CASE WHEN page_id % 7 = 3 THEN '.export.CSV.zip' WHEN page_id % 7 = 4 "
    "THEN '.Mentions.CSV.zip?v=1#top' ELSE '.gkg.csv.zip' END"
)
_FILE_URL = (
    "'http://feed.example/gkg/' || CASE WHEN page_id % 17 = 5 "
    f"THEN 'readme-' || CAST(page_id AS string) || '.txt' ELSE {_NAME} END"
)
_SIZE = "CAST(1000 + length(html) AS string)"

FILE_LINES = f"""
SELECT page_id,
  CASE WHEN page_id % 13 = 4 THEN 'x ' || md5(url) || ' ' || {_FILE_URL}
       WHEN page_id % 13 = 5 THEN {_SIZE} || ' ' || md5(url)
       WHEN page_id % 13 = 6 THEN {_SIZE} || ' ' || md5(url) || ' ' || {_FILE_URL} || ' more'
       WHEN page_id % 13 = 7 THEN '  '
       WHEN page_id % 13 = 8 THEN '  ' || {_SIZE} || chr(9) || md5(url) || '   ' || {_FILE_URL} || ' '
       ELSE {_SIZE} || ' ' || md5(url) || ' ' || {_FILE_URL} END AS value
FROM {{pages}}
"""

# ---------------------------------------------------------------- event log

_USER_URL = "'http://feed.example/f' || CAST(user_id AS string) || '.gkg.csv.zip'"

EVENTS = f"""
SELECT {_USER_URL} AS file_url,
  CASE event_type WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'touch' ELSE 'reset' END
    WHEN 'click' THEN 'claim' ELSE 'status' END AS kind,
  CASE event_type WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'pending' END
    WHEN 'click' THEN 'downloading' WHEN 'signup' THEN 'downloaded'
    WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS status,
  CASE WHEN event_type = 'purchase' AND event_id % 4 <> 0
    THEN CAST(floor(value * 10) AS BIGINT) END AS record_count,
  CASE WHEN event_type = 'signup' THEN 1000 + event_id END AS file_size_bytes,
  CASE WHEN event_type = 'signup' AND event_id % 3 = 0
    THEN md5(CAST(event_id AS string)) END AS checksum_md5,
  CAST(NULL AS string) AS date_partition,
  CASE WHEN event_type = 'error' AND event_id % 5 <> 0
    THEN 'error ' || CAST(event_id AS string) END AS error_message,
  CAST(ts AS {{timestamp}}) AS event_ts, event_id + 1 AS seq
FROM {{events}}
UNION ALL
SELECT {_USER_URL}, 'discovered', 'pending', CAST(NULL AS BIGINT), 500 + user_id,
  md5(CAST(user_id AS string)),
  CASE WHEN user_id % 9 = 4 THEN NULL ELSE '202401' || {_two('1 + user_id % 28')} END,
  CAST(NULL AS string), CAST('2023-12-31 00:00:00' AS {{timestamp}}), CAST(0 AS BIGINT)
FROM (SELECT DISTINCT user_id FROM {{events}}) AS u
"""

# ---------------------------------------------------------------- vector table

VECTORS = f"""
SELECT gkg_record_id, date, date AS timestamp, themes, persons, organizations, locations,
  countries, tone, source, source_url, text_hash, vector,
  CASE WHEN length(date) >= 6 THEN substr(date, 1, 6) ELSE 'unknown' END AS year_month
FROM (
  SELECT 'R' || CAST(e.vec_id AS string) AS gkg_record_id,
    CASE WHEN e.vec_id % 29 = 3 THEN '' WHEN e.vec_id % 29 = 4 THEN '2024'
      ELSE '2024' || {_two('1 + e.vec_id % 12')} || {_two('1 + e.vec_id % 28')} END AS date,
    split('LABEL_' || CAST(e.label AS string) || ';TOPIC_' || CAST(e.vec_id % 7 AS string)
      || ';' || upper(coalesce(d.lang, 'xx')), ';') AS themes,
    split('Person ' || CAST(e.vec_id % 30 AS string) || ';Person ' || CAST(e.vec_id % 11 AS string), ';')
      AS persons,
    split('Org ' || CAST(e.vec_id % 25 AS string), ';') AS organizations,
    split('City ' || CAST(e.vec_id % 50 AS string), ';') AS locations,
    split(n.n_name || ';C' || CAST(e.label AS string), ';') AS countries,
    CAST(e.vec_id % 21 - 10 AS FLOAT) AS tone,
    coalesce(d.source, '') AS source,
    'http://news.example/' || CAST(e.vec_id AS string) AS source_url,
    md5(coalesce(d.text, '')) AS text_hash,
    e.embedding AS vector
  FROM {{embeddings}} e LEFT JOIN {{documents}} d ON e.vec_id = d.doc_id
  LEFT JOIN {{nation}} n ON n.n_nationkey = e.vec_id % 25
) AS v
"""

# ---------------------------------------------------------------- requests

REQUESTS = """
SELECT CAST(item_id AS string) AS qid,
  CASE WHEN item_id % 11 = 3 THEN 'ab' WHEN item_id % 10 = 7 THEN 'sanctions on trade' ELSE text END
    AS query,
  CAST(CASE WHEN item_id % 11 = 4 THEN 0 WHEN item_id % 11 = 5 THEN 101
    ELSE 1 + item_id % 10 END AS INT) AS limit_n,
  CASE WHEN item_id % 11 = 6 THEN '2024-01-01' WHEN item_id % 3 = 1 THEN '20240301' END AS date_from,
  CASE WHEN item_id % 11 = 7 THEN '2024123' WHEN item_id % 3 = 2 THEN '20240915' END AS date_to,
  CASE WHEN item_id % 4 = 1 THEN split('C1;C3;NATION_2', ';') END AS countries,
  CASE WHEN item_id % 5 = 2 THEN split('label_1;3 topic_', ';') END AS themes
FROM {benchmark}
"""


def _spark(spark: SparkSession, sf: str, sql: str, *names: str, **tables: DataFrame) -> DataFrame:
    return spark.sql(
        sql.replace("{timestamp}", "TIMESTAMP_NTZ"), **{n: table(spark, sf, n) for n in names}, **tables
    )


def duck(sql: str) -> str:
    """The recipe as DuckDB reads it."""
    out = sql.replace("{timestamp}", "TIMESTAMP")
    for name in DRIVER_TABLES:
        out = out.replace("{" + name + "}", name)
    return out


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _stored(
    spark: SparkSession, sf: str, name: str, rows: Callable[[], DataFrame], by: list[str]
) -> str:
    """Path of a derived table, written once per session to the shared folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _WRITTEN:
        path = scratch_path(spark, f"input-{name}")
        rows().write.partitionBy(*by).parquet(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def lines(spark: SparkSession, sf: str) -> DataFrame:
    path = _stored(spark, sf, "lines", lambda: _spark(spark, sf, LINES, documents=documents(spark, sf)), [])
    return spark.read.schema("line_number bigint, source_file string, value string").parquet(path)


def fresh_lines(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`lines` for a reader that takes them once: made from the documents, no copy is stored."""
    return _spark(spark, sf, LINES, documents=documents(spark, sf))


def source_files(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct source files of :func:`lines`; no text is read."""
    return _spark(spark, sf, LINES, documents=table(spark, sf, "documents")).select("source_file").distinct()


def file_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _spark(spark, sf, FILE_LINES, "pages")


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    path = _stored(spark, sf, "events", lambda: _spark(spark, sf, EVENTS, events=spread(spark, sf, "events")), [])
    return spark.read.schema(EVENT_LOG).parquet(path)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vector table in its stored layout, a folder per month."""

    def rows() -> DataFrame:
        embeddings = spread(spark, sf, "embeddings")
        # only documents with an embedding meet the join, which would sort whole texts
        ids = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
        met = table(spark, sf, "documents").join(ids, "doc_id", "left_semi")
        return _spark(spark, sf, VECTORS, "nation", embeddings=embeddings, documents=met)

    path = _stored(
        spark,
        sf,
        "vectors",
        rows,
        ["year_month"],
    )
    return spark.read.schema(VECTOR_STORED).parquet(path)


def vectors_table(spark: SparkSession, sf: str):
    """The vector table of :func:`vectors` as a table, with its stored codes."""
    from tidewire.sources.vectors import VectorTable

    vectors(spark, sf)
    return VectorTable(spark, _WRITTEN[(spark.sparkContext.applicationId, sf, "vectors")], VECTOR_WIDTH)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return _spark(spark, sf, REQUESTS, "benchmark").withColumnRenamed("limit_n", "limit")


def _means(column: str = "embedding", base: int = 0) -> str:
    return ", ".join(f"avg({column}[{i + base}])" for i in range(VECTOR_WIDTH))


def label_centers(spark: SparkSession, sf: str) -> DataFrame:
    """One request vector per label: the mean of the label's embeddings."""
    return (
        table(spark, sf, "embeddings")
        .groupBy("label")
        .agg(F.array(*[F.avg(F.col("embedding")[i]) for i in range(VECTOR_WIDTH)]).alias("vector"))
        .select(F.concat(F.lit("L"), F.col("label").cast("string")).alias("qid"), "vector")
    )


LABEL_CENTERS = f"""
SELECT 'L' || CAST(label AS string) AS qid, [{_means(base=1)}] AS vector
FROM embeddings GROUP BY label
"""


def center(spark: SparkSession, sf: str) -> list[float]:
    """Mean of all embeddings: one row, computed by Spark."""
    row = (
        table(spark, sf, "embeddings")
        .agg(F.array(*[F.avg(F.col("embedding")[i]) for i in range(VECTOR_WIDTH)]).alias("v"))
        .first()
    )
    return row["v"]


CENTER = f"SELECT [{_means(base=1)}] AS vector FROM embeddings"
