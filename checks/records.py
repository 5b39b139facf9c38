"""Record lines: parsing, rejects, counts, stored forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import fields as fx
from tidewire.functions.text import trim_ws
from tidewire.operators import records as rec
from tidewire.schemas import FIELDS
from tidewire.session import scratch_path
from tidewire.sources import archive, lines as raw_lines, parsed

from . import inputs
from .registry import query

# ---------------------------------------------------------------- SQL building blocks

# the ASCII part of the white space that is stripped, enough for these inputs
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
INT = "'[+-]?[0-9]+(_[0-9]+)*'"
FLOAT = (
    "'[+-]?([0-9]+(_[0-9]+)*(\\.([0-9]+(_[0-9]+)*)?)?|\\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?"
    "|[+-]?(inf|infinity|nan)'"
)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def f(i: int) -> str:
    return f"coalesce(f[{i + 1}], '')"


def int_of(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({strip(x)}, {INT}) "
        f"THEN TRY_CAST(replace({strip(x)}, '_', '') AS BIGINT) END"
    )


def float_of(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({strip(x)}, {FLOAT}) "
        f"THEN TRY_CAST(replace({strip(x)}, '_', '') AS DOUBLE) END"
    )


def items(x: str) -> str:
    return (
        f"list_filter(list_transform(string_split({x}, ';'), lambda v: {strip('v')}), "
        "lambda v: v <> '')"
    )


def date_of(d: str) -> str:
    return (
        f"CASE WHEN length({d}) >= 14 THEN CASE WHEN regexp_full_match(substr({d}, 1, 14), '[0-9]+') "
        f"THEN try_strptime(substr({d}, 1, 14), '%Y%m%d%H%M%S') END "
        f"WHEN length({d}) >= 8 THEN CASE WHEN regexp_full_match(substr({d}, 1, 8), '[0-9]+') "
        f"THEN try_strptime(substr({d}, 1, 8), '%Y%m%d') END END"
    )


def p(i: int) -> str:
    return f"coalesce(p[{i + 1}], '')"


def fine(i: int, form: str) -> str:
    return f"({p(i)} = '' OR regexp_full_match({strip(p(i))}, {form}))"


def locations(x: str) -> str:
    pieces = f"list_transform({items(x)}, lambda v: string_split(v, '#'))"
    good = (
        f"list_filter({pieces}, lambda p: {fine(0, INT)} AND {fine(5, FLOAT)} "
        f"AND {fine(6, FLOAT)} AND {fine(8, INT)})"
    )
    return (
        f"list_transform({good}, lambda p: {{'location_type': coalesce({int_of(p(0))}, 0), "
        f"'full_name': {p(1)}, 'country_code': {p(2)}, 'adm1_code': {p(3)}, 'adm2_code': {p(4)}, "
        f"'latitude': {float_of(p(5))}, 'longitude': {float_of(p(6))}, 'feature_id': {p(7)}, "
        f"'char_offset': {int_of(p(8))}}})"
    )


# all fields of a location but its coordinates
PLACE_FIELDS = [
    "location_type", "full_name", "country_code", "adm1_code", "adm2_code", "feature_id", "char_offset",
]


def t(i: int) -> str:
    return f"coalesce(tp[{i + 1}], '')"


TONE_BAD = (
    "len(list_filter(tp[1:7], lambda v: v <> '' AND NOT regexp_full_match("
    f"{strip('v')}, {FLOAT}))) > 0"
)
NUM = [f"coalesce({float_of(t(i))}, 0.0)" for i in range(7)]
TONE_CASE = (
    f"CASE WHEN {f(15)} = '' OR {TONE_BAD} OR isnan({NUM[6]}) THEN 'zero' "
    f"WHEN isinf({NUM[6]}) THEN 'null' ELSE 'ok' END"
)
TONE_NAMES = [
    "tone", "positive_score", "negative_score", "polarity", "activity_ref_density",
    "group_ref_density",
]

PIECES = f"""
lines AS ({inputs.duck(inputs.LINES)}),
pieces AS (
  SELECT *, CASE WHEN {strip('value')} = '' THEN 'blank' WHEN len(f) < 5 THEN 'error'
    WHEN {strip(f(0))} = '' OR {strip(f(4))} = '' THEN 'skipped' ELSE 'parsed' END AS kind
  FROM (SELECT *, string_split(rtrim(value, chr(13) || chr(10)), chr(9)) AS f FROM lines) AS l
)"""

RECORDS = f"""{PIECES},
toned AS (SELECT *, string_split({f(15)}, ',') AS tp FROM pieces WHERE kind = 'parsed'),
cased AS (SELECT *, {TONE_CASE} AS tone_case FROM toned),
recs AS (
  SELECT line_number, source_file, f, {strip(f(0))} AS gkg_record_id, {strip(f(1))} AS date_str,
    {date_of(strip(f(1)))} AS date, coalesce({int_of(f(2))}, 0) AS source_collection_id,
    {strip(f(3))} AS source_common_name, {strip(f(4))} AS document_id,
    {items(f(7))} AS themes, {items(f(11))} AS persons, {items(f(13))} AS organizations,
    {locations(f(10))} AS locations, tone_case,
    {', '.join(f"CASE tone_case WHEN 'ok' THEN {NUM[i]} WHEN 'zero' THEN 0.0 END AS {n}" for i, n in enumerate(TONE_NAMES))},
    CASE tone_case WHEN 'ok' THEN CAST(trunc({NUM[6]}) AS BIGINT) WHEN 'zero' THEN 0 END AS word_count,
    CASE WHEN length({strip(f(1))}) >= 6 THEN substr({strip(f(1))}, 1, 6) END AS year_month
  FROM cased
)"""


def records(spark, sf, fields=None):
    return rec.parse_records(inputs.lines(spark, sf), fields)


def joined(name):
    return F.array_join(name, "|").alias(name)


def duck_joined(name):
    return f"array_to_string({name}, '|') AS {name}"


def loc_text():
    """Locations as one string."""
    return F.array_join(
        F.transform(
            "locations",
            lambda x: F.concat_ws(
                "~",
                x["location_type"].cast("string"),
                x["full_name"],
                x["country_code"],
                x["adm1_code"],
                x["adm2_code"],
                F.coalesce(F.round(x["latitude"] * 100).cast("bigint").cast("string"), F.lit("-")),
                F.coalesce(F.round(x["longitude"] * 100).cast("bigint").cast("string"), F.lit("-")),
                x["feature_id"],
                F.coalesce(x["char_offset"].cast("string"), F.lit("-")),
            ),
        ),
        "|",
    ).alias("locations")


DUCK_LOC_TEXT = """array_to_string(list_transform(locations, lambda x: concat_ws('~',
  CAST(x.location_type AS VARCHAR), x.full_name, x.country_code, x.adm1_code, x.adm2_code,
  coalesce(CAST(CAST(round(x.latitude * 100) AS BIGINT) AS VARCHAR), '-'),
  coalesce(CAST(CAST(round(x.longitude * 100) AS BIGINT) AS VARCHAR), '-'), x.feature_id,
  coalesce(CAST(x.char_offset AS VARCHAR), '-'))), '|') AS locations"""

TIME = "yyyy-MM-dd HH:mm:ss"
DUCK_TIME = "'%Y-%m-%d %H:%M:%S'"


def full_columns():
    return [
        "line_number",
        "source_file",
        "gkg_record_id",
        F.date_format("date", TIME).alias("date"),
        "date_str",
        "source_collection_id",
        "source_common_name",
        "document_id",
        joined("themes"),
        loc_text(),
        joined("persons"),
        joined("organizations"),
        *[F.round(f"tone.{n}", 6).alias(n) for n in TONE_NAMES],
        F.col("tone.word_count").alias("word_count"),
        joined("parse_errors"),
        F.coalesce("year_month", F.lit("unknown")).alias("year_month"),
    ]


FULL_SQL = f"""
SELECT line_number, source_file, gkg_record_id, strftime(date, {DUCK_TIME}) AS date, date_str,
  source_collection_id, source_common_name, document_id, {duck_joined('themes')}, {DUCK_LOC_TEXT},
  {duck_joined('persons')}, {duck_joined('organizations')},
  {', '.join(f'round({n}, 6) AS {n}' for n in TONE_NAMES)}, word_count,
  CASE tone_case WHEN 'null' THEN 'cannot convert float infinity to integer' ELSE '' END AS parse_errors,
  coalesce(year_month, 'unknown') AS year_month
FROM recs"""

# ---------------------------------------------------------------- whole records


@query("parse_record", f"WITH {RECORDS} {FULL_SQL}")
def parse_record(spark, sf):
    return records(spark, sf).select(*full_columns())


def _text_folder(spark, sf):
    """The lines as text files, one folder per source file; a large one has several files.

    Spark cuts large partitions and joins small ones, so no task reads a whole source file.  It cuts
    between the tasks that send lines, so these come dealt from the documents, not from stored files.
    """
    path = scratch_path(spark, "lines")
    by_file = inputs.fresh_lines(spark, sf).select("value", "source_file").hint("rebalance", "source_file")
    by_file.write.partitionBy("source_file").text(path)
    return path


BY_ID_SQL = f"""
SELECT gkg_record_id, date_str, document_id, {duck_joined('themes')}, {DUCK_LOC_TEXT},
  round(tone, 6) AS tone FROM recs"""


def by_id(df):
    return df.select(
        "gkg_record_id", "date_str", "document_id", joined("themes"), loc_text(),
        F.round("tone.tone", 6).alias("tone"),
    )


@query("src_record_text", f"WITH {RECORDS} {BY_ID_SQL}")
def src_record_text(spark, sf):
    lines = raw_lines.read_record_lines(spark, _text_folder(spark, sf))
    return by_id(rec.parse_records(lines))


@query("src_record_string", f"WITH {RECORDS} {BY_ID_SQL}")
def src_record_string(spark, sf):
    """Each line as an in-memory text of its own, with its line end."""
    texts = inputs.lines(spark, sf).select(F.concat("value", F.lit("\r\n")).alias("content"))
    return by_id(rec.parse_records(raw_lines.lines_of_text(texts)))


# ---------------------------------------------------------------- single parsers

ALL_PARSED = f"WITH {RECORDS} SELECT line_number, "


def simple(name, sql, *columns):
    def run(spark, sf):
        return records(spark, sf).select("line_number", *[c() if callable(c) else c for c in columns])

    query(name, f"{ALL_PARSED} {sql} FROM recs")(run)


simple(
    "core_fields", "gkg_record_id, date_str, source_common_name, document_id",
    "gkg_record_id", "date_str", "source_common_name", "document_id",
)
simple("collection_id", "source_collection_id", "source_collection_id")
simple(
    "parse_date", f"date_str, strftime(date, {DUCK_TIME}) AS date",
    "date_str", lambda: F.date_format("date", TIME).alias("date"),
)
simple("themes", f"{duck_joined('themes')}, len(themes) AS n",
       lambda: joined("themes"), lambda: F.size("themes").cast("bigint").alias("n"))
simple("persons", duck_joined("persons"), lambda: joined("persons"))
simple("organizations", duck_joined("organizations"), lambda: joined("organizations"))
simple("locations", DUCK_LOC_TEXT, loc_text)
simple(
    "parse_tone",
    ", ".join(f"round({n}, 6) AS {n}" for n in TONE_NAMES) + ", word_count, tone_case = 'null' AS overflow",
    *[(lambda n=n: F.round(f"tone.{n}", 6).alias(n)) for n in TONE_NAMES],
    lambda: F.col("tone.word_count").alias("word_count"),
    lambda: (F.size("parse_errors") > 0).alias("overflow"),
)
simple("year_month", "date_str, year_month", "date_str", "year_month")


@query(
    "parse_list",
    f"WITH {PIECES} SELECT line_number, array_to_string({items('value')}, '|') AS parts FROM lines",
)
def parse_list(spark, sf):
    """The list parser on whole lines."""
    return inputs.lines(spark, sf).select(
        "line_number", F.array_join(fx.parse_list(F.col("value")), "|").alias("parts")
    )


@query(
    "parse_location",
    f"""WITH {RECORDS}, single AS (SELECT line_number, unnest(string_split({f(10)}, ';')) AS v FROM recs),
    one AS (SELECT line_number, {strip('v')} AS v, {locations(strip('v'))} AS l FROM single)
    SELECT line_number, v, """
    + ", ".join(f"CASE WHEN len(l) > 0 THEN l[1].{n} END AS {n}" for n in PLACE_FIELDS)
    + ", CASE WHEN len(l) > 0 THEN round(l[1].latitude, 6) END AS latitude,"
    " CASE WHEN len(l) > 0 THEN round(l[1].longitude, 6) END AS longitude FROM one",
)
def parse_location(spark, sf):
    one = records(spark, sf).select(
        "line_number", F.explode(F.split(rec.raw_field("v2_enhanced_locations"), ";")).alias("v")
    )
    one = one.select("line_number", trim_ws(F.col("v")).alias("v"))
    loc = one.withColumn("l", fx.parse_location(F.col("v")))
    return loc.select(
        "line_number", "v", *[f"l.{n}" for n in PLACE_FIELDS],
        *[F.round(f"l.{n}", 6).alias(n) for n in ("latitude", "longitude")],
    )


@query(
    "raw_field",
    f"WITH {RECORDS} SELECT line_number, "
    + ", ".join(f"{f(i)} AS {n}_raw" for i, n in enumerate(FIELDS))
    + ", '' AS no_such_raw FROM recs",
)
def raw_field(spark, sf):
    return records(spark, sf).select(
        "line_number",
        *[rec.raw_field(n).alias(f"{n}_raw") for n in FIELDS],
        rec.raw_field("no_such").alias("no_such_raw"),
    )


@query(
    "field_selection",
    f"WITH {RECORDS} SELECT line_number, gkg_record_id, {duck_joined('persons')}, "
    "0::BIGINT AS n_themes, 0::BIGINT AS n_locations, round(tone, 6) AS tone FROM recs",
)
def field_selection(spark, sf):
    return records(spark, sf, ["persons", "tone"]).select(
        "line_number",
        "gkg_record_id",
        joined("persons"),
        F.size("themes").cast("bigint").alias("n_themes"),
        F.size("locations").cast("bigint").alias("n_locations"),
        F.round("tone.tone", 6).alias("tone"),
    )


SHORT_LOC = (
    "array_to_string(list_transform(locations, lambda x: x.full_name || '~' || x.country_code), '|') "
    "AS locations"
)


def short_loc():
    return F.array_join(
        F.transform("locations", lambda x: F.concat(x["full_name"], F.lit("~"), x["country_code"])), "|"
    ).alias("locations")


PARSED_SQL = f"""SELECT gkg_record_id, date_str, source_common_name, document_id,
  {duck_joined('themes')}, {duck_joined('persons')}, {duck_joined('organizations')}, {SHORT_LOC},
  round(tone, 6) AS tone"""


def parsed_columns(*more):
    return [
        "gkg_record_id", "date_str", "source_common_name", "document_id", joined("themes"),
        joined("persons"), joined("organizations"), short_loc(), F.round("tone.tone", 6).alias("tone"),
        *more,
    ]


@query("project_parsed", f"WITH {RECORDS} {PARSED_SQL} FROM recs")
def project_parsed(spark, sf):
    return rec.project_parsed(records(spark, sf)).select(*parsed_columns())


# ---------------------------------------------------------------- filters, rejects, counts


@query(
    "filter_valid",
    f"WITH {PIECES} SELECT line_number, {strip(f(0))} AS gkg_record_id, {strip(f(4))} AS document_id, "
    "kind = 'parsed' AS is_valid FROM pieces WHERE kind IN ('parsed', 'skipped')",
)
def filter_valid(spark, sf):
    return rec.parse_records(inputs.lines(spark, sf), keep_invalid=True).select(
        "line_number", "gkg_record_id", "document_id", "is_valid"
    )


@query(
    "filter_malformed",
    f"WITH {PIECES} SELECT line_number, source_file, 'Too few fields: ' || len(f) || "
    "', expected at least 5' AS message, substr(value, 1, 200) AS line_head FROM pieces WHERE kind = 'error'",
)
def filter_malformed(spark, sf):
    return rec.reject_lines(inputs.lines(spark, sf))


STATS_SQL = """SELECT source_file, count(*) AS lines_processed,
  count(*) FILTER (WHERE kind = 'parsed') AS records_parsed,
  count(*) FILTER (WHERE kind = 'error') AS errors,
  count(*) FILTER (WHERE kind = 'skipped') AS skipped FROM pieces GROUP BY source_file"""


@query("parse_stats", f"WITH {PIECES} {STATS_SQL}")
def parse_stats(spark, sf):
    return rec.parse_stats(inputs.lines(spark, sf))


@query(
    "max_errors_abort",
    f"""WITH {PIECES}, failed AS (SELECT source_file FROM pieces GROUP BY source_file
      HAVING count(*) FILTER (WHERE kind = 'error') >= 2)
    SELECT line_number, source_file, {strip(f(0))} AS gkg_record_id FROM pieces
    WHERE kind = 'parsed' AND source_file NOT IN (SELECT source_file FROM failed)""",
)
def max_errors_abort(spark, sf):
    kept = rec.drop_failed_files(inputs.lines(spark, sf), max_errors=2)
    return rec.parse_records(kept).select("line_number", "source_file", "gkg_record_id")


@query(
    "partition_batches",
    f"""WITH {RECORDS}, placed AS (
      SELECT coalesce(year_month, 'unknown') AS partition_key, gkg_record_id, document_id,
        row_number() OVER (PARTITION BY coalesce(year_month, 'unknown')
          ORDER BY substr(md5(gkg_record_id || chr(9) || document_id), 1, 3), gkg_record_id, document_id) - 1 AS place
      FROM recs)
    SELECT partition_key, CAST(floor(place / 10) AS BIGINT) AS batch_no, gkg_record_id, document_id,
      count(*) AS n_copies FROM placed GROUP BY ALL""",
)
def partition_batches(spark, sf):
    return rec.partition_batches(records(spark, sf), batch_size=10)


# ---------------------------------------------------------------- landing and stored forms


@query(
    "landing_layout",
    f"""WITH {PIECES} SELECT source_file, substr(source_file, 1, 4) AS year,
    substr(source_file, 5, 2) AS month, count(*) AS n FROM lines GROUP BY source_file""",
)
def landing_layout(spark, sf):
    files = inputs.lines(spark, sf).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return archive.landing_layout(files)


def _store(spark, sf, fmt="parquet"):
    """Parsed records written per file."""
    path = scratch_path(spark, "parsed")
    rows = rec.project_parsed(records(spark, sf), "line_number", "source_file").withColumn(
        "date_partition", F.substring("source_file", 1, 8)
    )
    parsed.write_parsed(rows, path, fmt=fmt)
    return path, rows


@query(
    "sink_parsed",
    f"WITH {RECORDS} {PARSED_SQL}, substr(source_file, 1, 8) AS date_partition, source_file FROM recs "
    "WHERE source_file <> '20240315-main.gkg.csv'",
)
def sink_parsed(spark, sf):
    """Everything is written, the biggest file again, then that file read anew without records."""
    path, _ = _store(spark, sf)
    # lines are parsed once: what is written again is read from the store
    is_main = F.col("source_file") == "20240315-main.gkg.csv"
    parsed.write_parsed(parsed.read_parsed(spark, path).where(is_main), path)
    stored = parsed.read_parsed(spark, path)
    gone = stored.where(is_main).select("date_partition", "source_file").distinct()
    parsed.write_parsed(stored.where(~F.col("source_file").contains("main")), path, emptied=gone)
    return parsed.read_parsed(spark, path).select(*parsed_columns("date_partition", "source_file"))


_JSON: dict[tuple[str, str], str] = {}


@query(
    "src_parsed_json",
    f"WITH {RECORDS} {PARSED_SQL}, line_number, source_file FROM recs",
)
def src_parsed_json(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _JSON:
        _JSON[key], _ = _store(spark, sf, "json")
    path = _JSON[key]
    return parsed.read_parsed(spark, path, "json").select(
        *parsed_columns("line_number", "source_file")
    )


@query(
    "src_parsed_or_raw",
    f"""WITH {RECORDS} {PARSED_SQL}, line_number, source_file FROM recs
    WHERE source_file LIKE '%main%'
    UNION ALL {PARSED_SQL}, line_number, source_file FROM recs AS r WHERE NOT EXISTS (
      SELECT 1 FROM recs AS s WHERE s.source_file LIKE '%main%' AND s.source_file = r.source_file)""",
)
def src_parsed_or_raw(spark, sf):
    """Stored rows of one file, all others parsed afresh."""
    path, rows = _store(spark, sf)
    stored = parsed.read_parsed(spark, path).where(F.col("source_file").contains("main"))
    both = parsed.parsed_or_raw(stored, inputs.lines(spark, sf))
    return both.select(*parsed_columns("line_number", "source_file"))
