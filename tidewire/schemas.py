"""Declared schemas.  Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# The 27 columns of a record line, in file order.
FIELDS = [
    "gkg_record_id",
    "date",
    "source_collection_id",
    "source_common_name",
    "document_id",
    "counts",
    "v2_counts",
    "themes",
    "v2_enhanced_themes",
    "locations",
    "v2_enhanced_locations",
    "persons",
    "v2_enhanced_persons",
    "organizations",
    "v2_enhanced_organizations",
    "v2_tone",
    "v2_enhanced_dates",
    "v2_gcam",
    "v2_sharing_image",
    "v2_related_images",
    "v2_social_image_embeds",
    "v2_social_video_embeds",
    "v2_quotations",
    "v2_all_names",
    "v2_amounts",
    "v2_translation_info",
    "v2_extras_xml",
]
POSITION = {name: i for i, name in enumerate(FIELDS)}
MIN_FIELDS = 5

# File states.
STATUSES = ["pending", "downloading", "downloaded", "parsing", "completed", "failed", "skipped"]

STRINGS = T.ArrayType(T.StringType())

# Names and order as the reference stores them.
LOCATION = T.StructType(
    [
        T.StructField("location_type", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("adm1_code", T.StringType()),
        T.StructField("adm2_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("feature_id", T.StringType()),
        T.StructField("char_offset", T.LongType()),
    ]
)

# Names and order as the reference stores them.
TONE_PARTS = [
    "tone",
    "positive_score",
    "negative_score",
    "polarity",
    "activity_ref_density",
    "group_ref_density",
]
TONE = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in TONE_PARTS]
    + [T.StructField("word_count", T.LongType())]
)

SHORT_LOCATION = T.StructType(
    [
        T.StructField("full_name", T.StringType()),
        T.StructField("country_code", T.StringType()),
    ]
)
SHORT_TONE = T.StructType([T.StructField("tone", T.DoubleType())])

# The stored subset of a record.
# Names and order as the reference stores them.
PARSED_COLUMNS = [
    T.StructField("gkg_record_id", T.StringType()),
    T.StructField("date_str", T.StringType()),
    T.StructField("source_common_name", T.StringType()),
    T.StructField("document_id", T.StringType()),
    T.StructField("themes", STRINGS),
    T.StructField("persons", STRINGS),
    T.StructField("organizations", STRINGS),
    T.StructField("locations", T.ArrayType(SHORT_LOCATION)),
    T.StructField("tone", SHORT_TONE),
]
PARSED = T.StructType(PARSED_COLUMNS)
# On disk each row also knows the file it came from and that file's date.
PARSED_STORED = T.StructType(
    PARSED_COLUMNS
    + [
        T.StructField("line_number", T.LongType()),
        T.StructField("date_partition", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)

# Lines taken out of archives; line 0 stands for the file itself.
RAW_STORED = T.StructType(
    [
        T.StructField("line_number", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("actual_md5", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)

FILE_INFO = T.StructType(
    [
        T.StructField("file_url", T.StringType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("checksum_md5", T.StringType()),
        T.StructField("date_partition", T.StringType()),
        T.StructField("file_type", T.StringType()),
    ]
)

EVENT_LOG = T.StructType(
    [
        T.StructField("file_url", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("checksum_md5", T.StringType()),
        T.StructField("date_partition", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
    ]
)

# Names and order as the reference stores them.
VECTOR_COLUMNS = [
    T.StructField("gkg_record_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("themes", STRINGS),
    T.StructField("persons", STRINGS),
    T.StructField("organizations", STRINGS),
    T.StructField("locations", STRINGS),
    T.StructField("countries", STRINGS),
    T.StructField("tone", T.FloatType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("text_hash", T.StringType()),
    T.StructField("vector", T.ArrayType(T.FloatType())),
]
VECTOR_TABLE = T.StructType(VECTOR_COLUMNS)
VECTOR_STORED = T.StructType(VECTOR_COLUMNS + [T.StructField("year_month", T.StringType())])
DEFAULT_DIMENSIONS = 1536

REQUEST = T.StructType(
    [
        T.StructField("qid", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("limit", T.IntegerType()),
        T.StructField("date_from", T.StringType()),
        T.StructField("date_to", T.StringType()),
        T.StructField("countries", STRINGS),
        T.StructField("themes", STRINGS),
    ]
)

RUN_STATS = T.StructType(
    [
        T.StructField("run_started_at", T.TimestampNTZType()),
        T.StructField("run_ended_at", T.TimestampNTZType()),
        T.StructField("mode", T.StringType()),
        T.StructField("date_from", T.StringType()),
        T.StructField("date_to", T.StringType()),
        T.StructField("total_scanned", T.LongType()),
        T.StructField("new_inserted", T.LongType()),
        T.StructField("already_tracked", T.LongType()),
        T.StructField("files_downloaded", T.LongType()),
        T.StructField("download_errors", T.LongType()),
        T.StructField("parsed_files", T.LongType()),
        T.StructField("parse_errors", T.LongType()),
        T.StructField("files_embedded", T.LongType()),
        T.StructField("records_embedded", T.LongType()),
        T.StructField("records_skipped", T.LongType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("min_date", T.StringType()),
        T.StructField("max_date", T.StringType()),
    ]
)
