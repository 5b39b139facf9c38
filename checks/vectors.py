"""Embedding, the vector table and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import assemble
from tidewire.operators import embed, search
from tidewire.session import scratch_path
from tidewire.sources import vectors as vt

from . import inputs
from .records import PIECES, RECORDS, duck_joined, joined, records
from .registry import query

WIDTH = inputs.VECTOR_WIDTH
HASHING = embed.HashingEmbedder(WIDTH)

# ---------------------------------------------------------------- embedding text

LABEL = "CASE WHEN tone > 2 THEN 'positive' WHEN tone < -2 THEN 'negative' ELSE 'neutral' END"


def listing(label, items, n):
    return (
        f"CASE WHEN len({items}) > 0 THEN '{label}: ' || array_to_string({items}[1:{n}], ', ') END"
    )


LOC_NAMES = (
    "CASE WHEN len(locations) > 0 THEN 'Locations: ' || coalesce(array_to_string(list_filter("
    "list_transform(locations[1:5], lambda x: x.full_name), lambda x: x <> ''), ', '), '') END"
)
TEXTS = f"""{RECORDS},
texts AS (SELECT *, coalesce(nullif(concat_ws(' | ', {listing('Themes', 'themes', 20)},
    {listing('People', 'persons', 5)}, {listing('Organizations', 'organizations', 5)}, {LOC_NAMES},
    CASE WHEN tone_case <> 'null' THEN 'Tone: ' || {LABEL} END,
    CASE WHEN source_common_name <> '' THEN 'Source: ' || source_common_name END), ''), 'Unknown event') AS text
  FROM recs)"""


@query("tone_label", f"WITH {RECORDS} SELECT line_number, {LABEL} AS label FROM recs")
def tone_label(spark, sf):
    return records(spark, sf).select(
        "line_number", assemble.tone_label(F.col("tone.tone")).alias("label")
    )


@query("assemble_text", f"WITH {TEXTS} SELECT line_number, text FROM texts")
def assemble_text(spark, sf):
    return embed.with_text(records(spark, sf)).select("line_number", "text")


@query("text_hash", "SELECT doc_id, md5(text) AS text_hash FROM documents")
def text_hash(spark, sf):
    docs = inputs.documents(spark, sf)
    return docs.select("doc_id", assemble.text_hash(F.col("text")).alias("text_hash"))


DOC_WORDS = "list_filter(regexp_split_to_array({}, '\\s+'), lambda x: x <> '')"


@query(
    "token_count",
    f"SELECT doc_id, CAST(len({DOC_WORDS.format('text')}) AS INTEGER) AS token_count FROM documents",
)
def token_count(spark, sf):
    docs = inputs.documents(spark, sf)
    return docs.select("doc_id", assemble.token_count(F.col("text")).alias("token_count"))


@query("filter_trivial_text", f"WITH {PIECES} SELECT line_number, length(value) AS n FROM lines WHERE length(value) > 10")
def filter_trivial_text(spark, sf):
    kept = inputs.lines(spark, sf).where(assemble.not_trivial(F.col("value")))
    return kept.select("line_number", F.length("value").cast("bigint").alias("n"))


def duck_embedding(source, key, text):
    """Vectors of the hashing embedder for (key, text) rows: tables counts and vecs."""
    bucket = "CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % " + str(WIDTH)
    return f"""
w_{source} AS (SELECT {key}, unnest({DOC_WORDS.format(text)}) AS w FROM {source}),
b_{source} AS (SELECT {key}, {bucket} AS b, count(*) AS n FROM w_{source} GROUP BY ALL),
v_{source} AS (SELECT {key}, map_from_entries(list((b, n / norm))) AS m FROM
  (SELECT *, sqrt(sum(n * n) OVER (PARTITION BY {key})) AS norm FROM b_{source}) AS q GROUP BY {key}),
e_{source} AS (SELECT s.*, list_transform(range({WIDTH}), lambda i: CAST(coalesce(m[i], 0.0) AS FLOAT)) AS vector
  FROM {source} s LEFT JOIN v_{source} v ON s.{key} = v.{key})"""


def vector_text(name="vector"):
    """Vector as integers of a hundred-thousandth, so both engines print alike."""
    return F.array_join(
        F.transform(name, lambda x: F.round(x.cast("double") * 100000).cast("bigint").cast("string")), ","
    ).alias("vector")


DUCK_VECTOR = (
    "array_to_string(list_transform(vector, lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 100000) AS BIGINT) "
    "AS VARCHAR)), ',') AS vector"
)


@query(
    "embed_texts",
    f"WITH {duck_embedding('documents', 'doc_id', 'text')} SELECT doc_id, {DUCK_VECTOR} FROM e_documents",
)
def embed_texts(spark, sf):
    docs = inputs.documents(spark, sf)
    return embed.embed_texts(docs, HASHING).select("doc_id", vector_text())


@query(
    "embed_records",
    f"WITH {TEXTS}, kept AS (SELECT line_number, gkg_record_id, text FROM texts WHERE length(text) > 10), "
    f"{duck_embedding('kept', 'line_number', 'text')} SELECT line_number, gkg_record_id, md5(text) AS text_hash, "
    f"CAST(len({DOC_WORDS.format('text')}) AS INTEGER) AS token_count, {DUCK_VECTOR} FROM e_kept",
)
def embed_records(spark, sf):
    done = embed.embed_records(records(spark, sf), HASHING)
    return done.select("line_number", "gkg_record_id", "text_hash", "token_count", vector_text())


TURNS = "turns AS (SELECT *, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS k FROM conversations)"


@query(
    "embedder_plugin",
    f"WITH {TURNS}, {duck_embedding('turns', 'k', 'text')} SELECT conv_id, turn, {DUCK_VECTOR} FROM e_turns",
)
def embedder_plugin(spark, sf):
    """A model plugged in from outside: the same hashing, as Python code."""

    def load():
        import hashlib
        import math

        def one(text):
            v = [0.0] * WIDTH
            for w in text.split():
                v[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % WIDTH] += 1.0
            norm = math.sqrt(sum(x * x for x in v)) or 1.0
            return [x / norm for x in v]

        return lambda texts: [one(t) for t in texts]

    turns = inputs.table(spark, sf, "conversations")
    model = embed.ModelEmbedder(load, WIDTH)
    return model.embed(turns).select("conv_id", "turn", vector_text())


# ---------------------------------------------------------------- rows of the vector table

SHAPE_SQL = f"""SELECT {{more}} gkg_record_id, substr(date_str, 1, 8) AS date, date_str AS timestamp,
  array_to_string(themes[1:20], '|') AS themes, array_to_string(persons[1:10], '|') AS persons,
  array_to_string(organizations[1:10], '|') AS organizations,
  coalesce(array_to_string(list_filter(list_transform(locations[1:10], lambda x: x.full_name), lambda x: x <> ''), '|'), '') AS locations,
  coalesce(array_to_string(list_sort(list_distinct(list_filter(list_transform(locations[1:10], lambda x: x.country_code), lambda x: x <> ''))), '|'), '') AS countries,
  round(CAST(CAST(coalesce(tone, 0.0) AS FLOAT) AS DOUBLE), 4) AS tone, source_common_name AS source,
  document_id AS source_url, md5(text) AS text_hash, {DUCK_VECTOR}"""
LIST_COLUMNS = ["themes", "persons", "organizations", "locations", "countries"]


def shape_columns(*more):
    return [
        *more, "gkg_record_id", "date", "timestamp", *[joined(c) for c in LIST_COLUMNS],
        F.round(F.col("tone").cast("double"), 4).alias("tone"), "source", "source_url", "text_hash",
        vector_text(),
    ]


KEPT = (
    f"WITH {TEXTS}, kept AS (SELECT * FROM texts WHERE length(text) > 10), "
    f"{duck_embedding('kept', 'line_number', 'text')} "
)


@query("vec_row_shape", KEPT + SHAPE_SQL.format(more="") + " FROM e_kept")
def vec_row_shape(spark, sf):
    return vt.vec_row_shape(embed.embed_records(records(spark, sf), HASHING)).select(*shape_columns())


@query("country_set", f"""WITH {RECORDS} SELECT line_number, coalesce(array_to_string(list_sort(list_distinct(
  list_filter(list_transform(locations, lambda x: x.country_code), lambda x: x <> ''))), '|'), '') AS countries FROM recs""")
def country_set(spark, sf):
    codes = vt.country_set(F.col("locations"))
    return records(spark, sf).select("line_number", F.array_join(codes, "|").alias("countries"))


# each embedding takes the metadata of the last record of its id
JOINED = KEPT + ", " + f"""last AS (SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY gkg_record_id
    ORDER BY line_number DESC) = 1),
paired AS (SELECT l.*, k.text, k.vector, k.line_number AS from_line FROM e_kept k JOIN last l
  ON l.gkg_record_id = k.gkg_record_id) """


@query("join_embed_records", JOINED + SHAPE_SQL.format(more="") + " FROM paired")
def join_embed_records(spark, sf):
    rows = records(spark, sf)
    done = embed.embedding_results(embed.embed_records(rows, HASHING))
    return vt.vec_row_shape(vt.join_embed_records(done, rows, "line_number")).select(*shape_columns())


@query("vec_append", JOINED + SHAPE_SQL.format(more="year_month,").replace(
    "SELECT year_month,", "SELECT coalesce(year_month, 'unknown') AS year_month,") + " FROM paired")
def vec_append(spark, sf):
    rows = records(spark, sf)
    table = vt.VectorTable(spark, scratch_path(spark, "vectors"), WIDTH)
    table.add_records(embed.embedding_results(embed.embed_records(rows, HASHING)), rows, "line_number")
    return table.read().select(*shape_columns("year_month"))


# ---------------------------------------------------------------- ids and statistics

VT = f"vt AS ({inputs.duck(inputs.VECTORS)})"
IDS = "ids AS (SELECT doc_id AS position, 'R' || CAST(doc_id - doc_id % 2 AS VARCHAR) AS gkg_record_id FROM documents)"


def ids(spark, sf):
    """Ids asked for, in their order, with copies; some are stored."""
    docs = inputs.documents(spark, sf)
    even = F.col("doc_id") - F.col("doc_id") % 2
    return docs.select(
        F.col("doc_id").alias("position"),
        F.concat(F.lit("R"), even.cast("string")).alias("gkg_record_id"),
    )


@query("existing_ids", f"WITH {VT}, {IDS} SELECT position, gkg_record_id FROM ids WHERE gkg_record_id IN (SELECT gkg_record_id FROM vt)")
def existing_ids(spark, sf):
    return vt.existing_ids(ids(spark, sf), inputs.vectors(spark, sf)).select("position", "gkg_record_id")


@query("new_records", f"WITH {VT}, {IDS} SELECT position, gkg_record_id FROM ids WHERE gkg_record_id NOT IN (SELECT gkg_record_id FROM vt)")
def new_records(spark, sf):
    return vt.new_records(ids(spark, sf), inputs.vectors(spark, sf)).select("position", "gkg_record_id")


@query("vec_scan", f"WITH {VT} SELECT gkg_record_id, date FROM vt")
def vec_scan(spark, sf):
    return inputs.vectors(spark, sf).select("gkg_record_id", "date")


@query("vec_count", f"WITH {VT} SELECT count(*) AS total_records FROM vt")
def vec_count(spark, sf):
    return vt.vec_count(inputs.vectors(spark, sf))


@query("vec_date_range", f"WITH {VT} SELECT min(nullif(date, '')) AS min_date, max(nullif(date, '')) AS max_date FROM vt")
def vec_date_range(spark, sf):
    return vt.vec_date_range(inputs.vectors(spark, sf))


@query("vec_stats", f"""WITH {VT} SELECT count(*) AS total_records, min(nullif(date, '')) AS min_date,
  max(nullif(date, '')) AS max_date, 'vectors' AS db_path, 'gkg_embeddings' AS table_name FROM vt""")
def vec_stats(spark, sf):
    return vt.vec_stats(inputs.vectors(spark, sf), "vectors")


@query("delete_by_ids", f"""WITH {VT}, {IDS} SELECT gkg_record_id, year_month, (SELECT count(*) FROM vt
  WHERE gkg_record_id IN (SELECT gkg_record_id FROM ids) OR year_month = '202405') AS n_deleted FROM vt
  WHERE gkg_record_id NOT IN (SELECT gkg_record_id FROM ids) AND year_month <> '202405'""")
def delete_by_ids(spark, sf):
    """A copy of the table loses the asked ids and, with them, one whole month."""
    table = vt.VectorTable(spark, scratch_path(spark, "vectors"), WIDTH)
    table.append(inputs.vectors(spark, sf))
    month = table.scan("gkg_record_id", "year_month").where("year_month = '202405'")
    gone = table.delete_by_ids(
        ids(spark, sf).select("gkg_record_id").unionByName(month.select("gkg_record_id"))
    )
    return table.scan("gkg_record_id", "year_month").withColumn("n_deleted", F.lit(gone).cast("bigint"))


# ---------------------------------------------------------------- search

DIST = "power(list_distance(CAST(v.vector AS DOUBLE[]), q.vector), 2)"


def knn_sql(where="TRUE", k="10", over="qid", source="vt", queries="queries", key="gkg_record_id"):
    return f"""ranked AS (SELECT q.qid, v.*, {DIST} AS distance, row_number() OVER (PARTITION BY q.{over}
      ORDER BY {DIST}, v.{key}) AS rank FROM {source} v, {queries} q WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY q.{over} ORDER BY {DIST}, v.{key}) <= {k})"""


def dist(name="distance"):
    return F.round(name, 6).alias(name)


LABEL_Q = f"queries AS ({inputs.LABEL_CENTERS})"
CENTER_Q = f"queries AS (SELECT 'q' AS qid, vector FROM ({inputs.CENTER}) AS c)"


@query("knn_search", f"WITH {VT}, {CENTER_Q}, {knn_sql()} SELECT CAST(rank AS INTEGER) AS rank, gkg_record_id, date, "
       "round(distance, 6) AS distance FROM ranked")
def knn_search(spark, sf):
    near = search.knn_search(inputs.vectors(spark, sf), inputs.center(spark, sf), 10)
    return near.select("rank", "gkg_record_id", "date", dist())


@query("knn_batch", f"WITH {VT}, {LABEL_Q}, {knn_sql()} SELECT qid, CAST(rank AS INTEGER) AS rank, gkg_record_id, "
       "round(distance, 6) AS distance FROM ranked")
def knn_batch(spark, sf):
    near = search.knn_batch(inputs.vectors(spark, sf), inputs.label_centers(spark, sf))
    return near.select("qid", "rank", "gkg_record_id", dist())


@query("query_cross", f"""WITH {VT}, {LABEL_Q} SELECT qid, count(*) AS n_candidates, round(min({DIST}), 6) AS min_distance,
  round(max({DIST}), 6) AS max_distance, round(avg({DIST}), 6) AS avg_distance FROM vt v, queries q GROUP BY qid""")
def query_cross(spark, sf):
    """Every request against every row, folded while scoring."""
    profile = search.distance_profile(inputs.vectors(spark, sf), inputs.label_centers(spark, sf))
    names = ["min_distance", "max_distance", "avg_distance"]
    return profile.select("qid", "n_candidates", *[dist(n) for n in names])


DATES = "v.date >= '20240215' AND v.date <= '20241020'"
FILTERS = f"{DATES} AND list_has_any(v.countries, ['C1', 'NATION_3', 'C7']) AND (" + " OR ".join(
    f"contains(lower(array_to_string(v.themes, ' ')), '{t}')" for t in ("topic_2", "label_1 topic_")) + ")"
ARGS = dict(
    date_from="20240215", date_to="20241020", countries=["C1", "NATION_3", "C7"],
    themes=["Topic_2", "LABEL_1 topic_"],
)
RESULT_SQL = f"""SELECT CAST(rank AS INTEGER) AS rank, gkg_record_id, date, {', '.join(duck_joined(c) for c in LIST_COLUMNS)},
  CAST(tone AS DOUBLE) AS tone, source, source_url, round(1 - distance, 6) AS score FROM ranked"""


def result_columns(*more):
    return [
        *more, "rank", "gkg_record_id", "date", *[joined(c) for c in LIST_COLUMNS],
        F.col("tone").cast("double").alias("tone"), "source", "source_url", dist("score"),
    ]


@query("search_filtered", f"WITH {VT}, {CENTER_Q}, {knn_sql(FILTERS)} {RESULT_SQL}")
def search_filtered(spark, sf):
    near = search.knn_search(inputs.vectors(spark, sf), inputs.center(spark, sf), 10, **ARGS)
    return search.result_projection(near).select(*result_columns())


LOOSE = "list_has_any(v.countries, ['C1', 'C2', 'C3', 'C4']) AND contains(lower(array_to_string(v.themes, ' ')), 'topic_')"


@query("search_filtered_overfetch", f"""WITH {VT}, {LABEL_Q}, {knn_sql(DATES, '20')},
  cut AS (SELECT v.* EXCLUDE (rank), row_number() OVER (PARTITION BY qid ORDER BY distance, gkg_record_id) AS rank
    FROM ranked v WHERE {LOOSE} QUALIFY row_number() OVER (PARTITION BY qid ORDER BY distance, gkg_record_id) <= 10)
  {RESULT_SQL.replace('FROM ranked', 'FROM cut').replace('SELECT ', 'SELECT qid, ', 1)}""")
def search_filtered_overfetch(spark, sf):
    """Filters applied after twice the limit was fetched: matches further down are lost."""
    asked = inputs.label_centers(spark, sf).withColumns(
        {
            "date_from": F.lit("20240215"),
            "date_to": F.lit("20241020"),
            "countries": F.array(*[F.lit(c) for c in ("C1", "C2", "C3", "C4")]),
            "themes": F.array(F.lit("Topic_")),
        }
    )
    near = search.knn_batch(inputs.vectors(spark, sf), asked, mode="overfetch")
    return search.result_projection(near).select(*result_columns("qid"))


@query("filter_search_dates", f"WITH {VT} SELECT gkg_record_id, date FROM vt v WHERE {DATES}")
def filter_search_dates(spark, sf):
    kept = inputs.vectors(spark, sf).where(search.within_dates("20240215", "20241020"))
    return kept.select("gkg_record_id", "date")


@query("filter_countries", f"WITH {VT} SELECT gkg_record_id, {duck_joined('countries')} FROM vt WHERE list_has_any(countries, ['C1', 'NATION_3'])")
def filter_countries(spark, sf):
    kept = inputs.vectors(spark, sf).where(search.in_countries(["C1", "NATION_3", "c2"]))
    return kept.select("gkg_record_id", joined("countries"))


@query("filter_themes", f"""WITH {VT} SELECT gkg_record_id, {duck_joined('themes')} FROM vt WHERE
  contains(lower(array_to_string(themes, ' ')), 'topic_2') OR contains(lower(array_to_string(themes, ' ')), '3 topic_5')""")
def filter_themes(spark, sf):
    kept = inputs.vectors(spark, sf).where(search.has_themes(["Topic_2", "3 TOPIC_5"]))
    return kept.select("gkg_record_id", joined("themes"))


@query("score", f"WITH {VT}, {LABEL_Q}, {knn_sql()} SELECT qid, gkg_record_id, round(1 - distance, 6) AS score FROM ranked")
def score(spark, sf):
    near = search.knn_batch(inputs.vectors(spark, sf), inputs.label_centers(spark, sf))
    return near.select("qid", "gkg_record_id", F.round(search.score(F.col("distance")), 6).alias("score"))


@query("result_projection", f"WITH {VT}, {LABEL_Q}, {knn_sql()} {RESULT_SQL.replace('SELECT ', 'SELECT qid, ', 1)}")
def result_projection(spark, sf):
    near = search.knn_batch(inputs.vectors(spark, sf), inputs.label_centers(spark, sf))
    return search.result_projection(near).select(*result_columns("qid"))


# ---------------------------------------------------------------- text requests

REQ = f"req AS ({inputs.duck(inputs.REQUESTS)})"
OK = """(query IS NOT NULL AND length(query) BETWEEN 3 AND 1000 AND limit_n BETWEEN 1 AND 100
  AND (date_from IS NULL OR regexp_full_match(date_from, '[0-9]{8}'))
  AND (date_to IS NULL OR regexp_full_match(date_to, '[0-9]{8}')))"""


@query("request_validation", f"""WITH {REQ} SELECT qid, {OK} AS is_valid, CASE
    WHEN query IS NULL OR length(query) NOT BETWEEN 3 AND 1000 THEN 'query'
    WHEN limit_n NOT BETWEEN 1 AND 100 THEN 'limit'
    WHEN date_from IS NOT NULL AND NOT regexp_full_match(date_from, '[0-9]{{8}}') THEN 'date_from'
    WHEN date_to IS NOT NULL AND NOT regexp_full_match(date_to, '[0-9]{{8}}') THEN 'date_to' END AS problem FROM req""")
def request_validation(spark, sf):
    return search.check_requests(inputs.requests(spark, sf)).select("qid", "is_valid", "problem")


ASKED = f"""WITH {VT}, {REQ}, asked AS (SELECT * FROM req WHERE {OK}), {duck_embedding('asked', 'qid', 'query')},
docs AS (SELECT * FROM documents), {duck_embedding('docs', 'doc_id', 'text')},
store AS (SELECT v.* EXCLUDE (vector), e.vector FROM vt v JOIN e_docs e ON 'R' || CAST(e.doc_id AS VARCHAR) = v.gkg_record_id),
queries AS (SELECT * EXCLUDE (vector), CAST(vector AS DOUBLE[]) AS vector FROM e_asked), """
REQUEST_FILTER = """(q.date_from IS NULL OR v.date >= q.date_from) AND (q.date_to IS NULL OR v.date <= q.date_to)
  AND (q.countries IS NULL OR list_has_any(v.countries, q.countries))
  AND (q.themes IS NULL OR len(list_filter(q.themes, lambda t: contains(lower(array_to_string(v.themes, ' ')), lower(t)))) > 0)"""


def text_store(spark, sf):
    """The vector table with the documents' texts embedded."""
    docs = inputs.documents(spark, sf).select(
        F.concat(F.lit("R"), F.col("doc_id").cast("string")).alias("gkg_record_id"), "text"
    )
    rows = inputs.vectors(spark, sf).drop("vector").join(docs, "gkg_record_id")
    return HASHING.embed(rows).drop("text")


@query("search_text", ASKED + knn_sql(REQUEST_FILTER, "q.limit_n", source="store") +
       RESULT_SQL.replace("SELECT ", " SELECT qid, ", 1))
def search_text(spark, sf):
    found = search.search_text(text_store(spark, sf), inputs.requests(spark, sf), HASHING)
    return found.select(*result_columns("qid"))
