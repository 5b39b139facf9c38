"""Smaller vectors, two-stage search, filters on time, actors, tone and place."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewire.operators import retrieval as rt

from . import inputs
from .records import RECORDS, records
from .registry import query
from .vectors import CENTER_Q, VT, dist



@query("adv_mrl", f"""WITH short AS (SELECT vec_id, list_transform(embedding[1:16], lambda x: CAST(x AS DOUBLE)) AS h FROM embeddings),
  cut AS (SELECT vec_id, list_transform(h, lambda x: CAST(x / sqrt(list_inner_product(h, h)) AS FLOAT)) AS vector FROM short)
  SELECT vec_id, array_to_string(list_transform(vector, lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)), ',')
    AS thousandths, len(vector) AS width FROM cut""")
def adv_mrl(spark, sf):
    short = rt.truncate_vectors(inputs.table(spark, sf, "embeddings"), 16, "embedding")
    thousandths = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("bigint"))
    shown = F.array_join(F.transform(thousandths, lambda x: x.cast("string")), ",")
    return short.select("vec_id", shown.alias("thousandths"), F.size("embedding").cast("bigint").alias("width"))


DIMS = range(1, inputs.VECTOR_WIDTH + 1)
RANGES = (
    "ranges AS (SELECT [" + ", ".join(f"min(CAST(embedding[{i}] AS DOUBLE))" for i in DIMS) + "] AS lo, ["
    + ", ".join(f"max(CAST(embedding[{i}] AS DOUBLE))" for i in DIMS) + "] AS hi FROM embeddings)"
)
CODES = f"""{RANGES}, coded AS (SELECT vec_id, embedding, lo, hi, list_transform(embedding, lambda x, i:
  CAST(floor((CAST(x AS DOUBLE) - lo[i]) / (hi[i] - lo[i]) * 255 + 0.5) AS BIGINT) - 128) AS code FROM embeddings, ranges)"""


@query("adv_sq8", f"""WITH {CODES} SELECT vec_id, array_to_string(list_transform(code, lambda x: CAST(x AS VARCHAR)), ',') AS code,
  round(list_distance(CAST(embedding AS DOUBLE[]), list_transform(code, lambda x, i:
    CAST(CAST(lo[i] + (x + 128) / 255 * (hi[i] - lo[i]) AS FLOAT) AS DOUBLE))), 6) AS error FROM coded""")
def adv_sq8(spark, sf):
    """Codes and the distance between each vector and its decoded form."""
    store = inputs.table(spark, sf, "embeddings")
    ranges = rt.dimension_ranges(store, "embedding")
    both = rt.decode_sq8(rt.encode_sq8(store, ranges, "embedding"), ranges)
    squares = F.zip_with("embedding", "vector", lambda a, b: F.pow(a.cast("double") - b.cast("double"), 2.0))
    return both.select(
        "vec_id",
        F.array_join(F.transform("code", lambda x: x.cast("string")), ",").alias("code"),
        F.round(F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)), 6).alias("error"),
    )


@query("adv_funnel", f"""WITH {VT}, {CENTER_Q}, near AS (SELECT v.*, q.vector AS qv, len(list_filter(list_zip(v.vector, q.vector),
    lambda p: (p[1] > 0) <> (p[2] > 0))) AS bits FROM vt v, queries q ORDER BY bits, gkg_record_id LIMIT 100)
  SELECT gkg_record_id, CAST(row_number() OVER (ORDER BY d, gkg_record_id) AS INTEGER) AS rank, round(d, 6) AS distance
  FROM (SELECT gkg_record_id, power(list_distance(CAST(vector AS DOUBLE[]), qv), 2) AS d FROM near) AS x
  QUALIFY rank <= 5""")
def adv_funnel(spark, sf):
    table = inputs.vectors_table(spark, sf)
    found = rt.funnel_search(table.read(), inputs.center(spark, sf), codes=table.codes())
    return found.select("gkg_record_id", "rank", dist())


@query("adv_last_hours", f"""WITH {RECORDS} SELECT line_number, gkg_record_id FROM recs
  WHERE date >= TIMESTAMP '2024-06-18 12:00:00' - INTERVAL 72 HOUR AND date <= TIMESTAMP '2024-06-18 12:00:00'""")
def adv_last_hours(spark, sf):
    recent = rt.last_hours(F.col("date"), datetime(2024, 6, 18, 12), 72)
    return records(spark, sf).where(recent).select("line_number", "gkg_record_id")


@query("adv_actor_pair", f"WITH {RECORDS} SELECT line_number, gkg_record_id FROM recs "
       "WHERE list_contains(list_concat(persons, organizations), 'A') AND list_contains(list_concat(persons, organizations), 'Org 3')")
def adv_actor_pair(spark, sf):
    return records(spark, sf).where(rt.actor_pair("A", "Org 3")).select("line_number", "gkg_record_id")


@query("adv_intensity", f"WITH {RECORDS} SELECT line_number, round(tone, 6) AS tone FROM recs WHERE tone BETWEEN -6 AND -1.5")
def adv_intensity(spark, sf):
    kept = records(spark, sf).where(rt.intensity(F.col("tone.tone"), -6, -1.5))
    return kept.select("line_number", F.round("tone.tone", 6).alias("tone"))


KM = """2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(x.latitude - 48.0) / 2), 2) + cos(radians(x.latitude))
  * cos(radians(48.0)) * power(sin(radians(x.longitude - 10.0) / 2), 2))))"""


@query("adv_geo", f"""WITH {RECORDS} SELECT line_number, locations[1].full_name AS place,
    CAST(CAST(floor((locations[1].latitude + 90) / 5) AS BIGINT) AS VARCHAR) || '_' ||
    CAST(CAST(floor((locations[1].longitude + 180) / 5) AS BIGINT) AS VARCHAR) AS cell FROM recs
  WHERE len(list_filter(locations, lambda x: coalesce({KM} <= 4000, FALSE))) > 0""")
def adv_geo(spark, sf):
    first = F.get("locations", F.lit(0))
    near = records(spark, sf).where(rt.within_km(48.0, 10.0, 4000))
    return near.select(
        "line_number",
        first["full_name"].alias("place"),
        rt.grid_cell(first["latitude"], first["longitude"]).alias("cell"),
    )
