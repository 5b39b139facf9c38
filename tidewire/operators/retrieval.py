"""Search features beyond the plain nearest-neighbour query: smaller vectors, a
two-stage search, and filters on time, actors, tone and place."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import finite, has_themes, in_countries, knn_search, within_dates

EARTH_KM = 6371.0
KM_PER_DEGREE = EARTH_KM * math.pi / 180


# ---------------------------------------------------------------- smaller vectors


def truncate_vectors(df: DataFrame, dimensions: int, vector: str = "vector") -> DataFrame:
    """Keep the leading dimensions and scale to unit length again."""
    head = array_to_vector(F.slice(vector, 1, dimensions).cast("array<double>"))
    scaler = Normalizer(inputCol="_head", outputCol="_unit", p=2.0)
    scaled = scaler.transform(df.withColumn("_head", head))
    return scaled.withColumn(vector, vector_to_array("_unit", "float32")).drop("_head", "_unit")


def dimension_ranges(store: DataFrame, vector: str = "vector") -> DataFrame:
    """Least and greatest value per dimension (pos from 0).

    Each task sends one row per dimension, whatever it has read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo = hi = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            m = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
            least, most = m.min(axis=0), m.max(axis=0)
            lo = least if lo is None else np.minimum(lo, least)
            hi = most if hi is None else np.maximum(hi, most)
        if lo is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(lo)), pa.int32()), pa.array(lo), pa.array(hi)],
                names=["pos", "lo", "hi"],
            )

    usable = store.select(vector).where(finite(F.col(vector)))
    parts = usable.mapInArrow(run, "pos int, lo double, hi double")
    return parts.groupBy("pos").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _bounds(ranges: DataFrame) -> tuple[Column, Column]:
    rows = ranges.orderBy("pos").collect()  # one row per dimension
    return (
        F.array(*[F.lit(r["lo"]) for r in rows]),
        F.array(*[F.lit((r["hi"] - r["lo"]) or 1.0) for r in rows]),
    )


def encode_sq8(
    store: DataFrame, ranges: DataFrame, vector: str = "vector", code: str = "code"
) -> DataFrame:
    """One signed byte per dimension, linear between the dimension's bounds."""
    lo, span = _bounds(ranges)

    def byte(x: Column, i: Column) -> Column:
        share = (x.cast("double") - F.get(F.col("_lo"), i)) / F.get(F.col("_span"), i)
        return (F.floor(share * 255 + 0.5) - 128).cast("tinyint")

    return (
        store.withColumns({"_lo": lo, "_span": span})
        .withColumn(code, F.transform(vector, byte))
        .drop("_lo", "_span")
    )


def decode_sq8(
    coded: DataFrame, ranges: DataFrame, code: str = "code", vector: str = "vector"
) -> DataFrame:
    lo, span = _bounds(ranges)

    def value(x: Column, i: Column) -> Column:
        share = (x.cast("double") + 128) / 255
        return (F.get(F.col("_lo"), i) + share * F.get(F.col("_span"), i)).cast("float")

    return (
        coded.withColumns({"_lo": lo, "_span": span})
        .withColumn(vector, F.transform(code, value))
        .drop("_lo", "_span")
    )


# ---------------------------------------------------------------- two-stage search


def sign_bits(vector: Column, dimensions: int) -> Column:
    """Signs of a vector packed into 64-bit words (set where positive)."""

    def word(start: int) -> Column:
        return F.aggregate(
            F.slice(vector, start, 64),
            F.lit(0).cast("bigint"),
            lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > 0, 1).otherwise(0).cast("bigint")),
        )

    return F.array(*[word(s) for s in range(1, dimensions + 1, 64)])


def _pack(values: Iterable[float]) -> list[int]:
    values, words = list(values), []
    for start in range(0, len(values), 64):
        w = 0
        for x in values[start : start + 64]:
            w = (w << 1) | (x > 0)
        words.append(w - (1 << 64) if w >= 1 << 63 else w)
    return words


def hamming(bits: Column, words: list[int]) -> Column:
    """Number of differing signs."""
    total = F.lit(0)
    for i, w in enumerate(words):
        total = total + F.bit_count(F.get(bits, F.lit(i)).bitwiseXOR(F.lit(w).cast("bigint")))
    return total


def funnel_search(
    store: DataFrame,
    query_vector: Iterable[float],
    shortlist: int = 100,
    limit: int = 5,
    bits: str | None = None,
    key: str = "gkg_record_id",
    vector: str = "vector",
    codes: DataFrame | None = None,
    **knn_args,
) -> DataFrame:
    """Shortlist by differing signs, then exact order among the shortlist.

    Filters apply before the shortlist is cut (with ``mode="overfetch"`` the date
    filter does), so that they never leave fewer rows than there are.

    ``bits`` names a stored column of ``sign_bits``; with it the first stage
    reads 8 bytes per 64 dimensions instead of 256.  ``codes`` is a table of
    stored codes (``VectorTable.codes``: id, date, countries, themes, bits, month):
    the first stage then reads it alone, and only the shortlist (at most
    ``shortlist`` rows, broadcast) is looked up in ``store`` by month and id.
    """
    query = [float(x) for x in query_vector]
    if codes is not None:
        month = "year_month"
        first = codes.where(within_dates(knn_args.get("date_from"), knn_args.get("date_to"), month))
        if knn_args.get("mode", "prefilter") == "prefilter":
            first = first.where(in_countries(knn_args.get("countries")) & has_themes(knn_args.get("themes")))
        listed = (
            first.where(F.col("bits").isNotNull())
            .withColumn("_bits", hamming(F.col("bits"), _pack(query)))
            .orderBy("_bits", key)
            .limit(shortlist)
            .select(key, month)
        )
        near = store.join(F.broadcast(listed), [key, month], "left_semi")
        return knn_search(near, query, limit, key=key, vector=vector, **knn_args)
    month = "year_month" if "year_month" in store.columns else None
    store = store.where(within_dates(knn_args.get("date_from"), knn_args.get("date_to"), month))
    if knn_args.get("mode", "prefilter") == "prefilter":
        store = store.where(in_countries(knn_args.get("countries")) & has_themes(knn_args.get("themes")))
    store = store.where(F.col(bits).isNotNull() if bits else finite(F.col(vector)))
    code = F.col(bits) if bits else sign_bits(F.col(vector), len(query))
    near = (
        store.withColumn("_bits", hamming(code, _pack(query)))
        .orderBy("_bits", key)
        .limit(shortlist)
        .drop("_bits")
    )
    return knn_search(near, query, limit, key=key, vector=vector, **knn_args)


# ---------------------------------------------------------------- filters


def last_hours(ts: Column, as_of: datetime, hours: int) -> Column:
    """Within the hours up to ``as_of``."""
    end = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return (ts >= end - F.expr(f"interval {int(hours)} hours")) & (ts <= end)


def actor_pair(first: str, second: str, *lists: str) -> Column:
    """Both names occur among the persons and organizations."""
    names = F.concat(*[F.col(c) for c in lists or ("persons", "organizations")])
    return F.array_contains(names, first) & F.array_contains(names, second)


def intensity(tone: Column, low: float | None = None, high: float | None = None) -> Column:
    """Inclusive bounds on the tone."""
    ok = tone.isNotNull()
    if low is not None:
        ok = ok & (tone >= low)
    if high is not None:
        ok = ok & (tone <= high)
    return ok


def haversine_km(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    half_lat = F.sin(F.radians(lat - lat0) / 2)
    half_lon = F.sin(F.radians(lon - lon0) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat)) * math.cos(math.radians(lat0)) * half_lon * half_lon
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def within_km(
    lat0: float, lon0: float, km: float, locations: str = "locations"
) -> Column:
    """Any location within the distance; a band of latitude is checked first."""

    def near(x: Column) -> Column:
        band = F.abs(x["latitude"] - lat0) <= km / KM_PER_DEGREE + 1e-9
        return F.coalesce(
            band & (haversine_km(x["latitude"], x["longitude"], lat0, lon0) <= km), F.lit(False)
        )

    return F.exists(locations, near)


def grid_cell(lat: Column, lon: Column, degrees: float = 5.0) -> Column:
    """Name of the grid cell of a point, usable as a partition column."""
    return F.concat_ws(
        "_",
        F.floor((lat + 90) / degrees).cast("bigint").cast("string"),
        F.floor((lon + 180) / degrees).cast("bigint").cast("string"),
    )
