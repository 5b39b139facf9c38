"""Spans found in texts: from byte positions to rows of Spark, and the columns derived from them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType()),
]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

# A found span: row, kind number, first byte, byte after the last, whether a base rule found it.
Found = tuple[int, int, int, int, bool]


def to_arrow(found: list[Found], kinds: list[str], data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Per row a list of spans in code points of the row, by start, then kind as listed."""
    found = sorted(found, key=lambda f: (f[0], f[2], f[1]))
    points = np.concatenate([[0], np.cumsum(A.code_points(data))])
    row = np.array([f[0] for f in found], np.int64)
    base = points[bounds[row]]
    lo = points[np.array([f[2] for f in found], np.int64)] - base
    hi = points[np.array([f[3] for f in found], np.int64)] - base
    entries = pa.StructArray.from_arrays(
        [pa.array([kinds[f[1]] for f in found], pa.string()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()),
         pa.array([f[4] for f in found], pa.bool_())], names=["kind", "start", "end", "base"])
    offsets = np.searchsorted(row, np.arange(len(bounds)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_of(spans: Column, kind: str) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")
