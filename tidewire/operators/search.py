"""Nearest-neighbour search over the vector table, one request or many.

Requests are written to the shared folder, not collected.  The table is scanned
once for any number of them: each task buffers its own rows (id, month, vector
and the filter columns only), then reads the stored requests block by block (at
most ``BLOCK``), scores its rows against a block with one matrix product per
slice, rescoring candidates exactly, and keeps the best rows of each request of
the block until its rows are done.  Only (request, id, month, distance) leave the
task; pairs are never materialised.  Ranking runs in slices, then whole; the
winners are joined back to the table for the other columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .embed import Embedder

BLOCK = 4096  # request vectors a task holds at once: 50 MB at 1536 dimensions
CELLS = 4_000_000  # distances held at once in a task
SALTS = 32
DEFAULT_LIMIT = 10
RESULT_COLUMNS = [
    "gkg_record_id",
    "date",
    "themes",
    "persons",
    "organizations",
    "locations",
    "countries",
    "tone",
    "source",
    "source_url",
]


# ---------------------------------------------------------------- filters


def within_dates(
    date_from: str | None, date_to: str | None, month: str | None = "year_month"
) -> Column:
    """Inclusive date bounds, with the folder bounds that follow from them.

    Rows whose date is too short to name a month lie in folder ``unknown`` and
    are decided by the date alone.
    """
    ok = F.lit(True)
    if date_from:
        ok = ok & (F.col("date") >= date_from)
    if date_to:
        ok = ok & (F.col("date") <= date_to)
    if month and (date_from or date_to):
        folder = F.lit(True)
        if date_from:
            folder = folder & (F.col(month) >= date_from[:6])
        if date_to:
            folder = folder & (F.col(month) <= date_to[:6])
        ok = ok & (folder | (F.col(month) == "unknown"))
    return ok


def in_countries(codes: Iterable[str] | None) -> Column:
    """Any exact code match; no codes, no filter."""
    codes = list(codes or [])
    if not codes:
        return F.lit(True)
    return F.arrays_overlap(F.col("countries"), F.array(*[F.lit(c) for c in codes]))


def has_themes(terms: Iterable[str] | None) -> Column:
    """Any term found, in any case, in the space-joined themes."""
    terms = list(terms or [])
    if not terms:
        return F.lit(True)
    joined = F.lower(F.array_join("themes", " "))
    ok = F.lit(False)
    for term in terms:
        ok = ok | F.contains(joined, F.lower(F.lit(term)))
    return ok


# ---------------------------------------------------------------- requests


def check_requests(requests: DataFrame) -> DataFrame:
    """Add ``is_valid`` and ``problem``; a missing limit becomes the default."""
    eight = r"^[0-9]{8}\z"

    def date_ok(name: str) -> Column:
        return F.col(name).isNull() | F.col(name).rlike(eight)

    length = F.length("query")
    limit = F.coalesce(F.col("limit"), F.lit(DEFAULT_LIMIT))
    problem = (
        F.when(F.col("query").isNull() | (length < 3) | (length > 1000), F.lit("query"))
        .when(~limit.between(1, 100), F.lit("limit"))
        .when(~date_ok("date_from"), F.lit("date_from"))
        .when(~date_ok("date_to"), F.lit("date_to"))
    )
    return requests.withColumns(
        {"limit": limit, "problem": problem, "is_valid": problem.isNull()}
    )


def valid_requests(requests: DataFrame) -> DataFrame:
    return check_requests(requests).where("is_valid").drop("is_valid", "problem")


def rejected_requests(requests: DataFrame) -> DataFrame:
    return check_requests(requests).where(~F.col("is_valid")).drop("is_valid")


def embed_requests(requests: DataFrame, embedder: Embedder) -> DataFrame:
    """Add the query vector; equal query texts are embedded once."""
    texts = embedder.embed(requests.select("query").distinct(), "query", "vector")
    return requests.join(texts, "query")


# ---------------------------------------------------------------- scoring


def finite(vector: Column) -> Column:
    """The vector is there and holds finite numbers only."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list column -> float64 matrix, and which rows hold finite numbers only.

    Other rows (null, or with a null, NaN or infinite component) are zero.
    Fails on any other width.
    """
    there = column.is_valid().to_numpy(zero_copy_only=False)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if len(flat) != there.sum() * width:
        raise ValueError(f"vectors are not {width} wide")
    rows = np.zeros((len(column), width))
    rows[there] = flat.reshape(-1, width)
    usable = there & np.isfinite(rows).all(axis=1)
    rows[~usable] = 0.0
    return rows, usable


def _squared(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.square(rows - query).sum(axis=1)


def _with_request_columns(requests: DataFrame) -> DataFrame:
    """All request columns, absent ones as null or default."""
    types = {
        "date_from": "string",
        "date_to": "string",
        "countries": "array<string>",
        "themes": "array<string>",
    }
    out = requests
    for name, kind in types.items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    if "limit" not in out.columns:
        out = out.withColumn("limit", F.lit(DEFAULT_LIMIT))
    limit = F.coalesce(F.col("limit"), F.lit(DEFAULT_LIMIT)).alias("limit")
    return out.select(F.col("qid").cast("string").alias("qid"), "vector", limit, *types)



# ---------------------------------------------------------------- one scan for all requests

# Requests as they are stored in the shared folder, which every task reads block by block.
REQUEST_TABLE = T.StructType([
    T.StructField("_number", T.LongType()), T.StructField("qid", T.StringType()),
    T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("_keep", T.IntegerType()),
    T.StructField("_limit", T.IntegerType()), T.StructField("date_from", T.StringType()),
    T.StructField("date_to", T.StringType()), T.StructField("countries", T.ArrayType(T.StringType())),
    T.StructField("themes", T.ArrayType(T.StringType())),
])
PAIRS = 1 << 16  # candidate pairs rescored exactly at once
BROADCAST_WINNERS = 1_000_000  # winners joined back by broadcast up to this bound


def _filesystem(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def request_blocks(path: str, size: int) -> Iterator[pa.Table]:
    """The stored requests, ``size`` rows at a time, read by a task from the shared folder."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, root = _filesystem(path)
    files = sorted(
        i.path for i in fs.get_file_info(pafs.FileSelector(root))
        if i.is_file and i.base_name.endswith(".parquet") and not i.base_name.startswith(("_", "."))
    )
    held, count = [], 0
    for name in files:
        for batch in pq.ParquetFile(name, filesystem=fs).iter_batches(batch_size=size):
            held.append(batch)
            count += batch.num_rows
            while count >= size:
                whole = pa.Table.from_batches(held)
                yield whole.slice(0, size)
                rest = whole.slice(size)
                held, count = rest.to_batches(), rest.num_rows
    if count:
        yield pa.Table.from_batches(held)


def store_requests(requests: DataFrame, keep_factor: int = 1) -> str:
    """Write the requests, numbered, to the shared folder; return its path.

    Requests are never collected: tasks read them from there.  ``keep_factor`` times
    the limit is fetched.
    """
    asked = _with_request_columns(requests)
    rows = asked.select(
        F.monotonically_increasing_id().alias("_number"), "qid", F.col("vector").cast("array<double>").alias("vector"),
        (F.col("limit") * keep_factor).cast("int").alias("_keep"), F.col("limit").cast("int").alias("_limit"),
        "date_from", "date_to", "countries", "themes",
    )
    path = scratch_path(requests.sparkSession, "requests")
    rows.write.parquet(path)
    return path


def _ranks(*arrays: np.ndarray) -> list[np.ndarray]:
    """Integer stand-ins for strings that compare as the strings do; null becomes -1."""
    flat = np.concatenate([np.asarray(a, dtype=object) for a in arrays]) if arrays else np.zeros(0, object)
    there = np.array([v is not None for v in flat], bool)
    ranks = np.full(len(flat), -1, np.int64)
    if there.any():
        values = flat[there].astype(str)
        uniq, inverse = np.unique(values, return_inverse=True)
        ranks[there] = inverse
    out, at = [], 0
    for a in arrays:
        out.append(ranks[at : at + len(a)])
        at += len(a)
    return out


class _Rows:
    """The rows of one task, buffered once, with what the filters of any request need."""

    def __init__(self, table: pa.Table, key: str, month: str | None):
        self.table = table
        self.n = table.num_rows
        ids = np.array(table.column(key).to_pylist(), dtype=object)
        self.ids = ids
        order = sorted(range(self.n), key=lambda i: (ids[i] is None, ids[i] or ""))
        self.id_rank = np.empty(self.n, np.int64)
        self.id_rank[order] = np.arange(self.n)
        self.months = table.column(month).to_pylist() if month else [None] * self.n
        self.month = month
        self._dates = table.column("date").to_pylist()
        self._countries = None
        self._themes = None

    def allowed(self, req: pa.Table, lists: bool, start: int, stop: int) -> np.ndarray | None:
        """rows[start:stop] x requests: which rows each request may see; None when no request filters.

        Without ``lists`` only the dates count.  Made slice by slice, so that it
        never holds more cells than the distances of the slice."""
        b = req.num_rows
        n = stop - start
        ok = np.ones((n, b), bool)
        froms, tos = req.column("date_from").to_pylist(), req.column("date_to").to_pylist()
        filtered = False
        if any(froms) or any(tos):
            filtered = True
            dates, months = self._dates[start:stop], self.months[start:stop]
            low = [f[:6] if f else None for f in froms]
            high = [t[:6] if t else None for t in tos]
            d, m, f, t, lo6, hi6 = _ranks(dates, months, froms, tos, low, high)
            dated = d >= 0
            unknown = np.array([x == "unknown" for x in months], bool)
            for j in range(b):
                if froms[j]:
                    ok[:, j] &= dated & (d >= f[j])
                    if self.month:
                        ok[:, j] &= (m >= lo6[j]) | unknown
                if tos[j]:
                    ok[:, j] &= dated & (d <= t[j])
                    if self.month:
                        ok[:, j] &= ((m >= 0) & (m <= hi6[j])) | unknown
        asked = req.column("countries").to_pylist() if lists else []
        if any(asked):
            filtered = True
            names = sorted({c for cs in asked if cs for c in cs if c is not None})
            where = {c: i for i, c in enumerate(names)}
            has = np.zeros((n, len(names)), np.float32)
            if self._countries is None:
                self._countries = self.table.column("countries").to_pylist()
            for i, cs in enumerate(self._countries[start:stop]):
                for c in cs or ():
                    if c in where:
                        has[i, where[c]] = 1
            want = np.zeros((len(names), b), np.float32)
            for j, cs in enumerate(asked):
                for c in cs or ():
                    if c is not None:
                        want[where[c], j] = 1
            overlap = (has @ want) > 0
            for j, cs in enumerate(asked):
                if cs:
                    ok[:, j] &= overlap[:, j]
        terms = req.column("themes").to_pylist() if lists else []
        if any(terms):
            filtered = True
            words = sorted({t.lower() for ts in terms if ts for t in ts if t is not None})
            if self._themes is None:
                lists_of = self.table.column("themes").to_pylist()
                self._themes = pa.array([None if x is None else " ".join(v for v in x if v is not None).lower() for x in lists_of],
                                        pa.string())
            import pyarrow.compute as pc

            joined = self._themes.slice(start, n)
            found = np.stack([pc.fill_null(pc.match_substring(joined, w), False).to_numpy(zero_copy_only=False)
                              for w in words], 1).astype(np.float32)
            want = np.zeros((len(words), b), np.float32)
            where = {w: i for i, w in enumerate(words)}
            for j, ts in enumerate(terms):
                for t in ts or ():
                    if t is not None:
                        want[where[t.lower()], j] = 1
            any_term = (found @ want) > 0
            for j, ts in enumerate(terms):
                if ts:
                    ok[:, j] &= any_term[:, j]
        return ok if filtered else None


def _best_of_task(path: str, key: str, month: str | None, lists: bool):
    """Arrow function: a task's rows -> at most ``_keep`` (id, distance) rows per request."""
    block_rows, cells = BLOCK, CELLS  # as set when the plan is made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = _Rows(pa.Table.from_batches(held), key, month)
        if not rows.n:
            return
        vectors = rows.table.column("_vector").combine_chunks()
        for req in request_blocks(path, block_rows):
            wanted = req.column("vector").to_pylist()
            valid = np.array([v is not None and all(x is not None and math.isfinite(x) for x in v) for v in wanted], bool)
            if not valid.any():
                continue
            req = req.filter(pa.array(valid))
            queries = np.array(req.column("vector").to_pylist(), dtype=np.float64)
            if queries.ndim != 2:
                raise ValueError("request vectors are not all equally wide")
            width = queries.shape[1]
            b = len(queries)
            keep = np.maximum(np.array(req.column("_keep").to_pylist(), np.int64), 0)
            q_norms = np.square(queries).sum(axis=1)
            best_q = best_r = np.zeros(0, np.int64)
            best_d = np.zeros(0)
            worst = np.full(b, np.inf)
            step = max(1, cells // b)
            for start in range(0, rows.n, step):
                part, usable = _matrix(vectors.slice(start, step), width)
                near = np.square(part).sum(axis=1)[:, None] + q_norms[None, :] - 2.0 * (part @ queries.T)
                allowed = rows.allowed(req, lists, start, start + len(part))
                mask = usable[:, None] if allowed is None else usable[:, None] & allowed
                near[~np.broadcast_to(mask, near.shape)] = np.inf
                slack = 1e-9 * (1.0 + np.square(part).sum(axis=1).max(initial=0.0) + q_norms)
                k_eff = np.clip(keep, 1, len(part))
                kth = np.partition(near, np.unique(k_eff - 1), axis=0)[k_eff - 1, np.arange(b)]
                bound = np.minimum(worst, kth) + slack
                r_idx, q_idx = np.nonzero((near <= bound[None, :]) & np.isfinite(near) & (keep > 0)[None, :])
                exact = np.empty(len(r_idx))
                for s0 in range(0, len(r_idx), PAIRS):
                    sl = slice(s0, s0 + PAIRS)
                    exact[sl] = np.square(part[r_idx[sl]] - queries[q_idx[sl]]).sum(axis=1)
                all_q = np.concatenate([best_q, q_idx])
                all_r = np.concatenate([best_r, r_idx + start])
                all_d = np.concatenate([best_d, exact])
                order = np.lexsort((rows.id_rank[all_r], all_d, all_q))
                all_q, all_r, all_d = all_q[order], all_r[order], all_d[order]
                first = np.concatenate([[True], all_q[1:] != all_q[:-1]]) if len(all_q) else np.zeros(0, bool)
                place = np.arange(len(all_q)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(all_q) else all_q
                kept = place < keep[all_q]
                best_q, best_r, best_d = all_q[kept], all_r[kept], all_d[kept]
                full = np.bincount(best_q, minlength=b) >= keep
                last = np.full(b, np.inf)
                if len(best_q):
                    tail = np.concatenate([best_q[1:] != best_q[:-1], [True]])
                    last[best_q[tail]] = best_d[tail]
                worst = np.where(full, last, np.inf)
            if not len(best_q):
                continue
            columns = [
                pa.array(np.array(req.column("_number").to_pylist(), np.int64)[best_q], pa.int64()),
                req.column("qid").combine_chunks().take(pa.array(best_q)),
                pa.array(keep[best_q].astype(np.int32), pa.int32()),
                pa.array(np.array(req.column("_limit").to_pylist(), np.int64)[best_q].astype(np.int32), pa.int32()),
                pa.array(best_d, pa.float64()),
                rows.table.column(key).combine_chunks().take(pa.array(best_r)),
            ]
            names = ["_number", "qid", "_keep", "_limit", "distance", key]
            if month:
                columns.append(rows.table.column(month).combine_chunks().take(pa.array(best_r)))
                names.append("_month")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _date_bounds(path: str, spark: SparkSession) -> tuple[str | None, str | None]:
    """The widest dates any request allows, for the scan; None where some request is open."""
    r = spark.read.schema(REQUEST_TABLE).parquet(path).agg(
        F.min("date_from").alias("lo"), F.max("date_to").alias("hi"),
        F.count(F.lit(1)).alias("n"), F.count("date_from").alias("n_lo"), F.count("date_to").alias("n_hi"),
        F.max("_keep").alias("most"),
    ).first()
    return (r.lo if r.n and r.n_lo == r.n else None, r.hi if r.n and r.n_hi == r.n else None, r.n, r.most or 0)


def knn_batch(
    store: DataFrame,
    requests: DataFrame,
    mode: str = "prefilter",
    payload: Iterable[str] | None = None,
    key: str = "gkg_record_id",
    vector: str = "vector",
) -> DataFrame:
    """Nearest rows of every request (qid, vector and, optionally, limit,
    date_from, date_to, countries, themes): ascending squared distance, ties by
    id, ``rank`` from 1.

    ``prefilter`` applies all filters before ranking (exact).  ``overfetch``
    ranks twice the limit under the date filter only, then applies the country
    and theme filters and cuts to the limit; deeper matches are lost.

    The requests are written to the shared folder and never pass the driver; the
    table is scanned once for all of them: each task buffers its own rows (id,
    vector, filter columns) and reads the requests block by block, keeping the best
    rows of each request.  Only ids and distances leave the tasks; the winners are
    joined back to the table (by month and id) for the other columns.  A request
    whose vector is null or holds a number that is not finite has no rows.
    """
    plan = _Plan(store, mode, payload, key, vector)
    return plan.answer(store_requests(requests, 1 if plan.exact else 2))


@dataclass
class _Plan:
    """What all passes over the table have in common."""

    store: DataFrame
    mode: str
    payload: Iterable[str] | None
    key: str
    vector: str

    def __post_init__(self) -> None:
        if self.mode not in ("prefilter", "overfetch"):
            raise ValueError(f"Unknown mode: {self.mode}")
        self.exact = self.mode == "prefilter"
        columns = list(self.payload or [c for c in RESULT_COLUMNS if c in self.store.columns])
        needed = [self.key] if self.exact else [self.key, "countries", "themes"]
        self.payload = [c for c in needed if c not in columns] + columns

    def answer(self, path: str) -> DataFrame:
        """Ranked rows of all stored requests."""
        spark: SparkSession = self.store.sparkSession
        month = "year_month" if "year_month" in self.store.columns else None
        lo, hi, n_requests, most = _date_bounds(path, spark)
        rows = self.store.where(within_dates(lo, hi, month)) if (lo or hi) else self.store
        filters = [c for c in ("date", "countries", "themes") if c in self.store.columns]
        scanned = rows.select(self.key, *([month] if month else []), F.col(self.vector).alias("_vector"), *filters)
        for c in ("date", "countries", "themes"):
            if c not in filters:
                scanned = scanned.withColumn(c, F.lit(None).cast("string" if c == "date" else "array<string>"))
        schema = T.StructType(
            [T.StructField("_number", T.LongType()), T.StructField("qid", T.StringType()),
             T.StructField("_keep", T.IntegerType()), T.StructField("_limit", T.IntegerType()),
             T.StructField("distance", T.DoubleType()), self.store.schema[self.key]]
            + ([T.StructField("_month", T.StringType())] if month else [])
        )
        near = scanned.mapInArrow(_best_of_task(path, self.key, month, self.exact), schema)
        # Many tasks may send rows for one request: rank in slices first, then all.
        salted = W.partitionBy("_number", "_salt").orderBy("distance", self.key)
        whole = W.partitionBy("_number").orderBy("distance", self.key)
        ranked = (
            near.withColumn("_salt", F.pmod(F.xxhash64(self.key), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(salted))
            .where(F.col("rank") <= F.lit(max(int(most), 1)))
            .withColumn("rank", F.row_number().over(whole))
            .where((F.col("rank") <= F.lit(max(int(most), 1))) & (F.col("rank") <= F.col("_keep")))
            .drop("_salt", "_keep")
        )
        # late columns: joined by month and id; the winners are at most requests x their limits
        by = [self.key] + (["_month"] if month else [])
        extra = [c for c in self.payload if c != self.key]
        side = self.store.select(self.key, *([F.col(month).alias("_month")] if month else []), *extra)
        winners = F.broadcast(ranked) if n_requests * max(int(most), 1) <= BROADCAST_WINNERS else ranked
        joined = winners.join(side, by).drop(*(["_month"] if month else []))
        ordered = joined.select("_number", "qid", "distance", *self.payload, "rank", "_limit")
        if self.exact:
            return ordered.drop("_number", "_limit")
        lists = spark.read.schema(REQUEST_TABLE).parquet(path).select(
            "_number", F.col("countries").alias("_countries"), F.col("themes").alias("_themes"))
        return _postfilter(ordered.join(F.broadcast(lists) if n_requests <= BROADCAST_WINNERS else lists, "_number"), self.key)


def _postfilter(ranked: DataFrame, key: str) -> DataFrame:
    """Country and theme filters on ranked rows, then the cut to the limit."""
    joined = F.lower(F.array_join("themes", " "))
    country_ok = (F.coalesce(F.size("_countries"), F.lit(0)) <= 0) | F.arrays_overlap("countries", "_countries")
    theme_ok = (F.coalesce(F.size("_themes"), F.lit(0)) <= 0) | F.exists("_themes", lambda t: F.contains(joined, F.lower(t)))
    place = W.partitionBy("_number").orderBy("distance", key)
    return (
        ranked.where(country_ok & theme_ok)
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= F.col("_limit"))
        .drop("_number", "_limit", "_countries", "_themes")
    )


def knn_search(
    store: DataFrame,
    query_vector: Iterable[float],
    limit: int = DEFAULT_LIMIT,
    date_from: str | None = None,
    date_to: str | None = None,
    countries: Iterable[str] | None = None,
    themes: Iterable[str] | None = None,
    mode: str = "prefilter",
    payload: Iterable[str] | None = None,
    key: str = "gkg_record_id",
    vector: str = "vector",
) -> DataFrame:
    """Nearest rows to one vector: a request table of one row."""
    spark = store.sparkSession
    request = spark.createDataFrame(
        [("q", [float(x) for x in query_vector], int(limit), date_from, date_to, list(countries or []), list(themes or []))],
        "qid string, vector array<double>, limit int, date_from string, date_to string, countries array<string>, "
        "themes array<string>",
    )
    return knn_batch(store, request, mode, payload, key, vector).drop("qid")


def score(distance: Column) -> Column:
    return F.lit(1.0) - distance


def result_projection(ranked: DataFrame) -> DataFrame:
    """Result columns with defaults for missing values."""
    lists = {"themes", "persons", "organizations", "locations", "countries"}

    def column(name: str) -> Column:
        if name not in ranked.columns:
            default = F.array().cast("array<string>") if name in lists else F.lit("")
            return (F.lit(0.0).cast("float") if name == "tone" else default).alias(name)
        if name in lists:
            return F.coalesce(F.col(name), F.array().cast("array<string>")).alias(name)
        if name == "tone":
            return F.coalesce(F.col(name), F.lit(0.0).cast("float")).alias(name)
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    lead = [c for c in ("qid", "rank") if c in ranked.columns]
    return ranked.select(
        *lead,
        *[column(c) for c in RESULT_COLUMNS],
        score(F.coalesce(F.col("distance"), F.lit(0.0))).alias("score"),
    )


def search_text(
    store: DataFrame,
    requests: DataFrame,
    embedder: Embedder,
    mode: str = "prefilter",
) -> DataFrame:
    """Answer text requests: validate, embed, rank, shape.  Invalid requests are
    found with ``rejected_requests``."""
    asked = embed_requests(valid_requests(requests), embedder)
    return result_projection(knn_batch(store, asked, mode))


# ---------------------------------------------------------------- whole profile


def distance_profile(
    store: DataFrame, requests: DataFrame, vector: str = "vector"
) -> DataFrame:
    """Every request against every row, folded per request (qid) while scoring:
    number of rows, least, greatest and mean squared distance.  Vectors that are
    null or not finite take no part.  One scan; each task reads the stored requests
    block by block and sends one row per request."""
    path = store_requests(requests.where(finite(F.col("vector"))))
    ddl = "qid string, n bigint, lo double, hi double, total double"
    block_rows, cells = BLOCK, CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        column = pa.Table.from_batches(held).column(0).combine_chunks()
        for req in request_blocks(path, block_rows):
            qids = req.column("qid").to_pylist()
            queries = np.array(req.column("vector").to_pylist(), dtype=np.float64)
            n, lo, hi, total = 0, np.inf, -np.inf, 0.0
            step = max(1, cells // max(1, len(qids)))
            for start in range(0, len(column), step):
                data, usable = _matrix(column.slice(start, step), queries.shape[1])
                data = data[usable]
                if not len(data):
                    continue
                near = (
                    np.square(data).sum(axis=1)[:, None]
                    + np.square(queries).sum(axis=1)[None, :]
                    - 2.0 * (data @ queries.T)
                )
                n += len(data)
                lo = np.minimum(lo, near.min(axis=0))
                hi = np.maximum(hi, near.max(axis=0))
                total = total + near.sum(axis=0)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids, pa.string()), pa.array([n] * len(qids), pa.int64()), *map(pa.array, (lo, hi, total))],
                    names=["qid", "n", "lo", "hi", "total"],
                )

    parts = store.select(vector).mapInArrow(run, ddl)
    return parts.groupBy("qid").agg(
        F.sum("n").alias("n_candidates"),
        F.min("lo").alias("min_distance"),
        F.max("hi").alias("max_distance"),
        (F.sum("total") / F.sum("n")).alias("avg_distance"),
    )
