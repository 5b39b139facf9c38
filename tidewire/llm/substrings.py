"""Removal of repeated substrings by bucket-pointer refinement of sampled suffixes.

Every window of ``length`` bytes holds at least one sampled q-gram (the one of
least hash).  Sampled suffixes fall into buckets by their q-gram; buckets that
hold one document are done.  The others are refined by the bytes around: equal
surroundings decide all windows through the q-gram at once.  Windows that stay
open go to the bucket of their q-gram, where identifiers of longer prefixes are
made from identifiers at later offsets (20, then 40, then 50 bytes), each reused
for the next, and each time buckets of one document are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .steps import broadcast_if_small, store

LENGTH = 50
GRAM = 20
# Surroundings of one q-gram in one slice of texts beyond which they are dealt out one by one.
HOT = 32
# Rows that are refined together.
BLOCK_ROWS = 20_000
# Keys that are broadcast to pick texts before these are shuffled (about 60 bytes each).
BROADCAST_KEYS = 400_000
NO_ID = (1 << 63) - 1
TOP = np.uint64((1 << 64) - 1)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Rolling:
    """Hashes of any byte spans of one array from one running sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        with np.errstate(over="ignore"):
            if len(_powers[0]) <= n:
                for k, base in enumerate((A.BASE, A.BASE_INVERSE)):
                    _powers[k] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n + (n >> 1), base)]))
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(A.BYTE_CODE[data] * _powers[0][:n], out=self.sums[1:])
            self.inverse = _powers[1][: n + 1]

    def grams(self, q: int) -> np.ndarray:
        """Hashes of the q bytes from every position that has so many behind it."""
        with np.errstate(over="ignore"):
            return A.mix((self.sums[q:] - self.sums[:-q]) * self.inverse[: len(self.sums) - q] + np.uint64(q))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return A.mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + A.mix((ends - starts).astype(np.uint64)))


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every run of ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x, have = best(x[:-have], x[have:]), have * 2
    return best(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def short_of(bounds: np.ndarray, need: int, n: int) -> np.ndarray:
    """Positions with fewer than ``need`` bytes to the end of their row."""
    at = (bounds[1:, None] - np.arange(1, need)).ravel()
    at = at[at >= np.repeat(bounds[:-1], need - 1)]
    return at[at < n]


class Samples:
    """Sampled suffixes of texts: places, q-gram hashes, rows, surroundings."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int, q: int):
        n, w = len(data), length - q + 1
        self.length, self.width = length, w
        if n < length:
            self.at = np.zeros(0, np.int64)
            self.h = self.c = np.zeros(0, np.uint64)
            self.row = self.at
            self.open, self.least = np.zeros(0, bool), self.h
            return
        rolling = Rolling(data)
        h = rolling.grams(q)
        valid = np.ones(len(h), bool)
        valid[(s := short_of(bounds, q, n))[s < len(h)]] = False
        h[~valid] = TOP
        self.least = sliding(h, w, np.minimum)
        self.open = np.ones(len(self.least), bool)  # windows that lie within a row
        self.open[(s := short_of(bounds, length, n))[s < len(self.open)]] = False
        pad = np.zeros(w - 1, np.uint64)
        chosen = sliding(np.concatenate([pad, np.where(self.open, self.least, 0), pad]), w, np.maximum)
        self.at = np.flatnonzero((chosen == h) & valid)
        self.h, self.row = h[self.at], A.row_of(bounds, self.at)
        self.lo = np.maximum(self.at - (length - q), bounds[self.row])
        self.hi = np.minimum(self.at + length, bounds[self.row + 1])
        shape = A.mix(((self.at - self.lo) * 128 + (self.hi - self.at)).astype(np.uint64))
        self.c = rolling.spans(self.lo, self.hi) ^ shape


def keys_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part["key"].to_numpy(zero_copy_only=False), part["mark"].to_numpy(zero_copy_only=False)


def sample_rows(length: int, q: int):
    """(h, c, hot, key, mark): samples of texts, the same surroundings once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                s = Samples(*A.byte_view(part["text"]), length, q)
                if not len(s.at):
                    continue
                key, mark = keys_of(part)
                order = np.lexsort((s.row, s.c, s.h))
                h, c, row = s.h[order], s.c[order], s.row[order]
                new_h = np.concatenate([[True], h[1:] != h[:-1]])
                new_c = new_h | np.concatenate([[True], c[1:] != c[:-1]])
                once = new_c | np.concatenate([[True], row[1:] != row[:-1]])
                many = np.bincount(np.cumsum(new_h) - 1, new_c) > HOT
                hot = many[np.cumsum(new_h) - 1]
                signs = h[new_h][many]  # tell the q-gram's own place that it is hot
                h, c, row, hot = h[once], c[once], row[once], hot[once]
                none = np.full(len(signs), NO_ID)
                cols = [
                    np.concatenate([h, signs]).view(np.int64),
                    np.concatenate([c.view(np.int64), -none - 1]), np.concatenate([hot, np.ones(len(signs), bool)]),
                    np.concatenate([key[row], none]), np.concatenate([mark[row], np.zeros(len(signs), np.int64)]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["h", "c", "hot", "key", "mark"])

    return run


def flag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of samples sorted by h, c, key those that matter, each with ``seen``: an earlier document has
    the same surroundings.  Of a q-gram that several documents hold in several surroundings all
    rows matter, of others those that are seen.  What is held back between batches is one
    q-gram's rows, either of one document or one row."""
    held: list[np.ndarray] = []
    last: tuple | None = None  # h, c and first key of the row before, in a q-gram all of whose rows matter
    names = ["h", "c", "hot", "key", "mark"]

    def settle(cols: list[np.ndarray], final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, last
        h, c, hot, key, mark = cols
        n = len(h)
        goes_on = last is not None and n > 0 and h[0] == last[0]
        new_h = np.concatenate([[not goes_on], h[1:] != h[:-1]])
        starts = np.unique(np.concatenate([[0], np.flatnonzero(new_h)]))
        group = np.searchsorted(starts, np.arange(n), "right") - 1
        mixed = np.maximum.reduceat(key, starts) != np.minimum.reduceat(key, starts)
        mixed &= np.maximum.reduceat(c, starts) != np.minimum.reduceat(c, starts)
        mixed |= np.logical_or.reduceat(hot, starts)
        mixed[0] |= goes_on
        new_c = new_h | np.concatenate([[not goes_on or c[0] != last[1]], c[1:] != c[:-1]])
        first_at = np.maximum.accumulate(np.where(new_c, np.arange(n), -1))
        first_key = np.where(first_at >= 0, key[np.maximum(first_at, 0)], last[2] if goes_on else 0)
        seen = key > first_key
        matters = (mixed[group] | seen) & (c != -NO_ID - 1)
        if mixed[-1]:
            last = (h[-1], c[-1], first_key[-1])
        else:
            last = None
            if not final:  # wait for more of the last q-gram
                wait = (group == len(starts) - 1) & ~seen
                held = [x[wait] for x in cols]
        keep = np.flatnonzero(matters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in (key, mark, c, seen)], names=["key", "mark", "c", "seen"])

    for batch in batches:
        if batch.num_rows:
            cols = [batch[x].to_numpy(zero_copy_only=False) for x in names]
            if held:
                cols, held = [np.concatenate(x) for x in zip(held, cols)], []
            yield from settle(cols, False)
    if held and len(held[0]):
        rest, held = held, []
        yield from settle(rest, True)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def open_runs(length: int, q: int):
    """Of texts with their flagged surroundings: decided spans (h null), and runs of open windows
    for the bucket of their least q-gram."""
    names = ["key", "mark", "text_hash", "start", "stop", "h", "run"]
    width = length - q + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            for part in A.slices(batch, "text"):
                data, bounds = A.byte_view(part["text"])
                s = Samples(data, bounds, length, q)
                if not len(s.at):
                    continue
                key, mark = keys_of(part)
                lists = part["flags"]
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                c = flat.field("c").to_numpy(zero_copy_only=False).view(np.uint64)
                seen = flat.field("seen").to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(sizes)), sizes)
                asked, told = A.with_row(s.c, s.row), A.with_row(c, row)
                order = np.lexsort((seen, told))  # the last of equal ones says "seen" if any does
                told, seen = told[order], seen[order]
                at = np.searchsorted(told, asked, "right") - 1
                shared = (at >= 0) & (told[np.maximum(at, 0)] == asked) if len(told) else np.zeros(len(asked), bool)
                done = shared & seen[np.maximum(at, 0)] if len(told) else shared
                done &= s.hi - s.lo >= length
                out: list[tuple] = []
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, s.lo[done], 1)
                np.add.at(edge, s.hi[done], -1)
                decided = np.cumsum(edge)[:-1] > 0
                # windows that lie within a row, are not decided, and whose least q-gram matters
                n = len(s.open)
                some, sure = (np.concatenate([[0], np.cumsum(np.bincount(s.at[x], minlength=len(data)))]) for x in (shared, done))
                j = np.arange(n)
                j = np.flatnonzero(s.open & (some[j + width] > some[j]) & (sure[j + width] == sure[j]))
                who = np.searchsorted(s.at, j)
                while len(wrong := np.flatnonzero(s.h[who] != s.least[j])):
                    who[wrong] += 1
                j, who = j[shared[who]], who[shared[who]]
                # spans never cross a row, but neighbouring rows' spans may touch
                at_row = np.zeros(len(data) + 1, bool)
                at_row[bounds] = True
                for a, b in zip(*runs_of(decided)):
                    cuts = [a, *(a + 1 + np.flatnonzero(at_row[a + 1 : b])).tolist(), b]
                    out += [(lo, hi, None, None) for lo, hi in zip(cuts[:-1], cuts[1:])]
                if len(j):
                    new = np.flatnonzero(np.concatenate([[True], (np.diff(j) > 1) | (np.diff(who) != 0)]))
                    ends = np.append(new[1:], len(j)) - 1
                    raw = data.tobytes()
                    for a, b, g in zip(j[new].tolist(), (j[ends] + length).tolist(), s.h[who[new]].view(np.int64).tolist()):
                        text, own = raw[a:b], int(key[A.row_of(bounds, np.array([a]))[0]])
                        first = met.get((g, text))
                        if first is not None and first < own:  # this task has met the same run earlier
                            out.append((a, b, None, None))
                            continue
                        if len(met) > 100_000:
                            met.clear()
                        met[g, text] = own
                        out.append((a, b, g, text))
                if out:
                    start = np.array([x[0] for x in out])
                    stop = np.array([x[1] for x in out])
                    r = A.row_of(bounds, start)
                    cols = [pa.array(key[r]), pa.array(mark[r]), part["text_hash"].take(pa.array(r)), pa.array(start - bounds[r]),
                            pa.array(stop - bounds[r]), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def refine(length: int, q: int):
    """Spans of windows that an earlier document holds too, from runs sorted by q-gram."""
    names = ["key", "mark", "text_hash", "start", "stop"]

    def decide(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(held)
        data, bounds = A.byte_view(rows["run"])
        key, start = rows["key"].to_numpy(), rows["start"].to_numpy()
        counts = np.diff(bounds) - length + 1
        owner = np.repeat(np.arange(len(counts)), counts)
        p = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[owner]
        first = Rolling(data).grams(q)  # initial buckets: q-grams
        alive = np.arange(len(p))
        ids = first[p]
        for reach in (2 * q, length):  # bucket so far, with that of the q bytes that end at ``reach``
            with np.errstate(over="ignore"):
                ids = A.mix(ids * A.BASE + first[p[alive] + reach - q])
            order = np.lexsort((key[owner[alive]], ids))
            ids, alive = ids[order], alive[order]
            new = np.concatenate([[True], ids[1:] != ids[:-1]])
            heads = np.flatnonzero(new)
            least = key[owner[alive[heads]]]
            most = key[owner[alive[np.append(heads[1:], len(ids)) - 1]]]
            several = (least < most)[np.cumsum(new) - 1]
            if reach == length:
                later = key[owner[alive]] > least[np.cumsum(new) - 1]
            ids, alive = ids[several], alive[several]
            if not len(ids):
                break
        hit = np.zeros(len(p), bool)
        if len(ids):
            hit[alive] = later[several]
        a, b = runs_of(hit)
        cuts = np.cumsum(counts)
        spans = []
        for lo, hi in zip(a.tolist(), b.tolist()):  # windows lo..hi-1, maybe of several rows
            while lo < hi:
                r = int(owner[lo])
                end = min(hi, int(cuts[r]))
                at = int(start[r]) + lo - int(cuts[r] - counts[r])
                spans.append((r, at, at + end - lo + length - 1))
                lo = end
        r = pa.array([x[0] for x in spans], pa.int64())
        return pa.RecordBatch.from_arrays(
            [rows[c].take(r) for c in names[:3]]
            + [pa.array([x[1] for x in spans], pa.int64()), pa.array([x[2] for x in spans], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            h = batch["h"].to_numpy()
            # the last q-gram may go on in the next batch
            cut = int(np.searchsorted(h, h[-1], "left")) if len(h) else 0
            if count + cut >= BLOCK_ROWS and cut:
                yield decide([*held, batch.slice(0, cut)])
                held, count = [batch.slice(cut)], batch.num_rows - cut
            elif count >= BLOCK_ROWS and held and len(h) and held[-1]["h"][-1].as_py() != h[0]:
                yield decide(held)
                held, count = [batch], batch.num_rows
            elif batch.num_rows:
                held.append(batch)
                count += batch.num_rows
        if held:
            yield decide(held)

    return run


def remove(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What stays of a text, and the maximal removed spans."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, at = [], 0
    for a, b in merged:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), [(a, b) for a, b in merged]


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                q: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, spans (removed, in bytes), kept_sha256.

    A byte goes if a string of ``length`` bytes that covers it also starts in a
    document with a smaller id; all is judged on the input.  Ids must be whole
    numbers.  A null id is larger than any other and equal to other null ids;
    equal ids are never smaller, so repeated rows do not remove each other.  A
    null text counts as empty.  An empty table gives an empty result; other
    columns are not read.  A task needs about 100 bytes for each byte of a slice of
    texts, or of the longest text.
    """
    if not isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"column {id_col} must hold whole numbers")
    if not 2 * q <= length <= 3 * q:
        raise ValueError("the length must be two to three times the length of the q-grams")
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    texts = docs.select(key.alias("key"), F.coalesce(text_col, F.lit("")).alias("text"), F.col(id_col).alias("id"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = store(texts.select("id", "key", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")), "rows")
    groups = rows.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("rows"))
    copies = store(
        rows.join(groups.filter("rows > 1"), "digest").filter("key > first").select("key", "digest").distinct(), "copies")

    # texts that are no copy of an earlier document's; documents without an id are told apart by their text
    own = texts.join(broadcast_if_small(copies, BROADCAST_KEYS), ["key", "digest"], "left_anti").filter(F.octet_length("text") >= length)
    hashed = F.xxhash64("text")
    own = own.select("key", F.when(F.col("key") == NO_ID, hashed).otherwise(F.lit(0).cast("bigint")).alias("mark"),
                     hashed.alias("text_hash"), "digest", "text")

    samples = own.select("key", "mark", "text").mapInArrow(
        sample_rows(length, q), "h long, c long, hot boolean, key long, mark long")
    # rows of a hot q-gram are dealt out by their surroundings, but for the one that tells the others
    place = F.when(F.col("hot") & (F.col("key") != NO_ID), F.xxhash64("h", "c")).otherwise(F.col("h"))
    flagged = store(
        samples.repartition(place).sortWithinPartitions("h", "c", "key")
        .mapInArrow(flag_rows, "key long, mark long, c long, seen boolean"), "flagged")

    flags = flagged.groupBy("key", "mark").agg(F.collect_list(F.struct("c", "seen")).alias("flags"))
    told = own.join(flags, ["key", "mark"]).select("key", "mark", "text_hash", "text", "flags")
    span = "key long, mark long, text_hash long, start long, stop long"
    found = store(told.mapInArrow(open_runs(length, q), f"{span}, h long, run binary"), "runs")

    runs = found.filter("h is not null").repartition("h").sortWithinPartitions("h")
    late = runs.mapInArrow(refine(length, q), span)
    spans = store(found.filter("h is null").select(late.columns).union(late), "spans")

    by_text = spans.groupBy("key", "mark", "text_hash").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    by_text = store(by_text, "by-text")
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "stop")]))),
        T.StructField("kept", T.StringType()),
    ])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                out = [remove(t.encode(), [(s["start"], s["stop"]) for s in x])
                       for t, x in zip(part["text"].to_pylist(), part["spans"].to_pylist())]
                spans_type = part["spans"].type
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["digest"], pa.array([[{"start": a, "stop": b} for a, b in s] for _, s in out], spans_type),
                     pa.array([hashlib.sha256(k).hexdigest() for k, _ in out])], names=schema.names)

    names = ["key", "mark", "text_hash"]
    changed = broadcast_if_small(by_text.select(*names), BROADCAST_KEYS)
    touched = own.join(changed, names, "left_semi").join(by_text.hint("merge"), names)
    cut = touched.select("key", "digest", "text", "spans").mapInArrow(rest, schema).dropDuplicates(["key", "digest"])

    copy = copies.withColumn("copy", F.lit(True))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop")))
    is_copy = F.col("copy") & (F.col("n_bytes") >= length)
    return rows.join(copy, ["key", "digest"], "left").join(cut, ["key", "digest"], "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(is_copy, whole).otherwise(F.coalesce("spans", F.array().cast(schema["spans"].dataType))).alias("spans"),
        F.when(is_copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", F.lower(F.hex("digest")))).alias("kept_sha256"))
