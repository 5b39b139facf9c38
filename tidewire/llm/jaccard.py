"""Similarity join on word n-grams: rare-first prefixes, with length, positional and suffix filters.

Documents with equal n-gram sets become one node.  Each node's n-grams are put in
one order for the whole corpus, rare ones first, and two sets can only be similar
enough if their prefixes meet.  Nodes that meet are first compared with one hub
for each n-gram; what these comparisons connect need not be compared again, so
only pairs across components are enumerated after that.  Every pair that passes
the filters is verified once on the full sets.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path
from . import arrays as A
from .components import components
from .steps import broadcast_if_small, free_name, step, store

# Bits of an n-gram's hash that name its cell in the table of frequencies (4 MB on every worker).
CELL_BITS = 22
CHUNK_BITS = 16
# 64-bit words of a node's parity sketch.
SKETCH = 8
# Rows of a table of nodes, pairs or keys that may be broadcast (tens of bytes each).
BROADCAST_NODES = 500_000


def gram_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text; shorter texts are one gram, texts without words none."""
    data, bounds = A.byte_view(column)
    data = A.LOWER[data]
    starts, ends = A.word_spans(data, bounds)
    words = A.hash_spans(data, starts, ends)
    at = np.searchsorted(starts, bounds)
    grams = A.gram_hashes(words, k)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        if hi - lo >= k:
            g = np.sort(grams[lo : hi - k + 1])
            g = g[np.concatenate([[True], g[1:] != g[:-1]])] if len(g) > 1 else g
        else:
            g = A.gram_hashes(words[lo:hi], hi - lo) if hi > lo else grams[:0]
        out.append(g)
    return out


def frequencies(texts: DataFrame, text_col: str, k: int) -> np.ndarray:
    """How often n-grams occur, per cell of hashes, on a logarithmic scale (0: once at most).

    Every task counts the sets of all its texts; the table has a fixed size
    whatever the input.
    """
    size = 1 << CHUNK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            for part in A.slices(batch, text_col):
                sets = gram_sets(part[text_col], k)
                if sets:
                    at, times = np.unique(np.sort(np.concatenate(sets) >> np.uint64(64 - CELL_BITS)), return_counts=True, sorted=True)
                    cells[at.astype(np.int64)] += times.astype(np.uint32)
        for c in range(len(cells) // size):
            part = cells[c * size : (c + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["chunk", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, raw in zip(batch["chunk"].to_pylist(), batch["cells"]):
                part = np.frombuffer(zlib.decompress(raw.as_py()), np.uint32)
                sums[c] = sums.get(c, 0) + part.astype(np.uint64)
        for c, total in sums.items():
            level = np.minimum(np.ceil(8 * np.log2(np.maximum(total, 1))), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["chunk", "cells"])

    schema = "chunk int, cells binary"
    chunks = 1 << (CELL_BITS - CHUNK_BITS)
    summed = texts.select(text_col).mapInArrow(count, schema).repartition(chunks, "chunk").mapInArrow(add, schema)
    table = np.zeros(1 << CELL_BITS, np.uint8)
    for row in summed.collect():
        table[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["cells"], np.uint8)
    return table


def needed(n: np.ndarray | int, percent: int):
    """Smallest overlap of a set of n with any set that is similar enough."""
    return (percent * n + 99) // 100


def profile(grams: np.ndarray, table: np.ndarray, percent: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Digest, prefix in corpus order (with places) and parity sketch of a set."""
    n = len(grams)
    level = table[(grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    key = (level.astype(np.uint64) << np.uint64(56)) | (grams >> np.uint64(8))
    prefix = grams[np.argsort(key, kind="stable")[: n - needed(n, percent) + 1]]
    bits = np.bincount((grams & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    sketch = np.packbits(bits.astype(np.uint8)).view(np.int64)
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), prefix, sketch


def _profiles(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> tuple[DataFrame, str]:
    """(key, mark, n, digest, prefix, sketch) of every row, ``mark`` a hash of its text; stored."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequencies(docs, text_col, k))
    schema = T.StructType([
        T.StructField("key", docs.schema[id_col].dataType), T.StructField("mark", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("sketch", T.ArrayType(T.LongType())),
    ])
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                sets = gram_sets(part["text"], k)
                rows = [profile(g, table.value, percent) if len(g) else (None, g, g) for g in sets]
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum([len(r[c]) for r in rows])]), pa.int32()),
                        pa.array(np.concatenate([r[c].view(np.int64) for r in rows]), pa.int64())).cast(longs)
                    for c in (1, 2)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["mark"], pa.array([len(g) for g in sets], pa.int64()), pa.array([r[0] for r in rows], pa.binary()), *lists],
                    names=schema.names)

    texts = docs.select(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    return step(texts.mapInArrow(run, schema), "profiles")


def _may_link(percent: int) -> Column:
    """Length, positional and suffix filters on postings x and y of one n-gram.

    ``alpha`` is the overlap that sets of these sizes need.  Before and at the
    meeting place at most min(x.pos, y.pos) + 1 n-grams are shared, behind it no
    more than the shorter rest.  The sets may differ in nx + ny - 2 alpha n-grams,
    and in at least as many as their parity sketches differ in bits.
    """
    alpha = "(({p} * (x.n + y.n) + {d}) div {q})".format(p=percent, q=100 + percent, d=99 + percent)
    differ = " + ".join(f"bit_count(x.sketch[{i}] ^ y.sketch[{i}])" for i in range(SKETCH))
    return F.expr(
        f"100 * x.n >= {percent} * y.n AND 100 * y.n >= {percent} * x.n"
        f" AND least(x.pos, y.pos) + 1 + least(x.n - x.pos, y.n - y.pos) - 1 >= {alpha}"
        f" AND {differ} <= x.n + y.n - 2 * {alpha}")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int,
              percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; stored."""
    spark = docs.sparkSession
    asked = store(
        pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        .join(nodes.select("node", "first", "digest"), "node"), "asked")
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                sets = gram_sets(part["text"], k)
                # an identifier may stand for several texts: the digest tells which is meant
                mine = [i for i, (g, d) in enumerate(zip(sets, part["digest"].to_pylist()))
                        if hashlib.blake2b(g.tobytes(), digest_size=16).digest() == d]
                offsets = np.concatenate([[0], np.cumsum([len(sets[i]) for i in mine])])
                flat = np.concatenate([sets[i] for i in mine]).view(np.int64) if mine else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part["node"].take(pa.array(mine, pa.int64())),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))], names=schema.names)

    texts = docs.select(F.col(id_col).alias("first"), F.col(text_col).alias("text"))
    wanted = broadcast_if_small(asked, BROADCAST_NODES)
    chosen = texts.join(wanted, texts["first"].eqNullSafe(wanted["first"])).select("node", "digest", "text")
    sets = store(chosen.mapInArrow(run, schema), "sets")
    if sets.count() > asked.count():  # repeated rows
        sets = store(sets.dropDuplicates(["node"]), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    same = left.join(broadcast_if_small(pairs, BROADCAST_NODES), "a").join(right, "b").filter(
        both * 100 >= percent * (F.size("ga") + F.size("gb") - both))
    return store(same.select("a", "b"), "verified")


def _placed(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(key, mark, n, root, component_id) of every row of ``docs``; no root for empty sets."""
    spark = docs.sparkSession
    profiles, profiles_at = _profiles(docs, id_col, text_col, k, percent)
    rows = store(profiles.select("key", "mark", "n", "digest"), "rows")
    full, full_at = step(
        profiles.filter("n > 0").groupBy("digest").agg(
            F.min("key").alias("first"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "prefixes")
    remove_path(spark, profiles_at)
    nodes = store(full.select("node", "digest", "first", "n", "sketch", F.size("prefix").alias("length")), "nodes")

    postings = full.select("node", F.posexplode("prefix").alias("pos", "gram"))
    shared = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1").select("gram")
    met = store(postings.join(shared, "gram"), "met")
    remove_path(spark, full_at)

    # the hub of an n-gram: the node most of whose prefix is shared
    support = met.groupBy("node").agg(F.count(F.lit(1)).alias("support"))
    known = nodes.select("node", "n", "sketch", "length")
    full = store(
        met.join(known.join(support, "node"), "node")
        .select("gram", "node", "pos", "n", "sketch", (F.col("support") / F.col("length")).alias("share")), "postings")
    hubs = full.groupBy("gram").agg(F.max_by(F.struct("node", "pos", "n", "sketch"), F.struct("share", -F.col("node"))).alias("hub"))
    hubs = hubs.select("gram", "hub.*")

    def across(x: DataFrame, y: DataFrame, also: Column) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        found = x.join(y, (F.col("x.gram") == F.col("y.gram")) & also & _may_link(percent))
        return found.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()

    to_hubs = store(across(full, hubs, F.col("x.node") != F.col("y.node")), "pairs")
    links = _verified(to_hubs, nodes, docs, id_col, text_col, k, percent)
    joined = components(links)

    # what is left: n-grams met by several components, pairs across them
    placed = full.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_grams = placed.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("gram")
    placed = store(placed.join(open_grams, "gram"), "open")
    others = across(placed, placed, (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")))
    others = store(others.join(to_hubs, ["a", "b"], "left_anti"), "pairs")
    links = links.union(_verified(others, nodes, docs, id_col, text_col, k, percent))
    joined = components(links)

    named = nodes.select("digest", "node", "first").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "root").select("digest", "root", "component_id")
    return rows.select("key", "mark", "n", "digest").join(named, "digest", "left")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
            percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    A document's set holds the distinct windows of ``k`` words of its text with
    A-Z lower-cased (the whole text if it has fewer words); two documents link if
    100 times the shared windows are at least ``percent`` times all of both.
    ``component_id`` is the smallest id that links reach, one's own included; null
    ids are not smallest unless all are null.  A text without words, or null, has
    an empty set and links with nothing: its component is its own id.  Repeated
    rows link with each other.  An empty table gives an empty result; other
    columns are not read.
    """
    return _placed(docs, id_col, text_col, k, percent).select(
        F.col("key").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component.

    The smallest id stays, null ids last; of rows that share it one by the hash of
    its text.  Rows with an empty set all stay.  See :func:`classes`.
    """
    placed = store(_placed(docs, id_col, text_col, k, percent).filter("n > 0").select("key", "mark", "root"), "placed")
    rank = F.struct(F.col("key").isNull().alias("no_key"), "key", "mark")
    best = placed.groupBy("root").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("rows"))
    crowded = placed.join(best.filter("rows > 1"), "root").withColumn("stays", rank == F.col("best"))
    crowded = store(crowded.select("key", "mark", "stays"), "crowded")
    names = docs.columns
    # helper columns take names the caller's columns leave free
    mark_name, key_name = free_name(names, "__mark"), free_name(names, "__key")
    gone_key, gone_mark = free_name(names, "__gone_key"), free_name(names, "__gone_mark")
    gone = crowded.filter("not stays").select(F.col("key").alias(gone_key), F.col("mark").alias(gone_mark)).distinct()
    marked = docs.withColumns({mark_name: F.xxhash64(text_col), key_name: F.col(id_col)})
    here = F.col(mark_name).eqNullSafe(gone[gone_mark]) & F.col(key_name).eqNullSafe(gone[gone_key])
    left = marked.join(broadcast_if_small(gone, BROADCAST_NODES), here, "left_anti")
    if not crowded.filter("stays").groupBy("key", "mark").count().filter("count > 1").isEmpty():
        # repeated rows: one of them; texts without words are not touched
        wordless = F.coalesce(F.col(text_col), F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
        left = left.filter(~wordless).dropDuplicates([key_name, mark_name]).union(left.filter(wordless))
    return left.select(*names)
