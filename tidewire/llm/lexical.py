"""Ranked lexical search with bag deduplication.

Each document is read once (numpy over Arrow batches): its terms are counted,
and only those in the vocabulary of the query items are kept, found by hash and
verified byte by byte.  What is left of a document, its bag of (term, count)
together with its length norm m, decides its score for every item; documents
with identical bags form one class.  Classes are hashed and grouped by their
exact bag, so a hash collision cannot merge two bags; at most the ``k`` smallest
doc_ids of a class travel with it (a window limited before its exchange).  Each
class is scored once against all items of a block in the task that holds it;
the task keeps the best ``k`` documents of each item until its end, expanding a
class into its members only where they can still enter that list.  A last
window over at most ``k`` rows per item and task gives the ranks.

Scores follow integer BM25: N documents with a term, L terms in all, n terms in
a document, df and tf as usual; weight ``floor(1000*ln((2N+2)/(2df+1)))`` (in
doubles), ``m = 25 + (75*n*N) div L`` and score ``sum w*((10**9*tf) div
(1000*tf + 8*m))`` over the item's terms with repeats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import arrays as A

# The bytes that are not part of a term (ASCII controls, space, punctuation, symbols).
TERM_BYTE = np.ones(256, bool)
for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    TERM_BYTE[low : high + 1] = False
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

TOP = 10
# Items scored in one pass over the classes; their terms travel to every task.
ITEMS_PER_BLOCK = 4096
# Class entries times item postings expanded at once in a task.
EXPAND = 1 << 22

BAG = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType())),
])
HITS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType()),
])


def term_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of terms; no term crosses a row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = TERM_BYTE[data]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first = inside[1:-1] & ~inside[:-2]
    first[inner] = inside[1:-1][inner]
    last = inside[1:-1] & ~inside[2:]
    last[inner - 1] = inside[1:-1][inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.uint8)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return data[np.repeat(starts - first, lengths) + np.arange(total)]


class Vocabulary:
    """Terms of the items: sorted 64-bit hashes, and the bytes that verify a hit."""

    def __init__(self, terms: list[str]):
        encoded = [t.encode() for t in terms]
        self.size = len(encoded)
        self.data = np.frombuffer(b"".join(encoded), np.uint8) if encoded else np.zeros(0, np.uint8)
        lengths = np.array([len(b) for b in encoded], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if encoded else lengths
        self.lengths = lengths
        hashes = A.hash_spans(self.data, self.starts, self.starts + lengths) if encoded else np.zeros(0, np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(span index, term index) of the spans that are vocabulary terms."""
        if not self.size or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = A.hash_spans(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), self.size - 1)
        span = np.flatnonzero(self.hashes[at] == h)
        term = self.order[at[span]]
        lengths = ends[span] - starts[span]
        fits = lengths == self.lengths[term]
        span, term, lengths = span[fits], term[fits], lengths[fits]
        differ = _gather(data, starts[span], lengths) != _gather(self.data, self.starts[term], lengths)
        bad = A.per_row(differ, np.concatenate([[0], np.cumsum(lengths)])) > 0
        return span[~bad], term[~bad]


def bags(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs): each document's term count and its bag restricted to the vocabulary.

    ``terms`` are vocabulary indexes in ascending order, ``tfs`` their counts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, text_col):
                data, bounds = A.byte_view(part[text_col])
                data = A.LOWER[data]
                starts, ends = term_spans(data, bounds)
                rows = len(bounds) - 1
                n = np.diff(np.searchsorted(starts, bounds))
                span, term = vocabulary.find(data, starts, ends)
                key = A.row_of(bounds, starts[span]).astype(np.int64) * max(vocabulary.size, 1) + term
                keys, tfs = np.unique(key, return_counts=True)
                row = keys // max(vocabulary.size, 1)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part[id_col].cast(pa.int64()), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys % max(vocabulary.size, 1), pa.int32())),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(tfs, pa.int32())),
                ], names=BAG.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, BAG)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, q): the terms of each item and how often it holds them."""
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, UPPER.lower())
    found = items.select(F.col(id_col).cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), 0)).alias("term"))
    return found.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("q"))


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))), in doubles."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Block:
    """Items of one block as postings by term: for term t, items ``item[ptr[t]:ptr[t+1]]`` hold it ``q`` times."""

    def __init__(self, rows: list[tuple[int, int, int]], n_terms: int, weights: np.ndarray):
        rows = sorted(rows, key=lambda r: (r[1], r[0]))
        term = np.array([r[1] for r in rows], np.int64)
        self.ptr = np.searchsorted(term, np.arange(n_terms + 1))
        self.item = np.array([r[0] for r in rows], np.int64)
        self.q = np.array([r[2] for r in rows], np.int64)
        self.w = weights

    def score(self, terms: np.ndarray, tfs: np.ndarray, owner: np.ndarray, m: np.ndarray):
        """(class, item, score) of every class entry set against the items holding its term, summed."""
        part = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[owner])
        value = self.w[terms] * part
        many = self.ptr[terms + 1] - self.ptr[terms]
        total = int(many.sum())
        if not total:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.concatenate([[0], np.cumsum(many)[:-1]])
        post = np.repeat(self.ptr[terms] - first, many) + np.arange(total)
        cls = np.repeat(owner, many)
        item = self.item[post]
        contribution = np.repeat(value, many) * self.q[post]
        order = np.lexsort((item, cls))
        cls, item, contribution = cls[order], item[order], contribution[order]
        cut = np.flatnonzero(np.concatenate([[True], (cls[1:] != cls[:-1]) | (item[1:] != item[:-1])]))
        return cls[cut], item[cut], np.add.reduceat(contribution, cut)


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, k: int):
    """The k best (score down, doc_id up) rows of each item."""
    order = np.lexsort((doc, -score, item))
    item, score, doc = item[order], score[order], doc[order]
    start = np.concatenate([[True], item[1:] != item[:-1]])
    group = np.cumsum(start) - 1
    place = np.arange(len(item)) - np.flatnonzero(start)[group]
    keep = place < k
    return item[keep], score[keep], doc[keep]


def _candidates(item, score, cls, first, count, k: int) -> np.ndarray:
    """Rows (item, class) whose members can still be among an item's k best; all others lose."""
    order = np.lexsort((first[cls], -score, item))
    item, score, members = item[order], score[order], count[cls[order]]
    start = np.concatenate([[True], item[1:] != item[:-1]])
    group = np.cumsum(start) - 1
    before = np.cumsum(members) - members
    before = before - before[np.flatnonzero(start)][group]
    reach = (before < k) & (before + members >= k)
    bar = np.full(int(group[-1]) + 1 if len(group) else 0, -1, np.int64)
    bar[group[reach]] = score[reach]
    tie_start = start | np.concatenate([[True], score[1:] != score[:-1]])
    tie_group = np.cumsum(tie_start) - 1
    tie_place = np.arange(len(item)) - np.flatnonzero(tie_start)[tie_group]
    keep = (score > bar[group]) | ((score == bar[group]) & (tie_place < k))
    return order[keep]


def top_per_item(classes: DataFrame, block: Block, k: int = TOP) -> DataFrame:
    """(item_id, doc_id, score): each task's k best documents of every item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            terms = batch["terms"]
            owner_all = np.repeat(np.arange(batch.num_rows), np.diff(terms.offsets.to_numpy()))
            flat_terms = terms.flatten().to_numpy().astype(np.int64)
            flat_tfs = batch["tfs"].flatten().to_numpy().astype(np.int64)
            m = batch["m"].to_numpy()
            members = batch["members"]
            moff = members.offsets.to_numpy().astype(np.int64)
            mflat = members.flatten().to_numpy(zero_copy_only=False)
            count = np.diff(moff)
            first = mflat[moff[:-1]]
            # bound the expansion: split the entries where the postings they meet add up to EXPAND
            many = np.cumsum(block.ptr[flat_terms + 1] - block.ptr[flat_terms])
            cuts = np.searchsorted(many, np.arange(EXPAND, int(many[-1]) + EXPAND, EXPAND)) if len(many) else []
            # never cut inside a class: move each cut to the first entry of its class
            row_start = terms.offsets.to_numpy()[:-1]
            edges = np.unique(np.concatenate([[0], row_start[np.searchsorted(row_start, cuts, "right") - 1], [len(flat_terms)]]))
            for lo, hi in zip(edges[:-1], edges[1:]):
                cls, item, score = block.score(flat_terms[lo:hi], flat_tfs[lo:hi], owner_all[lo:hi], m)
                positive = score > 0
                cls, item, score = cls[positive], item[positive], score[positive]
                if not len(cls):
                    continue
                rows = _candidates(item, score, cls, first, count, k)
                cls, item, score = cls[rows], item[rows], score[rows]
                many_m = count[cls]
                at = np.repeat(moff[cls] - np.concatenate([[0], np.cumsum(many_m)[:-1]]), many_m) + np.arange(int(many_m.sum()))
                best = _best(np.concatenate([best[0], np.repeat(item, many_m)]),
                             np.concatenate([best[1], np.repeat(score, many_m)]),
                             np.concatenate([best[2], mflat[at]]), k)
        item, score, doc = best
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                         names=HITS.names)

    return classes.select("terms", "tfs", "m", "members").mapInArrow(run, HITS)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest-scoring documents with a score above 0.

    Equal scores go by ascending doc_id; ranks count from 1 and are unique.  A
    row with a null doc_id counts in N, L and df but is never returned, nor is an
    item with a null id.  Null texts have no terms; a document without terms counts in
    neither N nor L; repeated rows are ranked each, as their own documents; an
    item without terms, or whose terms no document holds, has no rows; an empty
    table gives no rows.  Only the id and text columns are read, so other names
    cannot clash.  Texts are read whole; a task holds one slice of texts (or one
    longer text) and a block's postings.  The item table is a stated query set:
    its items are dealt into blocks of about ``ITEMS_PER_BLOCK`` by a hash of
    their id, a block's terms reach the driver at a time, and each block reads the
    stored classes once more.
    """
    spark = docs.sparkSession
    wanted = item_terms(items, item_id, item_text).cache()
    try:
        vocab_terms = [r.term for r in wanted.select("term").distinct().orderBy("term").collect()]
        vocabulary = Vocabulary(vocab_terms)
        path = scratch_path(spark, "bags")
        bags(docs, vocabulary, id_col, text_col).write.parquet(path)
        stored = spark.read.schema(BAG).parquet(path)
        totals = stored.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
        n_docs, n_terms = int(totals.N), int(totals.L)
        if not n_terms or not vocabulary.size:
            return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
        df = np.zeros(vocabulary.size, np.int64)
        for r in stored.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r.t] = r["count"]
        weights = weight(n_docs, df)
        m = F.expr(f"cast((cast(75 as decimal(38, 0)) * n * {n_docs}) div {n_terms} as bigint)") + 25
        shaped = stored.where((F.size("terms") > 0) & F.col("doc_id").isNotNull()).withColumn("m", m)
        shaped = shaped.withColumn("key", F.xxhash64("terms", "tfs", "m"))
        bag_key = ["key", "terms", "tfs", "m"]
        first_k = Window.partitionBy(*bag_key).orderBy(F.col("doc_id").asc_nulls_last())
        ranked = shaped.withColumn("r", F.row_number().over(first_k)).where(F.col("r") <= k)
        classes = ranked.groupBy(*bag_key).agg(F.array_sort(F.collect_list("doc_id")).alias("members"))
        index = {t: i for i, t in enumerate(vocab_terms)}
        # items are dealt into blocks by a hash of their id; only the count reaches the driver at once
        named = wanted.where(F.col("item_id").isNotNull())
        n_blocks = max(1, -(-named.select("item_id").distinct().count() // ITEMS_PER_BLOCK))
        found = None
        for b in range(n_blocks):
            rows = named.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).collect()
            if not rows:
                continue
            block = Block([(r.item_id, index[r.term], r.q) for r in rows], vocabulary.size, weights)
            part = top_per_item(classes, block, k)
            found = part if found is None else found.unionByName(part)
        if found is None:
            return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    finally:
        wanted.unpersist()
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
