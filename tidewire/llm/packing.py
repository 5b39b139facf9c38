"""Packing documents into sequences by best fit and a swap-based local search."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import bpe

CAPACITY = 2048
# Pieces that are packed together, in one task.
GROUP_PIECES = 4096


class Bins:
    """Bins of one group: best fit first, then moves and swaps that raise the squared fill."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.size, self.capacity = lengths.astype(np.int64), capacity
        self.bin_of = np.full(len(lengths), -1)
        self.fill: list[int] = []
        self._best_fit()

    def _best_fit(self) -> None:
        """Longest first, each into the fullest bin that takes it."""
        by_fill: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        present: list[int] = []  # fills that some bin has, ascending
        for i in np.argsort(-self.size, kind="stable").tolist():
            n = int(self.size[i])
            at = bisect.bisect_right(present, self.capacity - n)
            if at:
                old = present[at - 1]
                b = by_fill[old].pop()
                if not by_fill[old]:
                    present.pop(at - 1)
            else:
                old, b = 0, len(self.fill)
                self.fill.append(0)
            self.bin_of[i], self.fill[b] = b, old + n
            if not by_fill[old + n]:
                bisect.insort(present, old + n)
            by_fill[old + n].append(b)

    def search(self) -> None:
        """Empty the least filled bins, one after another, until no bin can be emptied."""
        least = -(-int(self.size.sum()) // self.capacity)
        fill = self.fill = np.array(self.fill, np.int64)
        while (fill > 0).sum() > least:
            before = (fill > 0).sum()
            for b in np.argsort(fill, kind="stable").tolist():
                if 0 < fill[b] < self.capacity and (fill > 0).sum() > least:
                    while fill[b] and self._improve(b):
                        pass
            if (fill > 0).sum() == before:
                break

    def _improve(self, b: int) -> bool:
        """One move or swap that takes tokens from bin b to a bin at least as full; the largest wins."""
        size, fill, cap = self.size, self.fill, self.capacity
        mine = np.flatnonzero(self.bin_of == b)
        open_bins = np.flatnonzero((fill >= fill[b]) & (fill < cap))
        open_bins = open_bins[open_bins != b]
        if not len(open_bins):
            return False
        gap = np.zeros(len(fill), np.int64)
        gap[open_bins] = cap - fill[open_bins]
        # move: the largest document that fits, into the tightest gap
        fits = mine[size[mine] <= gap.max()]
        if len(fits):
            i = fits[np.argmax(size[fits])]
            room = open_bins[gap[open_bins] >= size[i]]
            self._put(i, room[np.argmin(gap[room])])
            return True
        theirs = np.flatnonzero(gap[self.bin_of] > 0)
        room = gap[self.bin_of[theirs]]
        best, gain = None, 0
        # one for one, two for one: what leaves bin b is longer than what comes back; of equal sizes two at most matter
        few = mine[np.argsort(size[mine], kind="stable")]
        few = few[np.concatenate([np.ones(min(2, len(few)), bool), size[few[2:]] != size[few[:-2]]])]
        one, two = np.triu_indices(len(few), 1)
        out = np.stack([np.concatenate([few, few[one]]), np.concatenate([np.full(len(few), -1), few[two]])], 1)
        leaves = np.concatenate([size[few], size[few[one]] + size[few[two]]])
        order = np.argsort(leaves, kind="stable")
        out, leaves = out[order], leaves[order]
        k = np.searchsorted(leaves, size[theirs] + room, "right") - 1
        more = np.where(k >= 0, leaves[k] - size[theirs], 0)
        if len(more) and more.max() > gain:
            t = int(np.argmax(more))
            best, gain = (tuple(i for i in out[k[t]].tolist() if i >= 0), (int(theirs[t]),)), int(more[t])
        # one for two of the same bin: neighbours in order of size, all other pairs if nothing is found
        order = np.lexsort((size[theirs], self.bin_of[theirs]))
        mates = theirs[order][size[theirs[order]] < size[few[-1]]]
        where, length = self.bin_of[mates], size[mates]
        mates = mates[np.concatenate([np.ones(min(2, len(mates)), bool), (length[2:] != length[:-2]) | (where[2:] != where[:-2])])]
        where, length = self.bin_of[mates], size[mates]
        for lag in range(1, len(mates)):
            at = np.flatnonzero(where[lag:] == where[:-lag])
            if not len(at) or (lag > 1 and best is not None):
                break
            pair = length[at] + length[at + lag]
            k = np.searchsorted(size[few], pair + gap[where[at]], "right") - 1
            more = np.where(k >= 0, size[few[k]] - pair, 0)
            t = int(np.argmax(more))
            if more[t] > gain:
                best, gain = ((int(few[k[t]]),), (int(mates[at[t]]), int(mates[at[t] + lag]))), int(more[t])
        if best is None:
            return False
        target = self.bin_of[best[1][0]]
        for i in best[0]:
            self._put(i, target)
        for j in best[1]:
            self._put(j, b)
        return True

    def _put(self, i: int, b: int) -> None:
        self.fill[self.bin_of[i]] -= self.size[i]
        self.fill[b] += self.size[i]
        self.bin_of[i] = b


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; bins are numbered from 0, offsets are gapless."""
    bins = np.zeros(len(lengths), np.int64)
    if not len(lengths):
        return bins, bins
    whole = lengths == capacity
    part = np.flatnonzero(~whole)
    if len(part):
        packer = Bins(lengths[part], capacity)
        packer.search()
        bins[part] = np.unique(packer.bin_of, return_inverse=True)[1]
    bins[whole] = (bins[part].max() + 1 if len(part) else 0) + np.arange(whole.sum())
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    starts = ends - lengths[order]
    first = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
    offset = np.empty(len(lengths), np.int64)
    offset[order] = starts - starts[np.flatnonzero(first)][np.cumsum(first) - 1]
    return bins, offset


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: id, piece, start, length, ids.

    A document is its ids and then ``end_id``.  Only longer ones are cut; all
    pieces but the first are full.  A null text counts as empty: one piece that
    holds ``end_id`` alone.
    """
    end = int(end_id).to_bytes(4, "little")
    whole = bpe.encode(docs, tokenizer, id_col, text_col).select(
        id_col, F.concat("ids", F.lit(end)).alias("__whole")
    ).withColumn("__n", F.expr("length(__whole) div 4"))
    count = F.expr(f"(__n + {capacity - 1}) div {capacity}")
    cut = whole.withColumn("__count", count).select(
        id_col, "__whole", "__n", "__count", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("piece"))
    head = F.col("__n") - (F.col("__count") - 1) * capacity
    start = F.when(F.col("piece") == 0, 0).otherwise(head + (F.col("piece") - 1).cast("bigint") * capacity)
    length = F.when(F.col("piece") == 0, head).otherwise(capacity)
    return cut.select(
        id_col, "piece", start.cast("bigint").alias("start"), length.cast("bigint").alias("length"),
        F.substring("__whole", (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"))


def pack(parts: DataFrame, length_col: str = "length", capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The rows of ``parts`` with ``sequence_id`` and ``offset`` added.

    Rows are stored, dealt by their number into groups of about
    ``group_pieces`` and each group is packed in one task, so memory does not
    grow with the input.  A length must be from 0 to ``capacity``; a null length
    counts as 0.  Columns named like the two new ones are refused.
    """
    for name in ("sequence_id", "offset"):
        if name in parts.columns:
            raise ValueError(f"column {name} is there already")
    spark = parts.sparkSession
    path = scratch_path(spark, "pieces")
    parts.write.parquet(path)
    stored = spark.read.schema(parts.schema).parquet(path)
    groups = max(1, round(stored.count() / group_pieces))
    key = bpe.free_name(parts.columns, "__group")
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = parts.columns

    def run(table: pa.Table) -> pa.Table:
        lengths = table[length_col].fill_null(0).to_numpy().astype(np.int64)
        if len(lengths) and (lengths.min() < 0 or lengths.max() > capacity):
            raise ValueError(f"a length is not from 0 to {capacity}")
        bins, offset = pack_lengths(lengths, capacity)
        base = table[key][0].as_py() << 32
        return pa.Table.from_arrays(
            [table[c] for c in names] + [pa.chunked_array([pa.array(base + bins)]), pa.chunked_array([pa.array(offset)])],
            names=schema.names)

    # row numbers of a stored table are the same whenever a task is repeated
    dealt = stored.withColumn(key, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy(key).applyInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids as whole sequences: sequence_id, n_ids, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), joined.alias("ids"))
