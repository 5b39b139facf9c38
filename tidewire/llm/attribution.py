"""Token counts of sections: whole documents are encoded once and tokens attributed by their spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import arrays as A
from . import bpe

MOST, FIRST = "most", "first"


def _owner(starts: np.ndarray, ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For tokens [starts, ends) and ascending, disjoint sections [lo, hi): the section each
    token goes to, -1 if it meets none, and whether it crosses a border."""
    first = np.searchsorted(hi, starts, "right")  # first section that ends behind the token's start
    after = np.searchsorted(lo, ends, "left")  # first section that begins at or behind its end
    met = after - first
    owner = np.where(met > 0, first, -1)
    inside = (met > 0) & (lo[np.minimum(first, len(lo) - 1)] <= starts) & (hi[np.minimum(first, len(hi) - 1)] >= ends)
    crossing = (met > 0) & ~inside
    if rule == MOST:
        for t in np.flatnonzero(met > 1).tolist():
            at = np.arange(first[t], after[t])
            share = np.minimum(hi[at], ends[t]) - np.maximum(lo[at], starts[t])
            owner[t] = at[np.argmax(share)]  # the earlier one at equal shares
    return owner, crossing


def _given(starts, ends, lo, hi, row_lo, row_hi, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(n_tokens, n_crossing) of sections as the caller gives them: in any order, overlapping or
    not, reaching beyond the text or not.  Each is cut to its own row's text first, so it never
    meets another row's tokens; tokens are non-decreasing spans, so two searches give the tokens
    that overlap a section, and each token goes to the section with most of its characters (the
    smaller number at equal shares) or, by ``first``, to the smallest number it meets.  Sections
    that are empty after the cut take part nowhere."""
    n = len(lo)
    tokens, crossing = np.zeros(n, np.int64), np.zeros(n, np.int64)
    clo = np.clip(lo, row_lo, row_hi)
    chi = np.maximum(np.clip(hi, row_lo, row_hi), clo)
    full = np.flatnonzero(chi > clo)
    if not len(full):
        return tokens, crossing
    a = np.searchsorted(ends, clo[full], "right")  # first token that ends behind the section's start
    b = np.searchsorted(starts, chi[full], "left")  # first token that starts at or behind its end
    many = np.maximum(b - a, 0)
    total = int(many.sum())
    if not total:
        return tokens, crossing
    sec = np.repeat(full, many)
    tok = np.repeat(a - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(total)
    if rule == MOST:
        share = np.minimum(chi[sec], ends[tok]) - np.maximum(clo[sec], starts[tok])
        order = np.lexsort((sec, -share, tok))
    else:
        order = np.lexsort((sec, tok))
    sec, tok = sec[order], tok[order]
    first = np.concatenate([[True], tok[1:] != tok[:-1]])
    sec, tok = sec[first], tok[first]
    inside = (lo[sec] <= starts[tok]) & (hi[sec] >= ends[tok])
    tokens += np.bincount(sec, minlength=n)
    crossing += np.bincount(sec[~inside], minlength=n)
    return tokens, crossing


def attribute(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              sections_col: str | None = None, rule: str = MOST) -> DataFrame:
    """One row per section: id, section (from 0), start, end, n_tokens, n_crossing.

    ``sections_col`` holds an array of (start, end) in code points, in any order,
    overlapping or not (a null border counts as 0); each section is cut to its own
    text, so one reaching beyond it counts that text's tokens only.  Without it the
    sections are the lines of the text, each with its line feed.  A token is a span of code points (all those it has bytes of).  It
    counts for the one section it meets; if it meets several it goes to the one
    that holds most of its characters, the earlier at equal shares (``most``),
    or to the first it meets (``first``).  A token outside all sections counts
    nowhere.  ``n_crossing`` tells how many counted tokens reach beyond the section.

    A null or empty text has one empty line and no tokens; null sections give no
    row; ids may be null or repeated (a row's sections follow each other); an
    empty table gives an empty result; other columns are not read.
    """
    if rule not in (MOST, FIRST):
        raise ValueError(f"unknown rule {rule!r}")
    shared = bpe.Tokenization(docs.sparkSession, tokenizer)
    fields = [("section", T.IntegerType()), ("start", T.LongType()), ("end", T.LongType()),
              ("n_tokens", T.LongType()), ("n_crossing", T.LongType())]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)] + [T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.vocabulary()
        for batch in batches:
            for part in A.slices(batch, text_col):
                yield from count(part, vocabulary)

    def count(part: pa.RecordBatch, vocabulary: bpe.Vocabulary) -> Iterator[pa.RecordBatch]:
        data, bounds = A.byte_view(part[text_col])
        ids, at = vocabulary.encode(part[text_col])
        points = np.concatenate([[0], np.cumsum(A.code_points(data))])
        byte_ends = np.cumsum((vocabulary.bounds[1:] - vocabulary.bounds[:-1])[ids])
        byte_starts = byte_ends - (vocabulary.bounds[1:] - vocabulary.bounds[:-1])[ids]
        # a token that begins within a code point holds that one too
        starts = points[byte_starts + 1] - 1 if len(ids) else byte_starts
        ends = points[byte_ends]
        base = points[bounds]  # each row's first code point
        if sections_col is None:
            feeds = points[np.flatnonzero(data == 10)] + 1
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(feeds, base, "right")))
            lo = np.concatenate([base[:-1], feeds])
            rows = np.concatenate([np.arange(len(bounds) - 1), row])
            order = np.lexsort((lo, rows))
            lo, rows = lo[order], rows[order]
            last = np.append(rows[1:] != rows[:-1], True) if len(rows) else np.zeros(0, bool)
            hi = np.append(lo[1:], 0)
            hi[last] = base[rows[last] + 1]
        else:
            lists = pc.fill_null(pc.list_value_length(part[sections_col]), 0).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(bounds) - 1), lists)
            flat = part[sections_col].flatten()
            lo, hi = (pc.fill_null(pc.struct_field(flat, k), 0).to_numpy(zero_copy_only=False).astype(np.int64) + base[rows]
                      for k in (0, 1))
        n = len(rows)
        tokens, crossing = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if sections_col is not None and n and len(ids):
            tokens, crossing = _given(starts, ends, lo, hi, base[rows], base[rows + 1], rule)
        elif n and len(ids):
            # rows lie one after another, so one search serves them all; empty sections take part nowhere
            full = np.flatnonzero(hi > lo)
            if len(full):
                owner, cross = _owner(starts, ends, lo[full], hi[full], rule)
                hit = owner >= 0
                tokens[full] = np.bincount(owner[hit], minlength=len(full))
                crossing[full] = np.bincount(owner[hit & cross], minlength=len(full))
        first = np.searchsorted(rows, np.arange(len(bounds) - 1))
        columns = [part[id_col].take(pa.array(rows)), pa.array(np.arange(n) - first[rows], pa.int32())]
        columns += [pa.array(x, pa.int64()) for x in (lo - base[rows], hi - base[rows], tokens, crossing)]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    wanted = [id_col, text_col] + ([sections_col] if sections_col else [])
    return docs.select(*wanted).mapInArrow(run, schema)
