"""Quality rules by repetition coverage.

Words are hashed once; windows of several lengths get hashes combined from
those, and the characters inside windows that occur twice or more in the text,
and inside lines equal to an earlier line, are measured as shares of all
characters in words.  A text is refused where a share passes its limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import arrays as A

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

# Percent of word characters that may lie in repeated windows of so many words.
GRAM_LIMITS = {4: 35, 7: 25, 10: 20}
# Percent of word characters that may lie in lines equal to an earlier line.
LINE_LIMIT = 30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(column: pa.Array, gram_limits: dict[int, int]) -> dict[str, np.ndarray]:
    """Counts and covered characters of every text of a column."""
    data, bounds = A.byte_view(column)
    starts, ends = A.word_spans(data, bounds)
    words = A.hash_spans(data, starts, ends)
    word_bounds = np.searchsorted(starts, bounds)
    letters = np.concatenate([[0], np.cumsum(A.code_points(data))])
    chars = letters[ends] - letters[starts]
    out = {
        "n_words": np.diff(word_bounds),
        "word_chars": A.per_row(chars, word_bounds),
        "n_symbols": A.per_row(SYMBOLS[data], bounds),
    }

    def covered(n: int) -> np.ndarray:
        at, rows = A.gram_rows(word_bounds, n)
        twice = at[A.duplicated(A.with_row(A.gram_hashes(words, n)[at], rows))]
        edge = np.bincount(twice, minlength=len(words) + 1) - np.bincount(twice + n, minlength=len(words) + 1)
        return np.cumsum(edge)[:-1] > 0

    # lines: cut at \n and at the rows' bounds
    breaks = np.flatnonzero(data == 10)
    line_from = np.union1d(bounds[:-1], breaks + 1)
    line_from = line_from[line_from < len(data)]
    line_to = np.append(line_from[1:], len(data))
    line_to = line_to - ((line_to > line_from) & (data[line_to - 1] == 10)) if len(line_to) else line_to
    first_word = np.searchsorted(starts, line_from)
    after_word = np.searchsorted(starts, line_to)
    filled = after_word > first_word
    line_from, line_to, first_word, after_word = (x[filled] for x in (line_from, line_to, first_word, after_word))
    rows = A.row_of(bounds, line_from)
    again = A.repeated_later(A.with_row(A.hash_spans(data, line_from, line_to), rows))
    n = len(bounds) - 1
    char_sum = np.concatenate([[0], np.cumsum(chars)])
    out["n_dup_lines"] = np.bincount(rows[again], minlength=n)[:n]
    in_lines = char_sum[after_word] - char_sum[first_word]
    out["dup_line_chars"] = np.bincount(rows[again], in_lines[again], minlength=n)[:n].astype(np.int64)
    out["n_repeat_words"] = A.per_row(covered(3), word_bounds)
    for k in gram_limits:
        out[f"dup_{k}gram_chars"] = A.per_row(np.where(covered(k), chars, 0), word_bounds)
    return out


def judge(m: dict[str, np.ndarray], gram_limits: dict[int, int], line_limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of measured texts."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    over = 100 * m["dup_line_chars"] > line_limit * m["word_chars"]
    for k, limit in gram_limits.items():
        over |= 100 * m[f"dup_{k}gram_chars"] > limit * m["word_chars"]
    return failed, ~failed & ~over


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            gram_limits: dict[int, int] | None = None, line_limit: int = LINE_LIMIT) -> DataFrame:
    """One row per row of ``docs``: id, counts, covered characters, verdicts.

    A null or empty text has no words, so it fails; a null id stays null;
    repeated rows are judged each; an empty table gives an empty result; other
    columns are not read, so their names cannot clash.  Memory is bounded by a
    slice of texts or the longest single text.
    """
    limits = dict(GRAM_LIMITS if gram_limits is None else gram_limits)
    covers = ["dup_line_chars"] + [f"dup_{k}gram_chars" for k in limits]
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, id_type)]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
        + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
        + [T.StructField(c, T.LongType()) for c in covers]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, text_col):
                m = measure(part[text_col], limits)
                failed, kept = judge(m, limits, line_limit)
                cols = [part[id_col]] + [pa.array(m[c], pa.int64()) for c in COUNTS]
                cols += [pa.array(failed), pa.array(kept)] + [pa.array(m[c], pa.int64()) for c in covers]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def keep_good(docs: DataFrame, text_col: str = "text", gram_limits: dict[int, int] | None = None,
              line_limit: int = LINE_LIMIT) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns.

    Nulls, repeated rows and other columns as in :func:`profile`; rows pass or
    go one by one, without a join.
    """
    limits = dict(GRAM_LIMITS if gram_limits is None else gram_limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, text_col):
                kept = judge(measure(part[text_col], limits), limits, line_limit)[1]
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
