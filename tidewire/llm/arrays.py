"""Numpy helpers for whole batches of texts: byte views, word spans, 64-bit span hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; a single longer text is handled alone.
SLICE_BYTES = 1024 * 1024
BLOCK = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(BLOCK, BASE)]))
INVERSES = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(BLOCK, BASE_INVERSE)]))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of ``column``, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop
    pa.default_memory_pool().release_unused()


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the bounds of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(bounds):
        bounds = np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_of(bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row that holds each byte position."""
    return np.searchsorted(bounds, at, "right") - 1


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of a per-byte (or per-item) array within each row's bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of every code point."""
    return (data & 0xC0) != 0x80


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of words ``[^\\x20\\x09-\\x0D]+``; no word crosses a row."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~SPACE[data]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first = word[1:-1] & ~word[:-2]
    first[inner] = word[1:-1][inner]
    last = word[1:-1] & ~word[2:]
    last[inner - 1] = word[1:-1][inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one running polynomial sum taken block by block.

    Starts and ends must each be in ascending order; spans may overlap.
    """
    at_start, at_end = np.zeros(len(starts), np.uint64), np.zeros(len(ends), np.uint64)
    inverse = np.ones(len(starts), np.uint64)
    carry, power, back = np.uint64(0), np.uint64(1), np.uint64(1)
    i = j = 0
    with np.errstate(over="ignore"):
        for at in range(0, max(1, len(data)), BLOCK):
            part = data[at : at + BLOCK]
            run = np.empty(len(part) + 1, np.uint64)
            run[0] = 0
            np.cumsum(BYTE_CODE[part] * POWERS[: len(part)], out=run[1:])
            i2 = int(np.searchsorted(starts, at + len(part), "right"))
            j2 = int(np.searchsorted(ends, at + len(part), "right"))
            at_start[i:i2] = carry + power * run[starts[i:i2] - at]
            inverse[i:i2] = back * INVERSES[starts[i:i2] - at]
            at_end[j:j2] = carry + power * run[ends[j:j2] - at]
            carry = carry + power * run[-1]
            power = power * POWERS[BLOCK]
            back = back * INVERSES[BLOCK]
            i, j = i2, j2
        return mix((at_end - at_start) * inverse + mix((ends - starts).astype(np.uint64) * BASE))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n words; window i starts at word i."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    last = len(words) - n + 1
    with np.errstate(over="ignore"):
        out = np.full(last, np.uint64(n) * BASE)
        for k in range(n):
            out = out * BASE + words[k : k + last]
        return mix(out)


def gram_rows(word_bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of n words that stay within a row, and their rows."""
    counts = np.maximum(np.diff(word_bounds) - n + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return word_bounds[rows] + np.arange(len(rows)) - first[rows], rows


def duplicated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more, first occurrence included."""
    if not len(keys):
        return np.zeros(0, bool)
    ranked = np.sort(keys)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    # narrow down by a table of low bits before the exact search
    table = np.zeros(1 << 16, bool)
    table[twice & np.uint64(0xFFFF)] = True
    out = table[keys & np.uint64(0xFFFF)]
    at = np.flatnonzero(out)
    twice = np.unique(twice)
    place = np.minimum(np.searchsorted(twice, keys[at]), len(twice) - 1)
    out[at] = twice[place] == keys[at]
    return out


def repeated_later(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:][keys[order][1:] == keys[order][:-1]]] = True
    return out


def with_row(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Keys that differ between rows."""
    with np.errstate(over="ignore"):
        return mix(keys + mix((rows.astype(np.uint64) + np.uint64(1)) * BASE))
