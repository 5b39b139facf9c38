"""Byte-level BPE: speculate with greedy longest matches, verify every adjacent pair, merge what fails.

Pre-tokens are cut with array operations over character classes that are asked
of the tokenizer library itself.  Each distinct pre-token of a batch that is not
cached yet is proposed as its greedy longest matches.  A proposal is the exact
encoding if no two neighbours could have merged across their border, which is
checked for all pairs at once; only failing words are merged step by step.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from . import arrays as A

# Distinct words a worker remembers before it starts anew.
CACHE_WORDS = 300_000
# Bytes beyond which a word is merged by itself.
LONG_WORD = 128
# Characters beyond these ranges are unassigned or private: neither letter, number nor space.
PROBED = [(0, 0xD800), (0xE000, 0x34000), (0xE0000, 0xE1000)]
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
NEVER = np.int64(1) << 40

# Endings that follow an apostrophe in the pre-tokenizer's pattern.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def character_classes(tokenizer: Tokenizer) -> np.ndarray:
    """Class of every code point, asked of the pre-tokenizer: which neighbour does it join?"""
    out = np.zeros(0x110000, np.uint8)
    for lo, hi in PROBED:
        points = np.arange(lo, hi)
        for kind, mate in ((LETTER, "a"), (NUMBER, "1"), (SPACE, "a")):
            order = "!{1}{0}!" if kind != SPACE else "!{0}{1}!"
            text = "".join(order.format(chr(p), mate) for p in points)
            starts = np.zeros(len(text) + 1, bool)
            starts[[s for _, (s, _) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]] = True
            at = 4 * np.arange(len(points))
            if kind == SPACE:  # a mark joins the mark before it, white space does not
                out[points[starts[at + 1] & (out[points] == OTHER)]] = SPACE
            else:
                out[points[~starts[at + 2]]] = kind
    out[[9, 10, 11, 12, 13, 32]] = SPACE
    return out


def token_bytes(spec: dict) -> list[bytes]:
    """The bytes of every id."""
    stand_in, names = byte_alphabet(), spec["model"]["vocab"]
    added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    words = [b""] * (max([*names.values(), *added]) + 1)
    for name, i in names.items():
        words[i] = bytes(stand_in[c] for c in name)
    for i, word in added.items():
        words[i] = word
    return words


class Decoder:
    """The bytes of all ids, one after another, and where each begins."""

    def __init__(self, words: list[bytes]):
        self.blob = np.frombuffer(b"".join(words), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ids, and the bounds of each id in them."""
        ids = ids.astype(np.int64)
        sizes = self.bounds[ids + 1] - self.bounds[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.blob[np.repeat(self.bounds[ids] - total[:-1], sizes) + np.arange(total[-1])], total


class Vocabulary(Decoder):
    """What encoding needs, from the JSON text of a byte-level BPE tokenizer."""

    def __init__(self, source: str, classes: np.ndarray | None = None):
        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        names = model["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.words = words = token_bytes(spec)
        super().__init__(words)
        size = len(words)
        self.classes = character_classes(Tokenizer.from_str(source)) if classes is None else classes

        # merges: key left * size + right, in order of rank
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([names[a] for a, _ in pairs], np.int64)
        right = np.array([names[b] for _, b in pairs], np.int64)
        made = np.array([names[a + b] for a, b in pairs], np.int64)
        self.size = size
        keys = left * size + right
        order = np.argsort(keys)
        self.merge_keys, self.merge_ranks = keys[order], order
        self.left, self.right = np.arange(size), np.arange(size)
        self.formed = np.full(size, -1, np.int64)
        # the first merge that makes a token is the one that forms it
        for array, value in ((self.left, left), (self.right, right), (self.formed, np.arange(len(pairs)))):
            array[made[::-1]] = value[::-1]
        self.made = made

        plain = [(names[n], words[names[n]]) for n in names]
        self.byte_id = np.zeros(256, np.int64)
        for i, w in plain:
            if len(w) == 1:
                self.byte_id[w[0]] = i
        self.tokens = self._by_length([w for _, w in plain], [i for i, _ in plain])
        heads = {w[:k] for _, w in plain for k in range(1, len(w))}
        self.heads = self._by_length(list(heads), [0] * len(heads))
        self._cache_reset()
        self.sound = np.ones(size, bool)
        self.sound = self._self_encoding(plain)

    @staticmethod
    def _by_length(words: list[bytes], ids: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        out, groups = {}, {}
        for w, i in zip(words, ids):
            groups.setdefault(len(w), []).append((w, i))
        for n, found in groups.items():
            data = np.frombuffer(b"".join(w for w, _ in found), np.uint8)
            at = np.arange(0, len(data), n)
            keys = A.hash_spans(data, at, at + n)
            order = np.argsort(keys)
            out[n] = keys[order], np.array([i for _, i in found])[order]
        return out

    def _self_encoding(self, plain: list[tuple[int, bytes]]) -> np.ndarray:
        """False for tokens whose own bytes would be encoded otherwise."""
        ids = np.array([i for i, w in plain if len(w) > 1])
        ok = np.ones(self.size, bool)
        ok[ids] = (self.formed[ids] >= 0) & ~self.joins(self.left[ids], self.right[ids], self.formed[ids])
        # monotone ranks: parts are formed before the whole
        rises = (self.formed[self.left[ids]] < self.formed[ids]) & (self.formed[self.right[ids]] < self.formed[ids])
        ok[ids] &= rises
        for i in sorted(ids.tolist(), key=lambda i: self.formed[i]):
            ok[i] &= ok[self.left[i]] and ok[self.right[i]]
        return ok

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b, NEVER where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == key, self.merge_ranks[at], NEVER)

    def joins(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """True where bytes of a and b side by side would merge across the border.

        Walks back in time: of the two pieces at the border the one formed last
        is undone, and a merge across counts if it comes before that event.  At
        equal rank the merge further left comes first.
        """
        x, y = a.copy(), b.copy()
        limit = np.full(len(x), NEVER) if before is None else before.copy()
        on_right = np.zeros(len(x), bool)
        bad = np.zeros(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            r = self.rank(x[live], y[live])
            bad[live] = (r < limit[live]) | ((r == limit[live]) & on_right[live] & (r != NEVER))
            fx, fy = self.formed[x[live]], self.formed[y[live]]
            go = ~bad[live] & ((fx >= 0) | (fy >= 0))
            live, fx, fy = live[go], fx[go], fy[go]
            undo_x = fx > fy
            i, j = live[undo_x], live[~undo_x]
            limit[i], limit[j] = fx[undo_x], fy[~undo_x]
            x[i], y[j] = self.right[x[i]], self.left[y[j]]
            on_right[i], on_right[j] = False, True
        return bad

    # words -> ids

    def _cache_reset(self) -> None:
        self.known: dict[int, int] = {}
        self.pool, self.pool_ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _remember(self, ids: np.ndarray, bounds: np.ndarray) -> None:
        self.pool_ends = np.concatenate([self.pool_ends, len(self.pool) + bounds[1:]])
        self.pool = np.concatenate([self.pool, ids])

    def speculate(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of words given as bytes and bounds: ids, and words' bounds in them."""
        n = len(data)
        left_over = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
        best_len, best_id = np.ones(n, np.int64), self.byte_id[data]
        alive, k = np.arange(n), 1
        while True:
            k += 1
            heads = self.heads.get(k - 1)
            if heads is None:
                break
            if k > 2:
                alive = alive[_found(heads[0], A.hash_spans(data, alive, alive + k - 1))[0]]
            alive = alive[left_over[alive] >= k]
            if not len(alive):
                break
            if k in self.tokens:
                keys, ids = self.tokens[k]
                hit, at = _found(keys, A.hash_spans(data, alive, alive + k))
                best_len[alive[hit]] = k
                best_id[alive[hit]] = ids[at[hit]]
        # follow the matches of all words in step; positions on a path are marked
        on_path = np.zeros(n + 1, bool)
        at, stop = bounds[:-1].copy(), bounds[1:]
        live = np.flatnonzero(at < stop)
        while len(live) > 8:
            on_path[at[live]] = True
            at[live] += best_len[at[live]]
            live = live[at[live] < stop[live]]
        for w in live.tolist():  # a few long words
            p, end = int(at[w]), int(stop[w])
            steps = best_len[p:end].tolist()
            marks, base = [], p
            while p < end:
                marks.append(p)
                p += steps[p - base]
            on_path[marks] = True
        picked = np.flatnonzero(on_path)
        return best_id[picked], np.searchsorted(picked, bounds)

    def encode_words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact ids of words, one after another, and each word's bounds in them."""
        ids, at = self.speculate(data, bounds)
        word = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
        wrong = np.zeros(len(bounds) - 1, bool)
        wrong[word[~self.sound[ids]]] = True
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair, back = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        bad = self.joins(pair // self.size, pair % self.size)
        wrong[word[inner[bad[back]]]] = True
        right = ~wrong[word]
        found, owner = [ids[right]], [word[right]]
        sizes = np.diff(bounds)
        for w in np.flatnonzero(wrong & (sizes > LONG_WORD)).tolist():
            found.append(self.merge(data[bounds[w] : bounds[w + 1]]))
            owner.append(np.full(len(found[-1]), w))
        short = np.flatnonzero(wrong & (sizes <= LONG_WORD))
        for merged, place in self.merge_all(data, bounds[short], bounds[short + 1]):
            found.append(merged)
            owner.append(short[place])
        found, owner = np.concatenate(found), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return found[order].astype(np.uint32), np.searchsorted(owner[order], np.arange(len(bounds)))

    def merge_all(self, data: np.ndarray, starts: np.ndarray,
                  ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge many short words in step: each round joins every word's lowest pair, leftmost
        first.  Yields ids of finished words and the words' numbers."""
        sizes = ends - starts
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.byte_id[data[np.arange(total[-1]) + np.repeat(starts - total[:-1], sizes)]]
        word, number = np.repeat(np.arange(len(starts)), sizes), np.arange(len(starts))
        ranks = np.full(len(ids), NEVER)
        inner = np.flatnonzero(word[1:] == word[:-1])
        ranks[inner] = self.rank(ids[inner], ids[inner + 1])
        while len(ids):
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(ranks, heads)
            over = lowest == NEVER
            sizes = np.diff(np.append(heads, len(ids)))
            if over.any():  # finished words leave
                stay = np.repeat(~over, sizes)
                yield ids[~stay], np.repeat(number[over], sizes[over])
                ids, ranks, number, lowest, sizes = ids[stay], ranks[stay], number[~over], lowest[~over], sizes[~over]
                word = np.repeat(np.arange(len(number)), sizes)
                if not len(ids):
                    break
            at = np.flatnonzero(ranks == lowest[word])
            at = at[np.concatenate([[True], word[at][1:] != word[at][:-1]])]
            ids[at] = self.made[lowest]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            at = place[at]
            ids, ranks, word = ids[stay], ranks[stay], word[stay]
            ranks[at] = NEVER
            for i in (at[at > 0] - 1, at[at < len(ids) - 1]):
                i = i[word[i] == word[i + 1]]
                ranks[i] = self.rank(ids[i], ids[i + 1])

    def merge(self, word: np.ndarray) -> np.ndarray:
        """Merge one long word step by step: always the lowest rank, leftmost first."""
        ids = self.byte_id[word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.rank(ids[:-1], ids[1:])
        heap = [(int(first[i]), i, int(ids[i]), int(ids[i + 1])) for i in np.flatnonzero(first != NEVER)]
        heapq.heapify(heap)
        ids = ids.tolist()

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                key = ids[i] * self.size + ids[j]
                at = int(np.searchsorted(self.merge_keys, key))
                if at < len(self.merge_keys) and self.merge_keys[at] == key:
                    heapq.heappush(heap, (int(self.merge_ranks[at]), i, ids[i], ids[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([t for t in ids if t >= 0], np.uint32)

    # texts -> ids

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after another, and each text's bounds in them."""
        data, bounds = A.byte_view(column)
        cuts, fixed = self._specials(data, bounds)
        starts, ends = pre_tokens(data, cuts, self.classes)
        special = None
        if fixed:
            added = np.array(sorted(fixed))
            size = np.array([len(self.words[fixed[p]]) for p in added.tolist()])
            owner = np.searchsorted(added, starts, "right") - 1
            inside = (owner >= 0) & (starts > added[owner]) & (starts < added[owner] + size[owner])
            starts, ends = starts[~inside], np.append(starts[~inside][1:], len(data))
            special = np.array([fixed.get(s, -1) for s in starts.tolist()], np.int64)
        keys = A.hash_spans(data, starts, ends)
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self._cache_reset()
        known = self.known
        slot = np.array([known.get(k, -1) for k in distinct.tolist()], np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            s, e = starts[first[new]], ends[first[new]]
            sizes = np.concatenate([[0], np.cumsum(e - s)])
            at = np.arange(sizes[-1]) + np.repeat(s - sizes[:-1], e - s)
            slot[new] = len(self.pool_ends) - 1 + np.arange(len(new))
            self._remember(*self.encode_words(data[at], sizes))
            known.update(zip(distinct[new].tolist(), slot[new].tolist()))
        offset, here = self.pool_ends[slot][back], np.diff(self.pool_ends)[slot][back]
        if special is not None:  # added tokens stand for themselves, right behind the pool
            mask = special >= 0
            offset[mask], here[mask] = len(self.pool) + np.arange(mask.sum()), 1
            pool = np.concatenate([self.pool, special[mask].astype(np.uint32)])
        else:
            pool = self.pool
        total = np.concatenate([[0], np.cumsum(here)])
        ids = pool[np.repeat(offset - total[:-1], here) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, bounds)]

    def _specials(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
        """Bounds of stretches that are cut by themselves, and the ids of those that are added tokens."""
        whole, cuts, fixed = None, [bounds], {}
        for word, i in self.special.items():
            head = np.flatnonzero(data[: len(data) - len(word) + 1] == word[0]) if len(data) >= len(word) else []
            if not len(head) or not (data[np.asarray(head) + 1] == word[1]).any():
                continue
            whole = data.tobytes() if whole is None else whole
            p = whole.find(word)
            while p >= 0:
                row = int(A.row_of(bounds, np.array([p]))[0])
                if p + len(word) <= bounds[row + 1]:
                    fixed[p] = i
                    cuts.append([p, p + len(word)])
                    p = whole.find(word, p + len(word))
                else:
                    p = whole.find(word, p + 1)
        return (np.unique(np.concatenate(cuts)) if fixed else np.unique(bounds)), fixed


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return keys[at] == asked, at


def pre_tokens(data: np.ndarray, cuts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of pre-tokens: an ending after an apostrophe; a run of letters,
    numbers or other marks with the one blank before it; white space, whose last
    character stays apart if something follows.  No span crosses a cut."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(A.code_points(data))
    text = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(text)
    kind = classes[text]
    begins = np.zeros(n + 1, bool)
    begins[np.searchsorted(heads, cuts)] = True
    begins[n] = True
    run = begins.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    start = run.copy()

    space = kind == SPACE
    # a run of marks after a blank begins at the blank
    first = np.flatnonzero(run[:n] & ~space)
    after_blank = first[(first > 0) & ~begins[first]]
    after_blank = after_blank[text[after_blank - 1] == 32]
    start[after_blank] = False
    # the last character of white space before something else stands apart
    after_space = first[(first > 0) & ~begins[first]]
    start[after_space[space[after_space - 1]] - 1] = True
    # endings after an apostrophe that begins a pre-token
    quote = np.flatnonzero((text == 39) & start[:n])
    for ending in ENDINGS:
        k = len(ending)
        q = quote[quote + k < n]
        fits = np.ones(len(q), bool)
        for j, c in enumerate(ending):
            fits &= (text[q + 1 + j] == ord(c)) & ~begins[q + 1 + j]
        start[q[fits] + 1] = False
        start[q[fits] + 1 + k] = True
    at = np.flatnonzero(start[:n])
    heads = np.append(heads, len(data))
    return heads[at], heads[np.append(at[1:], n)]


class Tokenization:
    """A vocabulary file (bounded in size), read on the driver, sent to every worker and built there once."""

    _built: dict[int, Vocabulary] = {}

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            source = f.read()
        if len(source) > 64 << 20:
            raise ValueError("vocabulary file beyond 64 MB")
        classes = character_classes(Tokenizer.from_str(source))
        self.shared = spark.sparkContext.broadcast((source, classes))
        self.key = hash(source)

    def vocabulary(self) -> Vocabulary:
        if self.key not in Tokenization._built:
            Tokenization._built.clear()
            Tokenization._built[self.key] = Vocabulary(*self.shared.value)
        return Tokenization._built[self.key]


def free_name(names: list[str], wanted: str) -> str:
    while wanted in names:
        wanted += "_"
    return wanted


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (little-endian unsigned 32-bit numbers).

    Ids are those of the tokenizer at path ``tokenizer`` without special tokens
    added; an added token's string within a text gives its id.  A null text
    counts as empty and has no ids; ids of documents may be null or repeated;
    an empty table gives an empty result; other columns are not read.  Memory is
    bounded by a slice of texts, or the longest text, and the word cache.
    """
    shared = Tokenization(docs.sparkSession, tokenizer)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.vocabulary()
        for batch in batches:
            for part in A.slices(batch, text_col, 2 * A.SLICE_BYTES):
                ids, bounds = vocabulary.encode(part[text_col])
                raw = ids.astype("<u4").tobytes()
                rows = pa.array([raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part[id_col], rows], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the text of their ids in ``text_col``.

    Null ids give an empty text; bytes that are no UTF-8 become the replacement
    character; ``text_col`` must not be among the columns yet.
    """
    if text_col in encoded.columns:
        raise ValueError(f"column {text_col} is there already")
    with open(tokenizer, encoding="utf-8") as f:
        table = Decoder(token_bytes(json.load(f)))
    shared = encoded.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([*encoded.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, ids_col):
                ids = part[ids_col].to_pylist()
                data, at = shared.value.decode(np.frombuffer(b"".join(x or b"" for x in ids), "<u4"))
                ends = at[np.cumsum([0] + [len(x or b"") // 4 for x in ids])].tolist()
                raw = data.tobytes()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
