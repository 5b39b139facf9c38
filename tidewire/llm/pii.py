"""Personal data: base patterns, and a linear-chain CRF over word shapes that adds what they miss.

The CRF labels words near a digit, an ``@`` or a spelled-out ``at`` or ``dot``
in brackets, also inside a word; every form of ``entity`` holds one of them and
lies in the window around it.  It is trained on the driver from a small labelled
table (words and tags), sent to the tasks, and decoded by Viterbi for many
windows at once.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from . import spans as S

KINDS = ["email", "ip", "card", "phone"]
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
FEATURES = 1 << 13
# Rows of the labelled table that training reads at most.
LABELLED_ROWS = 2_000
# Words on both sides of a hint that are labelled: the last word of '{n} (at) {h} (dot) com' is three behind '(at)'; and one neighbour.
CONTEXT = 4

# The base patterns, in forms that read a text once.
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = np.zeros(256, bool)
LOCAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")] = True
DIGITS = np.zeros(256, bool)
DIGITS[list(b"0123456789")] = True
HINT = DIGITS.copy()
HINT[ord("@")] = True


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def only_digits(raw: bytes) -> str:
    return "".join(chr(b) for b in raw if 48 <= b <= 57)


def emails(text: bytes) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find(b"@")
    while at >= 0:
        lo = at
        while lo > done and LOCAL[text[lo - 1]]:
            lo -= 1
        domain = DOMAIN.match(text, at + 1) if lo < at else None
        if domain:
            yield lo, domain.end()
            done = domain.end()
        at = text.find(b"@", max(at + 1, done))


def base_spans(text: bytes) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) in bytes."""
    for lo, hi in emails(text):
        yield 0, lo, hi
    for m in IP.finditer(text):
        if all(len(p.lstrip(b"0")) <= 3 and int(p) <= 255 for p in m[0].split(b".")):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield 2, m.start(), m.end()
    for m in PHONE.finditer(text):
        if 10 <= len(only_digits(m[0])) <= 15:
            yield 3, m.start(), m.end()


# word shapes and features

SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 else ord("9") if 48 <= b <= 57 else ord("u") if b > 127 else b
    for b in range(256)
)
RUNS = re.compile(rb"(.)\1*", re.S)


def shape(word: bytes) -> tuple[bytes, bytes]:
    """The shape with run lengths, and without."""
    runs = [(m[1], len(m[0])) for m in RUNS.finditer(word.translate(SHAPE))]
    return b"".join(c + b"%d" % min(n, 9) for c, n in runs), b"".join(c for c, _ in runs)


def word_features(word: bytes) -> list[bytes]:
    full, short = shape(word)
    digits = only_digits(word)
    n = len(digits)
    out = [b"f" + full[:40], b"s" + short[:40], b"a" + full[:4], b"z" + full[-4:], b"n%d" % min(n, 20)]
    if b"@" in word:
        out.append(b"@" + (b"." if b"." in word.rpartition(b"@")[2] else b""))
    if 14 <= n <= 19:
        out.append(b"luhn" if luhn(digits) else b"no-luhn")
    parts = word.strip(b".,;:!?()[]\"'").split(b".")
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        out.append(b"quad" if all(len(p) < 4 and int(p) <= 255 for p in parts) else b"no-quad")
    if not n and len(word) <= 12:
        out.append(b"w" + word.strip(b".,;:!?\"'").lower())
    return out


def feature_ids(words: list[bytes]) -> list[np.ndarray]:
    own = [word_features(w) for w in words]
    out = []
    for t in range(len(words)):
        names = own[t] + [b"<" + f for f in (own[t - 1] if t else [b"^"])] + [b">" + f for f in (own[t + 1] if t + 1 < len(words) else [b"$"])]
        # digits of the neighbours together with the own ones: cards and numbers in groups
        near = only_digits(b"".join(words[max(0, t - 3) : t + 4]))
        names.append(b"near%d" % min(len(near), 24))
        out.append(np.array(sorted({crc32(x) % FEATURES for x in names})))
    return out


class Crf:
    """Weights per feature and tag, and per pair of tags."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def emissions(self, ids: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(x) for x in ids])
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        return np.add.reduceat(self.weights[np.concatenate(ids)], starts, axis=0)

    def decode(self, sentences: list[list[np.ndarray]], batch: int = 512) -> list[np.ndarray]:
        """Best tags of each sentence; sentences of similar length are decoded together."""
        out: list = [None] * len(sentences)
        order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
        for at in range(0, len(order), batch):
            group = order[at : at + batch]
            sizes = np.array([len(sentences[i]) for i in group])
            flat = self.emissions([f for i in group for f in sentences[i]])
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            score = flat[starts]
            back = np.zeros((sizes.max(), len(group), len(TAGS)), np.int8)
            for t in range(1, sizes.max()):
                live = np.flatnonzero(sizes > t)
                step = score[live, :, None] + self.moves
                back[t, live] = step.argmax(1)
                score[live] = step.max(1) + flat[starts[live] + t]
            best = score.argmax(1)
            for g, i in enumerate(group):
                tags = np.zeros(sizes[g], np.int64)
                tags[-1] = best[g]
                for t in range(sizes[g] - 1, 0, -1):
                    tags[t - 1] = back[t, g, tags[t]]
                out[i] = tags
        return out


def train(rows: list[tuple[list[str], list[str]]], epochs: int = 60, rate: float = 0.1, decay: float = 1e-4) -> Crf:
    """Maximum likelihood by full-batch Adam; forward and backward sums for all sentences at once."""
    rows = [r for r in rows if len(r[0])]
    n_tags = len(TAGS)
    sentences = [feature_ids([w.encode() for w in words]) for words, _ in rows]
    longest = max(map(len, sentences))
    size = np.array([len(s) for s in sentences])
    gold = np.zeros((len(rows), longest), np.int64)
    for k, (_, tags) in enumerate(rows):
        gold[k, : size[k]] = [TAGS.index(t) for t in tags]
    flat = [f for s in sentences for f in s]
    token_of = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
    ids = np.concatenate(flat)
    mask = np.arange(longest) < size[:, None]
    legal = np.zeros((n_tags, n_tags))
    for j, tag in enumerate(TAGS):
        if tag.startswith("I-"):
            legal[[i for i in range(n_tags) if TAGS[i][2:] != tag[2:]], j] = -1e4
    begin = np.where([t.startswith("I-") for t in TAGS], -1e4, 0.0)
    weights, moves = np.zeros((FEATURES, n_tags)), np.zeros((n_tags, n_tags))
    state = [np.zeros_like(x) for x in (weights, weights, moves, moves)]
    counted = np.zeros_like(weights)
    np.add.at(counted, ids, np.eye(n_tags)[gold[mask]][token_of])
    steps_gold = np.zeros_like(moves)
    np.add.at(steps_gold, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for epoch in range(1, epochs + 1):
        score = np.zeros((len(rows), longest, n_tags))
        score[mask] = Crf(weights, moves).emissions(flat)
        step = moves + legal
        ahead = np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + begin
        for t in range(1, longest):
            new = lse(ahead[:, t - 1, :, None] + step, 1) + score[:, t]
            ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
        total = lse(ahead[:, -1], 1)
        behind = np.zeros_like(score)
        expected_moves = np.zeros_like(moves)
        for t in range(longest - 2, -1, -1):
            inner = score[:, t + 1] + behind[:, t + 1]
            both = ahead[:, t, :, None] + step + inner[:, None, :] - total[:, None, None]
            expected_moves += (np.exp(both) * mask[:, t + 1, None, None]).sum(0)
            behind[:, t] = np.where(mask[:, t + 1, None], lse(step + inner[:, None, :], 2), 0)
        share = np.exp(ahead + behind - total[:, None, None])[mask]
        expected = np.zeros_like(weights)
        np.add.at(expected, ids, share[token_of])
        for k, (x, grad) in enumerate((
            (weights, (counted - expected) / len(rows) - decay * weights),
            (moves, (steps_gold - expected_moves) / len(rows) - decay * moves),
        )):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * grad
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * grad**2
            x += rate * (state[2 * k] / (1 - 0.9**epoch)) / (np.sqrt(state[2 * k + 1] / (1 - 0.99**epoch)) + 1e-8)
    final = moves + legal
    # a sentence's first tag: a word in front of it that is outside
    return Crf(weights.astype(np.float32), final.astype(np.float32))


# labelled rows


def labelled_table(docs: DataFrame, text_col: str = "text", rows: int = 1_200, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """Labelled sentences: lines of at most ``rows`` documents (the least hash of their text in each of as many slots; 400 characters at most, without words of over 24) with entities and look-alikes set in by rule."""
    picked = (
        docs.select(F.substring(F.substring_index(F.col(text_col), "\n", 1), 1, 400).alias("line"), F.xxhash64(text_col).alias("h"))
        .filter(F.length("line") > 0).groupBy(F.pmod("h", F.lit(min(rows, LABELLED_ROWS))).alias("slot"))
        .agg(F.min(F.struct("h", "line")).alias("least")).select("least.*").collect()
    )
    picked.sort(key=lambda r: (r["h"], r["line"]))
    rng = random.Random(seed)
    lines = [[w for w in r["line"].split() if len(w) <= 24][:8] for r in picked] or [["a", "line"]]
    return [set_in(rng, lines[k % len(lines)]) for k in range(min(rows, LABELLED_ROWS))]


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random, valid: bool) -> str:
    body = rng.choice("3456") + _digits(rng, rng.choice([13, 14, 14, 14, 15, 17]))
    good = next(c for c in "0123456789" if luhn(body + c))
    return body + (good if valid else rng.choice([c for c in "0123456789" if c != good]))


def _groups(digits: str, sep: str) -> str:
    return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def entity(rng: random.Random) -> tuple[str, str]:
    """(kind, text) of an entity, in forms the base patterns find and in others."""
    name = rng.choice(["ann", "j.doe", "max_7", "info", "the.52", "eau.46"])
    host = rng.choice(["mail5", "example", "post", "web-1"])
    area, mid, line = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    kind = rng.choice(KINDS)
    if kind == "email":
        form = rng.choice(["{n}@{h}.example.com", "{n}@{h}.net", "{n}[at]{h}.org", "{n} (at) {h} (dot) com", "{n} [at] {h} [dot] net"])
        return kind, form.format(n=name, h=host)
    if kind == "ip":
        quad = ".".join(str(rng.randint(1, 255)) for _ in range(4))
        return kind, rng.choice([quad, quad, f"{quad}:80{_digits(rng, 2)}", f"2001:db8:{_digits(rng, 2)}::{_digits(rng, 1)}"])
    if kind == "card":
        number = _card(rng, True)
        return kind, rng.choice([number, _groups(number, " "), _groups(number, "-"), _groups(number, ".")])
    form = rng.choice(["+1 ({a}) {m}-{l}", "+1 ({a}) 555-{l}", "+44 {a} {m} {l}", "({a}) {m}-{l}", "{a}-{m}-{l}", "{a}.{m}.{l}", "00{a} {m} {l}{m}"])
    return kind, form.format(a=area, m=mid, l=line)


def look_alike(rng: random.Random) -> str:
    """Digits that are no personal data."""
    return rng.choice([
        lambda: str(rng.randint(1, 9999)), lambda: str(rng.randint(1900, 2030)), lambda: f"{rng.randint(1, 20)}.{rng.randint(0, 20)}",
        lambda: f"v{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", lambda: f"Version 2.{rng.randint(0, 9)}.",
        lambda: f"20{_digits(rng, 2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", lambda: f"{rng.randint(0, 23)}:{_digits(rng, 2)}",
        lambda: f"${rng.randint(1, 999)}.{_digits(rng, 2)}", lambda: f"#{_digits(rng, 6)}", lambda: f"{_digits(rng, 3)},{_digits(rng, 3)}",
        lambda: _card(rng, False), lambda: _card(rng, False), lambda: _groups(_card(rng, False), " "), lambda: _digits(rng, rng.randint(5, 13)),
        lambda: f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"', lambda: f"{rng.randint(256, 999)}.1.2.3",
        lambda: f"https://a{rng.randint(1, 9)}.example.com/en/{rng.randint(1, 999)}", lambda: f"{rng.randint(1, 99)}%", lambda: "@", lambda: "a@b",
        lambda: f"{_digits(rng, 2)}/{_digits(rng, 2)}/20{_digits(rng, 2)}", lambda: f"{_digits(rng, 4)}-{_digits(rng, 4)}",
        lambda: " ".join(str(rng.randint(1, 99)) for _ in range(rng.randint(2, 8))),
        lambda: " ".join(f"{rng.randint(1, 9)}." + _digits(rng, 2) for _ in range(4)),
    ])()


def set_in(rng: random.Random, words: list[str]) -> tuple[list[str], list[str]]:
    words, tags = list(words), ["O"] * len(words)
    for _ in range(rng.randint(1, 3)):
        at = rng.randint(0, len(words))
        while at < len(words) and tags[at].startswith("I-"):
            at += 1
        if rng.random() < 0.5:
            kind, text = entity(rng)
            new = text.split()
            new_tags = [f"{'I' if k else 'B'}-{kind}" for k in range(len(new))]
            if rng.random() < 0.2:  # another one right behind it
                kind, text = entity(rng)
                new_tags += [f"{'I' if k else 'B'}-{kind}" for k in range(len(text.split()))]
                new += text.split()
            if rng.random() < 0.3:
                new[-1] += rng.choice([".", ",", "###", "&&&", "!!"])
        else:
            new = look_alike(rng).split()
            new_tags = ["O"] * len(new)
        words[at:at] = new
        tags[at:at] = new_tags
    return words, tags


# texts


def plausible(kind: str, raw: bytes) -> bool:
    """What a span that the CRF adds must hold; its tags alone cannot count digits."""
    n = len(only_digits(raw))
    if kind == "email":
        return b"@" in raw or b"at" in raw.lower()
    if kind == "ip":
        return (raw.count(b".") >= 3 or raw.count(b":") >= 2) and all(
            len(p) < 4 and int(p) <= 255 for p in re.findall(rb"[0-9]+(?=\.)", raw))
    if kind == "card":
        return 14 <= n <= 19 and luhn(only_digits(raw))
    return 7 <= n <= 15


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that hold a spelled-out at or dot in brackets."""
    low = np.concatenate([A.LOWER[data], np.zeros(4, np.uint8)])
    opens = np.flatnonzero((data == ord("(")) | (data == ord("[")))
    word = np.searchsorted(starts, opens, "right") - 1
    out = np.zeros(len(starts), bool)
    for name in (b"at", b"dot"):
        is_it = opens + len(name) + 1 < ends[word]
        for k, c in enumerate(name, 1):
            is_it &= low[opens + k] == c
        shut = low[opens + len(name) + 1]
        out[word[is_it & ((shut == ord(")")) | (shut == ord("]")))]] = True
    return out


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Runs of words around those with a digit, an ``@`` or a spelled-out at or dot."""
    if not len(starts):
        return []
    hot = (A.per_row(HINT[data], np.stack([starts, ends], 1).ravel())[::2] > 0) | spelled(data, starts, ends)
    near = np.zeros(len(starts), bool)
    for k in range(-CONTEXT, CONTEXT + 1):
        i = np.flatnonzero(hot) + k
        ok = (i >= 0) & (i < len(starts))
        i, j = i[ok], i[ok] - k
        near[i[rows[i] == rows[j]]] = True
    at = np.flatnonzero(near)
    if not len(at):
        return []
    return np.split(at, np.flatnonzero((np.diff(at) > 1) | (np.diff(rows[at]) != 0)) + 1)


EDGE = b".,;:!?\"'#*$%&|<>{}"


def crf_spans(model: Crf, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> Iterator[S.Found]:
    runs = windows(data, starts, ends, rows)
    raw = data.tobytes()
    texts = [[raw[starts[i] : ends[i]] for i in run.tolist()] for run in runs]
    for run, tags in zip(runs, model.decode([feature_ids(t) for t in texts])):
        t = 0
        while t < len(run):
            if not TAGS[tags[t]].startswith("B-"):
                t += 1
                continue
            kind, stop = TAGS[tags[t]][2:], t + 1
            while stop < len(run) and TAGS[tags[stop]] == f"I-{kind}":
                stop += 1
            lo, hi = int(starts[run[t]]), int(ends[run[stop - 1]])
            while hi > lo and raw[hi - 1] in EDGE:
                hi -= 1
            while lo < hi and raw[lo] in EDGE:
                lo += 1
            if hi > lo and plausible(kind, raw[lo:hi]):
                yield int(rows[run[t]]), KINDS.index(kind), lo, hi, False
            t = stop


def find(column: pa.Array, model: Crf) -> pa.Array:
    """Spans of all texts of a column."""
    data, bounds = A.byte_view(column)
    starts, ends = A.word_spans(data, bounds)
    rows = A.row_of(bounds, starts)
    found: list[S.Found] = []
    for r in np.flatnonzero(A.per_row(HINT[data], bounds) > 0).tolist():
        lo = int(bounds[r])
        found += [(r, k, lo + a, lo + b, True) for k, a, b in base_spans(data[lo : bounds[r + 1]].tobytes())]
    taken = np.zeros(len(data) + 1, bool)
    for f in found:
        taken[f[2] : f[3]] = True
    found += [f for f in crf_spans(model, data, starts, ends, rows) if not taken[f[2] : f[3]].any()]
    return S.to_arrow(found, KINDS, data, bounds)


def detect(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, spans (kind, start, end in code points, base).

    Base spans stay as the patterns find them; the CRF adds spans that touch
    none of them.  A null text counts as empty; ids may be null or repeated; an
    empty table gives an empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("spans", S.SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([part[id_col], find(part[text_col], shared.value)], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
