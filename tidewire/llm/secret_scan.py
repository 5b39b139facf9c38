"""Secrets: base patterns, and a character-level convolutional network that judges every other candidate.

A candidate is a long run of token characters with letters and digits.  The
network reads the whole candidate with the characters around it, through
one-hot convolutions and pooling over any length.  It is trained on labelled
findings; its scores are calibrated on findings kept apart, and the threshold is
the highest that keeps the asked recall there.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from . import spans as S

KINDS = ["assign", "access", "hex", "learned"]
LEARNED = 3

# The base patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
WORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = np.zeros(256, bool)
HEX[list(b"0123456789abcdef")] = True

TOKEN = np.zeros(256, bool)
TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
LETTERS = np.zeros(256, bool)
LETTERS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
DIGITS = np.zeros(256, bool)
DIGITS[list(b"0123456789")] = True
MIN_CANDIDATE = 20
BEFORE, AFTER = 24, 8

# Rows of the labelled table that training reads at most.
LABELLED_ROWS = 4_000


def classes() -> np.ndarray:
    """Class of each byte: case and rough kind of letter, digit, hex letter, separators, others."""
    out = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        if b > 127:
            out[b] = 1
        elif c in "abcdef":
            out[b] = 2
        elif c in "ghijklmnopqrstuvwxyz":
            out[b] = 3 + "ghijklmnopqrstuvwxyz".index(c) // 2
        elif c.isupper():
            out[b] = 13 + (ord(c) - 65) // 6
        elif c.isdigit():
            out[b] = 18
        elif c in " \t\n\r":
            out[b] = 19
        elif c in "+/_=-.:\"'":
            out[b] = 20 + "+/_=-.:\"'".index(c)
        else:
            out[b] = 29
    return out


CLASS = classes()
N_CLASSES = 30
# classes of context characters are set apart from those of the candidate; the last pads
PAD = 2 * N_CLASSES
WIDTH, FILTERS = 5, 24


def encode(before: bytes, candidate: bytes, after: bytes) -> np.ndarray:
    parts = [CLASS[np.frombuffer(x, np.uint8)] for x in (before, candidate, after)]
    return np.concatenate([parts[0] + N_CLASSES, parts[1], parts[2] + N_CLASSES])


class Network:
    """Embedding-free convolution (a weight per place, class and filter), ReLU, maximum and mean
    over the text, a logistic unit; then calibration and a threshold."""

    def __init__(self, rng: np.random.Generator):
        self.conv = rng.normal(0, 0.15, (WIDTH, PAD + 1, FILTERS))
        self.conv[:, PAD] = 0
        self.shift = np.zeros(FILTERS)
        self.out = rng.normal(0, 0.15, 2 * FILTERS)
        self.bias = np.zeros(1)
        self.scale, self.offset, self.threshold = 1.0, 0.0, 0.5

    def forward(self, x: np.ndarray, size: np.ndarray):
        n = x.shape[1] - WIDTH + 1
        hidden = self.shift + sum(self.conv[k][x[:, k : k + n]] for k in range(WIDTH))
        hidden = np.maximum(hidden, 0)
        hidden[np.arange(n) >= size[:, None] - WIDTH + 1] = 0
        top = hidden.argmax(1)
        most = np.take_along_axis(hidden, top[:, None], 1)[:, 0]
        features = np.concatenate([most, hidden.sum(1) / size[:, None]], 1)
        return hidden, top, features, features @ self.out + self.bias[0]

    def scores(self, texts: list[np.ndarray], batch: int = 256) -> np.ndarray:
        """Calibrated probabilities; texts of similar length are judged together."""
        out = np.zeros(len(texts))
        order = np.argsort([len(t) for t in texts], kind="stable")
        at = 0
        while at < len(order):
            longest = len(texts[order[min(at + batch, len(order)) - 1]])
            take = max(1, min(batch, (1 << 20) // max(longest * FILTERS, 1)))
            group = order[at : at + take]
            out[group] = self.forward(*padded([texts[i] for i in group]))[3]
            at += take
        return 1 / (1 + np.exp(-(self.scale * out + self.offset)))


def padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([max(len(t), WIDTH) for t in texts])
    x = np.full((len(texts), size.max()), PAD)
    for k, t in enumerate(texts):
        x[k, : len(t)] = t
    return x, size


def train(rows: list[tuple[bytes, bytes, bytes, int]], recall: float = 0.95, epochs: int = 24, seed: int = 11) -> Network:
    """Adam on shuffled batches of three quarters of the rows; the rest calibrates and sets the threshold."""
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))[:LABELLED_ROWS]]
    cut = len(rows) * 3 // 4
    texts, y = [encode(*r[:3]) for r in rows], np.array([r[3] for r in rows], float)
    net = Network(rng)
    params = [net.conv, net.shift, net.out, net.bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(cut)
        for at in range(0, cut, 64):
            group = order[at : at + 64]
            x, size = padded([texts[i] for i in group])
            hidden, top, features, score = net.forward(x, size)
            slope = (1 / (1 + np.exp(-score)) - y[group]) / len(group)
            d_features = slope[:, None] * net.out
            d_hidden = np.repeat((d_features[:, FILTERS:] / size[:, None])[:, None], hidden.shape[1], 1)
            np.put_along_axis(d_hidden, top[:, None], np.take_along_axis(d_hidden, top[:, None], 1) + d_features[:, None, :FILTERS], 1)
            d_hidden *= hidden > 0
            d_conv = np.zeros_like(net.conv)
            n = hidden.shape[1]
            flat = d_hidden.reshape(-1, FILTERS)
            for k in range(WIDTH):
                at_class = x[:, k : k + n].ravel()
                for f in range(FILTERS):
                    d_conv[k, :, f] = np.bincount(at_class, flat[:, f], minlength=PAD + 1)
            d_conv[:, PAD] = 0
            grads = [d_conv, flat.sum(0), features.T @ slope, slope.sum(keepdims=True)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                g = g + 1e-4 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    calibrate(net, texts[cut:], y[cut:], recall)
    return net


def calibrate(net: Network, texts: list[np.ndarray], y: np.ndarray, recall: float) -> None:
    """Platt scaling with smoothed targets, then a threshold: among those that find at least
    ``recall`` of the positives the one of best precision, the lowest such, halfway to the next
    score below it."""
    raw = np.concatenate([net.forward(*padded(texts[i : i + 256]))[3] for i in range(0, len(texts), 256)])
    positives = int(y.sum())
    aim = np.where(y > 0, (positives + 1) / (positives + 2), 1 / (len(y) - positives + 2))
    a, b = 0.1, 0.0
    for _ in range(100):  # damped Newton steps
        p = 1 / (1 + np.exp(-(a * raw + b)))
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - aim) * raw).sum() + 1e-3 * a, (p - aim).sum()])
        hess = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum()]])
        a, b = np.array([a, b]) - 0.5 * np.linalg.solve(hess, grad)
    net.scale, net.offset = float(a), float(b)
    if not positives:
        return
    order = np.argsort(-raw)
    score = 1 / (1 + np.exp(-(a * raw[order] + b)))
    hits = np.cumsum(y[order])
    precision = hits / np.arange(1, len(y) + 1)
    precision[hits < recall * positives] = -1
    last = np.append(score[1:] != score[:-1], True)  # equal scores fall on one side
    precision[~last] = -1
    k = len(precision) - 1 - int(np.argmax(precision[::-1]))
    below = score[k + 1] if k + 1 < len(score) else 0.0
    net.threshold = float((score[k] + below) / 2)


# labelled findings


def _run(rng: random.Random, alphabet: str, n: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(n))


LOWER, UPPER, NUMBERS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def secret(rng: random.Random) -> str:
    mixed = LOWER + UPPER + NUMBERS
    return rng.choice([
        lambda: _run(rng, mixed, rng.randint(22, 64)), lambda: _run(rng, mixed + "+/", 43) + "=",
        lambda: "ghp_" + _run(rng, mixed, 36), lambda: "sk_live_" + _run(rng, mixed, 24), lambda: "xoxb-" + _run(rng, NUMBERS, 12) + "-" + _run(rng, mixed, 24),
        lambda: "eyJ" + _run(rng, mixed + "_-", rng.randint(40, 120)), lambda: "AIza" + _run(rng, mixed + "_-", 35),
        lambda: _run(rng, NUMBERS + "ABCDEF", rng.choice([32, 40, 64])), lambda: _run(rng, LOWER + NUMBERS, rng.randint(24, 40)),
    ])()


def harmless(rng: random.Random, words: list[str]) -> str:
    word = lambda: re.sub("[^A-Za-z]", "", rng.choice(words)) or "word"
    return rng.choice([
        lambda: word() + word() + word() + word() + str(rng.randint(1, 99)), lambda: "-".join(word() for _ in range(5)) + f"-{rng.randint(1, 999)}",
        lambda: "_".join(word().lower() for _ in range(4)) + f"_{rng.randint(1990, 2030)}", lambda: "/".join(word() for _ in range(4)) + f"/{rng.randint(1, 999)}",
        lambda: word().upper() + "-" + _run(rng, NUMBERS, 16), lambda: f"2024-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}T00-00-{_run(rng, NUMBERS, 6)}Z",
        lambda: "=" * rng.randint(10, 30) + word() + "1" + "=" * 8, lambda: "-".join(_run(rng, "0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
        lambda: f"{word()}{word()}{word()}Controller{rng.randint(1, 9)}Test", lambda: "page=" + str(rng.randint(1, 99)) + "_" + word() + "_" + word() + word(),
        lambda: (word() * 6)[:40] + str(rng.randint(0, 9)), lambda: _run(rng, NUMBERS, 18) + word(), lambda: word() + "+" + word() + "+" + word() + "+" + word() + str(rng.randint(2, 99)),
    ])().ljust(MIN_CANDIDATE, "x")


def labelled_table(docs: DataFrame, text_col: str = "text", rows: int = 3_000, seed: int = 5) -> list[tuple[bytes, bytes, bytes, int]]:
    """Labelled findings (before, candidate, after, 0/1): secrets and look-alikes made by rule, set
    into first lines (400 characters at most, without words of over 24) of at most ``rows`` documents
    (the least hash of their text in each of as many slots)."""
    picked = (
        docs.select(F.substring(F.substring_index(F.col(text_col), "\n", 1), 1, 400).alias("line"), F.xxhash64(text_col).alias("h"))
        .filter(F.length("line") > 0).groupBy(F.pmod("h", F.lit(min(rows, LABELLED_ROWS))).alias("slot"))
        .agg(F.min(F.struct("h", "line")).alias("least")).select("least.*").collect()
    )
    picked.sort(key=lambda r: (r["h"], r["line"]))
    rng = random.Random(seed)
    lines = [[w for w in r["line"].split() if len(w) <= 24][:40] for r in picked]
    lines = [x for x in lines if x] or [["a", "line", "of", "words"]]
    keys = ["key = ", "access_key: ", "auth=", "bearer ", "Authorization: Bearer ", "client = \"", "credential: ", "SIGNING_KEY=", ""]
    plain = ["file ", "see ", "path: ", "id=", "url=", "https://example.com/", "name: ", "", ""]
    out = []
    for k in range(min(rows, LABELLED_ROWS)):
        words = lines[k % len(lines)]
        at = rng.randint(0, len(words))
        bad = k % 2
        lead = rng.choice(keys if bad else plain)
        before = (" ".join(words[max(0, at - 5) : at]) + " " + lead).encode()[-BEFORE:]
        after = (rng.choice([" ", "\"", "\n", ". "]) + " ".join(words[at : at + 2])).encode()[:AFTER]
        out.append((before, (secret(rng) if bad else harmless(rng, words)).encode(), after, bad))
    return out


# texts


def runs_of(mask: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of at least ``least`` set positions; none crosses a row."""
    edge = np.zeros(len(mask) + 2, bool)
    edge[1:-1] = mask
    inner = bounds[(bounds > 0) & (bounds < len(mask))]
    first, last = edge[1:-1] & ~edge[:-2], edge[1:-1] & ~edge[2:]
    first[inner], last[inner - 1] = mask[inner], mask[inner - 1]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = hi - lo >= least
    return lo[long], hi[long]


def base_spans(data: np.ndarray, bounds: np.ndarray) -> list[S.Found]:
    found: list[S.Found] = []
    lo, hi = runs_of(HEX[data], bounds, 32)
    found += [(r, 2, a, b, True) for r, a, b in zip(A.row_of(bounds, lo).tolist(), lo.tolist(), hi.tolist())]
    lowered, raw = A.LOWER[data].tobytes(), data.tobytes()
    for rule, words, text in ((0, WORDS, lowered), (1, [b"AKIA"], raw)):
        rows: set[int] = set()
        for word in words:
            at = text.find(word)
            while at >= 0:
                row = int(A.row_of(bounds, np.array([at]))[0])
                rows.add(row)
                at = text.find(word, int(bounds[row + 1]))
        for r in rows:
            base = int(bounds[r])
            for m in (ASSIGN if rule == 0 else ACCESS).finditer(raw[base : bounds[r + 1]]):
                if len(m[2]) >= 8 if rule == 0 else len(m[0]) >= 16:
                    found.append((r, rule, base + m.start(), base + m.end(), True))
    return found


def candidates(data: np.ndarray, bounds: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of token characters with letters and digits that touch no base span."""
    lo, hi = runs_of(TOKEN[data], bounds, MIN_CANDIDATE)
    ends = np.stack([lo, hi], 1).ravel()
    has = [A.per_row(mask, ends)[::2] > 0 if len(lo) else np.zeros(0, bool) for mask in (LETTERS[data], DIGITS[data])]
    free = A.per_row(taken, ends)[::2] == 0 if len(lo) else np.zeros(0, bool)
    ok = has[0] & has[1] & free
    return lo[ok], hi[ok]


def locate(data: np.ndarray, bounds: np.ndarray, net: Network) -> list[S.Found]:
    found = base_spans(data, bounds)
    taken = np.zeros(len(data), bool)
    for f in found:
        taken[f[2] : f[3]] = True
    lo, hi = candidates(data, bounds, taken)
    if len(lo):
        rows = A.row_of(bounds, lo)
        raw = data.tobytes()
        texts = [
            encode(raw[max(bounds[r], a - BEFORE) : a], raw[a:b], raw[b : min(b + AFTER, bounds[r + 1])])
            for r, a, b in zip(rows.tolist(), lo.tolist(), hi.tolist())
        ]
        bad = net.scores(texts) >= net.threshold
        found += [(r, LEARNED, a, b, False) for r, a, b in zip(rows[bad].tolist(), lo[bad].tolist(), hi[bad].tolist())]
    return found


def scan(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, spans (kind, start, end in code points, base).

    Base spans stay as the patterns find them; the network adds spans (kind
    ``learned``) that touch none of them.  A null text counts as empty; ids may be
    null or repeated; an empty table gives an empty result; other columns are
    not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("spans", S.SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, text_col):
                data, bounds = A.byte_view(part[text_col])
                found = S.to_arrow(locate(data, bounds, shared.value), KINDS, data, bounds)
                yield pa.RecordBatch.from_arrays([part[id_col], found], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def redact(docs: DataFrame, net: Network, text_col: str = "text", mask: str = "[SECRET]",
           size_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with every found span replaced by ``mask``; ``size_col``, if there is
    such a column of whole numbers, tells the new length of changed texts.

    Overlapping spans count as one.  Rows and columns stay; a null text stays
    null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    names = docs.columns
    sized = names.index(size_col) if size_col in names and isinstance(
        docs.schema[size_col].dataType, (T.LongType, T.IntegerType)) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, text_col):
                data, bounds = A.byte_view(part[text_col])
                by_row: dict[int, list[tuple[int, int]]] = {}
                for r, _, a, b, _ in locate(data, bounds, shared.value):
                    by_row.setdefault(r, []).append((a, b))
                if not by_row:
                    yield part
                    continue
                texts = part[text_col].to_pylist()
                columns = list(part.columns)
                sizes = columns[sized].to_pylist() if sized is not None else None
                for r, found in by_row.items():
                    texts[r] = cover(data[bounds[r] : bounds[r + 1]].tobytes(), int(bounds[r]), found, mask.encode())
                    if sizes is not None:
                        sizes[r] = len(texts[r])
                columns[names.index(text_col)] = pa.array(texts, part[text_col].type)
                if sizes is not None:
                    columns[sized] = pa.array(sizes, columns[sized].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def cover(text: bytes, base: int, found: list[tuple[int, int]], mask: bytes) -> str:
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at : a - base], mask]
        at = b - base
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")
