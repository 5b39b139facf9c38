"""Toxicity by maximum-scoring segments over token log-odds.

Terms are runs of letters, digits and non-ASCII characters (A-Z lower-cased),
hashed to 64 bits.  Learning, from a bounded, labelled sample:

1. Terms are counted in toxic and clean sample documents (y_t, y_c; totals
   n_t, n_c) and, for the terms seen at least ``MIN_TOXIC`` times in toxic ones,
   in all documents (b; total B), so that the background grows with the corpus.
2. Dirichlet-prior log-odds (prior ``alpha_w = alpha0 * b/B``) with their
   z-scores pick the terms significantly likelier in toxic text.  Those get the
   score ``s = ln(q/p)`` with ``q = (y_t + beta*p) / (n_t + beta)`` and ``p = b/B``;
   every other term gets ``ln r``, r the share of probability left, so that the
   scores are log-likelihood ratios: their mean under the background is below 0
   and ``sum p*e^s = 1``, hence lambda = 1 in Karlin-Altschul statistics.

Scoring, per document: one linear scan of the reset sum ``R_j = max(0, R_{j-1} +
s_j)`` (cumulative sum minus its running minimum) yields every maximal excursion,
i.e. every locally best segment; a segment is a significant toxic passage when its
E-value ``K n e^(-S)`` is at most ``PASSAGE_E``.  The best segment is turned into a
p-value by the Gumbel law of the maximum, ``1 - exp(-K n e^(-S))``, with K fitted
by moments on clean sample documents, and ``-ln p`` is mapped to a probability by
Platt scaling fitted on the sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .lexical import term_spans

# Labelled rows the model learns from at most (chosen by a hash of doc_id).
MAX_LABELLED = 20_000
MIN_TOXIC = 2
# Bytes of text scored at once: the arrays of features take up to a hundred times as much.
SLICE = 1 << 18
# Bytes of the windows inside terms that count as features beside the term.
GRAM = 5
Z_MIN = 2.0
# Prior weight of the log-odds test, as a share of the sample's terms; prior weight of q, in terms.
ALPHA_SHARE = 3.0
BETA = 100.0
PASSAGE_E = 0.05
# Fixed value: scores from this on predict toxic.
THRESHOLD = 0.3
EULER = 0.5772156649015329

PASSAGE = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "end")] + [T.StructField("score", T.DoubleType())])
SCORED = T.StructType([
    T.StructField("n_terms", T.LongType()), T.StructField("best", T.DoubleType()),
    T.StructField("passages", T.ArrayType(PASSAGE)),
])


def term_hashes(column: pa.Array):
    """(data, bounds, starts, ends, term bounds per row, feature hashes, feature owners) of a text column.

    A term's features are the term itself and every byte window of ``GRAM`` inside a longer term.
    """
    data, bounds = A.byte_view(column)
    data = A.LOWER[data]
    starts, ends = term_spans(data, bounds)
    lengths = ends - starts
    many = np.where(lengths > GRAM, lengths - GRAM + 1, 0)
    total = int(many.sum())
    first = np.concatenate([[0], np.cumsum(many)[:-1]])
    at = np.repeat(starts - first, many) + np.arange(total)
    hashes = np.concatenate([A.hash_spans(data, starts, ends), A.hash_spans(data, at, at + GRAM)])
    owners = np.concatenate([np.arange(len(starts)), np.repeat(np.arange(len(starts)), many)])
    return data, bounds, starts, ends, np.searchsorted(starts, bounds), hashes, owners


def excursions(s: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(best score, starts, ends, scores) of all maximal excursions of the reset sum over ``s``.

    Segment i covers terms ``starts[i]:ends[i]``; the best score is 0 without a positive segment.
    """
    if not len(s):
        return 0.0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    prefix = np.concatenate([[0.0], np.cumsum(s)])
    low = np.minimum.accumulate(prefix)
    reset = prefix - low
    zero = reset <= 0
    run = np.cumsum(zero)  # excursion number of every prefix position
    up = np.flatnonzero(~zero)
    if not len(up):
        return 0.0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    cut = np.flatnonzero(np.concatenate([[True], run[up][1:] != run[up][:-1]]))
    peaks = np.maximum.reduceat(reset[up], cut)
    # the peak's last position ends the segment; the last zero before the excursion starts it
    group = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(up))))
    at_peak = reset[up] == peaks[group]
    ends = np.zeros(len(cut), np.int64)
    np.maximum.at(ends, group[at_peak], up[at_peak])
    zeros = np.flatnonzero(zero)
    starts = zeros[np.searchsorted(zeros, up[cut]) - 1]
    return float(peaks.max()), starts, ends, peaks


@dataclass
class Model:
    hashes: np.ndarray  # sorted hashes of significant terms
    scores: np.ndarray  # their scores
    other: float  # score of every other term
    log_k: float = 0.0
    a: float = 0.0
    b: float = 1.0

    def term_scores(self, h: np.ndarray, owners: np.ndarray, n_terms: int) -> np.ndarray:
        """Each term's score: the best of its significant features, else the score of all others."""
        out = np.full(n_terms, self.other)
        if len(self.hashes) and len(h):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            np.maximum.at(out, owners[hit], self.scores[at[hit]])
        return out

    def evidence(self, n: np.ndarray, best: np.ndarray) -> np.ndarray:
        """-ln p of the best segment under the Gumbel law of the maximum; 0 without terms."""
        e = np.exp(np.minimum(self.log_k + np.log(np.maximum(n, 1)) - best, 50.0))
        p = -np.expm1(-e)
        return np.where(n > 0, -np.log(np.maximum(p, 1e-300)), 0.0)

    def probability(self, n: np.ndarray, best: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.a + self.b * self.evidence(n, best))))


def _segments(model: Model, column: pa.Array, passages: bool):
    data, bounds, starts, ends, tb, h, owners = term_hashes(column)
    s = model.term_scores(h, owners, len(starts))
    letters = np.concatenate([[0], np.cumsum(A.code_points(data))])
    rows = len(bounds) - 1
    best = np.zeros(rows)
    found = []
    for r in range(rows):
        top, first, last, peaks = excursions(s[tb[r] : tb[r + 1]])
        best[r] = top
        if passages:
            n = tb[r + 1] - tb[r]
            keep = model.log_k + math.log(max(n, 1)) - peaks <= math.log(PASSAGE_E)
            first, last, peaks = first[keep] + tb[r], last[keep] + tb[r], peaks[keep]
            found.append([{"start": int(letters[starts[i]] - letters[bounds[r]]), "end": int(letters[ends[j - 1]] - letters[bounds[r]]),
                           "score": float(p)} for i, j, p in zip(first, last, peaks)])
    return np.diff(tb), best, found


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """The rows of ``docs`` with n_terms, best (segment score), passages and score (0 to 1) added.

    Without ``keep_text`` the text itself does not come back from the task.

    A null or empty text has no terms: best 0, no passages, and the score of no
    evidence.  Other columns pass through untouched, so their names cannot clash
    unless they are named like the four added ones, which are replaced.  A task
    holds a slice of texts or one longer text and a few arrays of its terms.
    """
    bc = docs.sparkSession.sparkContext.broadcast(model)
    added = ["n_terms", "best", "passages", "score"]
    kept = [f for f in docs.schema.fields if f.name not in added and (keep_text or f.name != text_col)]
    schema = T.StructType(kept + list(SCORED.fields) + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = bc.value
        for batch in batches:
            for part in A.slices(batch, text_col, SLICE):
                n, best, found = _segments(m, part[text_col], True)
                cols = [part[f.name] for f in kept]
                cols += [pa.array(n, pa.int64()), pa.array(best), pa.array(found, pa.list_(pa.struct([
                    ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))), pa.array(m.probability(n, best))]
                yield pa.RecordBatch.from_arrays(cols, schema=pa.schema([pa.field(f.name, c.type) for f, c in zip(schema.fields, cols)]))

    read = dict.fromkeys([f.name for f in kept] + [text_col])
    return docs.select(*[F.col(c) for c in read]).mapInArrow(run, schema)


def _counts(docs: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(h, yt, yc): term counts in toxic and clean documents, summed in each task."""
    schema = "h long, yt long, yc long"

    def run(batches):
        for batch in batches:
            for part in A.slices(batch, text_col):
                _, _, _, _, tb, h, owners = term_hashes(part[text_col])
                toxic = np.repeat(np.asarray(part[label_col].to_numpy(zero_copy_only=False), np.int64) == 1, np.diff(tb))[owners]
                keys, at = np.unique(h.view(np.int64), return_inverse=True)
                yt = np.bincount(at, toxic, minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(yt), pa.array(np.bincount(at, minlength=len(keys)) - yt)],
                                                 names=["h", "yt", "yc"])

    return docs.select(text_col, label_col).mapInArrow(run, schema).groupBy("h").agg(F.sum("yt").alias("yt"), F.sum("yc").alias("yc"))


def _background(docs: DataFrame, wanted: np.ndarray, text_col: str) -> DataFrame:
    """(h, b) for the wanted hashes over all documents, and h = null with the count of all terms."""
    bc = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        keys = bc.value
        for batch in batches:
            for part in A.slices(batch, text_col):
                h = term_hashes(part[text_col])[5].view(np.int64)
                hit = np.isin(h, keys) if len(keys) else np.zeros(len(h), bool)
                k, c = np.unique(h[hit], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(k, 0), mask=np.append(np.zeros(len(k), bool), True)),
                                                  pa.array(np.append(c, len(h)))], names=["h", "b"])

    return docs.select(text_col).mapInArrow(run, "h long, b long").groupBy("h").agg(F.sum("b").alias("b"))


def held_out(id_col: str = "doc_id"):
    """True for rows whose crc32 of doc_id in decimal leaves 2 by 4; their labels are never learnt."""
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled documents that are not held out, least hash of doc_id first.

    A document with several label rows is toxic if any says so; null labels and
    ids are not learnt.
    """
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("__label")))
    chosen = marks.orderBy(F.xxhash64(id_col), id_col).limit(limit)
    return docs.join(F.broadcast(chosen), id_col).select(F.col(text_col).alias("text"), F.col("__label").alias("toxic"))


def train(sample: DataFrame, docs: DataFrame, text_col: str = "text") -> Model:
    """A model from a labelled sample (text, toxic) and the background of all ``docs``."""
    counts = _counts(sample, "text", "toxic").cache()
    totals = counts.agg(F.sum("yt").alias("t"), F.sum("yc").alias("c")).first()
    n_t, n_c = int(totals.t or 0), int(totals.c or 0)
    if not n_t or not n_c:
        counts.unpersist()
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    # bounded by the sample's features; travels as Arrow
    candidates = counts.where((F.col("yt") >= MIN_TOXIC) & (F.col("yt") * n_c > F.col("yc") * n_t)).toPandas()
    counts.unpersist()
    h = candidates["h"].to_numpy(np.int64)
    yt, yc = candidates["yt"].to_numpy(float), candidates["yc"].to_numpy(float)
    found = _background(docs, np.sort(h), text_col).toPandas()
    total = float(found.loc[found["h"].isna(), "b"].sum())
    found = found[found["h"].notna()]
    b = pd.Series(found["b"].to_numpy(float), index=found["h"].to_numpy(np.int64)).reindex(h).fillna(0).to_numpy()
    p = np.maximum(b, yt + yc) / max(total, 1.0)
    alpha0 = ALPHA_SHARE * (n_t + n_c)
    a = alpha0 * p
    delta = np.log((yt + a) / (n_t + alpha0 - yt - a)) - np.log((yc + a) / (n_c + alpha0 - yc - a))
    z = delta / np.sqrt(1 / (yt + a) + 1 / (yc + a))
    sig = z >= Z_MIN
    q = (yt[sig] + BETA * p[sig]) / (n_t + BETA)
    rest = max(1 - q.sum(), 1e-12) / max(1 - p[sig].sum(), 1e-12)
    order = np.argsort(h[sig].view(np.uint64))
    model = Model(h[sig].view(np.uint64)[order], np.log(q / p[sig])[order], float(min(math.log(rest), 0.0)))
    return calibrate(model, sample)


def calibrate(model: Model, sample: DataFrame) -> Model:
    """K by moments on clean sample texts, then Platt scaling of the evidence on all of the sample."""
    bc = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = bc.value
        for batch in batches:
            for part in A.slices(batch, "text", SLICE):
                n, best, _ = _segments(m, part["text"], False)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(best), part["toxic"].cast(pa.int64())],
                                                 names=["n", "best", "y"])

    rows = sample.mapInArrow(run, "n long, best double, y long").where("n > 0").collect()
    n = np.array([r.n for r in rows], float)
    best = np.array([r.best for r in rows])
    y = np.array([r.y for r in rows], float)
    clean = y == 0
    if clean.any():
        model.log_k = float(np.mean(best[clean] - np.log(n[clean])) - EULER)
    if 0 < y.sum() < len(y):
        model.a, model.b = platt(model.evidence(n, best), y)
    return model


def platt(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) of the logistic 1 / (1 + e^-(a + b x)) fitted by Newton steps, with a small ridge."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(design @ w)))
        grad = design.T @ (p - y) + 1e-3 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])
