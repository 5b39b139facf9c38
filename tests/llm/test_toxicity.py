import random

import numpy as np
from pyspark.sql import functions as F

from tidewire.llm import toxicity

from .common import WORDS, edge_rows, prose, table

INSULTS = ["idiot", "moron", "worthless", "clown"]


def best_brute(s):
    """Best sum of a contiguous run, 0 for none, by trying all runs."""
    best = 0.0
    for i in range(len(s)):
        for j in range(i + 1, len(s) + 1):
            best = max(best, float(np.sum(s[i:j])))
    return best


def test_excursions_find_the_best_and_every_local_segment():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.normal(-0.3, 1.0, rng.integers(0, 40))
        top, starts, ends, peaks = toxicity.excursions(s)
        assert abs(top - best_brute(s)) < 1e-9
        for a, b, p in zip(starts, ends, peaks):
            assert abs(np.sum(s[a:b]) - p) < 1e-9 and p > 0
        assert np.all(ends[:-1] <= starts[1:])


def labelled(spark, n=400):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = prose(rng, rng.randint(20, 200))
        if toxic:
            words = text.split()
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(INSULTS) + rng.choice(["", "s", "ish"]))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, 1, int(toxic)))
    return table(spark, docs + edge_rows()), spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")


def test_learns_from_labels_and_scores_every_row(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(toxicity.labelled_sample(docs, labels), docs)
    out = toxicity.score_texts(docs, model).withColumn("held_out", toxicity.held_out())
    rows = out.join(labels.withColumnRenamed("quality", "q"), "doc_id").where("toxic is not null and held_out").collect()
    right = sum((r.score >= toxicity.THRESHOLD) == (r.toxic == 1) for r in rows)
    assert right / len(rows) >= 0.9
    all_rows = out.collect()
    assert len(all_rows) == docs.count()
    assert all(0.0 <= r.score <= 1.0 for r in all_rows)
    empty = [r for r in all_rows if not (r.text or "").strip()]
    assert empty and all(r.n_terms == 0 and r.best == 0 and r.passages == [] for r in empty)
    # extra columns pass through, repeated rows get equal scores
    assert {"key", "kept", "digest", "spans", "rows", "node"} <= set(out.columns)
    by_text = {}
    for r in all_rows:
        by_text.setdefault(r.text, set()).add(r.score)
    assert all(len(v) == 1 for v in by_text.values())


def test_passages_point_at_toxic_words(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(toxicity.labelled_sample(docs, labels), docs)
    text = " ".join(WORDS * 3) + " you worthless idiot moron " + " ".join(WORDS * 3)
    got = toxicity.score_texts(table(spark, [(1, text)]), model).first()
    assert got.score >= toxicity.THRESHOLD
    assert any("idiot" in text[p.start : p.end] for p in got.passages)


def test_empty_tables_and_no_labels(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(toxicity.labelled_sample(docs, labels.limit(0)), docs)
    assert len(model.hashes) == 0
    assert toxicity.score_texts(table(spark, []), model).count() == 0
    assert toxicity.score_texts(docs, model).where(F.col("score").isNull()).count() == 0


def test_text_stays_in_its_task(spark):
    docs, labels = labelled(spark, 100)
    model = toxicity.train(toxicity.labelled_sample(docs, labels), docs)
    narrow = toxicity.score_texts(docs.select("doc_id", "text"), model, keep_text=False)
    assert narrow.columns == ["doc_id", "n_terms", "best", "passages", "score"]
    whole = toxicity.score_texts(docs, model).select(*narrow.columns)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, whole.collect()))
