import math
import re
from collections import Counter

import numpy as np

from tidewire.llm import lexical

from .common import edge_rows, same, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    big_n = sum(1 for _, _, n in bags if n)
    big_l = sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, bag, n in bags:
            if doc is None:
                continue
            m = 25 + (75 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in terms(text) if bag[t])
            if s > 0:
                scored.append((-s, doc))
        for rank, (s, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc, -s))
    return out


def docs():
    extra = [(30 + i, "the same bag of words") for i in range(25)] + [(60 + i, "Bag words, THE same of") for i in range(3)]
    extra += [(70, "ünïcode wörds and 42 numbers"), (71, "numbers 42 42"), (72, "x" * 100_000 + " bag")]
    return edge_rows() + extra


def items():
    return [(1, "the bag of words"), (2, "ünïcode numbers 42"), (3, None), (4, "zzz unknown"), (5, "the the of"), (6, "xyz one")]


def test_matches_brute_force(spark):
    d, q = docs(), items()
    got = lexical.search(table(spark, d), spark.createDataFrame(q, "item_id long, text string")).collect()
    same(got, brute(d, q))
    assert len({r.item_id for r in got}) >= 4


def test_small_k_and_hot_class(spark):
    d, q = docs(), items()
    got = lexical.search(table(spark, d), spark.createDataFrame(q, "item_id long, text string"), k=3).collect()
    same(got, brute(d, q, 3))


def test_empty_tables(spark):
    q = spark.createDataFrame(items(), "item_id long, text string")
    assert lexical.search(table(spark, []), q).count() == 0
    assert lexical.search(table(spark, docs()), q.limit(0)).count() == 0


def test_candidates_keep_ties_by_first_member():
    # item 0: class scores 5 (3 members), 5 (first member 1), 4; k = 2
    item = np.array([0, 0, 0])
    score = np.array([5, 5, 4])
    cls = np.array([0, 1, 2])
    first, count = np.array([9, 1, 0]), np.array([3, 1, 1])
    kept = lexical._candidates(item, score, cls, first, count, 2)
    assert sorted(cls[kept]) == [0, 1]


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS_PER_BLOCK", 2)
    d, q = docs(), items() + [(None, "the bag")]
    got = lexical.search(table(spark, d), spark.createDataFrame(q, "item_id long, text string")).collect()
    same(got, brute(d, [x for x in q if x[0] is not None]))
