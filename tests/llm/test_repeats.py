"""Near duplicates and repeated substrings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tests.llm.common import WORD, edge_rows, prose, same, table
from tidewire.llm import components, jaccard, substrings


def near_copies(rng, count):
    """Groups of near copies around the threshold, with a line that many share."""
    rows, line = [], prose(rng, 25)
    for g in range(5):
        words = prose(rng, 90).split()
        for i in range(count):
            copy = [rng.choice(["zz", "qq", "yy"]) + str(rng.random())[2:6] if rng.random() < 0.012 * (i % 4) else w for w in words]
            rows.append((1000 - len(rows), " ".join(copy) + (" " + line if g % 2 else "")))
    return rows + [(2000 + i, prose(rng, 30) + "\n" + line) for i in range(25)]


def grams(text, k):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset([tuple(words)] if 0 < len(words) < k else [tuple(words[i : i + k]) for i in range(len(words) - k + 1)])


def brute_classes(rows, k, percent):
    sets = [grams(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        ids = [x for x in (least.get(r), d) if x is not None]
        least[r] = min(ids, default=None)
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_classes(spark, k, percent):
    rows = edge_rows() + near_copies(random.Random(k), 24)
    same(jaccard.classes(table(spark, rows).repartition(3), k=k, percent=percent).collect(), brute_classes(rows, k, percent))


def test_one_of_each_class_stays(spark):
    rows = edge_rows() + near_copies(random.Random(9), 8)
    docs = table(spark, rows)
    left = jaccard.keep_one(docs)
    assert left.columns == docs.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    placed = brute_classes(rows, 5, 80)
    wordless = [r for r, p in zip(rows, placed) if p[1] == 0]
    full = [r for r in got if grams(r[1], 5)]
    same([r for r in got if not grams(r[1], 5)], wordless)
    groups = {p[2] for p in placed if p[1]}
    # ids 4 and 11 stand for several texts or rows; one row of each class is there all the same
    assert len(full) == len({c for c in groups}) and {r[0] for r in full} <= groups
    assert jaccard.classes(table(spark, [])).collect() == [] and jaccard.keep_one(table(spark, [])).collect() == []


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(50)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)] + [(5, 5), (3000, 3001)] * 2
    rng.shuffle(links)
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    sizes = sorted(np.unique(list(found.values()), return_counts=True)[1].tolist())
    assert sizes == [2, 9, 51, 61] and len(found) == 123
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_cut(rows, length):
    big = float("inf")
    raw = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in raw:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, big), i)
    out = []
    for (d, _), (i, t) in zip(rows, raw):
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                gone[p + 1 : p + 1 + length] = True
        edge = np.flatnonzero(np.diff(gone.astype(int)))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[1:-1]])
        out.append((d, len(t), tuple(zip(edge[::2].tolist(), edge[1::2].tolist())), hashlib.sha256(kept).hexdigest()))
    return out


def listed(df):
    return [(r.doc_id, r.n_bytes, tuple((s.start, s.stop) for s in r.spans), r.kept_sha256) for r in df.collect()]


def test_cut_repeats(spark):
    rng = random.Random(3)
    rows = edge_rows() + near_copies(rng, 10)
    rows += [(3000 + i, "ab" * rng.randint(20, 90) + prose(rng, 3)) for i in range(12)]  # periodic texts
    rows += [(None, rows[30][1]), (None, rows[30][1] + "!"), (3100, "y" * 49), (3101, "y" * 49), (3102, "z" * 50), (3103, "z" * 50), (3104, "z" * 51)]
    same(listed(substrings.cut_repeats(table(spark, rows).repartition(4))), brute_cut(rows, 50))


def test_cut_repeats_small_alphabet(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 400)))) for i in range(40)]
    same(listed(substrings.cut_repeats(table(spark, rows), length=10, q=4)), brute_cut(rows, 10))
    assert substrings.cut_repeats(table(spark, [])).collect() == []
