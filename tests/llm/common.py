"""Small tables of documents with every awkward case, and brute-force twins."""

import random
import re
from collections import Counter

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("key", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("digest", T.LongType()),
    T.StructField("spans", T.StringType()), T.StructField("rows", T.StringType()), T.StructField("node", T.StringType()),
])
WORDS = "the of and to in is was for that on with as it by at from his her an were are which this also be had or".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "er", "ing", "é"]) + rng.choice(["", "", ".", "\n"]) for _ in range(n))


def edge_rows():
    """(doc_id, text): nulls, empty and very long texts, ties, copies, near copies, repeated rows."""
    rng = random.Random(4)
    base, long = prose(rng, 120), prose(rng, 30_000)
    other = base.replace("the", "xyz", 1)
    return [
        (7, base), (3, base), (9, other), (4, base + " tail"), (4, other + " end of it"), (11, base), (11, base),
        (None, base), (None, "no id here"), (1, None), (2, ""), (5, " \n\t "), (6, "one two"), (8, "one two"), (10, "One TWO"),
        (12, "a\x1fb\u00a0c d"), (13, long), (14, "x" * 30_000), (15, prose(rng, 80)), (16, "é" * 60 + "!" + base[:70]), (17, "ends " + base[-90:]),
    ]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", "x", 1, "s", "r", "n") for i, t in rows], SCHEMA)


def same(mine, theirs):
    a, b = Counter(map(tuple, mine)), Counter(map(tuple, theirs))
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])
