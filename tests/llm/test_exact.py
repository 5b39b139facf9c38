"""Exact deduplication against brute force."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.common import edge_rows, same, table
from tidewire.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for ids in groups.values():
        first = min((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=lambda i: i != first):
            out.append((i, first, len(ids), i == first and not kept))
            kept = True
    return out


def test_groups(spark):
    rows = edge_rows() + [(20 + i, "one  two") for i in range(30)]
    docs = table(spark, rows).repartition(4)
    same([tuple(r)[:4] for r in exact.group_copies(docs).collect()], brute(rows))


def test_equal_digests_of_different_texts(spark):
    rows = edge_rows() + [(20 + i, f"text {i % 3}") for i in range(12)]
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    same([tuple(r)[:4] for r in exact.group_copies(table(spark, rows), digest=weak).collect()], brute(rows))


def test_state_lasts_over_batches(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    docs = table(spark, rows).repartition(6, "doc_id")
    same([tuple(r)[:4] for r in exact.group_copies(docs, bytes_per_trigger=1).collect()], brute(rows))


def test_rows_that_stay(spark):
    rows = edge_rows()
    docs = table(spark, rows)
    left = exact.keep_first(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in brute(rows) if r[3])
    assert exact.keep_first(table(spark, [])).collect() == [] and exact.group_copies(table(spark, [])).collect() == []


def test_stages_keep_caller_columns_named_like_their_helpers(spark):
    """Columns named like the helper columns of keep_first and keep_one come back untouched."""
    from pyspark.sql import functions as F

    from tidewire.llm import exact, jaccard

    from .common import edge_rows, table

    base = table(spark, edge_rows())
    clashing = ["__key", "__digest", "__mark", "__gone_key", "__gone_digest", "__gone_mark"]
    odd = base.withColumns({c: F.lit(f"mine-{c}") for c in clashing})
    for keep in (exact.keep_first, jaccard.keep_one):
        plain = sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in keep(base).collect())
        got = keep(odd).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in got) == plain
        assert all(r[c] == f"mine-{c}" for r in got for c in clashing)
        assert keep(odd).columns == odd.columns
