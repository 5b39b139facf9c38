"""Repetition coverage and URL rules."""

import collections
import random

import pytest

from tests.llm.common import WORD, edge_rows, same, table
from tidewire.llm import repetition, url_rules


def brute(text, limits=repetition.GRAM_LIMITS, line_limit=repetition.LINE_LIMIT):
    text = text or ""
    words = WORD.findall(text)

    def covered(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = collections.Counter(grams)
        return {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(n)}

    seen, again, chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                again, chars = again + 1, chars + sum(map(len, WORD.findall(line)))
            seen.add(line)
    total = sum(map(len, words))
    grams = {k: sum(len(words[i]) for i in covered(k)) for k in limits}
    failed = len(words) < 50 or 100 * len(covered(3)) > 50 * len(words)
    over = 100 * chars > line_limit * total or any(100 * grams[k] > v * total for k, v in limits.items())
    return (len(words), total, sum(c in "#*$%&|<>" for c in text), again, len(covered(3)), failed, not failed and not over, chars, *grams.values())


def test_counts_and_verdicts(spark):
    rng = random.Random(1)
    rows = edge_rows()
    for i in range(100, 160):  # repeated windows and lines at every rate
        line = " ".join(rng.choice("abcdefgh") for _ in range(6))
        rows.append((i, "\n".join(line if rng.random() < 0.1 * (i % 10) else " ".join(rng.choice("uvwxyz#|é") * 3 for _ in range(7)) for _ in range(20))))
    docs = table(spark, rows).repartition(3)
    same(repetition.profile(docs).collect(), [(i, *brute(t)) for i, t in rows])
    kept = repetition.keep_good(docs)
    assert kept.columns == docs.columns
    same([(r.doc_id, r.text) for r in kept.collect()], [(i, t) for i, t in rows if brute(t)[6]])
    assert {brute(t)[6] for _, t in rows} == {True, False}


def test_empty_tables(spark):
    docs = table(spark, [])
    assert repetition.profile(docs).collect() == [] and repetition.keep_good(docs).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(pages, [("com", "/", "allow")]).collect() == []


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es", "block"),
         ("net", "/es/a/", "allow"), ("dup.org", "/", "allow"), ("dup.org", "/", "block"), ("", "", "block"), ("a.b", "", "block")]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    for c in "?#":
        rest = rest.split(c)[0]
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    fits = [(len(h), len(p), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_rules_by_trie_and_by_join(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "https://com", "http://example.com/en", "http://example.com/en/x?y=/z",
            "http://m.example.com/en/#top", "http://www.example.com/en/1", "http://badexample.com/en/", "ftp://x.net/esp", "http://x.net/es/a/b",
            "http://x.net/es/ab", "http://dup.org/", "http://a.b", "http://.a.b/x", "http://É.com/", "http://x://y.net/es", "http://a..com//en/"]
    rows = [(i, u, "host", "rule") for i, u in enumerate(urls)] + [(None, urls[7], None, None), (3, urls[7], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    expected = [(r[0], *plain(r[1])) for r in rows]
    same(url_rules.judge(pages, RULES).collect(), expected)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    same(url_rules.judge(pages, rules).collect(), expected)
    same(url_rules.judge(pages, rules, trie_rules=2).collect(), expected)


def test_both_paths_refuse_odd_verdicts_and_count_lists(spark):
    pages = spark.createDataFrame([(1, "http://x.net/es/a"), (2, "http://example.com/en/")], "page_id long, url string")
    odd = RULES + [("org", "/", "review")]
    for limit in (100, 2):
        with pytest.raises(Exception, match="neither allow nor block"):
            url_rules.judge(pages, odd, trie_rules=limit).collect()
        with pytest.raises(Exception, match="neither allow nor block"):
            url_rules.judge(pages, spark.createDataFrame(odd, "host string, path string, verdict string"), trie_rules=limit).collect()
    # a list longer than the trie's limit takes the join, with the same answer
    same(url_rules.judge(pages, RULES, trie_rules=2).collect(), url_rules.judge(pages, RULES).collect())
