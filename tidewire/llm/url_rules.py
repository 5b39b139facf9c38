"""Allow and block rules for URLs: a trie over reversed host labels, then path segments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A rule: (host, path, verdict).
Rule = tuple[str, str, str]
ALLOW, BLOCK = "allow", "block"

# Rules that may travel to every task as a trie (about 1 KB each at most).
TRIE_RULES = 100_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = str.maketrans(UPPER, UPPER.lower())


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = min((p for p in map(rest.find, "?#") if p >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(FOLD), path


class Trie:
    """Nodes are dicts.  Host labels lead to nodes whose ``None`` entry holds the
    root of a path trie; its nodes hold under ``None`` the rules that end there,
    with what they ask of the rest of the path."""

    def __init__(self, rules: Iterable[Rule]):
        self.hosts: dict = {}
        for host, path, verdict in sorted(set(rules)):
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"verdict {verdict!r} of a rule is neither allow nor block")
            node = self.hosts
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            # sorted: of two rules that differ in their verdict only, block comes last and stays
            node.setdefault(None, {})[rest] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that fits with the longest host, then the longest path, and its verdict."""
        best, node = None, self.hosts
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = self._path(node[None], segments) or best
        return best

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            fit = [rest for rest in node.get(None, ()) if segment.startswith(rest)]
            if fit:
                best = node[None][max(fit, key=len)]
            node = node.get(segment)
            if node is None:
                break
        return best


def judge(pages: DataFrame, rules: Iterable[Rule] | DataFrame, id_col: str = "page_id", url_col: str = "url",
          otherwise: str = ALLOW, trie_rules: int = TRIE_RULES) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (null if none fits), verdict.

    ``rules`` is a list or a table (host, path, verdict).  Up to ``trie_rules``
    of them are broadcast as a trie; beyond that (counted for lists and tables)
    the same answer comes from a join.  A verdict other than allow or block is
    refused on both paths.  A rule fits its host and all subdomains if the URL's path starts with
    the rule's; the longest host wins, then the longest path; block wins between
    equal rules.  A null URL, or one without ``://``, has an empty host and
    path and meets no rule unless one is empty too; ids may be null or repeated;
    empty tables give empty results; other columns are not read.
    """
    if not isinstance(rules, DataFrame):
        rules = list(rules)
        if len(rules) > trie_rules:  # a long list is not broadcast either
            rules = pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
    if isinstance(rules, DataFrame):
        table = rules.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("host", "path", "verdict")])
        if table.limit(trie_rules + 1).count() > trie_rules:
            # the same verdicts are refused on both paths
            odd = table.where(~F.col("verdict").isin(ALLOW, BLOCK)).select("verdict").limit(1).collect()
            if odd:
                raise ValueError(f"verdict {odd[0].verdict!r} of a rule is neither allow nor block")
            return _by_join(pages, table, id_col, url_col, otherwise)
        rules = [tuple(r) for r in table.collect()]
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))
    schema = T.StructType(
        [T.StructField(id_col, pages.schema[id_col].dataType)]
        + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch[url_col].to_pylist()]
            found = [trie.value.find(*p) or (None, otherwise) for p in parts]
            text = [[p[0] for p in parts], [p[1] for p in parts], [f[0] for f in found], [f[1] for f in found]]
            yield pa.RecordBatch.from_arrays(
                [batch[id_col]] + [pa.array(x, pa.string()) for x in text], names=schema.names
            )

    return pages.select(id_col, url_col).mapInArrow(run, schema)


def _parts(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + F.lit(3))).otherwise("")
    rest = F.regexp_extract(rest, r"^[^?#]*", 0)
    host = F.regexp_extract(rest, r"^[^/]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), F.substr(rest, F.length(host) + F.lit(1))


def _by_join(pages: DataFrame, rules: DataFrame, id_col: str, url_col: str, otherwise: str) -> DataFrame:
    """For rule tables that are not small: distinct URLs meet rules by host suffix."""
    host, path = _parts(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    labels = F.split("host", "[.]")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    asked = urls.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    rules = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), F.col("verdict").alias("says"))
    best = F.max(F.struct(F.length("suffix"), F.length("start"), "says", F.concat("suffix", "start").alias("rule")))
    found = (
        asked.join(rules, "suffix").filter(F.startswith("path", "start"))
        .groupBy("host", "path").agg(best.alias("best"))
    )
    return urls.join(found, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.says", F.lit(otherwise)).alias("verdict"),
    )
