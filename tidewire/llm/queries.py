"""Registered queries of the operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attribution, bpe, exact, fim, jaccard, lexical, toxicity, packing, pii, repetition, secret_scan, spans, substrings, url_rules

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

WORD = r"[^\x20\x09-\x0D]+"

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _covered(k: int) -> str:
    """Words inside windows of k words that occur twice or more."""
    key = "w" + "".join(f" || ' ' || w{j}" for j in range(1, k))
    return f"""
    d{k} AS (SELECT DISTINCT doc_id, unnest(range(i, i + {k})) AS i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, {key}) AS c FROM g WHERE w{k - 1} IS NOT NULL) WHERE c > 1),
    c{k} AS (SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM d{k} JOIN g USING (doc_id, i) GROUP BY doc_id)"""


def _op2_sql() -> str:
    limits = repetition.GRAM_LIMITS
    most = max(limits)
    leads = ", ".join(f"lead(w, {j}) OVER (PARTITION BY doc_id ORDER BY i) AS w{j}" for j in range(1, most))
    over = " OR ".join(f"100 * coalesce(c{k}.chars, 0) > {v} * word_chars" for k, v in limits.items())
    chars = ", ".join(f"coalesce(c{k}.chars, 0)::BIGINT AS dup_{k}gram_chars" for k in limits)
    joins = " ".join(f"LEFT JOIN c{k} USING (doc_id)" for k in limits)
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    ws AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS ws FROM t),
    g AS (SELECT doc_id, i, w, {leads} FROM (
        SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM ws)),
    {_covered(3)}, {", ".join(_covered(k) for k in limits)},
    l AS (SELECT doc_id, l, row_number() OVER (PARTITION BY doc_id, l) AS r FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t) WHERE regexp_matches(l, '{WORD}')),
    dl AS (SELECT doc_id, count(*) AS n,
        sum(length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS chars FROM l WHERE r > 1 GROUP BY doc_id),
    m AS (SELECT doc_id, len(ws) AS n_words,
        length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM ws),
    f AS (SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
        coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(c3.n, 0)::BIGINT AS n_repeat_words,
        coalesce(dl.chars, 0)::BIGINT AS dup_line_chars, {chars},
        n_words < {repetition.MIN_WORDS} OR 100 * coalesce(c3.n, 0) > {repetition.MAX_REPEAT_PERCENT} * n_words AS base_failed,
        100 * coalesce(dl.chars, 0) > {repetition.LINE_LIMIT} * word_chars OR {over} AS over
      FROM m LEFT JOIN dl USING (doc_id) LEFT JOIN c3 USING (doc_id) {joins})
    SELECT * EXCLUDE (over), NOT base_failed AND NOT over AS kept FROM f"""


@query("op2_quality_rules", _op2_sql())
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.profile(table(spark, sf, "documents"))


# The rules of the query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_OP4_SQL = f"""
    WITH rules(rhost, rpath, says) AS (VALUES {", ".join(map(str, URL_RULES))}),
    u AS (SELECT page_id, regexp_extract(CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '^[^?#]*') AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), '{url_rules.UPPER}', '{url_rules.UPPER.lower()}')
        AS host, rest FROM u),
    q AS (SELECT page_id, host, substr(rest, length(host) + 1) AS path FROM p),
    f AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
        arg_max(says, length(rhost || rpath)) AS says
      FROM q JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM q LEFT JOIN f USING (page_id)"""


@query("op4_url_filters", _OP4_SQL)
def op4_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judge(table(spark, sf, "pages"), URL_RULES)


_OP9_SQL = r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
        doc_id = min(doc_id) OVER g AS kept, sha256(n) AS text_sha256
    FROM t WINDOW g AS (PARTITION BY n)"""


@query("op9_exact_dedup", _OP9_SQL)
def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.group_copies(table(spark, sf, "documents")).withColumnRenamed("digest", "text_sha256")


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Token counts of every line of every document."""
    return attribution.attribute(table(spark, sf, "documents"), TOKENIZER)


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf, "documents"), TOKENIZER)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query("op10_bpe_round_trip")
def op10_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    back = bpe.decode(bpe.encode(table(spark, sf, "documents"), TOKENIZER), TOKENIZER)
    return back.select(
        "doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op1_pii")
def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = pii.detect(docs, pii.train(pii.labelled_table(docs)))
    base = spans.listed(spans.base_only("spans"))
    counts = [spans.count_of("spans", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.listed("spans").alias("spans"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.labelled_table(docs)))
    base = spans.listed(spans.base_only("spans"))
    counts = [spans.count_of("spans", k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.listed("spans").alias("spans"))


_OP5_SQL = f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_rules.UPPER}',
        '{url_rules.UPPER.lower()}'), '{WORD}') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) END) AS g FROM w)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g)
        WHERE a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM documents
    LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)"""


@query("op5_ngram_jaccard", _OP5_SQL)
def op5_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.classes(table(spark, sf, "documents"), k=4, percent=85)


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = substrings.cut_repeats(table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def _op12_part(i: int) -> str:
    return f"('0x' || substr(h, {8 * i + 1}, 8))::UBIGINT"


_OP12_SQL = f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
        sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS units,
        {_op12_part(0)} AS h1, {_op12_part(1)} AS h2, {_op12_part(2)} AS h3, {_op12_part(3)} AS h4 FROM t),
    c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi FROM u),
    p AS (SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= {fim.FIM_PERCENT} THEN 'plain' WHEN h4 % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(units[1:lo], '') AS prefix, array_to_string(units[lo + 1:hi], '') AS middle,
        array_to_string(units[hi + 1:n], '') AS suffix FROM c)
    SELECT doc_id, n::BIGINT AS n, form,
        CASE WHEN form = 'plain' THEN NULL ELSE length(prefix) END::BIGINT AS prefix_chars,
        CASE WHEN form = 'plain' THEN NULL ELSE length(middle) END::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM p"""


@query("op12_fill_in_middle", _OP12_SQL)
def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    out = fim.transform(table(spark, sf, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def _op13_terms(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{lexical.UPPER}', '{lexical.UPPER.lower()}'), '{lexical.TERM}')"


_OP13_SQL = f"""
    WITH d AS (SELECT doc_id, {_op13_terms("text")} AS ts FROM documents),
    st AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS big_n, sum(len(ts)) AS big_l FROM d),
    dt AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS t FROM d) GROUP BY ALL),
    q AS (SELECT item_id, t, count(*) AS qc FROM (SELECT item_id, unnest({_op13_terms("text")}) AS t FROM benchmark) GROUP BY ALL),
    df AS (SELECT t, count(*) AS df FROM dt WHERE t IN (SELECT t FROM q) GROUP BY t),
    w AS (SELECT t, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)))::BIGINT AS w FROM df, st),
    dm AS (SELECT doc_id, 25 + (75 * len(ts) * big_n) // big_l AS m FROM d, st),
    s AS (SELECT item_id, doc_id, sum(qc * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM q JOIN w USING (t) JOIN dt USING (t) JOIN dm USING (doc_id) GROUP BY item_id, doc_id)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    WHERE rank <= {lexical.TOP}"""


@query("op13_lexical_search", _OP13_SQL)
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents; labels of rows that are not held out train the model."""
    docs = table(spark, sf, "documents")
    model = toxicity.train(toxicity.labelled_sample(docs, table(spark, sf, "labels")), docs)
    scored = toxicity.score_texts(docs.select("doc_id", "text"), model, keep_text=False)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         "n_terms", "best", F.size("passages").cast("long").alias("n_passages"))
