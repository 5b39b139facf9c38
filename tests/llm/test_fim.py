import hashlib
import re

from pyspark.sql import functions as F

from tidewire.llm import fim

from .common import edge_rows, same, table

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def brute(doc_id, text):
    """The transformation written out line by line."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows():
    lines = "first line\nsecond\n\n\nthird é line\nno end"
    return edge_rows() + [
        (20, lines), (21, lines + "\n"), (22, "\n\n\n"), (23, "has <M> inside\nand more"), (24, "x\n" * 5000),
        (25, "ünïcode\r\nwith crlf\r\n"), (26, "<P"), (27, lines), (27, lines),
    ] + [(100 + i, lines * (i % 4 + 1)) for i in range(40)]


def test_matches_brute_force_and_restores(spark):
    data = rows()
    out = fim.transform(table(spark, data))
    got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    same(got, [brute(i, t) for i, t in data])
    back = out.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("r")).collect()
    same(back, [(i, t or "") for i, t in data])
    forms = {r.form for r in got}
    assert forms == {"plain", "psm", "spm"}


def test_cut_offsets_count_code_points():
    text = "é\nab\n"
    n, lo, hi = fim.cut_offsets(text, 1, 2)
    assert n == 2 and (lo, hi) == (2, 5)
    assert fim.cut_offsets("", 5, 9) == (0, 0, 0)


def test_empty_table(spark):
    assert fim.transform(table(spark, [])).count() == 0


def test_long_text_without_lines(spark):
    long = "y" * 2_000_000
    got = fim.transform(table(spark, [(1, long)])).select("n", "prefix_chars", "middle_chars").collect()
    assert got[0].n == 1 and got[0].prefix_chars + got[0].middle_chars <= len(long)
