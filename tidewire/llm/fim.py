"""Fill-in-middle transformation by repeated-capture matching.

A text is cut into units, its lines (``[^\\n]*\\n|[^\\n]+``).  One ``fullmatch`` of
``(unit)*`` with the regex library keeps every repetition of the group, so
``match.ends(1)`` lists where each unit ends: its length is n, and the ends of
units ``lo`` and ``hi`` are the two cut offsets, with no loop over lines.  Only
that match runs in Python (an Arrow-batched UDF that sends the text one way and
three numbers back); the hashes that choose the cuts and the form, the output
text and its inverse are column expressions.
"""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The units, the sentinels and the order of the two forms.
UNITS = regex.compile(r"([^\n]*\n|[^\n]+)*")
PRE, SUF, MID = "<P>", "<S>", "<M>"
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50

OUT = ["n", "form", "prefix_chars", "middle_chars", "output"]
CUTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "lo", "hi")])


def cut_offsets(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """(n, lo, hi): units of ``text`` and the code-point offsets where prefix and middle end."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    a, b = h1 % (n + 1), h2 % (n + 1)
    lo, hi = min(a, b), max(a, b)
    return n, (ends[lo - 1] if lo else 0), (ends[hi - 1] if hi else 0)


@F.pandas_udf(CUTS)
def _cuts(text: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
    rows = [cut_offsets(t, int(a), int(b)) for t, a, b in zip(text, h1, h2)]
    return pd.DataFrame(rows or None, columns=["n", "lo", "hi"], dtype="int64")


def _hash_part(h: Column, i: int) -> Column:
    """The i-th group of 8 hex digits of ``h`` as an unsigned integer."""
    return F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, n, form, prefix_chars, middle_chars, output.

    The cuts come from sha256 of ``"{seed}:" + id`` in decimal: h1 and h2 (groups 1
    and 2 of 8 hex digits) modulo n + 1 give the two cut units; the form is
    ``plain`` where the text is empty or holds a sentinel, or where h3 % 100 >=
    ``fim_percent``; else ``spm`` where h4 % 100 < ``spm_percent``, else ``psm``.
    A null text counts as empty (form plain, n 0); a null id hashes as ``"{seed}:"``;
    repeated rows and ties are transformed each, alike; an empty table gives an
    empty result; other columns are not read, so their names cannot clash (only the
    id column is kept, and it must not be named like an output column).  Lengths
    count code points; a row's memory in Python is its text and one integer per unit.
    """
    if id_col in OUT:
        raise ValueError(f"the id column may not be named {id_col}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    cut = _cuts(text, _hash_part(h, 0), _hash_part(h, 1))
    plain = ((text == "") | text.contains(PRE) | text.contains(SUF) | text.contains(MID)
             | (_hash_part(h, 2) % 100 >= fim_percent))
    form = F.when(plain, "plain").when(_hash_part(h, 3) % 100 < spm_percent, "spm").otherwise("psm")
    staged = docs.select(F.col(id_col), text.alias("t"), cut.alias("c"), form.alias("form"))
    lo, hi = F.col("c.lo"), F.col("c.hi")
    prefix = F.substring(F.col("t"), F.lit(1), lo)
    middle = F.substring(F.col("t"), lo + 1, hi - lo)
    suffix = F.substring(F.col("t"), hi + 1, F.length("t"))
    output = (F.when(F.col("form") == "psm", F.concat(F.lit(PRE), prefix, F.lit(SUF), suffix, F.lit(MID), middle))
              .when(F.col("form") == "spm", F.concat(F.lit(SUF), suffix, F.lit(PRE), prefix, F.lit(MID), middle))
              .otherwise(F.col("t")))
    is_plain = F.col("form") == "plain"
    return staged.select(
        F.col(id_col), F.col("c.n").alias("n"), "form",
        F.when(is_plain, None).otherwise(lo).alias("prefix_chars"),
        F.when(is_plain, None).otherwise(hi - lo).alias("middle_chars"),
        output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text an output of :func:`transform` was made from, as a column.

    The text of a form other than plain holds no sentinel, so the first of each
    marks its part's end exactly.
    """
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, len(first) + 1, F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, MID, 1)
        return one, two, F.substring(rest, F.length(two) + len(MID) + 1, F.length(rest))

    p_prefix, p_suffix, p_middle = parts(PRE, SUF)
    s_suffix, s_prefix, s_middle = parts(SUF, PRE)
    return (F.when(form == "psm", F.concat(p_prefix, p_middle, p_suffix))
            .when(form == "spm", F.concat(s_prefix, s_middle, s_suffix))
            .otherwise(output))
