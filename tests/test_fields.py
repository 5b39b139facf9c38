"""Single-field parsers against literal values and a plain restatement."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions import assemble, fields as fx, text, urls


def values(spark, strings, column):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, v string")
    return [r["x"] for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_equals_python(spark):
    odd = ["　 a \x1c", "\x85b ", "​c", " \t\n", "d e", "\x1ff᠎"]
    assert values(spark, odd, text.trim_ws) == [s.strip() for s in odd]


def test_words_equal_python(spark):
    odd = ["a  b\tc", "  x\x1dy z ", "", "one"]
    assert values(spark, odd, text.words) == [s.split() for s in odd]


def _py(fn, s):
    try:
        return fn(s)
    except ValueError:
        return None


NUMBERS = [
    "1", " 12 ", "+5", "-7", "1.5", "1_000", "1__0", "_1", "1_", "", " ", "x", "1.5f", "1d", "0x10", "1e3",
    "1E-2", ".5", "5.", ".", "e5", "inf", "-Infinity", "+INF", "nan", "-nan", "infx", "1,5", "--1", "1e5_0",
    " 3　", "9" * 18, "1e999", "1 2",
]


def test_int_grammar(spark):
    assert values(spark, NUMBERS, text.to_int) == [_py(int, s) for s in NUMBERS]


def test_float_grammar(spark):
    got, want = values(spark, NUMBERS, text.to_float), [_py(float, s) for s in NUMBERS]
    for s, a, b in zip(NUMBERS, got, want):
        same = a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
        assert same, (s, a, b)


def test_random_numbers(spark):
    rng = random.Random(7)
    strings = ["".join(rng.choice("0123456789+-._eE nfia") for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    got_i, got_f = values(spark, strings, text.to_int), values(spark, strings, text.to_float)
    for s, i, f in zip(strings, got_i, got_f):
        assert i == _py(int, s), s
        want = _py(float, s)
        assert f == want or (math.isnan(f) and math.isnan(want)), s


@pytest.mark.parametrize(
    "s, want",
    [
        ("20230131235959999", datetime.datetime(2023, 1, 31, 23, 59, 59)),
        ("2023010112", datetime.datetime(2023, 1, 1)),
        ("20240229000000", datetime.datetime(2024, 2, 29)),
        ("20230230000000", None),
        ("20231301", None),
        ("2023010a", None),
        ("20230101000060", None),
        ("20230101240000", None),
        ("00000101", None),
        ("2023", None),
        ("", None),
        ("20230101xx1234", None),
    ],
)
def test_parse_date(spark, s, want):
    assert values(spark, [s], fx.parse_date) == [want]


def test_parse_list(spark):
    got = values(spark, [" A ; ;B;", "", ";;", "x"], fx.parse_list)
    assert got == [["A", "B"], [], [], ["x"]]


def test_parse_list_other_delimiters(spark):
    assert values(spark, ["a | b||c"], lambda c: fx.parse_list(c, "|")) == [["a", "b", "c"]]


def test_locations(spark):
    s = "4#Paris#FR#A1##48.8#2.3#X#10; ;4#Bad#FR###abc;1.0#Bad;#Only name;2#N#US######y"
    (got,) = values(spark, [s], fx.parse_locations)
    assert [x["full_name"] for x in got] == ["Paris", "Only name"]
    assert got[0].asDict() == {
        "location_type": 4, "full_name": "Paris", "country_code": "FR", "adm1_code": "A1", "adm2_code": "",
        "latitude": 48.8, "longitude": 2.3, "feature_id": "X", "char_offset": 10,
    }
    assert got[1]["location_type"] == 0 and got[1]["latitude"] is None and got[1]["char_offset"] is None
    assert values(spark, ["", "1.0#Bad", "3#Q"], fx.parse_location)[:2] == [None, None]


def test_tone(spark):
    cases = ["1.5,2,,x", "1.5,2", "", "1,2,3,4,5,6,7.9", "1,,,,,,inf", "x,,,,,,inf", "1,,,,,,nan", " ", "1,2,3,4,5,6,7,x"]
    got = values(spark, cases, fx.parse_tone)
    flat = [None if t is None else tuple(t) for t in got]
    zero = (0.0,) * 6 + (0,)
    assert flat == [
        zero, (1.5, 2.0, 0.0, 0.0, 0.0, 0.0, 0), zero, (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7), None, zero, zero,
        zero, (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7),
    ]
    over = values(spark, cases, lambda c: fx.tone_overflow(fx.tone_numbers(c)))
    assert over == [False] * 4 + [True] + [False] * 4


def test_tone_label(spark):
    df = spark.createDataFrame([(2.0,), (2.1,), (-2.0,), (-2.1,), (float("nan"),)], "t double")
    got = [r[0] for r in df.select(assemble.tone_label(F.col("t"))).collect()]
    assert got == ["neutral", "positive", "neutral", "negative", "neutral"]


def test_urls(spark):
    from urllib.parse import urlparse

    links = [
        "http://h/gkg/20230101.gkg.csv.zip", "http://h/20230101123000.EXPORT.CSV.zip?x=/y#z", "bare.txt",
        "http://h", "http://h/", "http://h/a b.txt", "https://h/p/q;v=1", "//h/x", "http://h/a.Mentions.b",
    ]
    names = values(spark, links, urls.url_filename)
    skip = {"//h/x"}
    for u, n in zip(links, names):
        if u not in skip:
            assert n == urlparse(u).path.split("/")[-1], u
    kinds = values(spark, links, lambda c: urls.file_type(urls.url_filename(c)))
    assert kinds == ["gkg", "export", None, None, None, None, None, None, "mentions"]
    days = values(spark, links, lambda c: urls.date_partition(urls.url_filename(c)))
    assert days == ["20230101", "20230101"] + [None] * 7
    months = values(spark, links, lambda c: urls.landing_month(urls.url_filename(c)))
    assert months == ["01", "01"] + ["unknown"] * 7
