"""Steps whose cost once grew faster than their input."""

import io
import os
import zipfile

import pytest

from checks import inputs, records
from tidewire.operators import embed
from tidewire.sources import archive, lines, parsed, vectors


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def small_partitions(spark):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000"}
    keep = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_a_large_source_file_has_several_writers(spark, small, small_partitions):
    """F4 to F7"""
    path = records._text_folder(spark, small).removeprefix("file:")
    main = [f for f in os.listdir(f"{path}/source_file=20240315-main.gkg.csv") if f.startswith("part-")]
    assert len(main) > 1


def test_documents_are_dealt_by_hash(spark, small):
    """F8, F9, F13: dealing rows out in turn sorts them first."""
    executed = inputs.documents(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in executed and "RoundRobin" not in executed


def test_lists_are_cut_before_rows_are_copied(spark):
    """F10"""
    many = [f"T{i}" for i in range(100)]
    row = ("a", "20240101", "s", "d", many, many, many, [(n, "C") for n in many], (1.0,), 1, "20240101", "f")
    whole = spark.createDataFrame([row, ("b", "", "", "", [], None, [], None, None, None, None, "f")],
                                  "gkg_record_id string, date_str string, source_common_name string, document_id string, themes array<string>, "
                                  "persons array<string>, organizations array<string>, locations array<struct<full_name:string,country_code:string>>, "
                                  "tone struct<tone:double>, line_number bigint, date_partition string, source_file string")
    cut = vectors.cut_lists(whole)
    assert {len(r.themes) for r in cut.where("gkg_record_id = 'a'").collect()} == {20}
    embedder = embed.HashingEmbedder(8)
    a, b = (vectors.vec_row_shape(embed.embed_records(r, embedder)).orderBy("gkg_record_id").collect() for r in (whole, cut))
    assert a == b and len(a) == 2


def test_what_is_written_again_is_read_from_the_store(spark, small, monkeypatch):
    """F11"""
    seen, write = [], parsed.write_parsed
    monkeypatch.setattr(parsed, "write_parsed", lambda rows, path, *a, **k: (seen.append((path, rows.inputFiles())), write(rows, path, *a, **k))[1])
    records.sink_parsed(spark, small)
    assert len(seen) == 3 and all(path.removeprefix("file:") in f for path, files in seen[1:] for f in files)


def test_line_ends_without_regular_expressions(spark):
    """F12"""
    texts = ["a\r\nb\rc\nd", "a\n\n", "\n", "\r", "\r\n", "\n\r", "\r\r\n", "x", "x\r\n\r", "é\r\n", ""]
    df = lines.lines_of_text(spark.createDataFrame(list(enumerate(texts)), "i int, content string"))
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.i, r.line_number)):
        found.setdefault(r.i, []).append((r.line_number, r.value))
    for i, t in enumerate(texts):
        wanted = [x.rstrip("\n") for x in io.StringIO(t, newline=None)]
        assert found.get(i, []) == list(enumerate(wanted, 1)), repr(t)
    assert "regexp_replace" not in plan(df) and r"\r\n|" not in plan(df)


def test_heads_without_lines(spark):
    """the same heads, damage included, and no line leaves its task."""
    def zipped(*entries):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w", zipfile.ZIP_DEFLATED) as z:
            for e in entries:
                z.writestr("x.csv", e)
        return b.getvalue()

    good = zipped("a\nb\n" * 500)
    bad = bytearray(good)
    bad[60] ^= 0xFF
    rows = [("a.zip", "1", good), ("b.zip", "2", zipped()), ("c.zip", "3", good[:20]), ("d.csv", "4", b"x\n\xff"), ("e.zip", "5", bytes(bad))]
    df = spark.createDataFrame(rows, "source_file string, actual_md5 string, content binary")
    heads = archive.archive_heads(df).collect()
    assert sorted(heads) == sorted(archive.archive_lines(df).where("line_number = 0").collect()) and len(heads) == 5
