"""Whole lines: edge rows, counts, batches, stored forms, archives."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tidewire.operators import embed, records as rec
from tidewire.plans.feed_run import FeedPaths
from tidewire.schemas import FIELDS
from tidewire.session import scratch_path
from tidewire.sources import archive, filelist, lines as raw_lines, parsed


def line(n=27, **over):
    base = dict(gkg_record_id="r1", date="20240102030405", source_collection_id="1", source_common_name="src",
                document_id="http://d")
    base.update(over)
    return "\t".join(base.get(f, "") for f in FIELDS[:n])


def frame(spark, values, file="f.csv"):
    return spark.createDataFrame([(file, i + 1, v) for i, v in enumerate(values)],
                                 "source_file string, line_number bigint, value string")


def test_edge_lines(spark):
    rows = ["   ", "\t\t\t\t\t", "a\tb\tc\td", line(5), line() + "\tx\ty\tz", line(gkg_record_id=" "), line(document_id="")]
    df = frame(spark, rows)
    kinds = [r[0] for r in df.select(rec.line_kind(F.col("value"))).collect()]
    assert kinds == ["blank", "blank", "error", "parsed", "parsed", "skipped", "skipped"]
    stats = rec.parse_stats(df).first().asDict()
    assert stats == {"source_file": "f.csv", "lines_processed": 7, "records_parsed": 2, "errors": 1, "skipped": 2}
    got = rec.parse_records(df).orderBy("line_number").collect()
    assert [r["line_number"] for r in got] == [4, 5]
    assert got[0]["themes"] == [] and got[0]["tone"]["tone"] == 0.0 and got[0]["raw"]["v2_extras_xml"] == ""
    bad = rec.reject_lines(df).first()
    assert bad["message"] == "Too few fields: 4, expected at least 5" and bad["line_head"] == "a\tb\tc\td"


def test_overflow_keeps_record(spark):
    got = rec.parse_records(frame(spark, [line(v2_tone="1,2,3,4,5,6,inf", themes="A;B")])).first()
    assert got["tone"] is None and got["themes"] == ["A", "B"] and len(got["parse_errors"]) == 1


def test_selection_leaves_others_empty(spark):
    got = rec.parse_records(frame(spark, [line(themes="A", persons="P", v2_tone="1")]), ["persons"]).first()
    assert got["themes"] == [] and got["persons"] == ["P"] and got["tone"] is None and got["locations"] == []


def test_raw_field(spark):
    df = rec.parse_records(frame(spark, [line(v2_gcam=" keep me ")]))
    assert df.select(rec.raw_field("v2_gcam"), rec.raw_field("nope")).first()[:] == (" keep me ", "")


def test_max_errors(spark):
    df = frame(spark, [line(), "bad", "bad"], "a").unionByName(frame(spark, [line(), "bad"], "b"))
    kept = rec.drop_failed_files(df, max_errors=2).select("source_file").distinct().collect()
    assert [r[0] for r in kept] == ["b"]
    assert rec.drop_failed_files(df, skip_malformed=False).count() == 0
    over = frame(spark, [line(v2_tone="1,,,,,,inf")], "c")
    assert rec.drop_failed_files(over).count() == 1
    assert rec.drop_failed_files(over, skip_malformed=False).count() == 0


def test_batches_of_a_hot_month(spark):
    """A third of all rows are copies of one record; batches stay full and whole."""
    hot = spark.range(4000).select(F.lit("same").alias("gkg_record_id"), F.lit("d").alias("document_id"),
                                   F.lit("20240101").alias("date_str"))
    rest = spark.range(8000).select(F.col("id").cast("string").alias("gkg_record_id"), F.lit("d").alias("document_id"),
                                    F.when(F.col("id") % 2 == 0, "20240105").otherwise("2024").alias("date_str"))
    rows = rec.partition_batches(hot.unionByName(rest), 1000)
    sizes = {(r["partition_key"], r["batch_no"]): r["n"] for r in
             rows.groupBy("partition_key", "batch_no").agg(F.sum("n_copies").alias("n")).collect()}
    assert sizes == {**{("202401", i): 1000 for i in range(8)}, **{("unknown", i): 1000 for i in range(4)}}
    total = rows.groupBy("gkg_record_id").agg(F.sum("n_copies").alias("n"))
    assert total.where("gkg_record_id = 'same'").first()["n"] == 4000 and total.count() == 8001
    assert rows.count() < 8100  # copies travel as counts


def test_line_ends_and_bad_bytes(spark, tmp_path):
    body = (line(gkg_record_id="a") + "\r\n" + line(gkg_record_id="b") + "\r" + line(gkg_record_id="c") + "\n")
    path = tmp_path / "x.csv"
    path.write_bytes(body.encode() + b"d\xff\t20240101\t1\ts\tdoc\n")
    got = rec.parse_records(raw_lines.read_record_lines(spark, str(path)))
    assert sorted(r[0] for r in got.select("gkg_record_id").collect()) == ["a", "b", "c", "d�"]
    assert got.select("source_file").first()[0] == "x.csv"
    text = spark.createDataFrame([(bytearray(body.encode()),)], "content binary")
    lines = raw_lines.lines_of_text(text.select(F.col("content").cast("string").alias("content")))
    assert [r["line_number"] for r in lines.orderBy("line_number").collect()] == [1, 2, 3]


def test_json_reader_is_tolerant(spark):
    rows = ['{"gkg_record_id":"a","locations":["Paris",{"country_code":"FR"},7,null],"tone":2}', "{broken", '["list"]',
            "", '{"tone":{"tone":1.5},"locations":null,"themes":["T"]}', '{"tone":0}', '{"tone":{}}', '{"tone":"x"}',
            '{"tone":null}', '{"tone":true}', '{"tone":{"other":1}}']
    got = parsed.parsed_from_json(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, value string"))
    got = {r["i"]: r for r in got.collect()}
    assert sorted(got) == [0, 4, 5, 6, 7, 8, 9, 10]
    assert [tuple(x) for x in got[0]["locations"]] == [("Paris", ""), ("", "FR"), ("7", ""), ("None", "")]
    assert got[4]["gkg_record_id"] == "" and got[4]["themes"] == ["T"] and got[4]["locations"] == []
    tones = {i: r["tone"] and r["tone"]["tone"] for i, r in got.items()}
    assert tones == {0: 2.0, 4: 1.5, 5: None, 6: None, 7: 0.0, 8: None, 9: 1.0, 10: 0.0}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_store_replaces_per_file(spark, fmt):
    path = scratch_path(spark, "t")

    def rows(file, *ids):
        df = frame(spark, [line(gkg_record_id=i, v2_tone="1,2,3,4,5,6,inf" if i == "x" else "3") for i in ids], file)
        out = rec.project_parsed(rec.parse_records(df), "line_number", "source_file")
        return out.withColumn("date_partition", F.lit("20240102"))

    parsed.write_parsed(rows("f1", "a", "b").unionByName(rows("f2", "c", "x")), path, fmt=fmt)
    parsed.write_parsed(rows("f1", "z"), path, fmt=fmt)

    def ids():
        return sorted(r[0] for r in parsed.read_parsed(spark, path, fmt).select("gkg_record_id").collect())

    assert ids() == ["c", "x", "z"]
    none = {r["gkg_record_id"]: r["tone"] for r in parsed.read_parsed(spark, path, fmt).collect()}
    assert none["x"] is None and none["c"]["tone"] == 3.0
    gone = spark.createDataFrame([("20240102", "f2")], "date_partition string, source_file string")
    parsed.write_parsed(rows("f1", "z"), path, emptied=gone, fmt=fmt)
    assert ids() == ["z"]


def zipped(*entries):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in entries:
            z.writestr(name, text)
    return buffer.getvalue()


def test_archives(spark, tmp_path):
    (tmp_path / "20240101.gkg.csv.zip").write_bytes(zipped(("a", "l1\r\nl2\rl3"), ("b", "no")))
    (tmp_path / "empty.zip").write_bytes(zipped())
    (tmp_path / "broken.zip").write_bytes(b"PK nonsense")
    (tmp_path / "plain.csv").write_text("p1\n\np3\n")
    unpacked = archive.archive_lines(archive.read_archives(spark, str(tmp_path))).cache()
    got = sorted((r["source_file"], r["line_number"], r["value"]) for r in unpacked.where("line_number > 0").collect())
    assert got == [("20240101.gkg.csv.zip", 1, "l1"), ("20240101.gkg.csv.zip", 2, "l2"), ("20240101.gkg.csv.zip", 3, "l3"),
                   ("plain.csv", 1, "p1"), ("plain.csv", 2, ""), ("plain.csv", 3, "p3")]
    sums = {r["source_file"]: r["actual_md5"] for r in unpacked.where("line_number = 0").collect()}
    files = spark.createDataFrame(
        [("http://h/20240101.gkg.csv.zip", sums["20240101.gkg.csv.zip"]), ("http://h/plain.csv", "bad"),
         ("http://h/empty.zip", None), ("http://h/broken.zip", None)], "file_url string, checksum_md5 string")
    out = {r["source_file"]: (r["status"], r["error_message"]) for r in archive.checksum_join(unpacked, files).collect()}
    assert out["20240101.gkg.csv.zip"] == ("downloaded", None)
    assert out["plain.csv"][1].startswith("MD5 mismatch") and out["empty.zip"][1] == "Empty zip file: empty.zip"
    assert out["broken.zip"][0] == "failed"
    path = scratch_path(spark, "raw")
    archive.write_raw(unpacked, path)
    archive.write_raw(unpacked, path)
    assert archive.read_raw(spark, path).count() == unpacked.count()
    one = spark.createDataFrame([("plain.csv",)], "source_file string")
    assert archive.read_raw_of(spark, path, one).count() == 4


def test_file_list(spark):
    rows = ["123456 abc123 http://h/gkg/20230101.gkg.csv.zip", "1 a http://h/20230101123000.EXPORT.CSV.zip",
            "1 a http://h/readme.txt", "x a http://h/f", "1 a", "1 a b c", "", "  5\tq  http://h/z  "]
    got = filelist.parse_file_info(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("http://h/20230101123000.EXPORT.CSV.zip", 1, "a", "20230101", "export"),
        ("http://h/gkg/20230101.gkg.csv.zip", 123456, "abc123", "20230101", "gkg"),
        ("http://h/readme.txt", 1, "a", None, None), ("http://h/z", 5, "q", None, None)]
    assert filelist.filter_file_list(got, "gkg", "20240101").count() == 0
    assert filelist.filter_file_list(got, None, "20240101").count() == 2
    with pytest.raises(ValueError):
        filelist.read_file_list(spark, FeedPaths("/x").landing, "nope")


def test_texts(spark):
    none = "array()"
    rows = spark.sql(f"""
      SELECT 1 AS i, array('A') AS persons, CAST({none} AS array<string>) AS themes, CAST({none} AS array<string>) AS organizations,
        CAST({none} AS array<struct<full_name:string,country_code:string>>) AS locations,
        CAST(NULL AS struct<tone:double>) AS tone, '' AS source_common_name, 'r' AS gkg_record_id
      UNION ALL SELECT 2, array(), array(), array(), array(), NULL, '', 'r'
      UNION ALL SELECT 3, array(), array(), array(), array(struct('', 'FR')), struct(0.0D), '', 'r'
      UNION ALL SELECT 4, array(), transform(sequence(1, 25), x -> 'T' || x), array(), array(), struct(2.1D), 's', 'r'""")
    got = {r["i"]: r["text"] for r in embed.with_text(rows).collect()}
    assert got[1] == "People: A" and got[2] == "Unknown event" and got[3] == "Locations:  | Tone: neutral"
    assert got[4].count("T") == 22 and got[4].endswith(" | Tone: positive | Source: s")
    kept = embed.embed_records(rows, embed.HashingEmbedder(8))
    assert sorted(r["i"] for r in kept.select("i").collect()) == [2, 3, 4]
