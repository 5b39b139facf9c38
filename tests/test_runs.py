"""Whole runs and streams on small landed files."""

import datetime
import hashlib
import io
import zipfile


from tidewire.operators import embed
from tidewire.operators.manifest import ManifestLog
from tidewire.plans import feed_run as fr
from tidewire.schemas import FIELDS, PARSED_STORED
from tidewire.session import scratch_path
from tidewire.sources import archive, parsed
from tidewire.sources.vectors import VectorTable
from tidewire.streaming import feed

NOW = datetime.datetime(2024, 2, 1, 12)
HASHING = embed.HashingEmbedder(8)


def line(i, day, theme):
    v = dict(gkg_record_id=i, date=day + "000000", source_common_name="s", document_id="http://" + i, themes=theme)
    return "\t".join(v.get(f, "") for f in FIELDS)


def land(root, name, text, zipped=True):
    path = root / "landing" / "files" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text.encode()
    if zipped:
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            z.writestr(name[:-4], data)
        data = b.getvalue()
    path.write_bytes(data)
    return hashlib.md5(data).hexdigest()


def listing(root, rows):
    path = root / "landing" / "lists" / "gkg.txt"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{s} {m} http://h/{n}\n" for s, m, n in rows))


def states(spark, paths):
    rows = ManifestLog(spark, paths.manifest).state().collect()
    return {r["file_url"].rsplit("/", 1)[1]: r for r in rows}


def test_run(spark, tmp_path):
    paths = fr.FeedPaths(str(tmp_path))
    a = land(tmp_path, "20240131000000.gkg.csv.zip", line("a", "20240131", "OLD") + "\n" + line("a", "20240131", "NEW") + "\n" + line("b", "20240131", "T"))
    b = land(tmp_path, "20240131001500.gkg.csv.zip", line("c", "20240131", "T") + "\nshort\n" + line("a", "20240131", "LATER"))
    land(tmp_path, "20240201000000.gkg.csv.zip", line("d", "20240201", "T"))
    rows = [(1, a, "20240131000000.gkg.csv.zip"), (1, b, "20240131001500.gkg.csv.zip"), (1, "wrong", "20240201000000.gkg.csv.zip"),
            (1, "x", "20240201001500.gkg.csv.zip"), (1, "x", "20200101.gkg.csv.zip"), (1, "x", "20240131.export.CSV.zip")]
    listing(tmp_path, rows)
    s = fr.run(spark, paths, "incremental", NOW, HASHING, date_from="19990101").first()
    assert (s["date_from"], s["date_to"]) == ("20240131", "20240201")
    assert (s["total_scanned"], s["new_inserted"], s["files_downloaded"], s["download_errors"]) == (4, 4, 2, 1)
    assert (s["parsed_files"], s["parse_errors"], s["records_embedded"], s["total_records"]) == (2, 0, 3, 3)
    st = states(spark, paths)
    # both files of one day count; the file that has not landed stays pending
    assert {n: (r["status"], r["record_count"]) for n, r in st.items()} == {
        "20240131000000.gkg.csv.zip": ("completed", 3), "20240131001500.gkg.csv.zip": ("completed", 2),
        "20240201000000.gkg.csv.zip": ("failed", None), "20240201001500.gkg.csv.zip": ("pending", None)}
    assert st["20240131000000.gkg.csv.zip"]["checksum_md5"] == a
    store = VectorTable(spark, paths.vectors, 8).read()
    themes = {r["gkg_record_id"]: r["themes"] for r in store.collect()}
    assert themes == {"a": ["NEW"], "b": ["T"], "c": ["T"]}  # earliest file, last line in it

    # nothing new: nothing changes, but the failed file is tried again
    s = fr.run(spark, paths, "incremental", NOW + datetime.timedelta(minutes=15), HASHING).first()
    assert (s["new_inserted"], s["already_tracked"], s["records_embedded"], s["records_skipped"]) == (0, 4, 0, 5)
    assert states(spark, paths)["20240201000000.gkg.csv.zip"]["retry_count"] == 2

    # the file arrives as listed, another lands at last
    good = land(tmp_path, "20240201001500.gkg.csv.zip", line("e", "20240201", "T"))
    st = states(spark, paths)
    assert st["20240201001500.gkg.csv.zip"]["checksum_md5"] == "x" and good != "x"
    land(tmp_path, "20240201001500.gkg.csv", line("e", "20240201", "T"), zipped=False)
    listing(tmp_path, rows + [(1, hashlib.md5((tmp_path / "landing/files/20240201001500.gkg.csv").read_bytes()).hexdigest(), "20240201001500.gkg.csv")])
    s = fr.run(spark, paths, "backfill", NOW + datetime.timedelta(minutes=30), HASHING, days=5).first()
    assert (s["date_from"], s["records_embedded"], s["total_records"], s["max_date"]) == ("20240127", 1, 4, "20240201")
    assert states(spark, paths)["20240201000000.gkg.csv.zip"]["retry_count"] == 3

    s = fr.run(spark, paths, "embed_only", NOW, HASHING).first()
    assert (s["total_scanned"], s["records_embedded"], s["files_embedded"]) == (None, 0, 3)
    assert spark.read.parquet(paths.runs).count() == 4

    # stored records gone: they are parsed again from the raw lines
    files = spark.createDataFrame([("20240131", "20240131001500.gkg.csv.zip")], "date_partition string, source_file string")
    path = scratch_path(spark, "files")
    files.write.parquet(path)
    files = spark.read.schema("date_partition string, source_file string").parquet(path)
    stored = {r["gkg_record_id"] for r in fr.records_to_embed(spark, paths, files).collect()}
    (tmp_path / "parsed").rename(tmp_path / "parsed-away")
    fresh = fr.records_to_embed(spark, paths, files)
    assert {r["gkg_record_id"] for r in fresh.collect()} == stored == {"a", "c"}


def test_file_with_too_many_errors(spark, tmp_path):
    paths = fr.FeedPaths(str(tmp_path))
    m = land(tmp_path, "20240131000000.gkg.csv", "bad\nbad\n" + line("a", "20240131", "T"), zipped=False)
    n = land(tmp_path, "20240131001500.gkg.csv", "\n", zipped=False)
    listing(tmp_path, [(1, m, "20240131000000.gkg.csv"), (1, n, "20240131001500.gkg.csv")])
    fr.sync(spark, paths, NOW)
    assert fr.fetch(spark, paths, NOW) == {"files_downloaded": 2, "download_errors": 0}
    assert fr.parse_to_completed(spark, paths, NOW, max_errors=2) == {"parsed_files": 1, "parse_errors": 1}
    st = states(spark, paths)
    assert st["20240131000000.gkg.csv"]["error_message"] == "Max errors (2) exceeded"
    assert st["20240131001500.gkg.csv"]["record_count"] == 0
    assert parsed.read_parsed(spark, paths.parsed).count() == 0


def test_fetch_limit_and_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fr, "FETCH_BATCH", 2)
    paths = fr.FeedPaths(str(tmp_path))
    names = [f"2024010{i}.gkg.csv" for i in range(1, 8)]
    listing(tmp_path, [(1, land(tmp_path, n, line(n, n[:8], "T"), zipped=False), n) for n in names])
    fr.sync(spark, paths, NOW)
    assert fr.fetch(spark, paths, NOW, max_files=3)["files_downloaded"] == 3
    done = sorted(n for n, r in states(spark, paths).items() if r["status"] == "downloaded")
    assert done == names[:3]
    assert fr.fetch(spark, paths, NOW)["files_downloaded"] == 4


def test_streams_equal_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "20240131000000.gkg.csv").write_text("\n".join(line(f"a{i}", "20240131", "T") for i in range(20)) + "\nshort\n")
    out, mark = str(tmp_path / "parsed"), str(tmp_path / "mark")
    feed.stream_ingest(spark, str(src), out, mark).awaitTermination()
    (src / "20240201000000.gkg.csv").write_text("\n".join(line(f"a{i}", "20240201", "T") for i in range(10, 30)))
    feed.stream_ingest(spark, str(src), out, mark).awaitTermination()
    rows = spark.read.schema(PARSED_STORED).parquet(out)
    assert rows.count() == 40
    table = VectorTable(spark, str(tmp_path / "v"), 8)
    feed.stream_embed(spark, out, table, HASHING, str(tmp_path / "m1"), max_files=1).awaitTermination()
    feed.stream_embed(spark, out, table, HASHING, str(tmp_path / "m2")).awaitTermination()  # progress lost
    ids = [r[0] for r in table.scan("gkg_record_id").collect()]
    assert sorted(ids) == sorted(f"a{i}" for i in range(30))


def test_dates():
    assert fr.date_range("incremental", NOW, "1", "2") == ("20240131", "20240201")
    assert fr.date_range("backfill", NOW) == ("20240102", "20240201")
    assert fr.date_range("backfill", NOW, "20230101", None, 3) == ("20230101", "20240201")
    assert fr.date_range("embed_only", NOW, None, "2") == (None, "2")


def test_stream_keeps_the_batch_record_in_any_arrival_order(spark, tmp_path):
    """Two files hold the same ids; the earlier file's record counts, whichever arrives first."""
    early = "\n".join(line(f"b{i}", "20240131", "EARLY") for i in range(6))
    late = "\n".join(line(f"b{i}", "20240201", "LATE") for i in range(3, 9))
    found = []
    for order in (("20240201000000", late), ("20240131000000", early)), (("20240131000000", early), ("20240201000000", late)):
        src = tmp_path / f"in{len(found)}"
        src.mkdir()
        out, mark = str(tmp_path / f"parsed{len(found)}"), str(tmp_path / f"mark{len(found)}")
        table = VectorTable(spark, str(tmp_path / f"v{len(found)}"), 8)
        for name, text in order:
            (src / f"{name}.gkg.csv").write_text(text)
            feed.stream_ingest(spark, str(src), out, mark).awaitTermination()
            feed.stream_embed(spark, out, table, HASHING, str(tmp_path / f"m{len(found)}")).awaitTermination()
        found.append(sorted((r.gkg_record_id, r.date, tuple(r.themes)) for r in table.read().collect()))
    assert found[0] == found[1]
    assert len(found[0]) == 9 and [r[1] for r in found[0]].count("20240131") == 6
    batch = VectorTable(spark, str(tmp_path / "vb"), 8)
    fr.embed_incremental(spark.read.schema(PARSED_STORED).parquet(str(tmp_path / "parsed0")), batch, HASHING)
    assert sorted((r.gkg_record_id, r.date, tuple(r.themes)) for r in batch.read().collect()) == found[0]


def test_large_plain_file_is_never_one_value(spark, tmp_path, monkeypatch):
    """A landed file above the size read whole: lines, numbers, size and MD5 as Python reads them."""
    monkeypatch.setattr(archive, "WHOLE_BYTES", 3000)
    monkeypatch.setattr(archive, "PIECE_BYTES", 700)
    bodies = {
        "20240131000000.gkg.csv": "\n".join(line(f"x{i}", "20240131", "T") for i in range(300)).encode(),
        "2024 0131 a+b%41.gkg.csv": b"\xef\xbb\xbffirst\rsecond\r\n\r\r\n\n" + b"z\xff\xe2\x82 \xc3\xa9\n" * 900 + b"last\r",
        "20240131003000.gkg.csv": b"\n" + b"q\r\n" * 2000,
        "20240131004500.gkg.csv": b"\xef\xbb\xbf" + b"w\n" * 4000,
        "20240131010000.gkg.csv": b"small\nfile",
    }
    folder = tmp_path / "landing" / "files"
    folder.mkdir(parents=True)
    for name, body in bodies.items():
        (folder / name).write_bytes(body)
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.sources.binaryFile.maxLength": "3000"}
    keep = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        files = [(r.path, r.length) for r in archive.list_landed(spark, str(folder)).collect()]
        rows = archive.landed_lines(spark, files, scratch_path(spark, "pieces")).collect()
        heads = archive.landed_heads(spark, files, scratch_path(spark, "pieces")).collect()
        listing(tmp_path, [(1, hashlib.md5(bodies["20240131000000.gkg.csv"]).hexdigest(), "20240131000000.gkg.csv")])
        fr.sync(spark, fr.FeedPaths(str(tmp_path)), NOW)
        assert fr.fetch(spark, fr.FeedPaths(str(tmp_path)), NOW) == {"files_downloaded": 1, "download_errors": 0}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    for name, body in bodies.items():
        mine = sorted((r.line_number, r.value) for r in rows if r.source_file == name and r.line_number)
        wanted = io.TextIOWrapper(io.BytesIO(body), encoding="utf-8", errors="replace", newline=None).read().split("\n")
        wanted = wanted[:-1] if wanted[-1] == "" else wanted
        assert mine == list(enumerate(wanted, 1)), name
    expected = sorted((n, len(b), hashlib.md5(b).hexdigest(), None) for n, b in bodies.items())
    for found in (heads, [r for r in rows if r.line_number == 0]):
        assert sorted((r.source_file, r.n_bytes, r.actual_md5, r.error) for r in found) == expected
