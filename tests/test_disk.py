"""What whole runs put on disk beyond their tables."""

import os
import random
import time

import pyarrow.parquet as pq
import pytest

from checks import inputs, records, runs
from tidewire.plans import feed_run
from tidewire.session import scratch_path, shuffles_dropped
from tidewire.sources import archive


@pytest.fixture
def documents(spark, tmp_path):
    """Documents of a few sources, some without text, and their folder."""
    pick = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    rows = [(i, " ".join(pick.choices(words, k=200)) if i % 50 else None, "en", f"src{i % 9}", 900) for i in range(900)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def shuffle_bytes(spark):
    """Bytes by name of the shuffle files that are there."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(i) for i in range(files.size()))
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def left_since(spark, before, most):
    """Bytes of new shuffle files, once they are down to ``most`` or ten seconds have passed: they go in the background."""
    for _ in range(50):
        left = sum(n for name, n in shuffle_bytes(spark).items() if name not in before)
        if left <= most:
            break
        time.sleep(0.2)
    return left


def codecs(folder):
    parts = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    meta = [pq.ParquetFile(p).metadata for p in parts]
    return {m.row_group(g).column(c).compression for m in meta for g in range(m.num_row_groups) for c in range(m.num_columns)}


def test_a_run_keeps_no_second_copy_of_the_text(spark, documents, tmp_path, monkeypatch):
    """no stored input lines, no shuffled text, compressed stores."""
    monkeypatch.setattr(archive, "WHOLE_BYTES", 3000)
    paths = feed_run.FeedPaths(str(tmp_path / "run"))
    before = shuffle_bytes(spark)
    runs._land(spark, documents, paths)
    landed = sum(r.length for r in archive.list_landed(spark, paths.archives).collect())
    assert landed > 1_000_000 and left_since(spark, before, landed // 50) <= landed // 50
    assert (spark.sparkContext.applicationId, documents, "lines") not in inputs._WRITTEN
    before = shuffle_bytes(spark)
    stats = feed_run.run(spark, paths, "backfill", runs.NOW, runs.HASHING, date_from="20240101").first()
    assert stats["records_embedded"] > 500 and left_since(spark, before, landed // 20) <= landed // 20
    assert codecs(paths.raw) == codecs(paths.parsed) == {"ZSTD"}


def test_sums_are_stored_before_lines_are_written(spark, documents, tmp_path, monkeypatch):
    """writing the lines of large files shuffles nothing."""
    monkeypatch.setattr(archive, "WHOLE_BYTES", 3000)
    paths = feed_run.FeedPaths(str(tmp_path / "run"))
    runs._land(spark, documents, paths)
    files = [(r.path, r.length) for r in archive.list_landed(spark, paths.archives).collect()]
    assert all(n > 3000 for _, n in files)
    for rows in (archive.landed_lines, archive.landed_heads):
        found = rows(spark, files, scratch_path(spark, "pieces"))
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.where("line_number = 0").count() == len(files)


def test_fresh_lines_are_the_stored_ones(spark, documents):
    names = ["line_number", "source_file", "value"]
    rows = inputs.fresh_lines(spark, documents).select(names).collect()
    assert (spark.sparkContext.applicationId, documents, "lines") not in inputs._WRITTEN and len(rows) == 900
    assert sorted(rows, key=str) == sorted(inputs.lines(spark, documents).select(names).collect(), key=str)
    assert sorted(inputs.source_files(spark, documents).collect()) == sorted({(r.source_file,) for r in rows})


def test_text_files_are_made_without_stored_lines(spark, documents):
    """One stored file of lines has one sender, between whose rows Spark cannot cut."""
    folder = records._text_folder(spark, documents)
    assert (spark.sparkContext.applicationId, documents, "lines") not in inputs._WRITTEN
    assert spark.read.text(folder).count() == 900


def test_dropped_shuffles(spark, tmp_path):
    before, key = shuffle_bytes(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(key, "false")
    try:
        with shuffles_dropped(spark):
            df = spark.range(20_000).repartition(8, "id")
            df.write.parquet(str(tmp_path / "a"))
            assert df.count() == df.count() == 20_000 and len(df.collect()) == len(df.collect())
        assert left_since(spark, before, 0) == 0 and spark.read.parquet(str(tmp_path / "a")).count() == 20_000
        with pytest.raises(ValueError), shuffles_dropped(spark):
            raise ValueError
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)
