"""The physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tidewire.operators import embed, records as rec, search
from tidewire.schemas import VECTOR_COLUMNS, FIELDS
from tidewire.session import scratch_path
from tidewire.sources import vectors as vt


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark):
    t = vt.VectorTable(spark, scratch_path(spark, "vectors"), 2)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in VECTOR_COLUMNS)
    row = ("r", "20240301", "20240301", ["T"], [], [], [], ["C"], 0.0, "s", "u", "h", [1.0, 0.0])
    t.append(spark.createDataFrame([row, ("r2", "20240501") + row[2:]], ddl))
    return t.read()


@pytest.fixture(scope="module")
def lines(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("f", "\t".join("abcdefg" for _ in FIELDS))], "source_file string, value string").write.parquet(path)
    return spark.read.schema("source_file string, value string").parquet(path)


def test_search_prunes_months_and_columns(store):
    p = plan(search.knn_search(store, [1.0, 0.0], 3, "20240201", "20240331", payload=["gkg_record_id", "date"]))
    assert re.search(r"PartitionFilters: \[[^]]*year_month[^]]*202402", p)
    schema = re.search(r"ReadSchema: struct<([^>]*>?[^>]*)>", p).group(1)
    assert "persons" not in schema and "text_hash" not in schema
    assert "PushedFilters: [" in p and "GreaterThanOrEqual(date,20240201)" in p


def test_search_never_pairs_rows(spark, store):
    req = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "qid string, vector array<double>")
    p = plan(search.knn_batch(store, req))
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert p.count("WindowGroupLimit") == 4  # before and after each of two exchanges
    # the only join brings the other columns to the winners, which are broadcast
    assert "SortMergeJoin" not in p and p.count("BroadcastHashJoin") == 1


def test_new_records_is_anti_join_on_ids_only(spark, store):
    p = plan(vt.new_records(store.select("gkg_record_id", "themes"), store))
    assert "LeftAnti" in p and "LeftSemi" in p
    assert all("vector" not in s for s in re.findall(r"ReadSchema: (struct<.*?>)\n", p))


def test_counting_lines_never_splits_them(lines):
    assert "split(" not in plan(rec.parse_stats(lines))
    assert "split(" not in plan(rec.failed_files(lines))


def test_line_is_split_once(lines):
    p = plan(rec.parse_records(lines).select("gkg_record_id", "document_id", "date", "source_common_name"))
    assert p.count("split(rtrim(") == 1
    assert "Exchange" not in p


def test_unselected_parsers_vanish(lines):
    p = plan(rec.parse_records(lines).select("persons"))
    assert "RLIKE" not in p and "map_from_arrays" not in p


def test_embedding_a_record_needs_no_shuffle_and_no_python(lines):
    p = plan(embed.embed_records(rec.parse_records(lines), embed.HashingEmbedder(8)).select("gkg_record_id", "vector"))
    assert "Exchange" not in p and "Python" not in p
    assert p.count("split(rtrim(") == 1  # the filter on the text stays above the parsers


def test_one_per_id_cuts_before_the_shuffle(lines):
    p = plan(embed.one_per_id(rec.parse_records(lines).select("gkg_record_id", "date_str"), F.col("date_str")))
    assert p.count("WindowGroupLimit") == 2


def test_batches_share_one_count(spark, lines):
    df = rec.partition_batches(rec.parse_records(lines))
    df.collect()
    p = plan(df)
    assert p.count("FileScan parquet") == 1 or "ReusedExchange" in p
