"""The id index of the vector table against brute force, and its pruned reads."""

import numpy as np

from tidewire.session import scratch_path
from tidewire.sources import id_index
from tidewire.sources import vectors as vt

DIM = 4


def stored_rows(ids, vector=(1.0, 0.0, 0.0, 0.0)):
    return [(i, "20240105", "", [], [], [], [], [], 0.0, "s", "u", "h", list(vector) if vector else None) for i in ids]


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vt.VECTOR_COLUMNS))


def test_lookups_equal_brute_force(spark):
    index = id_index.IdIndex(spark, scratch_path(spark, "index"))
    first, second = [f"a{i}" for i in range(3000)], [f"b{i}" for i in range(500)]
    index.add(spark.createDataFrame([(i,) for i in first + first[:10]] + [(None,)], "gkg_record_id string"))
    index.add(spark.createDataFrame([(i,) for i in second], "gkg_record_id string"))
    asked = [f"a{i}" for i in range(0, 6000, 7)] + [f"b{i}" for i in range(0, 900, 3)] + ["a5", "a5", None]
    got = {r[0] for r in index.stored_among(spark.createDataFrame([(i,) for i in asked], "gkg_record_id string")).collect()}
    assert got == set(asked) & set(first + second)
    # the filters rule out nearly all new ids, so few buckets are read
    new = spark.createDataFrame([(f"new{i}",) for i in range(1000)], "gkg_record_id string")
    assert index.maybe_stored(new).count() <= 50
    assert index.stored_among(new).count() == 0


def test_read_of_ids_is_pruned_to_buckets(spark):
    index = id_index.IdIndex(spark, scratch_path(spark, "index"))
    index.add(spark.createDataFrame([(f"a{i}",) for i in range(5000)], "gkg_record_id string"))
    asked = spark.createDataFrame([(f"a{i}",) for i in range(3)] + [(f"z{i}",) for i in range(1000)], "gkg_record_id string")
    found = index.stored_among(asked)
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    scan = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("dynamicpruning" in line.lower() for line in scan), scan
    assert sorted(r[0] for r in found.collect()) == ["a0", "a1", "a2"]


def test_table_keeps_its_index(spark):
    table = vt.VectorTable(spark, scratch_path(spark, "vectors"), DIM)
    table.append(frame(spark, stored_rows([f"r{i}" for i in range(200)]) + stored_rows(["bad"], None)))
    asked = spark.createDataFrame([(f"r{i}", i) for i in range(150, 260)] + [("bad", 0)], "gkg_record_id string, position int")
    assert sorted(r.position for r in vt.existing_ids(asked, table).collect()) == list(range(150, 200))
    assert sorted(r.gkg_record_id for r in vt.new_records(asked, table).collect()) == sorted(
        [f"r{i}" for i in range(200, 260)] + ["bad"])
    assert table.delete_by_ids(spark.createDataFrame([("r150",), ("r151",)], "gkg_record_id string")) == 2
    assert sorted(r.position for r in vt.existing_ids(asked, table).collect()) == list(range(152, 200))
    # a table written before it had an index gets one
    older = vt.VectorTable(spark, table.path, DIM)
    older.index = id_index.IdIndex(spark, scratch_path(spark, "other-index"))
    older.index.ids_path = older.index.ids_path  # not there yet
    assert older.stored_among(asked).count() == 48


def test_compact_keeps_answers(spark):
    index = id_index.IdIndex(spark, scratch_path(spark, "index"))
    for part in range(3):
        index.add(spark.createDataFrame([(f"p{part}-{i}",) for i in range(300)], "gkg_record_id string"))
    asked = spark.createDataFrame([(f"p{p}-{i}",) for p in range(4) for i in range(0, 300, 11)], "gkg_record_id string")
    before = sorted(r[0] for r in index.stored_among(asked).collect())
    rows_before = index.words().count()
    index.compact()
    assert index.words().count() <= rows_before
    assert sorted(r[0] for r in index.stored_among(asked).collect()) == before
    assert len(before) == 3 * len(range(0, 300, 11))
