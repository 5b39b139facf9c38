"""Rows that must not get lost: bad vectors, repeated request names, filters and limits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_runs import HASHING, NOW, land, line, listing
from tests.test_search import DIM, brute, found, rows
from tidewire import session
from tidewire.operators import manifest as mf
from tidewire.operators import records, retrieval, search
from tidewire.operators.manifest import ManifestLog
from tidewire.plans import feed_run as fr
from tidewire.session import scratch_path
from tidewire.sources import parsed
from tidewire.sources import vectors as vt
from tidewire.streaming import feed

COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vt.VECTOR_COLUMNS)
NAN, INF = float("nan"), float("inf")


def bad_rows():
    out = []
    for k, v in enumerate([[NAN] + [1.0] * (DIM - 1), [INF] * DIM, None, [None] + [1.0] * (DIM - 1), [-INF] + [0.0] * (DIM - 1)]):
        out.append((f"bad{k}", *rows(1)[0][1:12], v))
    return out


@pytest.fixture(scope="module")
def mixed(spark):
    """Good and bad vectors in one batch, as another writer may leave them."""
    table = spark.createDataFrame(rows() + bad_rows(), COLUMNS).coalesce(1)
    return table.withColumn("year_month", F.substring("date", 1, 6))


def test_one_bad_vector_spoils_nothing(mixed):
    q = [0.3] * DIM
    assert found(search.knn_search(mixed, q, 20)) == brute(q, 20)
    assert len(found(search.knn_search(mixed, q, 5000))) == len(rows())


def test_profile_and_ranges_leave_bad_vectors_out(spark, mixed):
    asked = spark.createDataFrame([("a", [0.3] * DIM), ("b", None), ("c", [NAN] * DIM)], "qid string, vector array<double>")
    got = search.distance_profile(mixed, asked).collect()
    assert [(r["qid"], r["n_candidates"]) for r in got] == [("a", len(rows()))] and np.isfinite(got[0]["avg_distance"])
    assert all(np.isfinite(r["lo"]) and np.isfinite(r["hi"]) for r in retrieval.dimension_ranges(mixed).collect())


def test_append_refuses_and_counts_bad_vectors(spark):
    table = vt.VectorTable(spark, scratch_path(spark, "mixed"), DIM)
    assert table.rejected().count() == 0
    table.append(spark.createDataFrame(rows(30) + bad_rows(), COLUMNS))
    assert table.read().count() == 30 and sorted(r["gkg_record_id"] for r in table.rejected().collect()) == [f"bad{k}" for k in range(5)]


@pytest.mark.parametrize("mode", ["prefilter", "overfetch"])
def test_requests_of_one_name_stay_apart(spark, mixed, mode):
    requests = [("x", [1.0] * DIM, 2, ["C1"]), ("x", [-1.0] * DIM, 3, []), ("y", None, 3, []), ("z", [NAN] * DIM, 3, [])]
    asked = spark.createDataFrame(requests, "qid string, vector array<double>, limit int, countries array<string>")
    got = search.knn_batch(mixed, asked, mode).collect()
    assert {r["qid"] for r in got} == {"x"}
    if mode == "prefilter":
        assert len(got) == 5
    assert {r["gkg_record_id"] for r in got} >= set(brute([-1.0] * DIM, 3))


def test_funnel_filters_before_it_cuts(mixed):
    q = [1.0] * DIM
    late = lambda r: r[1] >= "20241201"
    got = found(retrieval.funnel_search(mixed, q, shortlist=600, limit=5, date_from="20241201"))
    assert got == brute(q, 5, late)
    assert len(found(retrieval.funnel_search(mixed, q, shortlist=10, limit=5, date_from="20241201", countries=["C3"]))) == 5


def test_lists_of_files_have_no_limit_of_their_own(spark):
    names = spark.range(250).select(F.concat(F.lit("http://h/"), "id").alias("file_url"))
    state = names.withColumns({
        "status": F.lit("failed"), "retry_count": F.lit(0), "date_partition": F.lit("20240101"),
        "created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
    assert mf.retryable_files(state).count() == 250 and mf.files_by_status(state, "failed").count() == 250


def test_limits_count_files_still_to_do(spark, tmp_path):
    """Files without a date do not use up a limit, and embedded files are not taken again."""
    paths = fr.FeedPaths(str(tmp_path))
    names = [f"2024013100{m}00.gkg.csv.zip" for m in ("00", "15", "30")]
    sums = [land(tmp_path, n, line(f"r{k}", "20240131", "T")) for k, n in enumerate(names)]
    odd = land(tmp_path, "nodate.gkg.csv.zip", line("o", "20240131", "T"))
    listing(tmp_path, [(1, m, n) for m, n in zip(sums, names)] + [(1, odd, "nodate.gkg.csv.zip")])
    fr.sync(spark, paths, NOW, file_type=None)
    fr.fetch(spark, paths, NOW)
    for _ in range(3):
        fr.parse_to_completed(spark, paths, NOW, max_files=1)
    done = {r["status"] for r in ManifestLog(spark, paths.manifest).state().where("date_partition is not null").collect()}
    assert done == {"completed"}
    counts = [fr.embed(spark, paths, HASHING, max_files=1)["records_embedded"] for _ in range(4)]
    assert counts == [1, 1, 1, 0]


class Cluster:
    class conf:  # noqa: N801
        get = staticmethod(lambda key, default=None: None)

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getConf():  # noqa: N802
            return {}


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)


def test_stream_and_batch_share_a_store(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "20240131000000.gkg.csv").write_text("\n".join(line(f"a{i}", "20240131", "T") for i in range(5)))
    store = str(tmp_path / "parsed")
    feed.stream_ingest(spark, str(src), store, str(tmp_path / "mark")).awaitTermination()
    batch = parsed.read_parsed(spark, store).withColumns({"source_file": F.lit("20240201000000.gkg.csv"), "date_partition": F.lit("20240201")})
    parsed.write_parsed(spark.createDataFrame(batch.collect(), batch.schema), store)
    assert parsed.read_parsed(spark, store).count() == 10


def test_files_of_one_name_in_several_folders_are_all_kept(spark, tmp_path):
    """One file a batch: what a batch brings does not replace a namesake of an earlier one."""
    src, store = tmp_path / "in put", str(tmp_path / "parsed")
    deep = "/".join(["a-folder-with-a-long-name=20240131"] * 12)
    for k, folder in enumerate([".", "day=1", "day=2", "day=1/a b", deep]):
        (src / folder).mkdir(parents=True, exist_ok=True)
        (src / folder / "part-00003.csv").write_text("\n".join(line(f"{k}-{i}", "20240131", "T") for i in range(5)))
    for _ in range(2):  # again with the progress lost
        feed.stream_ingest(spark, str(src), store, str(tmp_path / f"mark{_}"), max_files=1).awaitTermination()
        rows = parsed.read_parsed(spark, store)
        assert sorted(r[0] for r in rows.select("gkg_record_id").collect()) == [f"{k}-{i}" for k in range(5) for i in range(5)]
    names = sorted(r[0] for r in rows.select("source_file").distinct().collect())
    assert len(names) == 5 and {"part-00003.csv", "day=1/part-00003.csv", "day=2/part-00003.csv", "day=1/a%20b/part-00003.csv"} < set(names)
    assert {r[0] for r in rows.select("date_partition").distinct().collect()} == {"unknown"}


def test_few_failed_files_shuffle_no_lines(spark, tmp_path):
    lines = spark.createDataFrame([(f"f{i % 9}", "short") for i in range(40)] + [("bad", "x\ty\tz")] * 3, "source_file string, value string")
    lines.write.parquet(str(tmp_path / "lines"))
    kept = records.drop_failed_files(spark.read.parquet(str(tmp_path / "lines")), max_errors=5)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
