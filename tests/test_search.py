"""Vector table and search against brute force."""

import re
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.operators import embed, search
from tidewire.schemas import REQUEST
from tidewire.session import scratch_path
from tidewire.sources import vectors as vt

DIM, N = 8, 600


def rows(n=N, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        v = rng.normal(size=DIM).astype("float32") if i % 3 else np.ones(DIM, dtype="float32")  # a third are copies
        date = "" if i % 50 == 7 else f"2024{1 + i % 12:02d}{1 + i % 28:02d}"
        out.append((f"r{i:04d}", date, date, [f"TH_{i % 5}", "X y"], ["p"], ["o"], ["l"], [f"C{i % 4}"], float(i % 9), "s",
                    f"http://{i}", "h", v.tolist()))
    return out


@pytest.fixture(scope="module")
def table(spark):
    t = vt.VectorTable(spark, scratch_path(spark, "vectors"), DIM)
    t.append(spark.createDataFrame(rows(), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vt.VECTOR_COLUMNS)))
    return t


def brute(q, k, keep=lambda r: True):
    scored = sorted((float(np.square(np.array(r[12]) - np.array(q)).sum()), r[0]) for r in rows() if keep(r))
    return [i for _, i in scored[:k]]


def found(df):
    return [r["gkg_record_id"] for r in df.orderBy("rank").collect()]


def test_nearest_with_ties(table):
    q = [1.0] * DIM  # all copies tie at distance zero: lower ids first
    assert found(search.knn_search(table.read(), q, 15)) == brute(q, 15)
    q = [0.3] * DIM
    ten, eleven = found(search.knn_search(table.read(), q, 10)), found(search.knn_search(table.read(), q, 11))
    assert ten == brute(q, 10) and eleven[:10] == ten
    assert len(found(search.knn_search(table.read(), q, 5000))) == N


def test_filters(table):
    q = [0.1] * DIM
    dates = dict(date_from="20240301", date_to="20240620")
    inside = lambda r: "20240301" <= r[1] <= "20240620"
    assert found(search.knn_search(table.read(), q, 20, **dates)) == brute(q, 20, inside)
    early = lambda r: r[1] <= "20240115"  # noqa: E731  (rows without a date pass an upper bound)
    assert found(search.knn_search(table.read(), q, 60, date_to="20240115")) == brute(q, 60, early)
    assert found(search.knn_search(table.read(), q, 20, countries=["C1", "c2"])) == brute(q, 20, lambda r: r[7] == ["C1"])
    spanning = found(search.knn_search(table.read(), q, 20, themes=["th_2 x Y"]))
    assert spanning == brute(q, 20, lambda r: r[3][0] == "TH_2")
    assert found(search.knn_search(table.read(), q, 20, themes=[], countries=[])) == brute(q, 20)


def test_overfetch_loses_deep_matches(table):
    q = [0.1] * DIM
    rare = dict(countries=["C3"], themes=["TH_1"])
    exact = found(search.knn_search(table.read(), q, 5, **rare))
    cut = found(search.knn_search(table.read(), q, 5, mode="overfetch", **rare))
    near = brute(q, 10)
    by_id = {r[0]: r for r in rows()}
    assert cut == [i for i in near if by_id[i][7] == ["C3"] and by_id[i][3][0] == "TH_1"][:5]
    assert len(exact) == 5 and len(cut) < 5
    assert found(search.knn_search(table.read(), q, 5, mode="overfetch")) == brute(q, 5)


def requests(spark, n):
    rng = np.random.default_rng(5)
    data = [(f"q{i}", rng.normal(size=DIM).tolist(), 1 + i % 7, "20240201" if i % 2 else None, None,
             [f"C{i % 4}"] if i % 3 == 0 else None, None) for i in range(n)]
    return data, spark.createDataFrame(data, "qid string, vector array<double>, limit int, date_from string, date_to string, "
                                             "countries array<string>, themes array<string>")


@pytest.mark.parametrize("block, cells", [(4096, 500), (7, 500), (4096, 40), (5, 3)])
def test_batch_in_any_number_of_blocks(spark, table, monkeypatch, block, cells):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "CELLS", cells)
    data, df = requests(spark, 30)
    got = {}
    for r in search.knn_batch(table.read(), df).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["gkg_record_id"])
    for qid, v, k, lo, _, cc, _ in data:
        assert got[qid] == brute(v, k, lambda r: (not lo or r[1] >= lo) and (not cc or r[7][0] in cc)), qid


def test_no_requests_no_rows(spark, table):
    _, df = requests(spark, 1)
    assert search.knn_batch(table.read(), df.where("qid = 'none'")).count() == 0


def test_wrong_width_fails(spark, table):
    with pytest.raises(Exception, match="wide"):
        search.knn_search(table.read(), [1.0] * (DIM + 1), 3).collect()
    with pytest.raises(Exception, match="wide"):
        table.append(table.read().drop("year_month").withColumn("vector", F.slice("vector", 1, 3)))


def test_profile(spark, table):
    _, df = requests(spark, 3)
    got = {r["qid"]: r for r in search.distance_profile(table.read(), df).collect()}
    m = np.array([r[12] for r in rows()])
    for r in df.collect():
        d = np.square(m - np.array(r["vector"])).sum(axis=1)
        assert got[r["qid"]]["n_candidates"] == N
        np.testing.assert_allclose([got[r["qid"]][c] for c in ("min_distance", "max_distance", "avg_distance")],
                                   [d.min(), d.max(), d.mean()])


def test_request_checks(spark):
    def req(qid, query="abc", limit=10, lo=None, hi=None):
        return (qid, query, limit, lo, hi, None, None)

    df = spark.createDataFrame([
        req("ok"), req("default", limit=None), req("short", "ab"), req("long", "x" * 1001), req("zero", limit=0),
        req("much", limit=101), req("date", lo="2024-01-01"), req("tail", hi="20240101\n")], REQUEST)
    ok = {r["qid"]: r["limit"] for r in search.valid_requests(df).collect()}
    assert ok == {"ok": 10, "default": 10}
    problems = {r["qid"]: r["problem"] for r in search.rejected_requests(df).collect()}
    assert problems == {"short": "query", "long": "query", "zero": "limit", "much": "limit", "date": "date_from", "tail": "date_to"}


def test_text_search(spark):
    hashing = embed.HashingEmbedder(64)
    words = ["oil price", "oil export ban", "football cup final", "cup of tea"]
    docs = spark.createDataFrame([(f"d{i}", "20240101", w) for i, w in enumerate(words)], "gkg_record_id string, date string, text string")
    store = hashing.embed(docs).withColumns({"themes": F.array(F.lit("T")), "countries": F.array(F.lit("C"))})
    asked = spark.createDataFrame([("a", "oil ban", 2, None, None, None, None), ("b", "oil ban", 1, None, None, None, ["none"]),
                                   ("c", "x", 1, None, None, None, None)], REQUEST)
    got = search.search_text(store, asked, hashing).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["gkg_record_id"]) for r in got] == [("a", "d1"), ("a", "d0")]
    assert got[0]["score"] > got[1]["score"] and got[0]["persons"] == [] and got[0]["source"] == ""


def test_hashing_embedder(spark):
    df = spark.createDataFrame([(1, "a b  a"), (2, ""), (3, None)], "i int, text string")
    got = {r["i"]: r["vector"] for r in embed.embed_texts(df, embed.HashingEmbedder(16)).collect()}
    assert abs(sum(x * x for x in got[1]) - 1) < 1e-6 and set(got[2]) == {0.0} == set(got[3])


def test_model_embedder(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "i int, text string")
    model = embed.ModelEmbedder(lambda: lambda texts: [[len(t), 1.0] for t in texts], 2)
    assert [r["vector"] for r in model.embed(df).orderBy("i").collect()] == [[2.0, 1.0], [0.0, 1.0]]
    with pytest.raises(Exception, match="wide"):
        embed.ModelEmbedder(lambda: lambda texts: [[1.0] for _ in texts], 2).embed(df).collect()


def test_ids_and_statistics(spark, table):
    ids = spark.createDataFrame([(0, "r0001"), (1, "zz"), (2, "r0001"), (3, "r0002")], "position int, gkg_record_id string")
    store = table.read()
    assert [r["position"] for r in vt.existing_ids(ids, store).orderBy("position").collect()] == [0, 2, 3]
    assert [r["position"] for r in vt.new_records(ids, store).collect()] == [1]
    s = vt.vec_stats(store, "here").first()
    assert (s["total_records"], s["min_date"], s["db_path"]) == (N, "20240101", "here")
    none = vt.vec_stats(store.where("false")).first()
    assert (none["total_records"], none["min_date"]) == (0, None)
    assert vt.VectorTable(spark, scratch_path(spark, "no"), DIM).read().count() == 0


def test_delete(spark):
    t = vt.VectorTable(spark, scratch_path(spark, "vectors"), DIM)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vt.VECTOR_COLUMNS)
    t.append(spark.createDataFrame(rows(120) + rows(1), ddl))  # r0000 is there twice
    month = [r[0] for r in rows(120) if r[1].startswith("202405")]
    gone = spark.createDataFrame([(i,) for i in month + ["r0000", "r0000", "absent"]], "gkg_record_id string")
    assert t.delete_by_ids(gone) == len(month) + 2
    left = sorted(r[0] for r in t.scan("gkg_record_id").collect())
    assert left == sorted(r[0] for r in rows(120) if r[0] not in set(month) | {"r0000"})
    assert t.delete_by_ids(gone) == 0


def test_last_record_wins(spark):
    rec = spark.sql("""SELECT id AS line, 'x' AS gkg_record_id, 'd' || id AS document_id, '2024010' || (id % 9) AS date_str,
      CAST(array() AS array<string>) AS themes, CAST(array() AS array<string>) AS persons, CAST(array() AS array<string>) AS organizations,
      transform(sequence(1, 12), i -> named_struct('full_name', IF(i = 2, '', 'L' || i), 'country_code', IF(i > 10, 'ZZ', 'B' || (i % 3))))
        AS locations, CAST(NULL AS struct<tone:double>) AS tone, CAST(NULL AS string) AS source_common_name FROM range(1000)""")
    emb = spark.createDataFrame([("x", [1.0], "h1"), ("x", [2.0], "h2"), ("orphan", [3.0], "h3")],
                                "gkg_record_id string, embedding array<float>, text_hash string")
    got = vt.vec_row_shape(vt.join_embed_records(emb, rec, "line")).collect()
    assert sorted((r["source_url"], r["text_hash"]) for r in got) == [("d999", "h1"), ("d999", "h2")]
    assert len(got[0]["locations"]) == 9 and got[0]["countries"] == ["B0", "B1", "B2"]
    assert got[0]["tone"] == 0.0 and got[0]["source"] == ""


def test_one_scan_for_many_requests_and_filters(spark, table):
    rng = np.random.default_rng(7)
    data = [(f"q{i}", rng.normal(size=DIM).tolist(), 1 + i % 5, f"2024{1 + i % 12:02d}{1 + i % 27:02d}", None,
             [f"C{i % 4}", f"C{(i + 1) % 4}"] if i % 3 else None, [f"th_{i % 5}"] if i % 2 else None) for i in range(300)]
    df = spark.createDataFrame(data, "qid string, vector array<double>, limit int, date_from string, date_to string, "
                                     "countries array<string>, themes array<string>")
    near = search.knn_batch(table.read(), df)
    plan = spark._jvm.PythonSQLUtils.explainString(near._jdf.queryExecution(), "formatted")
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    with_vector = [line for line in schemas if "vector:" in line]
    assert len(with_vector) == 1, schemas
    assert "persons" not in with_vector[0] and "source_url" not in with_vector[0]
    assert len(re.findall(r"^\(\d+\) \w*MapInArrow", plan, re.M)) == 1
    got = {}
    for r in near.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["gkg_record_id"])

    def keep(lo, cc, th):
        return lambda r: (r[1] >= lo and r[1] != "") and (not cc or r[7][0] in cc) and (
            not th or any(t.lower() in " ".join(r[3]).lower() for t in th))

    for qid, v, k, lo, _, cc, th in data:
        assert got.get(qid, []) == brute(v, k, keep(lo, cc, th)), qid


def test_funnel_first_stage_reads_stored_codes_only(spark, table):
    from tidewire.operators import retrieval

    q = np.random.default_rng(11).normal(size=DIM).tolist()
    coded = retrieval.funnel_search(table.read(), q, shortlist=60, limit=5, codes=table.codes(), date_from="20240301")
    plan = spark._jvm.PythonSQLUtils.explainString(coded._jdf.queryExecution(), "formatted")
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert any("bits:" in line and "vector:" not in line for line in schemas), schemas
    assert sum("vector:" in line for line in schemas) == 1
    plain = retrieval.funnel_search(table.read(), q, shortlist=60, limit=5, date_from="20240301")
    assert found(coded) == found(plain)
    assert table.codes().count() == table.read().count()


def test_delete_writes_no_vector_and_compaction_applies_it(spark):
    import glob
    import os

    t = vt.VectorTable(spark, scratch_path(spark, "vectors"), DIM)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vt.VECTOR_COLUMNS)
    t.append(spark.createDataFrame(rows(120), ddl))

    def vector_files():
        return sorted(f for f in glob.glob(f"{t.path}/year_month=*/*.parquet"))

    before = vector_files()
    month = [r[0] for r in rows(120) if r[1].startswith("202405")]
    gone = spark.createDataFrame([(i,) for i in month + ["r0003"]], "gkg_record_id string")
    assert t.delete_by_ids(gone) == len(month) + 1
    assert vector_files() == before
    expected = sorted(r[0] for r in rows(120) if r[0] not in set(month) | {"r0003"})
    assert sorted(r[0] for r in t.scan("gkg_record_id").collect()) == expected
    assert t.codes().count() == len(expected)
    assert t.compact() == len(month) + 1
    assert not os.path.exists(f"{t.path}/year_month=202405") and not os.path.exists(t.deleted_path)
    assert sorted(r[0] for r in t.scan("gkg_record_id").collect()) == expected
    assert t.codes().count() == len(expected)
    # a deleted id may come back
    t.delete_by_ids(spark.createDataFrame([("r0004",)], "gkg_record_id string"))
    t.append(spark.createDataFrame([r for r in rows(120) if r[0] == "r0004"], ddl))
    assert sorted(r[0] for r in t.scan("gkg_record_id").where("gkg_record_id = 'r0004'").collect()) == ["r0004"]


def flaky_model():
    """A model that refuses calls of more than 7 texts and fails its first two calls in each worker."""
    state = {"calls": 0}

    def model(texts):
        state["calls"] += 1
        if len(texts) > 7:
            raise ValueError("too many texts at once")
        if state["calls"] <= 2:
            raise ConnectionError("busy")
        return [[float(len(t)), float(state["calls"] > 2)] for t in texts]

    return model


def test_model_embedder_cuts_calls_and_tries_again(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(40)], "i int, text string").coalesce(1)
    got = embed.ModelEmbedder(flaky_model, 2, batch_size=7, tries=3, backoff=0.01).embed(df).orderBy("i").collect()
    assert [r["vector"] for r in got] == [[float(i), 1.0] for i in range(40)]
    with pytest.raises(Exception, match="busy"):
        embed.ModelEmbedder(flaky_model, 2, batch_size=7, tries=2, backoff=0.01).embed(df).collect()
