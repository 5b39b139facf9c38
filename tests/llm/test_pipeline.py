"""The pipeline, stage by stage, against brute force on its own input, and the driver contract."""

import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tests.conftest import ROOT
from tests.llm.common import edge_rows, prose, same, table
from tests.llm.test_exact import brute as equal_texts
from tests.llm.test_quality import brute as measured
from tests.llm.test_repeats import brute_classes
from tidewire.llm import secret_scan
from tidewire.llm.queries import TOKENIZER


def survivors(rows):
    """(id, text) that quality rules, exact and near deduplication keep, in that order."""
    kept = [r for r in rows if measured(r[1])[6]]
    first = defaultdict(list)
    for i, text in kept:
        first[i].append(text)
    stay = [r[0] for r in equal_texts(kept) if r[3]]
    kept = [(i, first[i][0]) for i in stay]
    placed = brute_classes(kept, 5, 80)
    return [r for r, (i, _, c) in zip(kept, placed) if i == c]


def test_stages_on_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = survivors(rows)
    data, outs = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        data = stage(spark, data, small)
        assert data.columns == docs.columns, name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        data.write.mode("overwrite").parquet(path)
        data = spark.read.parquet(path)
        outs.append(data)
    same([(r.doc_id, r.text) for r in outs[2].collect()], expected)
    masked = {r.doc_id: r.text for r in outs[3].collect()}
    assert set(masked) == {i for i, _ in expected}
    for i, text in expected:
        if not any(secret_scan.ASSIGN.search(text.encode()) or len(w) >= 20 for w in text.split()):
            assert masked[i] == text
        assert not any(len(m[2]) >= 8 and m[2] != b"SECRET" for m in secret_scan.ASSIGN.finditer(masked[i].encode()))
    library = Tokenizer.from_file(TOKENIZER)
    ids = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in masked.items()}
    places, seen = defaultdict(list), defaultdict(int)
    for r in corpus_pipeline.run(spark, small).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        places[r.sequence_id].append((r.offset, r.length))
        seen[r.doc_id] += r.length
    assert dict(seen) == {i: len(x) for i, x in ids.items()}
    for parts in places.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(x[1] for x in parts[:k]) for k in range(len(parts))] and sum(p[1] for p in parts) <= 2048


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_every_stage_takes_awkward_and_empty_tables(spark, small, name, stage):
    rng = __import__("random").Random(1)
    rows = edge_rows() + [(40 + i, prose(rng, 70)) for i in range(4)]
    for given in (rows, []):
        docs = table(spark, given)
        out = stage(spark, docs, small)
        count = out.count()
        assert count <= len(given) or name == "pack"
        if name != "pack":
            assert out.columns == docs.columns


def test_contract():
    known, sql = contract.queries(), contract.oracle_sql()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in known if k.startswith("op")}
    assert "pipeline" in known and set(sql) <= set(known)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mask_secrets", "pack"]


def test_the_rest_stands_without_these_operators():
    """Nothing else imports the subpackage, and the entry point does without it."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tidewire.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert 'knn_batch' in names and not any(n.startswith('op1_') or n == 'pipeline' for n in names)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_other_missing_modules_are_not_forgiven():
    """Only the subpackage's absence is passed over; a missing module it needs fails the import."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'public_tokenizers': raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, timeout=120, capture_output=True, text=True)
    assert done.returncode != 0 and "public_tokenizers" in done.stderr
