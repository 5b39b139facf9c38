"""Personal data and secrets: base patterns against plain regular expressions, models on held-out rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.common import edge_rows, same, table
from tidewire.llm import arrays as A
from tidewire.llm import pii, secret_scan, spans


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_pii(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def plain_secrets(text):
    words = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def base(found, kinds):
    return [(s["start"], kinds.index(s["kind"]), s["end"]) for s in found if s["base"]]


CARD = "4111111111111111"
PII_PARTS = ["a", "1", ".", "@", "-", "+", " ", "(", ")", "_", "%", "0947", "é", "\n", ",", CARD, "4111 1111-1111 1111", "+1 (743) 555-3824", "8.8.8.8", "x.y@m-1.com"]
SECRET_PARTS = ["token", "TOKEN", "api", "_key", "key", "ſecret", "secret", "passwd", "password", "=", ":", " ", "'", '"', "abc", "0123456789abcdef",
                "AKIA", "ABCDEF012345", "é", "\n", ".", "abcdefabcdefabcdef"]


@pytest.fixture(scope="module")
def crf(spark, small):
    return pii.train(pii.labelled_table(spark.read.parquet(f"{small}/documents.parquet")))


@pytest.fixture(scope="module")
def network(spark, small):
    return secret_scan.train(secret_scan.labelled_table(spark.read.parquet(f"{small}/documents.parquet")))


def test_base_patterns_of_personal_data(crf):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PII_PARTS) for _ in range(rng.randint(0, 30))) for _ in range(6000)]
    texts += [t or "" for _, t in edge_rows()] + ["1" * 50_000, "1." * 20_000, "a" * 50_000 + "@b.c", "+1 " * 20_000]
    for text, found in zip(texts, pii.find(pa.array(texts), crf).to_pylist()):
        assert base(found, pii.KINDS) == plain_pii(text), text[:80]
        taken = {i for s in found if s["base"] for i in range(s["start"], s["end"])}
        assert not any(taken & set(range(s["start"], s["end"])) for s in found if not s["base"])


def entities(tags):
    out, i = set(), 0
    while i < len(tags):
        j = i + 1
        if tags[i][0] == "B":
            while j < len(tags) and tags[j] == "I-" + tags[i][2:]:
                j += 1
            out.add((i, j, tags[i][2:]))
        i = j
    return out


def test_crf_on_rows_kept_apart(spark, small, crf):
    rows = pii.labelled_table(spark.read.parquet(f"{small}/documents.parquet"), rows=300, seed=99)
    tags = crf.decode([pii.feature_ids([w.encode() for w in words]) for words, _ in rows])
    right = mine = gold = 0
    for (_, expected), got in zip(rows, tags):
        e, g = entities(expected), entities([pii.TAGS[t] for t in got])
        right, mine, gold = right + len(e & g), mine + len(g), gold + len(e)
    assert right / mine > 0.9 and right / gold > 0.85


def placed(words, tags):
    """(kind, start, end) of the labelled entities in the words joined by spaces."""
    text, out = " ".join(words), set()
    for i, j, kind in entities(tags):
        lo = len(" ".join(words[:i])) + (i > 0)
        hi, edge = len(" ".join(words[:j])), pii.EDGE.decode()
        out.add((kind, hi - len(text[lo:hi].lstrip(edge)), lo + len(text[lo:hi].rstrip(edge))))
    return out


def test_spelled_out_addresses_are_found_in_texts(crf):
    forms = ["info[at]post.org", "j.doe[at]example.org", "ann (at) example (dot) com", "info [at] post [dot] net", "info [AT] post [DOT] net"]
    texts = [f"please write to {f} or come by the office in town" for f in forms]
    got = pii.find(pa.array(texts), crf).to_pylist()
    assert [[t[s["start"] : s["end"]] for s in f] for t, f in zip(texts, got)] == [[f] for f in forms]
    # half of a form at the end of one text and half in the next is none
    assert not pii.spelled(*(np.array(x) for x in (np.frombuffer(b"(at)", np.uint8), [0, 2], [2, 4]))).any()


def test_recall_through_find(spark, small, crf):
    """Whole texts, as they are searched: base spans or the CRF's, at the exact place."""
    rows = pii.labelled_table(spark.read.parquet(f"{small}/documents.parquet"), rows=300, seed=99)
    found = pii.find(pa.array([" ".join(w) for w, _ in rows]), crf).to_pylist()
    right = gold = 0
    for (words, tags), f in zip(rows, found):
        expected = placed(words, tags)
        right, gold = right + len(expected & {(s["kind"], s["start"], s["end"]) for s in f}), gold + len(expected)
    print(f"recall through find(): {right} of {gold}")
    assert right / gold > 0.85


def test_viterbi_is_the_best_path(crf):
    rng = np.random.default_rng(0)
    small_crf = pii.Crf(rng.normal(size=(pii.FEATURES, len(pii.TAGS))).astype(np.float32), rng.normal(size=(len(pii.TAGS),) * 2).astype(np.float32))
    sentence = [rng.choice(pii.FEATURES, 4, replace=False) for _ in range(4)]
    emit = small_crf.emissions(sentence)
    n = len(pii.TAGS)
    best = max(((emit[0, a] + small_crf.moves[a, b] + emit[1, b] + small_crf.moves[b, c] + emit[2, c] + small_crf.moves[c, d] + emit[3, d]), (a, b, c, d))
               for a in range(n) for b in range(n) for c in range(n) for d in range(n))
    assert tuple(small_crf.decode([sentence, sentence[:1]])[0]) == best[1]


def test_crf_adds_what_patterns_miss_and_leaves_clean_text(crf):
    texts = ["please call (743) 555-3824 today or write", "two cards 4111111111111111 5500005555555559 in a row",
             "In 2024 we sold 1,234 units of version 2.0.1 for $19.99 on 2024-05-01 at 10:30 of 16 kinds, order #482131.",
             "The year was 1999 and the number 1234567890123456 is no card."]
    found = pii.find(pa.array(texts), crf).to_pylist()
    assert [s["kind"] for s in found[1]] == ["card", "card"]
    assert found[2] == [] and found[3] == []


def test_base_patterns_of_secrets(network):
    rng = random.Random(1)
    texts = ["".join(rng.choice(SECRET_PARTS) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    texts += [t or "" for _, t in edge_rows()] + ["token" + " " * 20_000 + "=abcdefgh", "abcdef0123" * 5_000]
    data, bounds = A.byte_view(pa.array(texts))
    found = spans.to_arrow(secret_scan.locate(data, bounds, network), secret_scan.KINDS, data, bounds).to_pylist()
    for text, f in zip(texts, found):
        assert base(f, secret_scan.KINDS) == plain_secrets(text), text[:80]


def test_network_on_findings_kept_apart(spark, small, network):
    rows = secret_scan.labelled_table(spark.read.parquet(f"{small}/documents.parquet"), rows=600, seed=99)
    score = network.scores([secret_scan.encode(*r[:3]) for r in rows])
    said, true = score >= network.threshold, np.array([r[3] for r in rows]) > 0
    assert (said & true).sum() / said.sum() > 0.95 and (said & true).sum() / true.sum() > 0.93
    # calibrated: the mean score is near the rate of secrets
    assert abs(score.mean() - true.mean()) < 0.05


def test_scores_do_not_depend_on_the_batch(network):
    rng = random.Random(2)
    texts = [secret_scan.encode(b"key = ", secret_scan.secret(rng).encode() * rng.randint(1, 9), b" end") for _ in range(40)]
    alone = [network.scores([t])[0] for t in texts]
    assert np.allclose(network.scores(texts), alone)


def test_awkward_rows(spark, crf, network):
    secret = 'x token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" é'
    rows = edge_rows() + [(30, "é mail a.b@c.de, +1 (743) 555-3824!"), (31, secret), (31, secret)]
    docs = table(spark, rows)
    for found, kinds, plain in ((pii.detect(docs, crf), pii.KINDS, plain_pii), (secret_scan.scan(docs, network), secret_scan.KINDS, plain_secrets)):
        same([(r.doc_id, tuple(base([s.asDict() for s in r.spans], kinds))) for r in found.collect()], [(i, tuple(plain(t or ""))) for i, t in rows])
    assert pii.detect(table(spark, []), crf).collect() == [] and secret_scan.scan(table(spark, []), network).collect() == []
    masked = secret_scan.redact(docs, network)
    assert masked.columns == docs.columns
    got = {r.doc_id: r for r in masked.collect() if r.doc_id in (1, 30, 31)}
    assert got[31].text == "x [SECRET]\" é" and got[31].n_chars == len(got[31].text) and got[1].text is None and got[30].text == rows[-3][1]
