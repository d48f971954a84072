import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_brute import SF, rows

from tabrisk.llm import importance
from tabrisk.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def runs(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, target, rate=25, least=20):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(runs(x)[1])
    for x in target:
        t.update(runs(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + 10_000) / ((s[b] + 1) * (nt + 10_000))))
    out = []
    for i, x in docs:
        n, f = runs(x)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    eligible = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(eligible[: rate * len(eligible) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_crc_matrices_equal_zlib():
    rng = np.random.default_rng(0)
    buffer = rng.integers(0, 256, 60_000).astype(np.uint8)
    length = np.r_[np.arange(40), rng.integers(0, 30, 500), [importance.LONG, importance.LONG + 1, 2 * importance.LONG, 9_999]]
    starts = rng.integers(0, 50_000, len(length))
    got = importance.crc32s(buffer, starts, starts + length)
    assert got.tolist() == [zlib.crc32(buffer[s : s + n].tobytes()) for s, n in zip(starts, length)]


@pytest.mark.parametrize("block", [1 << 22, 500, 9])
def test_blocks_and_caches_do_not_matter(block, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", block)
    monkeypatch.setattr(importance, "CACHE_WORDS", 50)
    texts = [t for (t,) in rows(SF, "SELECT text FROM documents")] + ["x" * 5000 + " y", "", None, "Éa1_b"]
    hasher, got = importance._Hasher(10_000), [Counter() for _ in texts]
    for b in importance._blocks(importance._plain([None if t is None else t.encode() for t in texts])):
        for d, k in zip(*(a.tolist() for a in hasher.features(*b))):
            got[d][k] += 1
    assert got == [Counter(runs(t)[1]) for t in texts]


DOCS = [(1, None), (2, ""), (3, "...!"), (4, "One two TWO"), (4, "One two TWO"), (5, "straße 漢字 漢字 x " * 9), (None, "no id " * 12), (None, None), (6, "b" * 40_000 + " c " * 30), (7, "a b " * 40_000), (7, "a b " * 11), (8, "x-y_z " * 30), (9, "p q r " * 8), (9, "p q r " * 8)]


@pytest.mark.parametrize("rate", [25, 100, 0])
def test_edges(spark, rate):
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in DOCS], "doc_id long, text string, weight long, id string")
    target = ["p q r", None, "漢字 漢字"]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = sorted((tuple(r) for r in importance.resample(df, t, rate=rate).collect()), key=str)
    assert got == brute(DOCS, target, rate)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert importance.resample(none, some).collect() == []
    assert sorted((tuple(r) for r in importance.resample(some, none).collect()), key=str) == brute(DOCS, [])


def test_query_equals_brute_force(spark):
    got = sorted((tuple(r) for r in QUERIES["op13_importance_resampling"](spark, SF).collect()), key=str)
    assert got == brute(rows(SF, "SELECT doc_id, text FROM documents"), [t for (t,) in rows(SF, "SELECT text FROM benchmark")])
