import random

import numpy as np
import xxhash
from llm_brute import SF, SF1, closure, rows

from tabrisk.llm import simhash
from tabrisk.llm.queries import QUERIES

DOC = "doc_id long, text string"


def fingerprint(text) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(docs, bits=4):
    fp = [fingerprint(t) for _, t in docs]
    n = range(len(docs))
    top = closure(n, [(i, j) for i in n for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= bits])
    low = {}
    for i in n:
        if docs[i][0] is not None:
            low[top[i]] = min(low.get(top[i], docs[i][0]), docs[i][0])
    return sorted(((docs[i][0], f"{fp[i]:016x}", low.get(top[i])) for i in n), key=str)


def test_query_equals_brute_force(spark):
    got = QUERIES["op6_simhash_golay"](spark, SF1)
    assert got.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows(SF1, "select doc_id, text from documents"))


def test_all_pairs_within_four_bits_share_a_key_and_small_tiles_agree(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << bit
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    want = closure(values, [(a, b) for i, a in enumerate(values) for b in values[:i] if bin(a ^ b).count("1") <= 4])
    for tile in (8192, 4):
        links = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in simhash.links(df, tile=tile).collect()]
        assert all(bin(a ^ b).count("1") <= 4 for a, b in links)
        assert closure(values, links) == want


def test_every_pair_of_words_two_bits_apart_shares_a_golay_key():
    tab, n = simhash._golay_table()
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 23, 4000)
    for k in (0, 1, 2):
        v = w.copy()
        for i in range(len(v)):
            for bit in rng.choice(23, k, replace=False):
                v[i] ^= 1 << bit
        (a, oa), (b, ob) = simhash.segment_keys(w, tab, n), simhash.segment_keys(v, tab, n)
        assert all(set(x[p]) & set(y[q]) for x, p, y, q in zip(a, oa, b, ob))


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = [(5, None), (3, ""), (9, " \t\n"), (7, "one"), (8, "ONE"), (1, "a b c"), (None, "a b c"), (4, "x y z w v u"), (4, "x y z w v u"), (None, "only here, with no id"), (20, long), (21, long + " tail")]
    df = spark.createDataFrame(docs, DOC).selectExpr("doc_id", "text", "7 as fp", "'x' as component_id", "1 as _id")
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)
    assert got == brute(docs)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([3, 7, 1, 4, 20, None], key=str)
    empty = spark.createDataFrame([], DOC)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def test_drop_keeps_one_document_of_each_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r[2] for r in brute(rows(SF, "select doc_id, text from documents"))}
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect()) == sorted(want)
