import itertools
import re

from llm_brute import SF1, rows

from tabrisk.llm import decontam
from tabrisk.llm.queries import QUERIES

DOC = "doc_id long, text string"
ITEM = "item_id long, text string"


def words(t):
    return re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else " ", (t or "").lower()).encode().split()


def share(text, item):
    """The best share of equal words in a window along any diagonal."""
    w, best = min(13, len(item)), 0
    if not item:
        return 0
    for shift in range(-len(item) + 1, len(text)):
        same = [0 <= i + shift < len(text) and item[i] == text[i + shift] for i in range(len(item))]
        best = max([best, *(sum(same[k : k + w]) / w for k in range(len(item) - w + 1))])
    return best


def test_query_equals_brute_force(spark):
    got = {r.doc_id: (r.n_items, r.item_ids) for r in QUERIES["op7_spaced_seed_decontamination"](spark, SF1).collect()}
    items = [(i, words(t)) for i, t in rows(SF1, "select item_id, text from benchmark")]
    grams = {}
    for i, w in items:
        for k in range(len(w)):
            grams.setdefault(w[k], set()).add(i)
    want = {}
    for d, t in rows(SF1, "select doc_id, text from documents where doc_id % 4 = 0"):
        w = words(t)
        held = {}
        for x in set(w):
            for i in grams.get(x, ()):
                held[i] = held.get(i, 0) + 1
        found = [i for i, x in items if held.get(i, 0) >= 0.8 * min(13, len(set(x))) - 3 and share(w, x) >= 0.8]
        if found:
            want[d] = (len(found), sorted(found))
    assert want and {d: v for d, v in got.items() if d % 4 == 0} == want


def test_substitutions_edges_and_clashing_names(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"
    w = item.split()
    swapped = " ".join("other" if i in (3, 9) else x for i, x in enumerate(w))
    half = " ".join("other" if i % 2 else x for i, x in enumerate(w))
    long = "filler " * 50_000
    docs = [(1, f"so: {item.upper()}!"), (2, swapped), (3, half), (4, None), (5, ""), (6, " ".join(w[:9])), (7, " ".join(w[2:15])), (7, " ".join(w[2:15])), (None, item), (8, long + swapped + " " + long), (9, "one two three four"), (10, "one two three four five six")]
    items = [(0, item), (1, None), (2, "one two three four"), (3, "five six seven eight nine"), (None, "one two three four five six"), (4, item), (5, item + " sigma tau upsilon phi chi psi omega")]
    df = spark.createDataFrame(docs, DOC).selectExpr("doc_id", "text", "1 as uid", "2 as item", "'x' as words", "0 as share")
    got = {r.doc_id: r.item_ids for r in decontam.contaminated(df, spark.createDataFrame(items, ITEM)).collect()}
    assert got == {1: [0, 4, 5], 2: [0, 4, 5], 7: [0, 4, 5], None: [0, 4, 5], 8: [0, 4, 5], 9: [2], 10: [2]}
    left = decontam.drop_contaminated(df, spark.createDataFrame(items, ITEM))
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], DOC), spark.createDataFrame([], ITEM)
    assert decontam.contaminated(docs, items).count() == 0
    assert decontam.drop_contaminated(docs, items).count() == 1
    assert decontam.contaminated(spark.createDataFrame([], DOC), spark.createDataFrame([(1, "a b c d e f")], ITEM)).count() == 0


def test_masks_cover_every_pattern_of_their_length():
    for n in range(1, 40):
        w = min(n, 13)
        differ = max(k for k in range(w + 1) if (w - k) / w >= 0.8)
        masks = decontam.masks_of(n)
        for p in itertools.combinations(range(w), differ):
            assert any(not {q + x for x in m} & set(p) for m in masks for q in range(w - m[-1])), (n, p)
    assert decontam.masks_of(13) == decontam.masks_of(200) == decontam.MASKS  # long items have the same masks as before
    assert decontam.masks_of(0) == ()


def test_short_items_with_replaced_words(spark):
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in range(1, 13)]
    docs, want = [], {}
    for n, text in items:
        w = text.split()
        differ = max(k for k in range(n + 1) if (n - k) / n >= 0.8)
        for k in range(differ + 2):
            for p in itertools.combinations(range(n), k):
                d = len(docs)
                docs.append((d, "so " + " ".join("other" if i in p else x for i, x in enumerate(w)) + " then"))
                if k <= differ:
                    want[d] = [n]
    got = {r.doc_id: r.item_ids for r in decontam.contaminated(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert got == want


def test_a_hash_that_every_text_and_item_holds(spark, monkeypatch):
    """A template line in all items and texts: the same overlaps with the items' hashes sent out and with salted keys."""
    line = "question answer the following with one of the given choices"
    items = [(i, f"{line} item{i} " + " ".join(f"i{i}w{k}" for k in range(12))) for i in range(30)]
    docs = [(d, f"{line} " + " ".join(f"d{d}w{k}" for k in range(20)) + (" " + items[d % 30][1] if d % 10 == 0 else "")) for d in range(200)]
    df, it = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)
    want = {d: [d % 30] for d in range(0, 200, 10)}
    for limit in (300_000, 0):
        monkeypatch.setattr(decontam, "BROADCAST_SEEDS", limit)
        assert {r.doc_id: r.item_ids for r in decontam.contaminated(df, it).collect()} == want
