import random

import numpy as np

from llm_brute import crc, rows

from tabrisk.llm import toxicity
from tabrisk.llm.queries import QUERIES

SF2 = "/root/testdata/sf0.1"
DOC, LABEL = "doc_id long, text string", "doc_id long, toxic int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_automaton_and_trie_find_the_terms_that_brute_force_finds():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    terms = {word(rng.randint(3, 12)): rng.random() for _ in range(60)}
    lexicon = toxicity.Lexicon(terms)
    for _ in range(3000):
        w = list(rng.choice(list(terms)))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "x"])
        w = "".join(w)
        near = [(d, -x) for t, x in terms.items() if (d := distance(w, t)) <= toxicity.limit_of(t)]
        want = (-min(near)[1], min(near)[0]) if near else None
        assert lexicon.match(w) == want, w


def test_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op5_toxicity_lexicon"](spark, SF2).collect()}
    assert all(r.held_out == (crc(i) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(got[i].predicted, y) for i, y in rows(SF2, "select doc_id, toxic from labels") if crc(i) % 3 == 1]
    tp = sum(p and y for p, y in held)
    assert tp / sum(y for _, y in held) >= 0.85 and tp / sum(p for p, _ in held) >= 0.97


def training():
    docs, labels = [], []
    filler = "the house stands by a river and its garden is green in spring"
    for i in range(300):
        kind = i % 3
        docs.append((i, [filler, f"{filler} you dreadful blockhead {filler}", f'he wrote "dreadful blockhead" {filler}'][kind]))
        labels.append((i, int(kind == 1)))
    return docs, labels


def test_misspelled_abuse_scores_high_and_quotation_low(spark):
    docs, labels = training()
    new = ["you dreadfull blokhead", 'she said "dreadfull blokhead" to them', None, "", "123 !?", "green garden " * 40_000, "you dreadful blockhead"]
    ids = range(1000, 1000 + len(new))
    df = spark.createDataFrame([*docs, *zip(ids, new), (None, new[-1]), (1000, new[0])], DOC).selectExpr("*", "1 as score", "'l' as label", "2 as exact")
    lab = spark.createDataFrame([*labels, (1, None), (99999, 1), (None, 1), (2, 7)], LABEL).selectExpr("*", "1 as text")
    out = toxicity.score(df, lab).collect()
    assert len(out) == len(docs) + len(new) + 2
    got = {r.doc_id: r.score for r in out}
    assert got[1000] > 0.7 and got[1006] > 0.7 and got[None] > 0.7
    assert max(got[k] for k in (1001, 1002, 1003, 1004, 1005)) < 0.3


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOC)
    assert {r.score for r in toxicity.score(docs, spark.createDataFrame([], LABEL)).collect()} == {0.0}
    assert {r.score for r in toxicity.score(docs, spark.createDataFrame([(1, 1), (2, 1)], LABEL)).collect()} <= {0.0, 1.0}
    assert toxicity.score(spark.createDataFrame([], DOC), spark.createDataFrame([(1, 1)], LABEL)).count() == 0


def swap_distance(a, b):
    """Edits of ``a`` to ``b``, a swap of adjacent letters being one; no letter is edited twice."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def allowed(term):
    return 0 if len(term) < 4 else 1 if len(term) < 10 else 2


def test_two_edits_of_long_terms_and_swapped_letters_are_found():
    lexicon = toxicity.Lexicon({"disgusting": 3.0, "idiot": 2.0, "stupid": 2.5, "ass": 1.0}, swaps=True)
    want = {"disgusitng": (3.0, 1), "disgvstjng": (3.0, 2), "idsgustign": (3.0, 2), "disgstng": (3.0, 2), "idoit": (2.0, 1), "stpuid": (2.5, 1), "diiot": (2.0, 1), "sas": None, "idito": (2.0, 1), "isgvstjng": None}
    assert {w: lexicon.match(w) for w in want} == want
    assert toxicity.MIN_LOG_ODDS == 2.0 and [toxicity.limit_of("x" * n) for n in (3, 4, 9, 10, 30)] == [0, 1, 1, 2, 2]


def test_swaps_and_edits_equal_brute_force():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    terms = {word(rng.randint(3, 14)): rng.random() for _ in range(60)}
    lexicon, found = toxicity.Lexicon(terms, swaps=True), 0
    for _ in range(6000):
        w = list(rng.choice(list(terms)))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w))
            if rng.random() < 0.5:
                w[k : k + 2] = w[k : k + 2][::-1]
            else:
                w[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "x"])
            w = w or ["a"]
        w = "".join(w)
        near = [(d, -x) for t, x in terms.items() if (d := swap_distance(w, t)) <= allowed(t)]
        want = (-min(near)[1], min(near)[0]) if near else None
        found += want is not None and want[1] == 2
        assert lexicon.match(w) == want, w
        assert lexicon.match(w, filtered=False) == want, w  # the whole trie walked
    assert found > 300


def brute_features(text, lexicon):
    """The features by their definition: every window, every word matched by plain edit distance."""
    text = text.lower()
    spans = [m.span() for m in toxicity.WORD.finditer(text)]
    words = [text[a:b] for a, b in spans]

    def distance(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1] and a[i - 1] != a[i - 2]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    def best(w):
        near = [(distance(w, t), -x) for t, x in lexicon.items()]
        near = [(e, x) for (e, x), t in zip(near, lexicon) if e <= toxicity.limit_of(t)]
        return min(near, default=None)

    hits = []
    for k, w in enumerate(words):
        if (b := best(w)) is not None:
            a, z = spans[k]
            line_a, line_z = text.rfind("\n", 0, a) + 1, text.find("\n", z)
            line_z = len(text) if line_z < 0 else line_z
            quotes = toxicity.QUOTES
            hits.append((k, w, -b[1], b[0], len(quotes.findall(text[line_a:a])) % 2 == 1 and quotes.search(text[z:line_z]) is not None))
    first = {}
    for h in hits:
        first.setdefault((h[1], h[4]), h)
    level = lambda x: x / (1 + x / 12)
    exact = sum(h[2] for h in first.values() if not h[4] and not h[3])
    fuzzy = sum(h[2] / (1 + h[3]) for h in first.values() if not h[4] and h[3])
    quote = sum(h[2] for h in first.values() if h[4])
    peak = 0.0
    for h in hits:
        if not h[4]:
            inside = {g[1]: g[2] / (1 + g[3]) for g in hits if not g[4] and 0 <= h[0] - g[0] < toxicity.WINDOW}
            peak = max(peak, sum(inside.values()))
    return [level(x) for x in (exact, fuzzy, quote, peak)]


def test_features_equal_brute_force():
    weights = {"idiot": 3.0, "stupid": 2.5, "disgusting": 4.0, "vile": 2.0, "rat": 2.2, "worthless": 3.5}
    lexicon = toxicity.Lexicon(weights, swaps=True)
    rng = np.random.default_rng(4)
    terms = list(weights) + ["idoit", "stpuid", "disgvstjng", "wrthless", "vlie", "rats", "idiotic"]
    texts = []
    for _ in range(300):
        w = [str(rng.choice(terms)) if rng.random() < 0.2 else f"w{chr(97 + rng.integers(26))}" for _ in range(rng.integers(0, 60))]
        texts.append("".join(x + str(rng.choice([" ", " ", " ", '"', "\n", " \u201c", "\u201d "])) for x in w))
    # scattered first, dense later: the dense passage counts
    far = " ".join(["idiot", *["so"] * 30, "stupid", *["so"] * 30])
    texts += [far, far + " idiot stupid", "idiot stupid", "idiot " * 30, '"idiot" idiot', ""]
    for t in texts:
        low = t.lower()
        words = toxicity.WORD.findall(low)
        got = toxicity.context_features(low, words, [(i, *m) for i, w in enumerate(words) if (m := lexicon.match(w))])
        assert np.allclose(got, brute_features(t, weights)), t
    peak = lambda t: brute_features(t, weights)[3]
    assert peak(far + " idiot stupid") == peak("idiot stupid") > peak(far)
