import itertools

import numpy as np
import pytest
from llm_brute import SF, SF1, crc, rows

from tabrisk.llm import langid
from tabrisk.llm.queries import QUERIES

DOC = "doc_id long, text string, lang string"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(5)
    k, lengths = 3, np.array([5, 3, 1])
    e, trans, start = rng.normal(size=(9, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    g, pairs = langid.forward_backward(e, lengths, trans, start, pairs=True)
    at, total = 0, np.zeros((k, k))
    for n in lengths:
        p, want, both = 0.0, np.zeros((n, k)), np.zeros((k, k))
        for y in itertools.product(range(k), repeat=int(n)):
            s = np.exp(start[y[0]] + sum(e[at + t, y[t]] for t in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            p += s
            for t in range(n):
                want[t, y[t]] += s
            for a, b in zip(y, y[1:]):
                both[a, b] += s
        np.testing.assert_allclose(g[at : at + n], want / p, rtol=1e-9)
        total += both / p
        at += n
    np.testing.assert_allclose(pairs, total, rtol=1e-9)


def test_query_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op10_language_crf"](spark, SF1).collect()}
    docs = rows(SF1, "select doc_id, lang from documents")
    assert len(got) == len(docs) and all(r.held_out == (crc(i) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 for r in got.values())
    held = [(got[i].lang_pred, lang) for i, lang in docs if crc(i) % 4 == 2]
    assert sum(a == b for a, b in held) / len(held) >= 0.98


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_code_switched_words_are_labelled_apart(model):
    text = {x: langid.words_of(t) for x, t in rows(SF1, "select lang, max(text) from documents where n_chars between 800 and 3000 group by lang")}
    words = text["en"][:40] + text["de"][:40]
    g = langid.forward_backward(model.emissions(words), np.array([80]), model.trans, model.start)
    labels = [model.labels[i] for i in g.argmax(1)]
    assert labels[:38].count("en") >= 36 and labels[42:].count("de") >= 36


def test_edge_rows(spark, model):
    de = rows(SF, "select text from documents where lang = 'de' order by doc_id limit 1")[0][0]
    docs = [(1, None, "en"), (2, "", "en"), (3, "123 ²³ _ !? 😀", None), (4, de, None), (4, de, None), (None, de, "en"), (6, (de + " ") * 400, "x"), (7, "a" * 30_000, "en"), (8, "Z", "de")]
    df = spark.createDataFrame(docs, DOC).selectExpr("*", "1 as score", "true as held_out", "2 as h", "3 as r")
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(df, model, ["doc_id"]).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "de"), (None, "de"), (6, "de")} <= got and len(got) == 8
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns
    assert not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], DOC)
    assert langid.identify(empty).count() == 0
    got = langid.identify(spark.createDataFrame([(1, "some text", None), (2, None, "en")], DOC)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


def test_sample_counts_texts_that_are_there(spark):
    """A language whose texts are nearly all null, one with few texts, one with many, and a row that is repeated very often."""
    rows = [(i, f"un texte {i}" if i % 100 == 0 else None, "fr") for i in range(90_000)]
    rows += [(100_000 + i, f"ein Text {i}", "de") for i in range(20_000)] + [(200_000 + i, f"a text {i}", "en") for i in range(40)]
    rows += [(300_000, "ein Text", "de")] * 30_000 + [(400_000 + i, f"testo {i}", None) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r.lang, r.text) for r in langid.sample(df, "text", "lang", "doc_id").collect()]
    assert len(got) == len(set(got))
    assert {x: sum(lang == x for lang, _ in got) for x in ("fr", "de", "en")} == {"fr": 300, "de": 300, "en": 40}
    # the smallest by hash of all distinct rows, whatever the partitions
    every = df.where("lang = 'de'").distinct().selectExpr("text", "shiftrightunsigned(xxhash64(doc_id, text), 11) as k").orderBy("k").limit(300)
    assert {t for lang, t in got if lang == "de"} == {r.text for r in every.collect()}


def test_repeated_rows_clashing_columns_and_ties(spark):
    base = [(i, f"der hund und die katze nummer {i}", "de") for i in range(40)] + [(100 + i, f"the dog and the cat number {i}", "en") for i in range(40)]
    rows = base + base[:5] * 3 + [(None, "the dog", "en"), (500, None, "de"), (501, "", "en"), (502, "the hund", None)]
    df = spark.createDataFrame([(*r, "x", 0.5, 1) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double, h long")
    got = langid.identify(df)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == len(rows)
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, set()).add((r.lang_pred, round(r.score, 12)))
    assert all(len(v) == 1 for v in by_id.values())
    assert by_id[500] == by_id[501] == {("und", 0.0)}
    assert {next(iter(by_id[i]))[0] for i in range(40)} == {"de"} and {next(iter(by_id[100 + i]))[0] for i in range(40)} == {"en"}
    # equal shares: the smallest label
    k = langid.Model(["a", "b"], {}, np.zeros((1, 2)), np.zeros((2, 2)), np.zeros(2))
    assert [r.lang_pred for r in langid.predict(spark.createDataFrame([(1, "word")], "doc_id long, text string"), k, ["doc_id"]).collect()] == ["a"]
