import hashlib
import re

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import tiktoken
from llm_brute import SF, rows
from test_decontam import share, words
from test_pii import luhn
from test_simhash import brute as simhash_groups

from tabrisk.llm import bpe, langid, pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    kept = rows(SF, "select doc_id, text from documents")
    assert len(model.labels) == 4
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path(bpe.VOCABULARY)), special_tokens={})
    items = [words(t) for _, t in rows(SF, "select item_id, text from benchmark")]
    out = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "language_id":
            kept = [(i, t) for i, t in kept if langid.words_of(t or "")]
        elif name == "simhash_near_dedup":
            top = {g for _, _, g in simhash_groups(kept)}
            kept = [(i, t) for i, t in kept if i in top]
        elif name == "benchmark_decontamination":
            seen = [set(x) for x in items]
            kept = [(i, t) for i, t in kept if not any(len(s & set(words(t))) >= 0.5 * min(13, len(s)) and share(words(t), x) >= 0.8 for s, x in zip(seen, items))]
        elif name == "pii_pseudonyms":
            new = {r.doc_id: r.text for r in out.collect()}
            found = {i: [m for m in re.findall(r"[\w.+-]+@[\w-]+\.[\w.-]*\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b", t) if not m.isdigit() or luhn(m)] for i, t in kept}
            assert any(found.values()) and not any(m in new[i] for i, ms in found.items() for m in ms)
            kept = [(i, new[i]) for i, _ in kept]
        if name != "byte_bpe":
            assert out.columns == COLUMNS
            assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(kept), name
            docs = out
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got) == sorted(i for i, _ in kept)
    for i, t in kept:
        ids = np.array(enc.encode_ordinary(t), "<u4").tobytes()
        assert bytes(got[i].ids) == ids and got[i].ids_sha256 == hashlib.sha256(ids).hexdigest()


def test_run_handles_odd_rows_and_clashing_names(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Some words of a text in here.", "en", "s", 9), (3, "Some words of a text in here.", "en", "s", 9), (None, "Write to a.b@c.org now please, all of you.", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 as fp", "'x' as uid", "2 as score", "'y' as ids")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted((r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()), key=str) == [3, None]


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_pii_keeps_what_has_no_personal_data(spark):
    docs = [(1, "Plain prose, nothing else.\nTwo lines; 3 numbers: 12, 345 and 6789.")]
    assert [tuple(r) for r in pii.replace(spark.createDataFrame(docs, "doc_id long, text string")).collect()] == docs
