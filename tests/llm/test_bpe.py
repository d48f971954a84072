import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from llm_brute import SF, rows

from tabrisk.llm import bpe
from tabrisk.llm.queries import QUERIES

PATH = P.path(bpe.VOCABULARY)
DOC = "doc_id long, text string"


@pytest.fixture(scope="module")
def enc():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def want(enc, i, t):
    ids = np.array(enc.encode_ordinary(t or ""), "<u4").tobytes()
    return i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()


def test_query_equals_the_library(spark, enc):
    got = sorted(tuple(r)[:4] for r in QUERIES["op2_byte_bpe"](spark, SF).collect())
    assert got == sorted(want(enc, *r) for r in rows(SF, "select doc_id, text from documents"))


TEXTS = [
    None, "", " ", "\n\n  \n", "it's we'll x's 'sx I'D", "a  b\t\tc  d　e\x1cf\x85g", "ᾳ²½Ⅷ٣߀𝟘𐍈😀👩‍🚀 é ՘࢏Ᲊ\U0001e6c0",
    "漢字かな交じり文。" * 60, "x" * 900, "<|endoftext|> <|endoftext|>", "  " * 400, ("word " * 30 + "\n\n") * 9, "1234567 " * 90, "!?" * 300, ("a" * 45 + " ") * 20, " lead and trail ", "﻿bom​  x",
]


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (50, 49), (7, 3)])
def test_any_cut_gives_the_same_ids(spark, enc, chunk, overlap):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id " * 40), (3, TEXTS[7]), (3, TEXTS[7])]
    df = spark.createDataFrame(docs, DOC).selectExpr("doc_id", "text", "1 as ids", "2 as k", "'p' as piece", "3 as n_tokens")
    out = bpe.encode(df, PATH, P.PATTERN, chunk=chunk, overlap=overlap, with_ids=True).collect()
    assert sorted((tuple(r)[:4] for r in out), key=str) == sorted((want(enc, *d) for d in docs), key=str)
    back = bpe.decode(spark.createDataFrame(out), PATH, P.PATTERN).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in docs)


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], DOC), PATH, P.PATTERN).count() == 0


def test_classes_are_those_of_the_library(enc):
    codec = bpe.Codec.of(PATH, P.PATTERN)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 5000):
        t = "".join(f"a{c}b {c} " for c in every[at : at + 5000])
        assert codec.encode(t) == np.array(enc.encode_ordinary(t), "<u4").tobytes()
