import hashlib
import re

import pytest
from llm_brute import SF1, rows

from tabrisk.llm import fim
from tabrisk.llm.queries import QUERIES

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text, rate=100, spm=50, unit=UNIT, seed=7):
    text = text or ""
    u = unit.findall(text)
    h = [int(sha(f"{seed}:{'' if doc_id is None else doc_id}")[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < spm:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


EDGES = [
    (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one line"), (6, "a\nb"), (7, "a\nb\n"), (8, "has <P> in it\nx\n"), (9, "<S"), (10, "x<\nP>\nS>\n<M"),
    (11, "é\n漢字\r\n\U0001f600 z\n"), (12, "tab\x0bnot a\u0085break\n"), (13, "w " * 300_000 + "\n" + "q\n" * 50_000), (5, "one line"), (None, "no id\nat all\n"), (5, "another\ntext\n"), (14, "<M>"),
]


def test_edges_and_round_trip(spark):
    df = spark.createDataFrame([(i, t, 0, "keep") for i, t in EDGES], "doc_id long, text string, _in0 long, restored_text string")
    out = fim.transform(df)
    assert out.columns == ["doc_id", "_in0", "restored_text", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256) for r in out.collect()), key=str)
    want = sorted(((i, *(b := brute(i, t)), sha(b[4])) for i, t in EDGES), key=str)
    assert got == want
    back = fim.restore(out).select("doc_id", "restored", "restored_sha256").collect()
    assert sorted(((r.doc_id, r.restored, r.restored_sha256) for r in back), key=str) == sorted(((i, t or "", sha(t or "")) for i, t in EDGES), key=str)


@pytest.mark.parametrize("rate,spm,unit", [(60, 0, "line"), (100, 100, "line"), (0, 50, "line"), (90, 50, "char")])
def test_parameters(spark, rate, spm, unit):
    data = rows(SF1, "SELECT doc_id, text FROM documents WHERE doc_id < 120")
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = fim.transform(df, rate=rate, spm_rate=spm, unit=unit, seed=9)
    pattern = UNIT if unit == "line" else re.compile(r"(?s).")
    assert sorted((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()) == sorted((i, *brute(i, t, rate, spm, pattern, 9)) for i, t in data)
    assert sorted((r.doc_id, r.restored) for r in fim.restore(out).collect()) == sorted((i, t or "") for i, t in data)


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.transform(df)).collect() == []
    with pytest.raises(ValueError, match="form"):
        fim.transform(spark.createDataFrame([(1, "x", "y")], "doc_id long, text string, form string"))
    back = fim.restore(spark.createDataFrame([(None, None), ("x", None), (None, "plain")], "output string, form string"))
    assert sorted(r.restored for r in back.collect()) == ["", "", "x"]


def test_query(spark):
    got = sorted(tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, SF1).collect())
    want = sorted((i, *(b := brute(i, t))[:4], sha(b[4]), sha(t or "")) for i, t in rows(SF1, "SELECT doc_id, text FROM documents"))
    assert got == want
