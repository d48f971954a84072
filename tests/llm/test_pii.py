import datetime
import re

import numpy as np
import pytest
from llm_brute import SF1, rows
from pyspark.sql import functions as F

from tabrisk.llm import pii
from tabrisk.llm.queries import QUERIES

KEY = "test"


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def run(spark, values, key=KEY, back=False):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, m string")
    return [r.p for r in df.select("i", pii.pseudonym(F.col("m"), key, back).alias("p")).orderBy("i").collect()]


GOOD = [
    "4111111111111111", "5500 0000 0000 0004", "3782-822463-10005", "6011000990139424", "+1 (415) 555-2671", "(415) 555-2671", "415-555-2671", "+44 20 7946 0958", "+14155552671",
    "078-05-1120", "899-99-9999", "001-01-0001", "665-01-0001", "667-01-0001", "127.0.0.1", "255.255.255.255", "0.0.0.0", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NO9386011117947",
    "2024-02-29", "1999/12/31", "31.12.1999", "01/02/1985", "12/25/2020", "02/13/1970", "28-02-2023", "9599-01-01", "0400-03-01", "jane.doe+x9@mail.example.com", "a@b.org", "x1@b.org", "AbC.42@mail4.example.com",
]
BAD = ["4111111111111112", "1234567890123456", "2023-02-29", "31.04.2020", "13/32/2020", "000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000", "GB82 WEST 1234 5698 7654 33", "0001-01-01"]


def test_pseudonyms_keep_their_format_and_can_be_inverted(spark):
    new = run(spark, GOOD)
    for a, b in zip(GOOD, new):
        assert a != b, a
        form = lambda s: re.sub(r"\d+" if "." in s and s.count(".") == 3 else r"\d", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
        assert form(a) == form(b), (a, b)
    assert all(luhn(b) for b in new[:4]) and all(mod97(b) == 1 for b in new[17:20])
    for b, f in zip(new[20:27], ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y", "%m/%d/%Y", "%d-%m-%Y")):
        datetime.datetime.strptime(b, f)
    assert int(new[24][3:5]) > 12 and int(new[25][3:5]) > 12
    assert all(int(x) < 256 for v in new[14:17] for x in v.split("."))
    assert run(spark, new, back=True) == GOOD
    assert run(spark, GOOD) == new and run(spark, GOOD, key="other") != new


def test_what_fails_validation_stays(spark):
    assert run(spark, BAD) == BAD


def test_permutations_have_no_collisions(spark):
    n = 3000
    days = [(datetime.date(2000, 3, 1) + datetime.timedelta(i)).isoformat() for i in range(n)]
    assert len(set(run(spark, days))) == n
    assert len(set(run(spark, [f"10.0.{i // 256}.{i % 256}" for i in range(n)]))) == n
    d = spark.range(10_000).select(pii.feistel_digits(F.lpad(F.col("id").cast("string"), 4, "0"), KEY, "t").alias("p"))
    assert d.distinct().count() == 10_000
    cyc = spark.range(146097).select(pii._permute_day(F.col("id") + 5 * 146097, KEY, "t", False).alias("p")).agg(F.countDistinct("p"), F.min("p"), F.max("p")).first()
    assert tuple(cyc) == (146097, 5 * 146097, 6 * 146097 - 1)


def test_text_is_replaced_in_place_and_edges(spark):
    t = "Mail jane.doe@mail.example.com, call +1 (171) 555-2028. Card 4111 1111 1111 1111; IP 106.158.249.239."
    docs = [(1, t), (2, None), (3, ""), (4, "no data, v1.2.3 and 3.14, id 9807915"), (4, t), (None, "again jane.doe@mail.example.com"), (5, "1" * 200_000), (6, "w " * 50_000 + t), (7, "@"), (8, "x" * 100_000 + "@y"), (9, t + "\n" + t)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as m", "2 as _x")
    out = pii.replace(df, key=KEY, count="n")
    assert out.columns == ["doc_id", "text", "m", "_x", "n"]
    got = [(r.doc_id, r.text, r.n) for r in out.collect()]
    by = {(i, k): (x, n) for k, (i, x, n) in enumerate(got)}
    assert by[2, 1] == (None, 0) and by[3, 2] == ("", 0) and by[4, 3] == (docs[3][1], 0)
    new, n = by[1, 0]
    assert n == 4 and new.startswith("Mail ") and len(re.findall("Card|IP|call", new)) == 3 and by[4, 4][0] == new
    for secret in ("jane", "171", "4111 1111", "106.158"):
        assert secret not in new
    mail = re.search(r"\S+@mail\.example\.com", new)[0]
    assert by[None, 5][0] == "again " + mail.rstrip(",")
    assert by[5, 6][0] == docs[6][1] and by[6, 7][0].endswith(new) and by[9, 10] == (new + "\n" + new, 8)
    assert [r.text for r in pii.replace(out.drop("n"), key=KEY, back=True).collect()] == [x for _, x in docs]
    assert pii.replace(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.fixture(scope="module")
def done(spark):
    return {r.doc_id: r for r in QUERIES["op1_pii_feistel"](spark, SF1).collect()}


def test_query_removes_every_planted_value_and_leaves_the_rest(done):
    """Brute force: Python finds the values that are valid and checks each document around them."""
    pat = {"mail": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}", "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d)", "card": r"(?<!\w)\d{16}(?!\w)"}
    either = "|".join(pat.values())
    seen = 0
    for i, t in rows(SF1, "select doc_id, text from documents"):
        new, old = done[i].text, [m for m in re.findall(either, t)]
        live = [m for m in old if not re.fullmatch(r"\d{16}", m) or luhn(m)]
        seen += len(live)
        assert done[i].n_replaced == len(live)
        assert re.split(either, t) == re.split(either, new)
        for a, b in zip(old, re.findall(either, new)):
            assert (a != b) == (a in live)
    assert seen > 50


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = QUERIES["op1_pii_feistel"](spark, SF1)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan


def test_neighbours_hide_no_value(spark):
    card, spaced, phone, ip = "4111111111111111", "4111 1111 1111 1111", "+1 (826) 555-4081", "190.137.223.204"
    parts = [
        (phone, ip), ("+1 (843) 555-7672", "170.106.47.218"), ("+1 555 123 4567", "2024-01-02"), ("+14155552671", "2024-01-02"), ("+1 555 123 4567", spaced), (phone, spaced), ("+14155552671", spaced), ("+1 555 123 4567", "415-555-2671"),
        (spaced, ip), (spaced, "2024-01-02"), (spaced, "123-45-6789"), (spaced, "123@mail.example.com"), ("3782-822463-10005", spaced), (spaced, "5500 0000 0000 0004"), (spaced, "415-555-2671"), ("+33 1 23 45 67 89", spaced), (card, card),
    ]
    loose = [f"{spaced} 12/27", f"{card} 123", f"12345 {spaced}", f"1234 {spaced}", f"77 {spaced} 5500 0000 0000 0004 9"]
    texts = [" ".join(p) for p in parts] + loose
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = pii.replace(docs, key=KEY, count="n").orderBy("doc_id").collect()
    for r, p in zip(out, parts):
        assert r.n == 2 and all(x not in r.text for x in p), (p, r.text)
    rest = [r.text for r in out[len(parts) :]]
    assert [r.n for r in out[len(parts) :]] == [1, 1, 1, 1, 2]
    assert rest[0].endswith(" 12/27") and rest[1].endswith(" 123") and rest[2].startswith("12345 ") and rest[3].startswith("1234 ") and rest[4].startswith("77 ") and rest[4].endswith(" 9")
    assert all(luhn(x) for x in (rest[0][:-6], rest[1][:-4], rest[2][6:], rest[3][5:], rest[4][3:22], rest[4][23:42]))
    # many numbers with a tail, so that new digits often make another prefix valid
    many = [f"{i % 997} {b}{next(c for c in '0123456789' if luhn(b + c))} {i % 1000:03}" for i in range(300) for b in [f"{4 * 10**14 + i * 7919:015}"]]
    df = spark.createDataFrame(list(enumerate(texts + many)), "doc_id int, text string")
    new = pii.replace(df, key=KEY, count="n")
    assert [r.text for r in pii.replace(new.drop("n"), key=KEY, back=True).orderBy("doc_id").collect()] == texts + many
    assert all(r.n >= 1 for r in new.collect())


def plain_pieces(run):
    """Python's reading of a run of digit groups: [(text, kind)]."""
    g, out, i = re.split(r"(?<=[0-9])(?=[ -])", run), [], 0
    while i < len(g):
        for n in range(min(19, len(g) - i), 0, -1):
            d = re.sub("[^0-9]", "", "".join(g[i : i + n]))
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("".join(g[i : i + n]), "card"))
                break
        else:
            n = 3 if re.fullmatch(r"[ -]?[0-9]{3}([ -])[0-9]{3}\1[0-9]{4}", "".join(g[i : i + 3])) else 1
            out.append(("".join(g[i : i + n]), "phone" if n == 3 else ""))
        i += n
    return out


def test_runs_of_any_length_lose_no_value(spark):
    card = "4111 1111 1111 1111"
    texts = [" ".join(["1234"] * n + [card]) for n in range(30, 45)]
    texts += [" ".join(["1234"] * n + [card, *["77"] * n, card]) + "." for n in (100, 1000, 5000)]
    texts += ["12 " * 3000 + card + "x " + card, "9" * 300 + " " + card, card + " " + "9" * 300, card + "-" + "-".join(["55"] * 200) + " 22nd"]
    rng = np.random.default_rng(8)
    texts += [" ".join(str(rng.integers(10 ** (k - 1), 10**k)) for k in rng.integers(1, 8, 120)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    whole = re.compile(r"(?<!\w)(?=\d(?:[ -]?\d){12})\d+(?!\w)(?:[ -]\d+(?!\w))*")
    for r in pii.replace(df, key=KEY, count="n").collect():
        old = texts[r.doc_id]
        values = [v for m in whole.finditer(old) for v, k in plain_pieces(m[0]) if k]
        assert r.n == len(values), (r.doc_id, r.n, values)
        for v in values:
            assert v.strip() not in r.text or v.strip() in old.replace(v, "", 1)
        # all that is no value stays, and each value is a valid one of the same shape (long runs: as the value alone)
        assert re.sub(r"\d", "0", r.text) == re.sub(r"\d", "0", old)
        for m in whole.finditer(old):
            at = m.start()
            for v, k in plain_pieces(m[0]):
                new = r.text[at : at + len(v)]
                assert (new == v) if not k else (luhn(re.sub(r"\D", "", new)) if k == "card" else True), (v, new)
                at += len(v)
    alone = pii.replace(spark.createDataFrame([(0, card)], "doc_id int, text string"), key=KEY).first().text
    long_run = pii.replace(df.where("doc_id = 16"), key=KEY).first().text
    assert alone in long_run  # linked with the value alone
