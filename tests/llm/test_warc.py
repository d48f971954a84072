import base64
import hashlib
import uuid

import pytest
from llm_brute import SF, rows

from tabrisk.llm import warc
from tabrisk.llm.common import ensure_checkpoint_dir
from tabrisk.llm.queries import ORACLE, QUERIES

PAGE = "page_id long, url string, html string"


def brute(pages, least=0):
    last = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        b = (h or "").encode()
        to = last.get(h or "")
        revisit = to is not None and i != to and len(b) >= least
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def archive(spark, df, least=0):
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    warc.write(df, path, min_bytes=least)
    return path


def test_query_equals_brute_force_and_sql(spark):
    got = sorted(map(tuple, QUERIES["op4_warc_archive"](spark, SF).collect()), key=str)
    assert got == brute(rows(SF, "select page_id, url, html from pages"))
    assert got == sorted(rows(SF, ORACLE["op4_warc_archive"]), key=str)


PAGES = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (5, "http://é/", "é" * 10), (6, "u", "x" * 300_000), (7, "u", "x" * 300_000), (7, "u", "x" * 300_000), (None, "n", "same"), (None, "n", "alone"), (8, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n")]


@pytest.mark.parametrize("least", [0, 5])
def test_records_and_edges(spark, least):
    df = spark.createDataFrame(PAGES, PAGE).selectExpr("*", "1 as id", "'d' as digest", "2 as n", "'t' as type")
    path = archive(spark, df, least)
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({h or "" for _, _, h in PAGES})
    r = warc.read(spark, path).collect()
    got = sorted(((x.id and int(x.id), len(x.payload), x.digest, x.type, x.refers_to and int(x.refers_to)) for x in r), key=str)
    assert got == brute(PAGES, least)
    for x in r:
        head, _, rest = bytes(x.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        assert len(rest) == n + 4 and rest.endswith(b"\r\n\r\n")
        http, _, body = rest[:n].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK") and body == (b"" if x.type == "revisit" else x.payload)
        assert b"X" not in fields and (x.target is None) == (b"WARC-Target-URI" not in fields)


def test_a_changed_payload_is_noticed(spark):
    path = archive(spark, spark.createDataFrame(PAGES[:4], PAGE))
    other = f"{path}-other"
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    spark.read.parquet(f"{path}/payloads").selectExpr("sha256", "cast('changed' as binary) as payload").write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="differs"):
        warc.read(spark, other).collect()


def test_empty_table(spark):
    assert warc.read(spark, archive(spark, spark.createDataFrame([], PAGE))).count() == 0
