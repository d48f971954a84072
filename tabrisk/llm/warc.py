"""Content-addressed WARC archive.

Every page becomes a WARC 1.1 record. Payload bytes are stored once, under
their SHA-256, in one table; the exact header bytes of each record (WARC and
HTTP headers) in another. Records with equal payloads have one ``response``,
that of the largest id, and ``revisit`` records that refer to it. Original
records are put together again by joining headers and payloads by digest.

The digest is verified: when the archive is made, all payloads of one SHA-256
must have one length and one SHA-1, and when it is read both digests are
computed again from the stored bytes. A difference stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW_KEY, with_row_key

#: Records carry this date, as pages have none of their own.
DATE = "1970-01-01T00:00:00Z"
URN = "urn:tabrisk:page:"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of bytes: each five hex digits give four letters."""
    h = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(h, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(fields: list[tuple[str, Column]]) -> Column:
    """Header lines; fields whose value is null are left out, line ends in values are escaped."""
    line = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), F.regexp_replace(F.regexp_replace(v, "\r", "%0D"), "\n", "%0A"), F.lit("\r\n"))) for k, v in fields]
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("", *line), F.lit("\r\n"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", body: str = "html", min_bytes: int = 0) -> None:
    """Write the archive to ``path``/headers and ``path``/payloads (a shared folder).

    A null body is an empty payload, a null URL leaves its header out. Payloads
    shorter than ``min_bytes`` are responses all. Of rows that repeat the
    largest id of a payload each is a response; a group whose ids are all null
    has no revisits.
    """
    rows = with_row_key(pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{body}`").alias("body")))
    payload = F.coalesce(F.col("body").cast("binary"), F.lit("").cast("binary"))
    marked = rows.withColumn("payload", payload).drop("body")
    marked = marked.withColumn("sha256", F.sha2("payload", 256)).withColumn("digest", base32_sha1(F.col("payload"))).withColumn("n", F.octet_length("payload").cast("long"))
    small = marked.select(*ROW_KEY, "id", "sha256", "digest", "n")
    first = F.max(F.struct(F.col("id").isNotNull().alias("z"), "id", *ROW_KEY)).alias("first")
    kept = small.groupBy("sha256").agg(first, F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("digest").alias("d0"), F.max("digest").alias("d1"))
    same = F.when((F.col("n0") == F.col("n1")) & (F.col("d0") == F.col("d1")), F.col("first.id"))
    kept = kept.select("sha256", F.col("first.id").alias("largest"), *[F.col(f"first.{c}").alias(c) for c in ROW_KEY], F.when(same.isNull() & F.col("first.id").isNotNull(), F.raise_error(F.lit("payloads that differ have one SHA-256"))).otherwise(F.lit(True)).alias("ok"))
    marked.join(kept.where("ok").select(*ROW_KEY), ROW_KEY, "left_semi").select("sha256", "payload").write.parquet(f"{path}/payloads")

    rec = marked.select("id", "url", "sha256", "digest", "n").join(kept.select("sha256", "largest"), "sha256")
    revisit = F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest")) & (F.col("n") >= min_bytes)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("n"))
    head = _header([
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.concat(F.lit(f"<{URN}"), F.col("id").cast("string"), F.lit(">"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit(f"<{URN}"), F.col("largest").cast("string"), F.lit(">")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", length.cast("string")),
    ])
    rec.select("sha256", head.cast("binary").alias("warc_header"), http.cast("binary").alias("http_header")).write.parquet(f"{path}/headers")


def field(header: Column, name: str) -> Column:
    """A header field's value, null if there is none."""
    v = F.regexp_extract(header.cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(v != "", v)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive: type, id, refers_to, target, digest, payload, record (its exact bytes).

    A revisit's record ends after its HTTP header; its payload is the one that
    it refers to. Digest and lengths are checked against the stored bytes.
    """
    heads, bodies = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    r = heads.join(bodies, "sha256")
    h = F.col("warc_header")
    r = r.withColumn("type", field(h, "WARC-Type"))
    block = F.concat("http_header", F.when(F.col("type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload")))
    right = (F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))) == field(h, "WARC-Payload-Digest")) & (F.sha2("payload", 256) == F.col("sha256")) & (F.octet_length(block).cast("string") == field(h, "Content-Length"))
    page = lambda name: F.regexp_extract(field(h, name), f"^<{URN}(.*)>$", 1)
    return r.where(F.when(right, True).otherwise(F.raise_error(F.lit("a stored payload differs from its record")).cast("boolean"))).select(
        "type",
        page("WARC-Record-ID").alias("id"),
        page("WARC-Refers-To").alias("refers_to"),
        field(h, "WARC-Target-URI").alias("target"),
        F.substring(field(h, "WARC-Payload-Digest"), 6, 32).alias("digest"),
        "payload",
        F.concat(h, block, F.lit("\r\n\r\n").cast("binary")).alias("record"),
    )
