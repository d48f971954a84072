"""URL filters: host-suffix and path-prefix expressions, looked up by short hash prefixes.

Each distinct URL is expanded into host suffixes (whole labels) times path
prefixes (up to each slash), no deeper than the deepest rule, which is where
longer expressions can't match any more. Expressions meet the rules by an
equi-join on the first ``PREFIX_HEX`` hex digits of their SHA-256; the full
digest then confirms, and of the rules that fit the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8
DEFAULT_VERDICT = "allow"
#: (host, path, verdict); paths begin with a slash (fixed values of the registered query).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end, lower-cased in ASCII; empty for null or no ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to a question mark, a hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _host_suffixes(host: Column, labels: Column) -> Column:
    """Whole-label suffixes of at most ``labels`` labels, the whole host included if it has no more."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), F.least(n, F.greatest(labels, F.lit(1)))), lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))


def _path_prefixes(path: Column, depth: Column) -> Column:
    """Prefixes up to and with each of the first ``depth`` slashes."""
    parts = F.split(path, "/")
    most = F.least(F.size(parts) - 1, depth)
    return F.when(most > 0, F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))).otherwise(F.array().cast("array<string>"))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per distinct URL: url, host, path, rule (host and path of the longest rule that fits, or null), verdict.

    A rule fits its host and all its subdomains when the path starts with the
    rule's path. Rules that are equally long can't both fit, unless they are
    equal; then ``block`` wins. Rule paths need not end in a slash: they are
    filed under the part up to their last slash and compared after the digest
    is confirmed. Rules with a null or empty host, or a path without a leading
    slash, match nothing. A null URL, or one without ``://``, has an empty host and
    path and gets the default. An empty rule table gives the default to all.
    """
    r = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")).where("r_host <> '' and r_path like '/%'")
    r = r.withColumn("expr", F.concat("r_host", F.regexp_extract("r_path", r"(?s)^(.*/)", 1)))
    r = r.withColumn("digest", F.sha2(F.col("expr").cast("binary"), 256)).withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    deepest = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0)).alias("labels"), F.coalesce(F.max(F.size(F.split("path", "/")) - 1), F.lit(0)).alias("depth")).first()
    u = urls.select(F.col(f"`{url}`").alias("url")).distinct().withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    hosts = _host_suffixes(F.col("host"), F.lit(deepest["labels"]))
    e = u.where("host <> ''").select("url", "path", F.explode(hosts).alias("h")).select("url", "path", "h", F.explode(_path_prefixes(F.col("path"), F.lit(deepest["depth"]))).alias("p"))
    e = e.withColumn("digest", F.sha2(F.concat("h", "p").cast("binary"), 256)).withColumn("short", F.substring("digest", 1, PREFIX_HEX)).drop("h", "p")
    hit = e.join(r.withColumnRenamed("digest", "r_digest"), "short").where((F.col("digest") == F.col("r_digest")) & F.startswith("path", "r_path"))
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), (F.col("r_verdict") == "block").alias("b"))
    best = hit.groupBy("url").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")), rank).alias("best"))
    return u.join(best, "url", "left").select("url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def filter_pages(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: id, host, path, rule, verdict. Repeated rows and null ids are judged each; other columns play no part."""
    p = pages.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url}`").alias("_url"))
    j = judge(p, rules, "_url", default)
    return p.join(j, p["_url"].eqNullSafe(j["url"]), "left").select(id_col, "host", "path", "rule", "verdict")
