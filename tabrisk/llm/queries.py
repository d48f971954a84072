"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, fim, hnsw, importance, itq, langid, pii, simhash, toolcalls, toxicity, urlfilter, warc
from .common import ensure_checkpoint_dir, table


def op1_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data under pseudonyms: doc_id, text, n_replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, count="n_replaced")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


def op3_itq_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes an archive of ``pages`` to the shared checkpoint folder and reports what is read back."""
    pages = table(spark, sf_dir, "pages")
    path = os.path.join(ensure_checkpoint_dir(spark), f"warc-{uuid.uuid4().hex}")
    warc.write(pages, path, min_bytes=0)
    r = warc.read(spark, path)
    return r.select(F.col("id").cast("long").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


def op5_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item: doc_id, n_items, item_ids, best_share, equal_words."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results derived from every turn of ``conversations``, linked, ordered, validated and written canonically."""
    return toolcalls.link_conversations(spark, table(spark, sf_dir, "conversations"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_pages(table(spark, sf_dir, "pages"), urlfilter.rules_table(spark))


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_hnsw_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at lines and arranged, then restored from the arranged text."""
    out = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fim.restore(out, with_text=False)
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_pii_feistel": op1_pii_feistel,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_itq_embeddings": op3_itq_embeddings,
    "op4_warc_archive": op4_warc_archive,
    "op5_toxicity_lexicon": op5_toxicity_lexicon,
    "op6_simhash_golay": op6_simhash_golay,
    "op7_spaced_seed_decontamination": op7_spaced_seed_decontamination,
    "op8_tool_call_linking": op8_tool_call_linking,
    "op9_url_rules": op9_url_rules,
    "op10_language_crf": op10_language_crf,
    "op11_hnsw_nearest": op11_hnsw_nearest,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_importance_resampling": op13_importance_resampling,
}

#: CRC-32 of the bytes of ``f`` in DuckDB SQL; ``crc_table`` has its 256 values. The polynomial is a fixed value.
_CRC_SQL = """crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM range(256) r(i)))"""
_CRC_OF = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * octet_length(encode(f)) + 1, 2), lambda i: ('0x' || substr(hex(encode(f)), i::INT, 2))::BIGINT)),
                lambda a, b: xor(t[xor(a, b) % 256 + 1], a // 256)), 4294967295)"""

ORACLE: dict[str, str] = {
    "op11_hnsw_nearest": """
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op12_fill_in_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u, sha256('7:' || doc_id) AS h FROM documents),
        x AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                          WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
        p AS (SELECT doc_id, text, n, form, array_to_string(u[1:least(c1, c2)], '') AS prefix, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
                     array_to_string(u[greatest(c1, c2) + 1:], '') AS suffix FROM x)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(prefix || middle || suffix) AS restored_sha256 FROM p""",
    "op13_importance_resampling": f"""
        WITH {_CRC_SQL},
        w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
              FROM (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark)),
        f AS (SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w),
        c AS (SELECT kind, id, f, count(*) AS n FROM f GROUP BY ALL),
        b AS (SELECT f, {_CRC_OF} % 10000 AS bucket FROM (SELECT DISTINCT f FROM c), crc_table),
        t AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE kind = 1), 0)::DOUBLE AS t FROM c JOIN b USING (f) GROUP BY bucket),
        g AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM t) + 10000) / ((s + 1) * ((SELECT sum(t) FROM t) + 10000))))::BIGINT AS gain FROM t),
        m AS (SELECT id, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM c JOIN b USING (f) JOIN g USING (bucket) WHERE kind = 0 GROUP BY id),
        x AS (SELECT w.id AS doc_id, len(w.w) AS n_words, (2 * len(w.w) - least(len(w.w), 1))::BIGINT AS n_features, coalesce(m.weight, 0) AS weight,
                     coalesce(m.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
              FROM w LEFT JOIN m USING (id) WHERE kind = 0),
        r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE n_words >= 20)
        SELECT x.doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM r) * 25 // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (doc_id)""",
    "op4_warc_archive": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        h AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS last FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::INT >> (5 * (3 - i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
               CASE WHEN last IS NULL OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN last IS NULL OR page_id = last THEN NULL ELSE last END AS refers_to
        FROM h""",
    "op9_url_rules": """
        WITH u AS (SELECT page_id,
                          translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
        r AS (SELECT *, CASE
                WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule FROM u)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r""",
}
