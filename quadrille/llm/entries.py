"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import token_alignment
from .classifier import quality_classifier
from .common import shared_dir, table
from .exact_dup import exact_duplicates
from .extraction import extract
from .fim import fill_in_middle, restored
from .line_dedup import line_dedup
from .mixing import schedule
from .near_dup import near_duplicates
from .pieces import encode_documents
from .quality_rules import quality_rules
from .repeats import remove_repeats
from .topk_search import exact_topk
from .warc import page_records, read_warc, write_warc


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8)
    return out.select(F.col("id").alias("doc_id"), F.col("group").alias("class_id"), F.col("text_class").alias("text_class_id"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), dropout=0.1)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = schedule(table(spark, sf_dir, "documents"), max_repeats=2.0)
    return out.select(F.col("id").alias("doc_id"), "source", "tokens", "pass", F.round("position", 9).alias("position"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), length=400)
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), left.alias("text"), F.octet_length("kept").cast("long").alias("n_kept"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return page_records(read_warc(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"), seed=7, unit="lines", fim_percent=100, spm_percent=50)
    text = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_near_dedup": op2_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_pieces": op4_pieces,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_repeats": op8_repeats,
    "op9_warc": op9_warc,
    "op10_extraction": op10_extraction,
    "op11_alignment": op11_alignment,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL = {
    "op1_topk_search": """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c AS q JOIN c USING (i) WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((('0x' || substr(h, CAST(1 + (i // 4) * 5 AS INTEGER), 5))::BIGINT >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)""",
    "op3_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
found AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT keyed.*, coalesce(doc_id <> first, false) AS dropped FROM keyed LEFT JOIN found USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""",
    "op13_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
r AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 AS off, ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 AS spm FROM d),
p AS (
  SELECT doc_id, t, n, array_to_string(u[1:least(c1, c2)], '') AS prefix, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle, array_to_string(u[greatest(c1, c2) + 1:], '') AS suffix,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR off THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form FROM r)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p""",
}
