"""The training-data pipeline over ``documents``: quality, lines, near copies, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm.common import staged, table, unstage
from quadrille.llm.line_dedup import line_dedup
from quadrille.llm.mixing import mixed
from quadrille.llm.near_dup import near_duplicates
from quadrille.llm.pieces import encode_documents
from quadrille.llm.quality_rules import quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with ``n_chars`` as the text now has them."""
    return df.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules(docs).filter("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return as_documents(line_dedup(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest id; of rows that repeat an id one goes on, and rows without an id all do."""
    groups = near_duplicates(docs).filter(F.col("id") == F.col("group")).select(F.col("id").alias("__keep")).distinct()
    named = docs.filter(F.col("doc_id").isNotNull()).join(groups, F.col("doc_id") == F.col("__keep"), "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter(F.col("doc_id").isNull())).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to twice."""
    return mixed(docs, max_repeats=2.0).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, lossless: the documents as seeded piece sequences."""
    return encode_documents(docs, dropout=0.1)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near), ("mixing", mixture), ("encoding", encoding)]

#: The label model, the signatures and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs, done = staged(out, name), path
        docs, path = docs
        if done:
            unstage(spark, done)
    return docs
