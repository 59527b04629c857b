"""A corpus from raw to packed: drop toxic and poor documents, keep one of each near-copy group, redact, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonara.llm import jaccard_join, packing, pii, quality, toxicity
from zonara.llm.common import checkpointed
from zonara.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on the labels, calls toxic go; repeated rows are judged alike, a null or empty text is not toxic."""
    return toxicity.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or that are rather junk than good, go; a null or empty text has no words and goes."""
    return quality.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the first by doc_id (null last); texts without words all stay."""
    return jaccard_join.keep_one(docs, width=5, percent=80)  # 4 words and 85 % are op10_jaccard_join's contract


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; personal data in its text is replaced, a null text stays null."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null text is an empty document, which has its end token."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", keep_quality), ("jaccard_join", drop_near_copies), ("pii", redact), ("packing", pack)]
#: The learned stages and the byte-pair encoding have no SQL; tests hold the pipeline against its stages and brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table, each stage's rows written before the next; an empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
