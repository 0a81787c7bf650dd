"""The corpus pipeline: five stages over ``documents``, each reading what the stage before wrote.

Toxic documents go, recurring lines are taken out, one document of each group of near-copies
stays, documents that leak a benchmark item go, and what is left is encoded. A stage takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import decontaminate, line_dedup, sentencepiece_codec, simhash, toxicity
from scorelake.llm.common import fresh_name, stored, table

TOKENIZERS = os.environ.get("TOKENIZER_FOLDER", "/opt/tokenizers")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples of ``labels`` do not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of recurring templates.

    A document of nothing but such lines has no text left and goes; one that was empty before stays.
    """
    dropped = fresh_name(docs, "dropped_lines")
    kept = line_dedup.drop_recurring_lines(docs, dropped=dropped)
    return kept.where((F.col(dropped) == 0) | (F.trim("text") != "")).drop(dropped)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the text decoded from the ids."""
    model = sentencepiece_codec.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    found = sentencepiece_codec.encode_documents(docs, model, "doc_id", "lang", "source")
    return found.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

# no stage but the last can be said in SQL at all sizes; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
