"""The corpus pipeline: five stages over ``documents``, each written and read again.

Toxic documents go; lines that many documents share go; of each group of near-duplicates one
document stays; sources are mixed to their target weights; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.llm import bpe, line_dedup, mixing, simhash_wide, toxicity
from cubeloom.llm.common import crc_bucket, table
from cubeloom.llm.queries import word_bpe
from cubeloom.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go; a third of the labels stays held out."""
    learnt = crc_bucket(F.col("doc_id"), 3) != 1
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), learnt)
    return scored.where("predicted = 0").select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters in three documents or more stay in the last one only."""
    state = line_dedup.insert(line_dedup.empty_state(spark), docs)
    cleaned = line_dedup.drop_lines(state, docs)
    return cleaned.select(*_with_text(docs, F.col("kept_text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, 80 % in common; the smallest doc_id of a group stays.

    Candidates meet under the pigeonring's chains and, farther apart, under bands of least hashes.
    """
    return simhash_wide.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source in its target share; a document comes once for each pass over it."""
    mixed = mixing.mixed_texts(docs)
    return mixed.select(*_with_text(mixed, F.col("text")))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded), one row per row of the mix."""
    return bpe.encode(docs, word_bpe())


def _with_text(docs: DataFrame, text) -> list:
    """The columns of documents with a new text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return [new[c].alias(c) if c in new else F.col(c) for c in docs.columns if c != "kept_text"]


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]
# The trees of the first stage and the seeded order of the fourth are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
