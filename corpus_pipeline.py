"""From raw documents to token ids: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read
again as the next stage's documents.  All but the last return the columns of `documents`.

Defined cases: rows with null or empty text pass the toxicity stage (their score is that of a
text without evidence) and are rejected by language identification, which finds no letters;
an empty table passes through as an empty table; repeated rows are one document of their group;
columns beyond those of `documents` are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovane.llm import decontaminate, langid, sentencepieces, simhash, toxicity
from heliovane.llm.common import crc_remainder, table
from heliovane.llm.queries import PIECES
from heliovane.session import remove, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not call toxic."""
    scored = toxicity.fit_and_score(docs, table(spark, sf_dir, "labels"), crc_remainder(F.col("doc_id"), 4) != 2, carry=True)
    return scored.where("predicted = 0").select("row.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without any letter go."""
    sample = langid.labelled_sample(docs, crc_remainder(F.col("doc_id"), 5) > 0, "doc_id", "text", "lang")
    return langid.identify(docs, sample, carry=True).where(F.col("lang_pred") != langid.UNDETERMINED).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near duplicates."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return found.where(~F.col("contaminated")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return sentencepieces.round_trip(docs, PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode),
]

#: Trained models and 64-bit hashes are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the table between two stages goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
