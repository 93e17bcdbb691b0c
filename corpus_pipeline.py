"""A training corpus from raw documents: rules, near-duplicates, decontamination, pseudonyms, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a frame that
is written as parquet and read back as the next one's ``docs``. All but the last return the columns of
``documents``, extra ones included. Null and empty texts have no words and go in the first stage; rows
without an id pass the stages that tell documents by their id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import contamination, divergence, packing, pseudonyms
from tabwright.llm.neardup import Banding, one_of_each
from tabwright.llm.tokens import free_name
from tabwright.sources import read_parquet_table
from tabwright.sources.durable import materialise

PSEUDONYM_KEY = "a key for tests; real ones come from the caller"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are far from their language go."""
    references = divergence.language_references(docs)
    verdict = free_name(docs, "verdict")
    judged = docs.withColumn(verdict, divergence.quality_verdict(references, F.col("text"), F.col("lang")))
    return judged.where(F.col(verdict)["kept"]).drop(verdict)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return one_of_each(docs, plan=Banding(percent=80, agree=0.65))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget go."""
    found = free_name(docs, "hits")
    judged = contamination.with_hits(docs, read_parquet_table(spark, sf_dir, "benchmark"), into=found)
    return judged.where(F.size(found) == 0).drop(found)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses become pseudonyms; ``n_chars`` follows the text."""
    text = pseudonyms.pseudonymised(F.col("text"), PSEUDONYM_KEY)
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in bins of 2,048 words, without two of a source or of equal texts in one bin."""
    return packing.pack(docs, packing.n_words(F.col("text")), F.col("source"), packing.copy_key(F.col("text")))


STAGES = [
    ("quality_rules", quality_rules), ("minhash_dedup", minhash_dedup), ("decontaminate", decontaminate),
    ("pseudonymise", pseudonymise), ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # learnt references, hashes and packing are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
