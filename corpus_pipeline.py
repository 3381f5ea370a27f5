"""From raw documents to packed training sequences: language ID, near-dedup, secret masking, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
``documents``. ``run`` writes each stage's result to the shared folder and reads it as the next one's input, so a lost
executor never costs more than the stage it ran in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnguard.llm import lang_ppm, near_dups, packing, secrets_linked
from txnguard.llm.common import Scratch, table
from txnguard.session import prepare

LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, those whose best language has no majority of the posterior, and those whose code
    length even in it is beyond that of its training rows: other languages and noise."""
    model = lang_ppm.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = lang_ppm.predict(docs, model)
    fits = lang_ppm.fits("text", lang_ppm.bounds(docs))
    return judged.where((F.col("lang_pred") != lang_ppm.UNKNOWN) & (F.col("score") >= LEAST_SCORE) & fits).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group whose five-word shingles are similar by 0.8 or more.
    Of rows that repeat an id, those that are equal stay once."""
    found = near_dups.near_duplicates(docs, words=5).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.dropDuplicates().join(found, "doc_id", "left_semi")
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets found; documents stay, with the length of their masked text."""
    clean = secrets_linked.masked(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a training sequence for every piece of every document."""
    return packing.report(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packing_stage)]

#: Code lengths and packing can't be stated in SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(prepare(spark), sf_dir, "documents"), Scratch(spark, "corpus")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
