"""The corpus pipeline: stages over ``documents``, each written and read again.

Quality rules, line dedup, near-duplicates, personal data, packing. All but the
last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import linededup, packing, pii, probminhash, quality
from wardflow.llm.scratch import read_table, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.kept_documents(docs).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go, short ones if on twice as many sites; so do documents that held nothing else."""
    out = linededup.drop_boilerplate(docs, short_sites=6)
    return _documents(out.filter((F.col("n_removed") == 0) | F.col("text").rlike(quality.NOT_SPACE)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates. Of rows that repeat an id and text, one; null ids stay."""
    docs = docs.select(*COLUMNS)
    kept = probminhash.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").withColumn("_key", F.xxhash64("text"))
    named = named.dropDuplicates(["doc_id", "_key"])
    return _documents(named.drop("_key").unionByName(docs.filter("doc_id is null")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind."""
    return _documents(pii.redacted(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of windows of 2048 tokens."""
    return packing.piece_digests(packing.pack(docs))


STAGES = [("quality", quality_rules), ("lines", line_dedup), ("near_duplicates", near_dedup),
          ("personal_data", personal_data), ("packing", pack_windows)]
#: Estimates, sketches and tokens are beyond SQL; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
