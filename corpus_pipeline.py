"""A corpus pipeline: language ID, near duplicates, benchmark decontamination, personal data, source mix.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written to the shared folder and read again as the next one's docs, so that a lost executor costs one
stage at most. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, language, mixing, ngram_join, pii, scratch

# Cosine with the nearest language below which a text is in none of them. Related or very short texts lie far above.
LEAST_SCORE = 0.02


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts unlike every learned language; without labels only the former."""
    names, vectors = language.train(docs)
    told = language.predict(docs, names, vectors, ("_language", "_score"))
    lettered = F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))
    kept = (F.col("_language") != language.UNKNOWN) & (F.col("_score") >= LEAST_SCORE) if names else lettered
    return told.where(kept).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies, and documents without doc_id.

    Rows that share a doc_id stay or go together.
    """
    groups = ngram_join.join(docs)
    gone = groups.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; every document stays, with n_chars of its new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with size, source_size, target and taken (repeats counted).

    Columns that had these names are replaced.
    """
    keep = [c for c in docs.columns if c not in ("doc_id", "size", "source_size", "target", "taken")]
    mixed = mixing.mix(docs, keep=keep)
    return mixed.where("taken > 0").select("doc_id", *keep, "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("source_mix", mix_sources),
]
# Language ID is a fitted model, so SQL cannot give the rows; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
