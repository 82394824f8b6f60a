"""A corpus from raw documents: toxic ones out, repeated lines out, near duplicates and leaks out, sources mixed.

Each stage works on all rows of the one before and returns the columns of ``documents``; the last
one returns the mix: documents with the words it takes, and how many. Empty tables pass through
every stage; columns besides those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasewright.llm import decontam, forest, lines, mixing, toxicity
from phasewright.session import stage


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones among them, does not call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of 40 characters and more that at least 5 of them hold, except in the last of these."""
    return _with_length(lines.dedup_lines(docs, min_chars=40, min_docs=5))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group linked by a similarity of 0.8 on 5-word shingles."""
    return forest.drop_near_duplicates(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes words of: ``text`` is what it takes, a second reading included."""
    mixed = mixing.mix(docs, columns=[c for c in docs.columns if c != "doc_id"]).where("taken > 0")
    text = mixing.mixed_text(F.col("text"), F.col("turns"), F.col("pieces"))
    return _with_length(mixed.withColumn("text", text)).drop("turns", "pieces")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

# The severity model is fitted: SQL cannot express it. The stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
