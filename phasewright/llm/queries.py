"""Registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasewright.llm import codes, decontam, exact, forest, html, licenses, line_quality, lines, mixing, negatives, rules, suffixes, toxicity
from phasewright.llm import sql as S
from phasewright.llm.text import whole


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _sha256(text):
    return F.sha2(whole(text).cast("binary"), 256)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return rules.classify(_documents(spark, folder), _table(spark, folder, "labels"), cut=0.3)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_documents(spark, folder))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text")
    out = lines.with_bitmaps(docs, min_chars=40, min_docs=5)
    text = F.when(F.col("n_dropped") > 0, lines.kept_text(F.col("text"), F.col("keep_runs"))).otherwise(F.col("text"))
    return out.select("doc_id", "n_lines", "n_dropped", _sha256(text).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _documents(spark, folder), _table(spark, folder, "labels")
    held = rules.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.where(~held))
    return toxicity.score(docs, model).withColumn("held_out", held)


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return forest.near_duplicates(_documents(spark, folder), percent=85)


def op6_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    out = suffixes.remove_repeats(_documents(spark, folder), window=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks_by_document(_documents(spark, folder), _table(spark, folder, "benchmark"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.quality_rules(_documents(spark, folder))


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(_table(spark, folder, "pages"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, folder, "embeddings").withColumn("label", shifted))


def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(_documents(spark, folder))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compress(_table(spark, folder, "embeddings"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_license_scan": op2_license_scan,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_repeated_strings": op6_repeated_strings,
    "op7_decontamination": op7_decontamination,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_main_text": op10_main_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES = {
    "op3_line_dedup": S.LINE_DEDUP, "op8_mixing": S.MIXING, "op9_quality_rules": S.QUALITY_RULES,
    "op11_hard_negatives": S.HARD_NEGATIVES, "op12_exact_dedup": S.EXACT_DEDUP, "op13_vector_codes": S.vector_codes(),
}
