"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on statistics of the labelled texts; every path from a root to a node is
a rule, a conjunction of comparisons. A lasso logistic regression on the rules keeps few of
them. The result is one Spark column expression: the score needs no model at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import LOWER, SPACE, UPPER, let, lines, strip, whole, words
from phasewright.session import stage

# Marks whose share is a statistic.
MARKS = "#*$%&|<>"
STOPS = ".,;:!?"


@dataclass(frozen=True)
class Rule:
    """Comparisons (statistic, is above, bound) that must all hold, and the weight of the rule."""

    parts: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, bound in self.parts:
            out = out & ((F.col(name) > bound) if above else (F.col(name) <= bound))
        return out


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of each whole text, one pass; a null or empty text has zeros."""
    text, own = whole(F.col(text_col)), F.col("_words")
    without = lambda marks: F.length("_text") - F.length(F.translate("_text", marks, ""))
    share = lambda part, of: (part / F.greatest(of, F.lit(1))).cast("double")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), words(F.col(text_col)).alias("_words"), F.filter(lines(F.col(text_col)), lambda x: strip(x) != "").alias("_lines"))
    rows = rows.withColumns({"_n": F.size(own), "_chars": F.length("_text"), "_rows": F.size("_lines")})
    adjacent = let(own, lambda w: F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))))
    return rows.select(
        "doc_id", F.col("_n").cast("double").alias("n_words"), F.col("_chars").cast("double").alias("n_chars"), F.col("_rows").cast("double").alias("n_lines"),
        share(F.length(F.translate("_text", SPACE, "")), F.col("_n")).alias("word_length"), share(without(MARKS), F.col("_n")).alias("marks_per_word"),
        share(without(STOPS), F.col("_n")).alias("stops_per_word"), share(without("!"), F.col("_n")).alias("calls_per_word"),
        share(without(UPPER), F.col("_chars")).alias("upper_share"), share(without(LOWER), F.col("_chars")).alias("lower_share"),
        share(without("0123456789"), F.col("_chars")).alias("digit_share"), share(F.size(F.array_distinct(own)), F.col("_n")).alias("distinct_share"),
        share(adjacent, F.col("_n")).alias("echo_share"), share(F.size(F.array_distinct("_lines")), F.col("_rows")).alias("distinct_lines"),
        share(F.col("_n"), F.col("_rows")).alias("words_per_line"), share(without("|"), F.col("_n")).alias("bars_per_word"),
        share(without("\n"), F.col("_n")).alias("breaks_per_word"), share(without("/:@_=\\{}[]()"), F.col("_n")).alias("code_per_word"))


def _paths(node, names: list[str], parts: tuple = ()) -> list[tuple]:
    """The rules of a tree: the way to every node below the root."""
    found = [parts] if parts else []
    if node.subtreeDepth() == 0:
        return found
    name, bound = names[node.split().featureIndex()], float(node.split().threshold())
    return found + _paths(node.leftChild(), names, (*parts, (name, False, bound))) + _paths(node.rightChild(), names, (*parts, (name, True, bound)))


def extract_rules(rows: DataFrame, names: list[str], label: str, trees: int, depth: int, seed: int) -> list[Rule]:
    """Different rules of a forest of shallow trees grown on ``rows``."""
    data = VectorAssembler(inputCols=names, outputCol="_x").transform(rows)
    forest = RandomForestClassifier(featuresCol="_x", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7, featureSubsetStrategy="onethird", minInstancesPerNode=10).fit(data)
    found = {tuple(sorted(set(path))) for tree in forest.trees for path in _paths(tree._java_obj.rootNode(), names)}
    return [Rule(parts) for parts in sorted(found)]


def fit_lasso(rows: DataFrame, rules: list[Rule], label: str, penalty: float) -> tuple[list[Rule], float]:
    """Rules with a weight other than 0, and the intercept."""
    columns = {f"_r{i}": rule.column().cast("double") for i, rule in enumerate(rules)}
    data = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(rows.withColumns(columns)).select(label, "_x")
    fitted = LogisticRegression(featuresCol="_x", labelCol=label, elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(data)
    weights = fitted.coefficients.toArray().tolist()
    return [Rule(rule.parts, w) for rule, w in zip(rules, weights, strict=True) if w], float(fitted.intercept)


def compile_score(rules: list[Rule], intercept: float) -> Column:
    """The probability of the good class as an expression over the statistics."""
    total = F.lit(intercept)
    for rule in rules:
        total = total + F.when(rule.column(), F.lit(rule.weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000, trees: int = 20, depth: int = 3, penalty: float = 0.0005, seed: int = 3) -> Column:
    """Score expression fitted on at most ``max_rows`` labelled rows (``doc_id``, ``quality`` 0 or 1), drawn by a seeded hash of the id.

    Null labels and ids are left out; without both classes the score is the share of the one
    there is, 0.5 without any; where no statistic tells them apart it is the share of the good one.
    """
    drawn = labels.select("doc_id", F.col("quality").cast("double").alias("quality")).where("doc_id IS NOT NULL AND quality IS NOT NULL")
    drawn = drawn.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rows)
    rows = stage(stats.join(drawn, "doc_id"), "rule-rows").repartition(8)
    classes = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return F.lit(float(next(iter(classes), 0.5)))
    names = [c for c in stats.columns if c != "doc_id"]
    found = extract_rules(rows, names, "quality", trees, depth, seed)
    if not found:
        return F.lit(classes[1.0] / sum(classes.values()))
    return compile_score(*fit_lasso(rows, found, "quality", penalty))


def held_out(doc_id: Column) -> Column:
    """Rows kept for evaluation: crc32 of the id as text leaves no remainder modulo 5; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, cut: float = 0.3, **settings) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from ``cut`` on).

    Labels of held-out rows are never read. Only ``doc_id`` and ``text`` of ``docs`` are; the id
    joins labels and is no input of the score.
    """
    stats = stage(statistics(docs), "statistics")
    score = fit(stats, labels.where(~held_out(F.col("doc_id"))), **settings)
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= cut).cast("int"))
