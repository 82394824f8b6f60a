"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 is clean, higher ones hold more of the language that marks toxic texts.
One weight vector serves every threshold: P(grade >= k) = logistic(w x - theta_k) with rising
thresholds, and the expected severity is the sum of these probabilities. The features (words and
beginnings of words) are chosen by a chi-square count over the training rows in Spark; the fit
runs on a bounded sample of labelled rows; scoring reads every text once.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasewright.llm.text import id_key, id_of, whole

_EDGE = string.punctuation + "…«»“”„’‘¡¿"
PREFIXES = (4, 5, 6)


@dataclass
class Model:
    """Weights by feature, rising thresholds, number of grades above 0."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [30.0])


def features(text: str | None) -> Counter:
    """Counts of words (``w:``) and of beginnings of longer words (``p:``), lower-cased, without outer punctuation."""
    words = Counter((text or "").lower().split())
    out: Counter = Counter()
    for raw, n in words.items():
        word = raw.strip(_EDGE)
        if word:
            out["w:" + word] += n
            for k in PREFIXES:
                if len(word) > k:
                    out["p:" + word[:k]] += n
    return out


def _seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(name, int(toxic)) for text, toxic in zip(batch["text"], batch["toxic"], strict=True) for name in features(text)]
        yield pd.DataFrame(rows, columns=["feature", "toxic"])


def _sparse(batches: Iterator[pd.DataFrame], place: dict[str, int]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            found = [(place[name], n) for name, n in features(text).items() if name in place]
            rows.append((int(toxic), [i for i, _ in found], [float(n) for _, n in found]))
        yield pd.DataFrame(rows, columns=["toxic", "index", "count"])


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def grade_cuts(hits: np.ndarray, grades: int) -> np.ndarray:
    """Rising cuts that split positive hit counts into ``grades`` groups of like size."""
    positive = hits[hits > 0]
    return np.unique(np.quantile(positive, np.arange(1, grades) / grades)) if len(positive) else np.empty(0)


def fit_cumulative(rows: list[np.ndarray], values: list[np.ndarray], grade: np.ndarray, n: int, ridge: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative logit model by full-batch Adam on the penalised likelihood."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)
    value = np.concatenate(values) if values else np.empty(0)
    top = int(grade.max())
    w, first, gaps = np.zeros(n), 0.0, np.zeros(max(0, top - 1))
    at_least = np.array([(grade >= k).mean() for k in range(1, top + 1)])
    logit = -np.log(at_least / (1 - at_least + 1e-9) + 1e-9)
    first, gaps = logit[0], np.log(np.maximum(np.diff(logit), 1e-2))
    params = np.concatenate([w, [first], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, first, gaps = params[:n], params[n], params[n + 1 :]
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        score = np.bincount(owner, value * w[index], len(rows))
        low, high = _logistic(score - edges[grade]), _logistic(score - edges[grade + 1])
        low[grade == 0], high[grade == top] = 1.0, 0.0
        p = np.maximum(low - high, 1e-12)
        by_score = (1.0 - low - high) / len(rows)
        by_theta = np.zeros(top)
        np.add.at(by_theta, grade[grade > 0] - 1, -(low * (1 - low) / p)[grade > 0] / len(rows))
        np.add.at(by_theta, grade[grade < top], (high * (1 - high) / p)[grade < top] / len(rows))
        later = np.cumsum(by_theta[::-1])[::-1]
        gradient = -np.concatenate([np.bincount(index, value * by_score[owner], n) - ridge * w, [later[0]], later[1:] * np.exp(gaps)])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        params = params - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return params[:n], params[n] + np.concatenate([[0.0], np.cumsum(np.exp(params[n + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, n_features: int = 2_000, grades: int = 3, seed: int = 5) -> Model:
    """Fit on at most ``max_rows`` labelled rows (the bound of what reaches the driver), drawn by a seeded hash of the id.

    ``labels`` has ``doc_id`` and ``toxic`` (0 or 1). Toxic rows get grades 1 to ``grades`` by how
    often features that mark toxic texts occur in them, in groups of like size. Null labels and
    ids are left out. Without both classes the model calls nothing toxic.
    """
    drawn = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rows))
    # at most max_rows pairs of numbers, whatever the size of the tables
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text")).join(F.broadcast(drawn), "doc_id").select("text", "toxic")
    totals = {r["toxic"]: r["n"] for r in drawn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model()
    clean, toxic = float(totals[0]), float(totals[1])
    a, b = F.col("t"), F.col("n") - F.col("t")
    chi = F.pow(a * clean - b * toxic, F.lit(2)) * (clean + toxic) / ((a + b) * (clean + toxic - a - b + 0.5) * clean * toxic)
    chosen = (
        train.mapInPandas(_seen, "feature string, toxic int").groupBy("feature").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
        .where("n >= 5").withColumn("chi", chi).orderBy(F.desc("chi"), "feature").limit(n_features).collect())
    names = [r["feature"] for r in chosen]
    place = {name: i for i, name in enumerate(names)}
    marks = np.array([r["t"] / r["n"] >= 0.9 and name.startswith(("w:", "p:")) for r, name in zip(chosen, names, strict=True)], bool)
    sparse = lambda batches: _sparse(batches, place)
    data = train.mapInPandas(sparse, "toxic int, index array<int>, count array<double>").limit(max_rows).collect()
    rows = [np.array(r["index"], np.int64) for r in data]
    counts = [np.array(r["count"], float) for r in data]
    label = np.array([r["toxic"] for r in data])
    hits = np.array([c[marks[i]].sum() if len(i) else 0.0 for i, c in zip(rows, counts, strict=True)]) * (label == 1)
    grade = np.where(label == 1, 1 + np.searchsorted(grade_cuts(hits, grades), hits), 0).astype(np.int64)
    order = {old: new for new, old in enumerate(sorted(set(grade.tolist())))}
    grade = np.array([order[g] for g in grade.tolist()], np.int64)
    if len(order) < 2:
        return Model()
    weights, thresholds = fit_cumulative(rows, [1.0 + np.log(c) for c in counts], grade, len(names))
    return Model({name: float(x) for name, x in zip(names, weights, strict=True)}, [float(x) for x in thresholds])


def _scored(batches: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    weights, thresholds = model.weights, np.array(model.thresholds)
    for batch in batches:
        score = np.array([sum(weights[name] * (1.0 + np.log(n)) for name, n in features(text).items() if name in weights) for text in batch["text"]], float)
        above = _logistic(score[:, None] - thresholds[None, :]) if len(score) else np.empty((0, len(thresholds)))
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "expected_severity": above.sum(axis=1), "p_toxic": above[:, 0], "grade": (above >= 0.5).sum(axis=1).astype(np.int32)})


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``expected_severity``, ``p_toxic`` (of grade 1 or more), ``grade``, ``toxic``.

    Whole texts are scored. Null and empty texts have no features and get what the thresholds say of none.
    """
    rows = docs.select(id_key(F.col(id_col)).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    run = lambda batches: _scored(batches, model)
    out = rows.mapInPandas(run, "doc_id long, expected_severity double, p_toxic double, grade int")
    return out.withColumns({"doc_id": id_of(F.col("doc_id")), "toxic": F.col("p_toxic") >= 0.5})


def drop_toxic(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text the model calls toxic."""

    def keep(texts: pd.Series) -> pd.Series:
        frame = next(_scored(iter([pd.DataFrame({"doc_id": 0, "text": texts})]), model))
        return frame["p_toxic"] < 0.5

    return docs.where(F.pandas_udf(keep, "boolean")(whole(F.col(text_col))))
