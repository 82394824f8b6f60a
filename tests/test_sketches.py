"""Quantile sketches against exact percentiles."""

import random

from pyspark.sql import functions as F

from phasewright.functions import sketches as K
from phasewright.operators import measures as M
from tests.conftest import rows


def test_merged_sketches_keep_their_error(spark):
    draw = random.Random(8)
    data = [(g, d, draw.lognormvariate(0, 1) if g == 1 else float(draw.randrange(5))) for g in (1, 2) for d in range(30) for _ in range(400)]
    values = spark.createDataFrame(data, "g int, d int, v double")
    daily = values.groupBy("g", "d").agg(K.sketch("v").alias("s"))
    for q in (0.0, 0.5, 0.95, 1.0):
        whole = daily.groupBy("g").agg(K.merged("s").alias("s")).select("g", K.quantile("s", q).alias("p"), K.seen("s").alias("n"))
        assert rows(whole, "g", "n") == [(1, 12_000), (2, 12_000)]
        assert all(r["error"] <= K.rank_error(200) for r in K.rank_errors(values, whole, ["g"], "v", "p", q).collect())


def test_nulls_and_nothing(spark):
    values = spark.createDataFrame([(1, None), (2, 3.0), (2, None)], "g int, v double")
    out = values.groupBy("g").agg(K.sketch("v").alias("s")).select("g", K.quantile("s", 0.5).alias("p"), K.seen("s").alias("n"))
    assert rows(out) == [(1, None, 0), (2, 3.0, 1)]
    assert K.rank_error(200) < 0.0134 and K.rank_error() < K.rank_error(200)


def test_days_of_actuations_merge_by_week(spark, log):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-14')) AS Date")
    detections = days.crossJoin(spark.range(1, 4).select(F.col("id").cast("int").alias("Detector"))).crossJoin(spark.range(1, 101).select(F.col("id").cast("double").alias("DetDuration")))
    detections = detections.withColumns({"SignalID": F.lit("1"), "Phase": F.lit(2)})
    config = spark.createDataFrame([("1", 2, 1), ("1", 2, 2)], "SignalID string, CallPhase int, Detector int")
    daily = M.actuation_sketches(detections, config)
    assert daily.count() == 28
    weekly = daily.groupBy("Detector", F.weekofyear("Date").alias("w")).agg(K.merged("sketch").alias("s")).select("Detector", "w", K.quantile("s", 0.95).alias("p"), K.seen("s").alias("n"))
    assert all(abs(p - 95) <= 2 and n == 700 for _, _, p, n in rows(weekly))
