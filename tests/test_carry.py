"""As-of carries against a brute-force search, over several bin widths."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from phasewright.operators.carry import Mark, asof, carry
from phasewright.operators.overlap import overlap_join, overlap_seconds
from tests.conftest import DAY, at, rows


def _brute(left, right, forward, strict):
    out = []
    for key, t in left:
        if forward:
            found = [r for k, r in right if k == key and (r > t if strict else r >= t)]
            out.append((key, t, min(found) if found else None))
        else:
            found = [r for k, r in right if k == key and (r < t if strict else r <= t)]
            out.append((key, t, max(found) if found else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("bin_seconds", [86_400, 3600, 600])
@pytest.mark.parametrize("forward,strict", [(False, False), (False, True), (True, False), (True, True)])
def test_asof_matches_brute_force(spark, bin_seconds, forward, strict):
    rng = random.Random(bin_seconds + forward * 2 + strict)
    base = at("0:00")
    # One key holds most rows; minutes make exact matches frequent; some fall outside the day.
    def draw(n):
        return [(rng.choice("aaaaab"), base + timedelta(minutes=rng.randint(-30, 1500))) for _ in range(n)]

    left, right = draw(150), list(set(draw(40)))
    ldf = spark.createDataFrame([(k, t, DAY) for k, t in left], "k string, t timestamp_ntz, Date date")
    rdf = spark.createDataFrame([(k, t, DAY) for k, t in right], "k string, r timestamp_ntz, Date date")
    out = asof(ldf, rdf, ["k", "Date"], "t", "r", [], forward=forward, strict=strict, bin_seconds=bin_seconds)
    assert sorted((tuple(x) for x in out.select("k", "t", "r").collect()), key=str) == _brute(left, right, forward, strict)


def test_asof_carries_values_and_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([("a", at("5:00"), DAY), ("a", at("9:30"), DAY)], "k string, t timestamp_ntz, Date date")
    right = spark.createDataFrame([("a", at("6:00"), 1, DAY), ("a", at("7:00"), 2, DAY)], "k string, r timestamp_ntz, v int, Date date")
    out = asof(left, right, ["k"], "t", "r", ["v"])
    assert rows(out, "t", "v") == [(at("5:00"), None), (at("9:30"), 2)]


def test_nothing_is_carried_into_another_day(spark):
    nxt = DAY.replace(day=3)
    df = spark.createDataFrame([("a", at("23:59"), 1, DAY), ("a", at("0:01", nxt), None, nxt)], "k string, t timestamp_ntz, v int, Date date")
    out = carry(df, ["k", "Date"], "t", [Mark("m", F.col("v").isNotNull(), F.col("v"))])
    assert rows(out, "t", "m") == [(at("23:59"), 1), (at("0:01", nxt), None)]


def test_day_key_is_required(spark):
    df = spark.createDataFrame([("a", at("1:00"), 1)], "k string, t timestamp_ntz, v int")
    with pytest.raises(ValueError):
        carry(df, ["k"], "t", [Mark("m", F.col("v").isNotNull(), F.col("v"))])


@pytest.mark.parametrize("bin_seconds", [30, 60, 3600])
def test_overlap_join_finds_each_pair_once(spark, bin_seconds):
    rng = random.Random(7)

    def spans(n):
        out = []
        for i in range(n):
            s = at("8:00") + timedelta(seconds=rng.randint(0, 600))
            out.append((i, "k", s, s + timedelta(seconds=rng.choice([0, 1, 45, 200]))))
        return out

    a, b = spans(30), spans(30)
    adf = spark.createDataFrame(a, "i int, k string, s timestamp_ntz, e timestamp_ntz")
    bdf = spark.createDataFrame(b, "j int, k string, s2 timestamp_ntz, e2 timestamp_ntz")
    out = overlap_join(adf, bdf, ["k"], ("s", "e"), ("s2", "e2"), bin_seconds=bin_seconds)
    want = sorted(
        (i, j, (min(e, e2) - max(s, s2)).total_seconds()) for i, _, s, e in a for j, _, s2, e2 in b if s <= e2 and s2 <= e
    )
    assert rows(out.select("i", "j", overlap_seconds(("s", "e"), ("s2", "e2")).alias("d"))) == want
