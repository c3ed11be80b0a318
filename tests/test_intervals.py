import random

import pytest
from pyspark.sql import functions as F

from strandwise.operators import intervals as I


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), s := rng.randint(0, 400), s + rng.randint(0, 30), i) for i in range(120)]
    return rows, spark.createDataFrame(rows, "k string, start long, `end` long, i long").repartition(3)


@pytest.mark.parametrize("slack", [0, 1, 5])
def test_merge(spans, slack):
    rows, df = spans
    want = []
    for k in "ab":
        now = None
        for _, s, e, _ in sorted(r for r in rows if r[0] == k):
            if now and s <= now[1] + slack:
                now = [now[0], max(now[1], e), now[2] + 1]
            else:
                if now:
                    want.append((k, *now))
                now = [s, e, 1]
        want.append((k, *now))
    assert sorted(map(tuple, I.merge_intervals(df, ["k"], slack=slack).collect())) == sorted(want)


@pytest.mark.parametrize("bucket", [1, 7, 1000])
def test_joins(spark, spans, bucket):
    rows, df = spans
    other = [(k, s + 3, e + 9, i) for k, s, e, i in rows if i % 5 == 0]
    b = spark.createDataFrame(other, "k string, s long, e long, j long")
    pairs = {(i, j) for k, s, e, i in rows for k2, s2, e2, j in other if k == k2 and s <= e2 and s2 <= e}
    got = [(r["i"], r["j"]) for r in I.interval_join(df, b, ["k"], ("start", "end"), ("s", "e"), bucket).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    for how in ("left_semi", "left_anti"):
        kept = {r["i"] for r in I.interval_join(df, b, ["k"], ("start", "end"), ("s", "e"), bucket, how).collect()}
        assert kept == {i for *_, i in rows if (i in {a for a, _ in pairs}) == (how == "left_semi")}
    points = spark.createDataFrame([(k, p) for k in "ab" for p in range(0, 450, 3)], "k string, p long")
    inside = {(k, p) for k in "ab" for p in range(0, 450, 3) if any(k == q and s <= p <= e for q, s, e, _ in rows)}
    assert {tuple(r) for r in I.point_in_interval(points, df, ["k"], "p", bucket).collect()} == inside
    out = {tuple(r) for r in I.point_in_interval(points, df, ["k"], "p", bucket, how="left_anti").collect()}
    assert len(out) + len(inside) == points.count() and not out & inside


def test_range_join_plans_no_nested_loop(spark, spans):
    _, df = spans
    points = spark.range(1000).selectExpr("'a' AS k", "id AS p")
    plan = I.point_in_interval(points, df, ["k"], "p", 50)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_islands_masks_and_fill(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 2, 3, 7, 9, 10, 10)], "k string, p long")
    assert sorted(map(tuple, I.gaps_islands(df, ["k"], "p", 2).collect())) == [("a", 1, 3, 3), ("a", 9, 10, 2)]
    filled = I.dense_fill(df.distinct().withColumn("n", F.lit(1)), ["k"], "p", 1, 10, {"n": 0}).orderBy("p").collect()
    assert [r["n"] for r in filled] == [1, 1, 1, 0, 0, 0, 1, 0, 1, 1]
    m = I.last_anchor_mask(df.distinct(), ["k"], ["p"], "p", F.col("p").isin(2, 9), 4).orderBy("p").collect()
    assert [(r["p"], r["masked"]) for r in m] == [(1, True), (2, False), (3, False), (7, True), (9, False), (10, False)]


def test_merge_ignores_row_order_and_partitions(spans):
    _, df = spans
    once = sorted(map(tuple, I.merge_intervals(df, ["k"]).collect()))
    assert once == sorted(map(tuple, I.merge_intervals(df.orderBy(F.rand(3)).repartition(7), ["k"]).collect()))
