"""Operators on empty frames, and properties that don't depend on the order of rows."""

import pytest
from pyspark.sql import functions as F

from strandwise.operators import cohort as C
from strandwise.operators import intervals as I
from strandwise.operators import kernels as K
from strandwise.operators import stats as ST
from strandwise.operators import variants as V


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "k string, start long, `end` long, pos long, v double, w double, i long")


def test_empty_frames(none):
    assert I.merge_intervals(none, ["k"]).count() == 0
    assert I.gaps_islands(none, ["k"], "pos").count() == 0
    assert I.point_in_interval(none, none, ["k"], "pos", 10).count() == 0
    assert I.dense_fill(none.select("k", "pos", "v"), ["k"], "pos", 1, 3, {"v": 0.0}).count() == 0
    assert ST.robust_stats(none, ["k"], "v").count() == 0
    assert ST.bh_fdr(none, ["k"], "v", ["i"]).count() == 0
    assert ST.spearman(none, ["k"], "v", "w").count() == 0
    assert C.depleted_runs(none, ["k"], "pos", "v", "w").count() == 0
    assert K.founder_clusters(none, ["k"], "start", "end", "i").count() == 0
    assert K.chains(none, ["k"], "start", "end").count() == 0
    assert V.copy_number(none, none.selectExpr("v AS genome_depth"), ["k"], "v").count() == 0


def test_nulls_stay_out(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, 2.0), ("a", 3.0, 4.0), (None, 1.0, 1.0)], "k string, v double, w double")
    got = {r["k"]: r["n"] for r in ST.spearman(df, ["k"], "v", "w").collect()}
    assert got == {"a": 1, None: 1}
    assert df.where(C.compile_filter(F.col("v"), ">2")).count() == 1


def test_order_and_partitions_do_not_matter(spark):
    rows = [(f"s{i % 5}", i, float(i * 7 % 31), float(i * 11 % 17)) for i in range(200)]
    a = spark.createDataFrame(rows, "k string, i long, v double, w double")
    b = spark.createDataFrame(rows[::-1], a.schema).repartition(7)
    for f in (
        lambda d: ST.robust_z(d, ["k"], "v").select("i", F.round("z", 9).alias("z")),
        lambda d: ST.rank_avg(d, ["k"], "w").select("i", "rank"),
        lambda d: C.rank_donors(d, ["k"], ("w", "v"), "v", "i"),
        lambda d: ST.mode_with_tie(d, ["k"], "w"),
    ):
        assert sorted(map(tuple, f(a).collect()), key=str) == sorted(map(tuple, f(b).collect()), key=str)


def test_deeper_is_never_worse(spark):
    df = spark.range(60).select(F.col("id").cast("double").alias("dp"))
    verdict = {r["dp"]: r["v"] for r in df.select("dp", C.verdict(C.qc_flags({"depth": F.col("dp"), "breadth": F.lit(99.0)})).alias("v")).collect()}
    rank = {"FAIL": 0, "WARN": 1, "PASS": 2}
    own = [rank[verdict[float(d)]] for d in range(60)]
    assert own == sorted(own) and own[0] == 0 and own[-1] == 2
