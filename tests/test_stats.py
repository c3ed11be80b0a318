import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise.operators import matrix as M
from strandwise.operators import stats as ST


def test_distributions_against_tables():
    assert ST.student_p(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert ST.student_p(12.7062, 1) == pytest.approx(0.05, abs=1e-5)
    assert ST.student_p(0.0, 7) == pytest.approx(1.0)
    assert ST.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert ST.chi2_tail(18.307038, 10) == pytest.approx(0.05, abs=1e-6)
    assert ST.chi2_tail(2 * math.log(10), 2) == pytest.approx(0.1, abs=1e-12)
    # known quantiles, closed forms, and far tails
    assert ST.student_p(4.587, 10) == pytest.approx(0.001, rel=1e-3) and ST.student_p(2.5758293, 1e7) == pytest.approx(0.01, rel=1e-5)
    for t in (0.3, 1.0, 7.0, 200.0):
        assert ST.student_p(t, 1) == pytest.approx(2 / math.pi * math.atan2(1, t), rel=1e-12) == ST.student_p(-t, 1)
        assert ST.student_p(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t) if t < 10 else 2 / (t * t + 2 + t * math.sqrt(t * t + 2)), rel=1e-9)
    assert ST.student_p(60.0, 40) == pytest.approx(8.310990424e-41, rel=1e-6) and 0 <= ST.student_p(40.0, 5000) < 1e-300
    assert ST.chi2_tail(0.0, 3) == 1.0 and ST.chi2_tail(10.827566, 1) == pytest.approx(0.001, rel=1e-6) and ST.chi2_tail(124.342113, 100) == pytest.approx(0.05, rel=1e-6)
    assert ST.chi2_tail(400.0, 2) == pytest.approx(math.exp(-200), rel=1e-9) and ST.chi2_tail(2000.0, 2001) == pytest.approx(0.5, abs=0.02)
    assert ST.chi2_quantile_975(2) == pytest.approx(7.378, rel=0.01)


def test_robust_fallbacks(spark):
    df = spark.createDataFrame([("flat", 1.0)] * 5 + [("spike", 1.0)] * 9 + [("spike", 5.0)] + [("even", float(x)) for x in range(4)], "k string, v double")
    got = {r["k"]: r for r in ST.robust_stats(df, ["k"], "v").collect()}
    assert got["flat"]["sigma"] == 1.0
    assert got["spike"]["sigma"] == pytest.approx(np.std([1.0] * 9 + [5.0]))
    near = {r["k"]: r["med"] for r in ST.robust_stats(df, ["k"], "v", accuracy=1000).collect()}
    assert near["flat"] == near["spike"] == 1.0 and near["even"] in (1.0, 2.0)
    assert got["even"]["med"] == 1.5 and got["even"]["sigma"] == pytest.approx(1.4826)


def test_ranks_kruskal_and_fdr(spark):
    df = spark.createDataFrame([("x", g, float(v)) for g, own in (("a", [1, 2, 2]), ("b", [3, 4, 4]), ("c", [5, 6, 7])) for v in own], "k string, g string, v double")
    r = sorted((x["v"], x["rank"]) for x in ST.rank_avg(df, ["k"], "v").collect())
    assert [b for _, b in r] == [1, 2.5, 2.5, 4, 5.5, 5.5, 7, 8, 9]
    h = ST.kruskal_h(df, ["k"], "g", "v").first()
    ranks = {"a": 6, "b": 15, "c": 24}
    plain = 12 / 90 * sum(s * s / 3 for s in ranks.values()) - 30
    assert h["h"] == pytest.approx(plain / (1 - 12 / (729 - 9))) and h["df"] == 2
    p = spark.createDataFrame([("f", i, x) for i, x in enumerate([0.01, 0.04, 0.03, 0.5])], "k string, i int, p double")
    q = {x["i"]: x["q"] for x in ST.bh_fdr(p, ["k"], "p", ["i"]).collect()}
    assert q == {0: pytest.approx(0.04), 1: pytest.approx(0.16 / 3), 2: pytest.approx(0.16 / 3), 3: pytest.approx(0.5)}


def test_spearman_p(spark):
    df = spark.createDataFrame([(0.5, 20), (1.0, 9), (None, 5), (0.3, 3)], "rho double, n long")
    got = [r["p"] for r in ST.spearman_p(df).collect()]
    assert got[0] == pytest.approx(ST.student_p(0.5 * (18 / 0.75) ** 0.5, 18)) and got[1] == 0.0 and got[2] is None and got[3] is None


def test_axes_and_distances(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 1, 0], [0, 0, 0.3]])
    x[0] = [40, -40, 9]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "i long, a double, b double, c double").withColumn("gone", F.lit(None).cast("double"))
    z, kept = M.robust_columns(df, ["a", "b", "c", "gone"])
    assert kept == ["a", "b", "c"]
    zz = np.array([[r[c] for c in kept] for r in z.orderBy("i").collect()])
    pc = np.array([[r["pc1"], r["pc2"]] for r in M.principal_axes(df, "i", ["a", "b", "c", "gone"]).orderBy("i").collect()])
    values, vectors = np.linalg.eigh(np.cov(zz.T))
    want = (zz - zz.mean(axis=0)) @ vectors[:, ::-1][:, :2]
    for k in range(2):
        assert abs(np.corrcoef(pc[:, k], want[:, k])[0, 1]) > 0.999
    d = {r["i"]: r for r in M.mahalanobis(df, "i", ["a", "b", "c"]).collect()}
    assert d[0]["outlier"] and d[0]["d2"] == max(r["d2"] for r in d.values())
    assert len(values) == 3


def test_weighted_mean_and_density(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 4.0, 2.0), ("b", 3.0, 0.0), ("b", 5.0, None), ("c", None, 2.0), ("c", 2.0, 2.0)], "k string, v double, w double")
    got = {r["k"]: r["m"] for r in df.groupBy("k").agg(ST.weighted_mean(F.col("v"), F.col("w")).alias("m")).collect()}
    assert got == {"a": 3.0, "b": 4.0, "c": 2.0}
    rng = random.Random(0)
    w = [("k", i, float(i), rng.random()) for i in range(50)]
    d = ST.highest_density(spark.createDataFrame(w, "k string, i int, v double, w double"), ["k"], "v", "w", ["i"], 0.5).first()
    own = sorted(w, key=lambda x: -x[3])
    total, run, kept = sum(x[3] for x in w), 0.0, []
    for x in own:
        if run / total >= 0.5:
            break
        kept.append(x[2])
        run += x[3]
    assert (d["low"], d["high"]) == (min(kept), max(kept))
