"""Totals, ranks and quantiles in blocks give what a window over the group gives."""

import numpy as np
import pytest

from strandwise.operators import ordered as O
from strandwise.operators import stats as ST


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    rows = [(None if k == 2 else int(k), float(v), i) for i, (k, v) in enumerate(zip(rng.integers(0, 3, 400), rng.integers(0, 60, 400), strict=True))]
    return rows, spark.createDataFrame(rows, "k int, v double, i int").repartition(5)


@pytest.mark.parametrize("how", ["sum", "min", "max"])
@pytest.mark.parametrize("backwards", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running(frame, how, backwards, inclusive):
    rows, df = frame
    got = {(r["k"], r["i"]): r["x"] for r in O.running(O.in_blocks(df, ["k"], ["v", "i"]), ["k"], ["v", "i"], "v", "x", how, backwards, inclusive).collect()}
    fold = {"sum": sum, "min": min, "max": max}[how]
    for k in (None, 0, 1):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]), reverse=backwards)
        for n, r in enumerate(own):
            upto = [x[1] for x in own[: n + inclusive]]
            assert got[k, r[2]] == (fold(upto) if upto else 0.0 if how == "sum" else None)


def test_quantiles(frame):
    rows, df = frame
    got = {r["k"]: r for r in O.exact_quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.5, "c": 1.0}).collect()}
    up = {r["k"]: r["m"] for r in O.upper_medians(df, ["k"], "v", "m").collect()}
    for k in (None, 0, 1):
        own = sorted(r[1] for r in rows if r[0] == k)
        assert [got[k][c] for c in "abc"] == pytest.approx(np.quantile(own, [0.25, 0.5, 1.0]).tolist())
        assert up[k] == own[len(own) // 2]
    assert O.exact_quantiles(df.where("k > 9"), ["k"], "v", {"a": 0.5}).count() == 0
    assert O.exact_quantiles(df, [], "v", {"a": 0.5}).first()["a"] == np.median([r[1] for r in rows])


def test_fdr_without_p(spark):
    df = spark.createDataFrame([(1, 0.01, 1), (1, None, 2), (1, 0.04, 3), (1, 0.03, 4)], "k int, p double, i int")
    q = {r["i"]: r["q"] for r in ST.bh_fdr(df, ["k"], "p", ["i"]).collect()}
    assert q[2] is None and [q[1], q[4], q[3]] == pytest.approx([0.03, 0.04, 0.04])


def test_spearman_without_keys(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 7)) for i in range(12)], "x double, y double")
    r = ST.spearman(df, [], "x", "y").first()
    import pandas as pd

    p = df.toPandas()
    assert r["n"] == 12 and r["rho"] == pytest.approx(pd.DataFrame(p).rank().corr().iloc[0, 1])
