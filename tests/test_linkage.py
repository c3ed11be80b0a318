"""Forest and leaf order against the plain ones."""

import random

import pytest

from strandwise.operators import kernels as K
from strandwise.operators.linkage import leaf_order, minimum_forest


def plain_forest(pairs):
    up, out = {}, []

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b, d in sorted(pairs, key=lambda e: (e[2], e[0], e[1])):
        if find(a) != find(b):
            up[find(a)] = find(b)
            out.append((a, b, d))
    return sorted(out)


@pytest.mark.parametrize("seed, ties", [(1, 3), (2, 1000), (3, 1)])
def test_against_kruskal(spark, seed, ties):
    rng = random.Random(seed)
    names = [f"s{i:02d}" for i in range(26)]
    pairs = [(a, b, float(rng.randint(1, ties))) for i, a in enumerate(names[:24]) for b in names[i + 1 : 24] if (i < 12) == (names.index(b) < 12) and rng.random() < 0.5]
    pairs = [(b, a, d) if rng.random() < 0.3 else (a, b, d) for a, b, d in pairs]
    df = spark.createDataFrame(pairs + [("s00", "s00", 0.0), (None, "s01", 0.0), ("s00", "s01", None)], "a string, b string, d double").repartition(4)
    assert sorted(map(tuple, minimum_forest(df).collect())) == plain_forest(pairs)
    nodes = spark.createDataFrame([(n,) for n in names + names[:3] + [None]], "node string")
    got = [r["node"] for r in leaf_order(df, nodes).orderBy("nth").collect()]
    assert got == K.leaf_order(pairs, names)


def test_empty(spark):
    none = spark.createDataFrame([], "a long, b long, d double")
    assert minimum_forest(none).count() == 0 and leaf_order(none, spark.createDataFrame([], "node long")).count() == 0
    got = leaf_order(none, spark.createDataFrame([(2,), (1,)], "node long")).orderBy("nth").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1), (2, 2, 2)]


def test_query(spark):
    import os

    from strandwise.plans import catalogue

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    rows = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_nationkey", "c_acctbal").collect()
    pairs = [(a["c_custkey"], b["c_custkey"], abs(round(a["c_acctbal"] * 100) - round(b["c_acctbal"] * 100))) for a in rows for b in rows if a["c_custkey"] < b["c_custkey"] and a["c_nationkey"] == b["c_nationkey"] and abs(round(a["c_acctbal"] * 100) - round(b["c_acctbal"] * 100)) <= 100_000]
    got = [r["node"] for r in catalogue.QUERIES["leaf_order"](spark, folder).orderBy("nth").collect()]
    assert got == K.leaf_order(pairs, [r["c_custkey"] for r in rows])
