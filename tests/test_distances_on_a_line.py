"""Nearest nodes and forests on a line against all pairs, and that no pairs are made."""

import random

from strandwise.operators import kernels as K
from strandwise.operators.linkage import leaf_order, line_forest, minimum_forest
from strandwise.operators.relational import nearest_on_line


def test_nearest_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(n, rng.randint(0, 1), rng.randint(0, 2), rng.randint(0, 40)) for n in rng.sample(range(300), 60)] + [(900, 7, 0, 5), (901, 8, 1, 3), (902, 8, 1, 3)]
    df = spark.createDataFrame(rows, "n long, k int, g int, p long")
    out = nearest_on_line(df, ["k"], "n", "g", "p")
    assert "NestedLoop" not in out._jdf.queryExecution().toString()
    want = set()
    for n, k, g, p in rows:
        mates = [(abs(p - q), m, h) for m, j, h, q in rows if j == k and m != n]
        if mates:
            i, x = min(((d, m) for d, m, h in mates if h == g), default=(None, None)), min(((d, m) for d, m, h in mates if h != g), default=(None, None))
            want.add((n, i[1], i[0], x[1], x[0]))
    assert {tuple(r) for r in out.collect()} == want


def test_forest_of_a_line(spark):
    rng = random.Random(6)
    rows = [(n, rng.randint(0, 1), rng.choice([rng.randint(0, 90), 17])) for n in rng.sample(range(200), 50)] + [(999, 0, 500), (998, 5, 1), (997, None, 3)]
    pairs = [(a, b, abs(x - y)) for a, g, x in rows for b, h, y in rows if a < b and g == h and g is not None and abs(x - y) <= 3]
    df = spark.createDataFrame(rows, "n long, g int, x long")
    edges, roots = line_forest(df, ["g"], "n", "x", 3)
    assert edges.count() < len(rows) < len(pairs)
    all_ = spark.createDataFrame(pairs, "a long, b long, d long")
    assert {tuple(r) for r in edges.collect()} == {tuple(r) for r in minimum_forest(all_).collect()}
    got = leaf_order(edges, df.select(df.n.alias("node")), roots).orderBy("nth").collect()
    assert [r["node"] for r in got] == K.leaf_order(pairs, [n for n, _, _ in rows])
