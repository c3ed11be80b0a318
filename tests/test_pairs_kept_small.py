"""Joins whose pairs are counted, not kept."""

import random

from strandwise.operators import intervals as I
from strandwise.operators import taxonomy as X
from pyspark.sql import functions as F


def test_argmin_searches_alike_rows_once(spark):
    rng = random.Random(2)
    left = [(n, rng.randint(0, 1), rng.randint(0, 20)) for n in range(200)] + [(500, None, 3)]
    right = [(m, rng.randint(0, 1), s, s + rng.randint(-1, 8)) for m in range(30) for s in [rng.randint(0, 20)]]
    a, b = spark.createDataFrame(left, "n long, k int, p long"), spark.createDataFrame(right, "m long, k int, s long, e long")
    cost = F.abs(F.col("p") - F.col("s"))
    out = I.bucket_argmin(a, b, ["k"], "p", ("s", "e"), 5, cost, ["n"], ["m"], reads=[]).select("n", "m", "s", "e")
    want = {(n, *min(((abs(p - s), m, s, e) for m, j, s, e in right if j == k and s <= p <= e), default=())[1:]) for n, k, p in left if any(j == k and s <= p <= e for _, j, s, e in right)}
    assert {tuple(r) for r in out.collect()} == want
    assert {tuple(r) for r in I.bucket_argmin(a, b, ["k"], "p", ("s", "e"), 5, cost, ["n"], ["m"]).select("n", "m", "s", "e").collect()} == want
    assert "least" in out._jdf.queryExecution().analyzed().toString()


def test_tract_annotation_makes_no_list_of_pairs(spark):
    tr = spark.createDataFrame([("t", "c", 1, 100)], "tract string, contig string, start long, `end` long")
    ft = spark.createDataFrame([("c", i % 90, i % 90 + 5, f"g{i % 3}") for i in range(900)], "contig string, start long, `end` long, name string")
    cg = spark.createDataFrame([("c", i % 50 + 1, ("synonymous", "nonsynonymous", "other")[i % 3], f"L{i % 2}") for i in range(600)], "contig string, pos long, change string, label string")
    out = X.tract_annotation(tr, ft, cg, 16)
    assert tuple(out.select("genes", "n_syn", "n_nonsyn", "changes").first()) == ("g0,g1,g2", 200, 200, "L0,L1")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(" not in plan and "array_distinct(" not in plan
