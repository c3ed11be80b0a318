import pytest
from pyspark.sql import functions as F

from strandwise.operators import cohort as C
from strandwise.operators import relational as R
from strandwise.operators.components import connected_components
from strandwise.operators.lift import LiftParams, lift_positions, spacer_offsets, to_local, unique_anchors


def test_checked_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    assert R.checked_one_to_one(a, a.withColumnRenamed("a", "b"), ["k"]).count() == 2
    for bad in (a.where("k = 1"), a.union(a)):
        with pytest.raises(Exception, match="not one to one"):
            R.checked_one_to_one(a, bad.withColumnRenamed("a", "b"), ["k"]).collect()
        assert R.mismatches(a, bad, ["k"]).count() > 0
    with pytest.raises(Exception, match="other keys"):
        R.aligned(a, a.where("k = 1").select("k"), ["k"]).collect()


def test_closure_and_components(spark):
    edges = spark.createDataFrame([(2, 1), (3, 1), (4, 2), (5, 4), (9, 8)], "child int, parent int")
    got = {(r["node"], r["depth"]) for r in R.closure(edges, spark.createDataFrame([(2,)], "child int")).collect()}
    assert got == {(2, 0), (4, 1), (5, 2)}
    assert {r["node"] for r in R.ancestors(edges, spark.createDataFrame([(5,)], "child int")).collect()} == {5, 4, 2, 1}
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a int, b int")).collect()}
    assert roots == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_verdicts(spark):
    df = spark.createDataFrame([(1, 5.0, 95.0, 1.0), (2, 50.0, 95.0, 1.0), (3, None, None, None), (4, 50.0, 95.0, None)], "i int, depth double, breadth double, dup double")
    f = C.qc_flags({"depth": F.col("depth"), "breadth": F.col("breadth"), "dup": F.col("dup") * 50})
    got = {r["i"]: (r["f"], r["v"]) for r in df.select("i", f.alias("f")).withColumn("v", C.verdict(F.col("f"))).collect()}
    assert got == {1: (["LOW_DEPTH", "HIGH_DUP"], "FAIL"), 2: (["HIGH_DUP"], "WARN"), 3: (["NO_DATA"], "FAIL"), 4: ([], "PASS")}
    for text, want in (("> 3", [4]), ("2-3", [2, 3]), ("2 to 3", [2, 3]), ("=1", [1]), ("4", [4])):
        assert sorted(r["i"] for r in df.where(C.compile_filter(F.col("i"), text)).collect()) == want


def test_lift(spark):
    import random

    rng = random.Random(0)
    src = "".join(rng.choice("ACGT") for _ in range(3000))
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    tgt = src[:1000] + src[1040:2000] + "ACGTACG" + flip(src[2000:])
    p = LiftParams(k=15, min_chain=5)
    s, t = (spark.createDataFrame([("c", x)], "contig string, seq string") for x in (src, tgt))
    assert unique_anchors(s, t, p).where("strand = '-'").count() > 500
    places = list(range(50, 2950, 37))
    got = {r["pos"]: (r["tgt_pos"], r["strand"]) for r in lift_positions(spark.createDataFrame([("c", x) for x in places], "contig string, pos long"), s, t, p).collect()}
    for x, (y, strand) in got.items():
        want = x if x <= 1000 else x - 40 if x <= 2000 else len(tgt) - (x - 2001)
        assert (y, strand) == (want, "-" if x > 2000 else "+"), x
    assert len(got) >= 0.85 * len(places)
    layout = spark.createDataFrame(spacer_offsets([("a", 50), ("b", 70)], 10), "contig string, first long, last long")
    local = {r["pos"]: (r["contig"], r["local"]) for r in to_local(spark.createDataFrame([(1,), (50,), (55,), (61,)], "pos long"), layout, bucket=16).collect()}
    assert local == {1: ("a", 1), 50: ("a", 50), 61: ("b", 1)}


def test_staged_tables(spark):
    from strandwise.session import drop_staged, staged

    df = staged(spark.range(5).where("id > 9"), "none")
    assert df.count() == 0 and df.columns == ["id"]
    drop_staged(spark)
