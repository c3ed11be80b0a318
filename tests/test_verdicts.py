"""Verdicts of modern and ancient samples in one table, live thresholds, placeholders and outliers."""

import math

from pyspark.sql import functions as F

from strandwise.operators import cohort as C
from strandwise.operators import matrix as M
from strandwise.operators import relational as R
from strandwise.operators import variants as V

NAMES = ("depth", "breadth", "missing", "mapping", "dup", "iupac", "titv", "snp_z", "het", "hom", "damage")


def flags(spark, p=C.QcThresholds(), **kw):
    row = {"depth": 50.0, "breadth": 99.0, "missing": 1.0, "mapping": 99.0, "dup": 1.0, "iupac": 0.0, "titv": None, "snp_z": 0.0, "het": 0.0, "hom": 100.0, "damage": None, "ancient": False} | kw
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'boolean' if k == 'ancient' else 'double'}" for k in row))
    return df.select(C.qc_flags({k: F.col(k) for k in (*NAMES, "ancient")}, p)).first()[0]


def test_each_kind_has_its_own_thresholds(spark):
    assert flags(spark, damage=0.01) == []  # a modern sample has no damage to show
    assert flags(spark, damage=0.01, ancient=True) == ["DAMAGE_LOW"]
    assert flags(spark, damage=0.2, ancient=True) == []
    assert flags(spark, het=50.0, hom=50.0) == ["HET_HIGH"] and flags(spark, het=50.0, hom=50.0, ancient=True) == []
    assert flags(spark, snp_z=-9.0) == ["SNP_LOW"] and flags(spark, snp_z=9.0) == ["SNP_HIGH"] and flags(spark, snp_z=-9.0, ancient=True) == []
    assert flags(spark, depth=5.0, missing=50.0) == ["LOW_DEPTH", "HIGH_MISSING"] and flags(spark, depth=5.0, missing=50.0, ancient=True) == []
    assert flags(spark, titv=1.0) == [] and flags(spark, C.QcThresholds(titv=1.5), titv=1.0) == ["TITV_LOW"]
    assert flags(spark, depth=None, breadth=None, missing=None, mapping=None, ancient=True) == ["NO_DATA"]
    assert flags(spark, ancient=None, het=50.0, hom=50.0) == ["HET_HIGH"]


def test_live_thresholds_are_the_viewers(spark):
    one = spark.createDataFrame([(4.0, 40.0)], "z double, a double")
    c = {"high_z": F.col("z"), "annotated": F.col("a")}
    assert one.select(C.live_flags(c)).first()[0] == ["HIGH_IMPACT_EXCESS", "ANNOTATION_POOR"]
    assert one.select(C.live_flags(c, C.LiveThresholds(high_z=5, annotated=30))).first()[0] == []


def test_placeholders_only_without_a_match(spark):
    left = spark.createDataFrame([(1, math.nan), (2, 1.0), (3, None)], "k int, own double")
    right = spark.createDataFrame([(1, None), (2, math.nan)], "k int, v double")
    got = {r["k"]: (r["own"], r["v"]) for r in R.left_with_placeholder(left, right, ["k"], {"v": -1.0}).collect()}
    assert math.isnan(got[1][0]) and got[1][1] is None and math.isnan(got[2][1]) and got[3] == (None, -1.0)


def test_outliers_where_most_rows_are_equal(spark):
    rows = [(i, 1.0, 1.0) for i in range(30)] + [(30, 2.0, 1.0), (31, 9.0, -8.0), (32, -3.0, 6.0)]
    df = spark.createDataFrame(rows, "i int, x double, y double")
    got = {r["i"]: (r["d2"], r["outlier"]) for r in M.mahalanobis(df, "i", ["x", "y"]).collect()}
    d2 = [v for v, _ in got.values()]
    mean = sum(d2) / len(d2)
    cut = sorted(d2)[16] + 3 * (sum((v - mean) ** 2 for v in d2) / len(d2)) ** 0.5
    assert all(o == (v > cut) for v, o in got.values()) and not got[30][1]
    assert not any(r["outlier"] for r in M.mahalanobis(df.where("i < 9"), "i", ["x", "y"]).collect())


def test_copies_over_the_genome(spark):
    sites = spark.createDataFrame([("s", "l", 30), ("s", "l", 34), ("s", "l", 2), ("s", "m", 1), ("t", "l", 30)], "sample string, locus string, dp int")
    genome = spark.createDataFrame([("s", 16.0), ("t", 0.0)], "sample string, genome_depth double")
    got = {(r["sample"], r["locus"]): (r["ratio"], r["copies"], r["expected_af"]) for r in V.copy_number(sites, genome, ["locus"], "dp", ["sample"]).collect()}
    assert got == {("s", "l"): (2.0, 2, 0.5), ("s", "m"): (None, None, None), ("t", "l"): (None, None, None)}


def test_rank_donors(spark):
    """Spans that overlap are one candidate; the best score per marker decides."""
    rows = [("e", "a", 10, 20, 40.0, 4), ("e", "b", 18, 30, 60.0, 4), ("e", "c", 50, 60, 20.0, 2), ("e", "d", None, None, None, 3), ("f", "x", 1, 5, 9.0, 3), ("f", "y", 7, 9, 8.0, 3), ("g", "s", 1, 2, 5.0, 1), ("h", "n", None, 7, 5.0, 0), ("h", "m", 1, 3, None, 2)]
    df = spark.createDataFrame(rows, "event string, row string, s int, z int, bf double, n int").repartition(3)
    got = {r["row"]: (r["donor_rank"], r["n_donors"], r["margin"], r["is_representative"], r["donor_call"]) for r in C.rank_donors(df, ["event"], ("s", "z"), "bf", "n").collect()}
    assert got["a"] == (1, 3, 5.0, False, "resolved") and got["b"] == (1, 3, 5.0, True, "resolved")
    assert got["c"] == (2, 3, 5.0, False, "ambiguous") and got["d"] == (3, 3, 5.0, False, "ambiguous")
    assert got["x"][0] == 1 and got["x"][4] == got["y"][4] == "ambiguous" and abs(got["x"][2] - 1 / 3) < 1e-12
    assert got["s"] == (1, 1, None, True, "only candidate")
    assert got["m"][1:3] == (2, None) and {got["m"][0], got["n"][0]} == {1, 2}
