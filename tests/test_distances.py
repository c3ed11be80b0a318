"""Distances by bit planes, and depleted runs, against plain versions."""

import random

import pytest

from strandwise.operators import cohort as C
from strandwise.operators.distances import DistanceParams, plane_distances, planes_of_bases, planes_of_sequences


def plain(seqs):
    out = {}
    names = sorted(seqs)
    variable = [i for i in range(max(map(len, seqs.values()))) if len({s[i].upper() for s in seqs.values() if i < len(s)} & set("ACGT")) > 1]
    for x, a in enumerate(names):
        for b in names[x + 1 :]:
            both = [(seqs[a][i].upper(), seqs[b][i].upper()) for i in variable if i < min(len(seqs[a]), len(seqs[b])) and {seqs[a][i].upper(), seqs[b][i].upper()} <= set("ACGT")]
            if both:
                out[a, b] = (sum(p != q for p, q in both), len(both))
    return out


@pytest.mark.parametrize("tile, block", [(16, 3), (1 << 15, 64), (40, 1)])
def test_against_loops(spark, tile, block):
    rng = random.Random(tile)
    base = [rng.choice("ACGT") for _ in range(130)]
    groups = {g: {f"{g}{i}": "".join(rng.choice("ACGTacgtNRX-") if rng.random() < 0.15 else b for b in base) for i in range(9)} for g in "pq"}
    rows = [(g, s, q) for g, own in groups.items() for s, q in own.items()] + [("p", "bare", "NNN"), ("p", "none", ""), ("p", "null", None)]
    df = spark.createDataFrame(rows, "ref string, sample string, seq string").repartition(5)
    p = DistanceParams(tile, block)
    got = {(r["ref"], r["a"], r["b"]): (r["snps"], r["compared"]) for r in plane_distances(planes_of_sequences(df, ["ref"], p), ["ref"], p).collect()}
    assert got == {(g, *k): v for g, own in groups.items() for k, v in plain(own).items()}
    bases = spark.createDataFrame([(s, i, c) for s, q in groups["p"].items() for i, c in enumerate(q)], "sample string, pos long, base string")
    assert {(r["a"], r["b"]): (r["snps"], r["compared"]) for r in plane_distances(planes_of_bases(bases, (), p), (), p).collect()} == plain(groups["p"])


def runs(spark, acc, don, excluded=(), **kw):
    rows = [("l", x, acc[x], don.get(x), x in excluded) for x in sorted(acc)]
    df = spark.createDataFrame(rows, "locus string, pos int, acc int, don int, ex boolean")
    got = C.depleted_runs(df, ["locus"], "pos", "acc", "don", "ex", C.DepletionParams(**kw)).orderBy("start").collect()
    return [(r["start"], r["end"]) for r in got]


def locus(acc_mid, don_mid, acc_flank=40, don_flank=40):
    flanks, middle = (10, 20, 70, 80), (30, 40, 50)
    return {x: acc_flank for x in flanks} | {x: acc_mid for x in middle}, {x: don_flank for x in flanks} | {x: don_mid for x in middle}


def test_depleted_runs(spark):
    assert runs(spark, *locus(0, 100)) == runs(spark, *locus(4, 100)) == [(30, 50)]
    assert runs(spark, *locus(5, 100)) == []  # covered at the floor
    assert runs(spark, *locus(0, 100), least=4) == []
    assert runs(spark, *locus(0, 50)) == [(30, 50)] and runs(spark, *locus(0, 49)) == []  # 1.25 times the donor elsewhere
    assert runs(spark, *locus(4, 6)) == []  # a hole without a gain
    assert runs(spark, *locus(4, 100, acc_flank=6)) == [] and runs(spark, *locus(3, 100, acc_flank=6)) == [(30, 50)]  # 0.6 of the level elsewhere
    acc, don = locus(0, 100)
    assert runs(spark, acc, {}) == []
    assert runs(spark, acc, don, excluded={40}) == [] and runs(spark, acc, don, excluded={20}) == [(30, 50)]
    acc, don = {x: 30 if x < 30 else 1 for x in (10, 20, 30, 40, 50)}, {x: 30 if x < 30 else 90 for x in (10, 20, 30, 40, 50)}
    assert runs(spark, acc, don) == [(30, 50)]  # up to the last site
    assert runs(spark, {x: 0 for x in (30, 40, 50)}, {x: 90 for x in (30, 40, 50)}) == []  # nothing elsewhere to compare with


def test_the_probe_is_not_reported(spark):
    """Four sites at depth 2 among sites at 10, with no donor at all."""
    acc = {x: 2 if 3 <= x <= 6 else 10 for x in range(12)}
    assert runs(spark, acc, {}) == []
