"""Lift of places between assemblies."""

import random

import pytest
from pyspark.sql import functions as F

from strandwise.operators import lift as L
from strandwise.operators.lift import LiftParams


def letters(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


def flip(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def lifted(spark, src, tgt, places, **kw):
    frame = lambda d: spark.createDataFrame(list(d.items()) if isinstance(d, dict) else [("A", d)], "contig string, seq string")
    s, t, p = frame(src), frame(tgt), LiftParams(**kw)
    q = spark.createDataFrame([x if isinstance(x, tuple) else ("A", x) for x in places], "contig string, pos long")
    links = L.chain_links(L.unique_anchors(s, t, p), p).cache()
    got = {(r["contig"], r["pos"]): (r["tgt_contig"], r["tgt_pos"], r["strand"]) for r in L.lift_positions(q, s, t, p, links).collect()}
    return got if isinstance(src, dict) else {x: v for (_, x), v in got.items()}, links


SEQ = letters(600, 11)
INSERT = "GGATCCTTAAGGCCTTAACCGGTTAACCGGTTAACC"


def test_collinear_and_ends(spark):
    got, links = lifted(spark, SEQ, SEQ, [1, 50, 100, 300, 500, 600])
    assert got == {x: ("A", x, "+") for x in (50, 100, 300, 500)} and L.lost_regions(links).count() == 0


@pytest.mark.parametrize("sample", [1, 4])
def test_insertion(spark, sample):
    got, _ = lifted(spark, SEQ, SEQ[:300] + INSERT + SEQ[300:], [50, 100, 250, 400, 500], sample=sample)
    assert got == {x: ("A", x + (36 if x > 300 else 0), "+") for x in (50, 100, 250, 400, 500)}


@pytest.mark.parametrize("k", [20, 21])
def test_inversion(spark, k):
    got, links = lifted(spark, SEQ, SEQ[:200] + flip(SEQ[200:400]) + SEQ[400:], [50, 250, 300, 350, 500], k=k)
    assert got == {50: ("A", 50, "+"), 500: ("A", 500, "+")} | {x: ("A", 601 - x, "-") for x in (250, 300, 350)}
    assert links.where("strand = '-'").select("chain").distinct().count() == 1


def test_several_inversions_have_chains_of_their_own(spark):
    seq = letters(2000, 21)
    tgt = seq[:300] + flip(seq[300:500]) + seq[500:900] + flip(seq[900:1200]) + seq[1200:]
    got, links = lifted(spark, seq, tgt, [400, 700, 1000, 1500])
    assert got == {400: ("A", 801 - 400, "-"), 700: ("A", 700, "+"), 1000: ("A", 2101 - 1000, "-"), 1500: ("A", 1500, "+")}
    assert links.where("strand = '-'").select("chain").distinct().count() == 2


def test_lost_region(spark):
    got, links = lifted(spark, SEQ, SEQ[:200] + SEQ[300:], [50, 100, 250])
    (r,) = L.lost_regions(links).collect()
    assert r["contig"] == "A" and r["left"] < 200 < 300 < r["right"] and set(got) == {50, 100}


def test_nothing_in_common(spark):
    assert lifted(spark, SEQ, letters(600, 99), [100, 200])[0] == {}


def test_another_anchor_in_the_gap_drops_it(spark):
    """Forward anchors at 100 and 120 and a reverse one at 110, whose own chain is too short to count."""
    rows = [("A", x, "T", x, "+") for x in (80, 100, 120, 140)] + [("A", 110, "T", 900, "-")]
    anchors = spark.createDataFrame(rows, "src_contig string, src_pos long, tgt_contig string, tgt_pos long, strand string")
    links = L.chain_links(anchors)
    q = spark.createDataFrame([("A", x) for x in (90, 100, 105, 110, 112, 130, 150)], "contig string, pos long")
    got = {r["pos"]: (r["tgt_pos"], r["exact"]) for r in L.place(q, links).collect()}
    assert got == {90: (90, False), 100: (100, True), 130: (130, False)}
    contigs = spark.createDataFrame([("A", 100, "T", 100, "+"), ("A", 120, "U", 120, "+")], anchors.schema)
    assert L.place(q, L.chain_links(contigs)).where("pos = 105").count() == 0  # from one target contig into another


def test_chains_have_no_cap(spark):
    """1,100 reversed blocks of two anchors each."""
    rows = [("A", 10 * n + 3 * i, "T", 10 * n + 9 - 3 * i, "-") for n in range(1100) for i in range(2)]
    anchors = spark.createDataFrame(rows, "src_contig string, src_pos long, tgt_contig string, tgt_pos long, strand string")
    assert L.chain_links(anchors, LiftParams(min_chain=2)).select("chain").distinct().count() == 1100


def test_contigs(spark):
    a, b, c = letters(400, 1), letters(500, 2), letters(300, 3)
    got, _ = lifted(spark, {"a": a, "b": flip(b), "c": c}, {"T": a + b, "U": c}, [("a", 200), ("b", 200), ("c", 100), ("d", 5)])
    assert got == {("a", 200): ("T", 200, "+"), ("b", 200): ("T", 400 + 501 - 200, "-"), ("c", 100): ("U", 100, "+")}


def test_gate(spark):
    s = letters(400, 2)
    m = s[:200] + "".join("A" if x != "A" else "C" for x in s[200:206]) + s[206:]

    def passes(src, tgt, pos, at, strand, identity):
        rows = spark.createDataFrame([("A", pos, "B", at, strand, False)], "contig string, pos long, tgt_contig string, tgt_pos long, strand string, exact boolean")
        seqs = [spark.createDataFrame([(n, x)], "contig string, seq string") for n, x in (("A", src), ("B", tgt))]
        return L.identity_gate(rows, *seqs, LiftParams(identity=identity)).count() == 1

    assert passes(s, s, 200, 200, "+", 0.9) and not passes(s, s, 200, 240, "+", 0.9)
    assert not passes(s, m, 200, 200, "+", 0.6) and passes(s, m, 200, 200, "+", 0.3)
    assert passes(s, flip(s), 200, 201, "-", 0.9) and not passes(s, flip(s), 200, 201, "+", 0.9)
    assert passes(s, s, 1, 1, "+", 0.9) and not passes("ACGTA", "ACGTA", 3, 3, "+", 0.9)


def test_alignment_beside_a_deletion(spark):
    seq = letters(800, 31)
    places = [390, 395, 398, 410, 415]
    tgt = seq[:400] + seq[405:]
    assert len(lifted(spark, seq, tgt, places)[0]) < len(places)
    got, _ = lifted(spark, seq, tgt, places, align=True)
    assert [got[x] for x in (390, 395, 410, 415)] == [("A", x, "+") for x in (390, 395, 405, 410)]


def test_what_the_target_lacks(spark):
    seq, more = letters(800, 32), letters(300, 33)
    got, _ = lifted(spark, seq[:400] + more + seq[400:], seq, [395, 550, 705], align=True)
    assert got == {395: ("A", 395, "+"), 550: (None, None, None), 705: ("A", 405, "+")}


def test_alignment_without_anchors(spark):
    seq = letters(900, 34)
    tgt = "".join("CGTA"["ACGT".index(x)] if 350 <= i < 550 and (i - 350) % 8 == 0 else x for i, x in enumerate(seq))
    assert lifted(spark, seq, tgt, [400, 450, 500], align=True, align_identity=0.8)[0] == {x: ("A", x, "+") for x in (400, 450, 500)}


def test_an_unrelated_stretch(spark):
    seq = letters(900, 35)
    swap = lambda seed: seq[:350] + letters(200, seed) + seq[550:]
    assert lifted(spark, swap(36), swap(37), [450], align=True)[0] == {}


def test_alignment_in_an_inversion(spark):
    seq = letters(1200, 41)
    block = seq[300:900]
    got, _ = lifted(spark, seq, seq[:300] + flip(block[:300] + block[306:]) + seq[900:], [450, 590, 615, 700], align=True)
    assert got == {x: ("A", 300 + 594 - (x - 301 - (6 if x > 606 else 0)), "-") for x in (450, 590, 615, 700)}


def test_windows(spark):
    seqs = spark.createDataFrame([("A", "abcdefghij")], "contig string, seq string")
    rows = spark.createDataFrame([("A", f, n) for f in range(-4, 13) for n in range(1, 6)] + [("B", 1, 2)], "contig string, f long, n long")
    got = L.windows(rows, seqs, "contig", F.col("f"), F.col("n"), "w", 5, 3).collect()
    text = " " * 10 + "abcdefghij" + " " * 10
    assert all(r["w"] == ("  " if r["contig"] == "B" else text[r["f"] + 9 : r["f"] + 9 + r["n"]]) for r in got) and len(got) == rows.count()


def test_queries(spark):
    """On the small tables: every place is the one by construction, and few are left out."""
    import os

    from strandwise.plans import catalogue

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    rows = spark.read.parquet(f"{folder}/customer.parquet").join(spark.read.parquet(f"{folder}/nation.parquet"), F.expr("c_nationkey = n_nationkey")).select("n_regionkey", "c_custkey", "c_name").collect()
    want, lost, ends = {}, set(), {}
    for region, i, _ in sorted(rows):
        contig = f"r{region}"
        s, t = ends.get(contig, (0, 0))
        n = 0 if i % 50 == 3 else 56 if i % 7 == 1 else 64
        flipped = n == 64 and i % 11 == 4 and i % 7 != 1
        want[contig, s + 32] = None if not n else (contig, t + 33 if flipped else t + 32, "-" if flipped else "+")
        if not n:
            lost.add((contig, s))
        ends[contig] = s + 64, t + n
    got = {(r["contig"], r["pos"]): (r["tgt_contig"], r["tgt_pos"], r["strand"]) if r["tgt_contig"] else None for r in catalogue.QUERIES["anchor_lift"](spark, folder).collect()}
    assert all(want[k] == v for k, v in got.items()) and len(got) >= 0.97 * len(want)
    regions = [tuple(r) for r in catalogue.QUERIES["lost_regions"](spark, folder).collect()]
    inner = {(c, s) for c, s in lost if 0 < s < ends[c][0] - 64}
    assert all(any(c == d and left <= s and s + 64 < right for d, left, right in regions) for c, s in inner)
