"""Base counts against a loop over every base."""

import random
from collections import Counter

import pytest

from strandwise.operators.pileup import COUNTS, PileupParams, blocks, dense_pileup

READS = "sample string, rname string, pos long, cigar string, seq string, qual string"
CIGARS = ["20M", "5S10M5S", "6M3D14M", "8M2I10M", "4M10N16M", "1M1D1M1D1M1I16M", "3H20M", "10=2X8M", "20I", "2D18M2S"]


def plain(reads, axis, least):
    counts = Counter()
    for sample, contig, pos, cigar, seq, qual in reads:
        if pos is None or cigar in (None, "*"):
            continue
        good = lambda q: qual in (None, "", "*") or (q < len(qual) and ord(qual[q]) - 33 >= least)
        for op, r, q, n in blocks(cigar):
            for i in range(n):
                if op != "M":
                    if good(q):
                        counts[sample, contig, pos + r + i, "skipped" if op == "N" else "deleted"] += 1
                elif seq in (None, "", "*") or q + i < len(seq):
                    if good(q + i):
                        b = "n" if seq in (None, "", "*") else seq[q + i].lower()
                        counts[sample, contig, pos + r + i, b if b in "acgt" else "n"] += 1
    out = []
    for sample, contig, length in axis:
        for pos in range(1, length + 1):
            own = [counts[sample, contig, pos, c] for c in COUNTS]
            out.append((sample, contig, pos, *own, sum(own)))
    return out


def make(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        qual = rng.choice([None, "*", "".join(chr(33 + rng.randint(5, 40)) for _ in range(20))])
        seq = rng.choice(["*", None]) if rng.random() < 0.05 else "".join(rng.choice("ACGTNacgtRY") for _ in range(20))
        rows.append((rng.choice(["s1", "s2", None]), rng.choice("xy"), rng.randint(-5, 330), rng.choice(CIGARS), seq, qual))
    return rows + [("s1", "x", None, "20M", "A" * 20, None), ("s1", "x", 5, None, "A", None), ("s1", "x", 5, "*", "A", None), ("s1", "elsewhere", 5, "1M", "A", None)]


@pytest.mark.parametrize("tile", [16, 100, 4096])
def test_against_a_loop(spark, tile):
    reads = make(400) + [("s1", "x", 40, "20M", "ACGT" * 5, None)] * 600  # a place with very many reads
    axis = [("s1", "x", 340), ("s1", "y", 300), ("s2", "x", 340), ("s1", "bare", 50), (None, "y", 20), ("s2", "none", 0)]
    got = dense_pileup(spark.createDataFrame(reads, READS).repartition(6), spark.createDataFrame(axis, "sample string, contig string, length long"), ["sample"], PileupParams(tile=tile, held=500))
    assert got.columns == ["sample", "contig", "pos", *COUNTS, "depth"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(reads, axis, 13)))


def test_empty(spark):
    axis = spark.createDataFrame([("c", 3)], "contig string, length long")
    got = dense_pileup(spark.createDataFrame([], READS.replace("sample string, ", "")), axis)
    assert sorted(tuple(r) for r in got.collect()) == [("c", i, *[0] * 8) for i in (1, 2, 3)]


def test_reads_of_a_cigar_are_counted_at_once(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from strandwise.operators import pileup

    looked = []
    monkeypatch.setattr(pileup, "blocks", lambda cigar: looked.append(cigar) or blocks(cigar))
    tile = pileup._Tile(1, PileupParams(tile=100, held=50))
    texts = lambda x: pileup._Texts(pa.array([x] * 1000, pa.string()))
    tile.add(np.arange(1000) % 80 + 1, pa.array(["20M"] * 1000), texts("é" * 10 + "c" * 10), texts(None))
    assert looked == ["20M"]
    assert tile.all().sum(1).tolist() == [0, 10000, 0, 0, 10000, 0, 0]
