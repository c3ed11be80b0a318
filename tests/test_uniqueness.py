"""Least unique lengths against counts of all k-mers."""

import random
from collections import Counter

import pytest

from strandwise.operators.uniqueness import Names, UniqueParams, least_unique_lengths, unique_track

SCHEMA = "contig string, seq string"


def flip(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def plain(seqs, longest):
    out = {}
    for k in range(1, longest + 1):
        counts, where = Counter(), {}
        for name, s in seqs:
            for i in range(len(s) - k + 1):
                w = s[i : i + k].upper()
                if set(w) <= set("ACGT"):
                    where[name, i + 1] = min(w, flip(w))
                    counts[where[name, i + 1]] += 1 + (w == flip(w))
        for spot, w in where.items():
            if counts[w] == 1:
                out.setdefault(spot, k)
    return {(name, i + 1): out.get((name, i + 1)) for name, s in seqs for i in range(len(s))}


def genome(seed):
    rng = random.Random(seed)
    base = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    block = base(60)
    one = base(150) + block + base(40) + "A" * 35 + base(30) + flip(block) + "N" * 3 + base(20) + "AC" * 20 + "ACGCGT" + base(50).lower()
    return [("c1", one), ("c2", base(30) + block[:45] + base(10) + block[20:]), ("c3", "ACG"), ("c4", ""), ("c5", "NNN")]


@pytest.mark.parametrize("seed, longest, first, piece", [(1, 70, 16, 64), (2, 50, 3, 1000), (3, 7, 16, 100)])
def test_against_counts(spark, seed, longest, first, piece):
    seqs = genome(seed)
    got = least_unique_lengths(spark.createDataFrame(seqs, SCHEMA), UniqueParams(longest, first, piece)).collect()
    assert {(r["contig"], r["pos"]): r["mul"] for r in got} == plain(seqs, longest) and len(got) == sum(len(s) for _, s in seqs)


def test_names():
    n = Names("ACGTTGCAACGTACGT")
    import numpy as np

    for k in (1, 2, 3, 5, 8):
        a, b, times = n.of(np.arange(16 - k + 1), k)
        words = ["ACGTTGCAACGTACGT"[i : i + k] for i in range(16 - k + 1)]
        groups = lambda x: [x.index(v) for v in x]
        assert times.tolist() == [1 + (w == flip(w)) for w in words]
        assert groups(list(zip(a.tolist(), b.tolist(), strict=True))) == groups([min(w, flip(w)) for w in words])


def test_track(spark):
    rows = [("c", 1, 5, 9), ("c", 2, 12, 20), ("c", 3, None, 20), ("c", 4, None, 3)]
    df = spark.createDataFrame(rows, "contig string, pos long, mul int, room int")
    assert [r["mul"] for r in unique_track(df, 8).orderBy("pos0").collect()] == [8, 12, 65535, 0]
    assert [r["mul"] for r in unique_track(df, 8, False).orderBy("pos0").collect()] == [8, 12, 65535, 65535]


def test_empty(spark):
    assert least_unique_lengths(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pieces_are_tested_in_several_tasks(spark):
    """Brackets stay beside their piece's text, so that a round's join has a row for each piece, and pieces spread over tasks."""
    from pyspark.sql import functions as F

    from strandwise.operators.uniqueness import _spread

    few = spark.range(16).coalesce(1)
    assert _spread(few).select(F.spark_partition_id().alias("p")).distinct().count() > 1
    got = least_unique_lengths(spark.createDataFrame(genome(1), SCHEMA), UniqueParams(70, 16, 64))
    assert "Join" not in got._jdf.queryExecution().toString() and got.count() == sum(len(s) for _, s in genome(1))
