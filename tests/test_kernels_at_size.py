"""Kernels on rows that come again: alignments, reads and shuffles in blocks."""

import numpy as np

from strandwise.operators import kernels as K
from strandwise.operators.lift import cut, decreasing_chains, increasing, kmers


def test_equal_texts_are_aligned_once(spark, tmp_path):
    rows = [(i, ("ring", "bolt", None)[i % 3], "bring") for i in range(60)]
    df = K.align(spark.createDataFrame(rows, "id long, a string, b string"), "id", "a", "b")
    assert "Aggregate" in df._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: (r["score"], r["cigar"]) for r in df.collect()}
    assert got == {i: K.affine(a or "", b) for i, a, b in rows}


def test_equal_reads_count_as_often(spark):
    rng = np.random.default_rng(3)
    rows = []
    for read in range(300):
        donor = read % 3 == 0
        rows += [("p", f"r{read}", int(x), "D" if donor and 200 <= x <= 400 else "A", 30) for x in range(100, 800, 100) if rng.random() < 0.9]
    df = spark.createDataFrame(rows, "pair string, read string, pos long, allele string, qual int")
    (got,) = K.conversion_tracts(df, ["pair"]).collect()
    p = K.TractParams()
    (want,) = K.segment(*K.evidence_matrix(df.toPandas(), p), p)
    assert got["n_reads"] == 300 and (got["start"], got["end"], got["verdict"]) == (want["start"], want["end"], want["verdict"])
    assert abs(got["log10_bf"] - want["log10_bf"]) < 1e-6 * abs(want["log10_bf"]) and abs(got["fraction"] - want["fraction"]) < 1e-9
    plan = K.conversion_tracts(df, ["pair"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_times" in plan


def test_shuffles_in_blocks(spark):
    rng = np.random.default_rng(8)
    rows = [("p", s, t, float(x), float(x + rng.normal() * 3)) for s in range(40) for t, x in enumerate(rng.normal(size=6 + s % 3))]
    df = spark.createDataFrame(rows, "pair string, series int, t int, x double, y double")
    one, many = (K.permutation_p(df, "pair", "series", "t", "x", "y", 800, block).first() for block in (512, 7))
    assert one["n_series"] == many["n_series"] == 40 and abs(one["r"] - many["r"]) < 1e-12
    assert abs(one["p"] - many["p"]) < 0.08


def test_chains_by_stretches():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 60):
        for v in (rng.permutation(n), rng.integers(0, 20, n), np.concatenate([np.arange(9)[::-1] + 10 * i for i in range(n // 9)] or [np.empty(0, np.int64)])):
            assert increasing(v).tolist() == K.longest_increasing(v.tolist())
            rest, want = np.arange(len(v)), []
            while len(rest) >= 2 and len(picked := K.longest_increasing((-v[rest]).tolist())) >= 2:
                want.append(rest[picked].tolist())
                rest = np.delete(rest, picked)
            assert [c.tolist() for c in decreasing_chains(v, 2)] == want


def test_cut_by_levels(spark):
    rng = np.random.default_rng(2)
    texts = {"a": "".join(rng.choice(list("ACGT"), 5000)), "b": "ACGTN", "c": ""}
    df = spark.createDataFrame(list(texts.items()), "contig string, seq string")
    for step, more in ((128, 20), (3000, 4100), (1 << 14, 7)):
        want = {(c, i, s[i : i + step + more]) for c, s in texts.items() for i in range(0, len(s), step)}
        assert {tuple(r) for r in cut(df, step, more).collect()} == want
    got = sorted((r["contig"], r["pos"], r["kmer"]) for r in kmers(df, 21).collect())
    assert got == [("a", i + 1, texts["a"][i : i + 21]) for i in range(4980)]
