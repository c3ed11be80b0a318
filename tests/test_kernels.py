import random

import numpy as np
import pandas as pd
import pytest

from strandwise.operators import kernels as K


def test_longest_increasing():
    rng = random.Random(0)
    for _ in range(200):
        v = [rng.randint(0, 12) for _ in range(rng.randint(0, 12))]
        best = [1] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max((best[j] for j in range(i) if v[j] < v[i]), default=0)
        got = K.longest_increasing(v)
        own = [v[i] for i in got]
        assert len(got) == max(best, default=0) and own == sorted(set(own)) and got == sorted(got)


def plain_score(a, b, p=K.AlignParams()):
    low = -1e9
    n, m = len(a), len(b)
    h = np.full((n + 1, m + 1), low)
    d, r = h.copy(), h.copy()
    h[0, 0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            if i:
                d[i, j] = max(d[i - 1, j] + p.gap_extend, h[i - 1, j] + p.gap_open + p.gap_extend)
            if j:
                r[i, j] = max(r[i, j - 1] + p.gap_extend, h[i, j - 1] + p.gap_open + p.gap_extend)
            if i and j:
                h[i, j] = h[i - 1, j - 1] + (p.match if a[i - 1] == b[j - 1] else p.mismatch)
            h[i, j] = max(h[i, j], d[i, j], r[i, j])
    return h[n, m]


def test_affine_alignment():
    rng = random.Random(1)
    for _ in range(150):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 25)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 4)] = [rng.choice("ACGT") for _ in range(rng.randint(0, 4))]
        b = "".join(b)
        score, cigar = K.affine(a, b)
        assert score == pytest.approx(plain_score(a, b) if a or b else 0)
        assert K.cigar_score(a, b, cigar) == pytest.approx(score), (a, b, cigar)


def test_alignment_bands():
    assert K.affine("ACGTAAAATGCA", "ACGTAAATGCA")[1] == "4M1D7M"
    assert K.affine("ACGTCCGGTTAACCGGTTAAGGCA", "ACGTGGCA")[1].count("16D") == 1 and K.affine("NNNN", "NNNN")[0] == -16
    assert K.affine("A" * 400, "C" * 5, K.AlignParams(band=16, most_cells=100)) is None
    rng = random.Random(5)
    long = "".join(rng.choice("ACGT") for _ in range(20_000))
    cut = long[:9000] + long[9100:]
    assert K.affine(long, cut, K.AlignParams(band=16))[1] in {f"{at}M100D{19900 - at}M" for at in range(8990, 9011)}


def test_regions_are_headed_by_their_first_stretch():
    s, e = np.array([1, 1, 50, 60, 300]), np.array([100, 90, 149, 160, 400])
    assert K.regions_of(s, e).tolist() == [0, 0, 0, 1, 2]  # 60..160 has 41 of 101 positions in common with 1..100
    rng = random.Random(3)
    rows = sorted((a, a + rng.randint(0, 60)) for a in (rng.randint(0, 200) for _ in range(150)))
    got = K.regions_of(np.array([a for a, _ in rows]), np.array([b for _, b in rows])).tolist()
    heads = []
    for (a, b), r in zip(rows, got, strict=True):
        fits = [k for k, (x, y) in enumerate(heads) if y >= a and len(set(range(x, y + 1)) & set(range(a, b + 1))) * 2 >= max(y - x + 1, b - a + 1)]
        assert r == (fits[0] if fits else len(heads))
        if not fits:
            heads.append((a, b))


def test_region_ends_are_medians_over_carriers(spark):
    rows = [("k", "A", 1, 1000), ("k", "B", 1, 900), ("k", "B", 100, 950), ("k", "B", 200, 1000)]
    got = K.founder_clusters(spark.createDataFrame(rows, "key string, who string, start long, `end` long"), ["key"], "start", "end", "who").collect()
    assert [tuple(r) for r in got] == [("k", 0, 2, 1, 1000)]


def test_candidate_intervals():
    p = K.TractParams()
    assert p.exact_sites == 150
    for n, blocked in ((12, ()), (301, ()), (301, (40, 41, 200))):
        free = np.ones(n, bool)
        free[list(blocked)] = False
        sites = np.arange(n) * 30 + 1
        got = {tuple(x) for x in K.candidate_intervals(sites, free, p).tolist()}
        runs, at = [], 0
        for b in (*blocked, n):
            if b > at:
                runs.append((at, b - 1))
            at = b + 1
        stride, want = -(-int(free.sum()) // 150), set()
        for a, b in runs:
            ends = sorted({*range(a, b + 1, stride), b})
            want |= {(i, j) for i in ends for j in ends if i <= j} | {(i, j) for i in range(a, b + 1) for j in range(i, min(b, i + p.short - 1) + 1)}
            assert (a, b) in got or (b - a) * 30 + 1 > p.max_span
        assert got == {(i, j) for i, j in want if sites[j] - sites[i] + 1 <= p.max_span}
    ends = K.candidate_intervals(np.array([1, 10_000, 10_001]), np.ones(3, bool), K.TractParams(max_span=10_000)).tolist()
    assert [0, 1] in ends and [0, 2] not in ends


def test_reads_without_qualities(spark):
    assert K.walk_cigar(1, "4M", "acgt", None, [2, 4]) == {2: ("C", 60), 4: ("T", 60)}
    assert K.walk_cigar(1, "4M", "ACGT", [9, 8], [2, 4]) == {2: ("C", 8)}
    reads = spark.createDataFrame([("r", "c", 1, "4M", "acgt", "*"), ("s", "c", 1, "4M", "ACGT", "I")], "qname string, rname string, pos long, cigar string, seq string, qual string")
    sites = spark.createDataFrame([("c", 1), ("c", 2)], "contig string, pos long")
    assert sorted(tuple(r) for r in K.observations(reads, sites).collect()) == [("r", 1, "A", 60), ("r", 2, "C", 60), ("s", 1, "A", 40)]


def test_permutation_is_deterministic_and_sane(spark):
    rng = np.random.default_rng(0)
    rows = [("tied", s, t, float(t), float(t) + 0.01 * rng.normal()) for s in range(3) for t in range(8)] + [("free", s, t, *map(float, rng.normal(size=2))) for s in range(3) for t in range(8)] + [("flat", 0, t, 1.0, float(t)) for t in range(5)]
    df = spark.createDataFrame(rows, "pair string, series int, t int, x double, y double")
    got = {r["pair"]: r for r in K.permutation_p(df, "pair", "series", "t", "x", "y", 200).collect()}
    assert got["tied"]["p"] == pytest.approx(1 / 201) and got["free"]["p"] > 0.02 and got["flat"]["p"] is None
    again = {r["pair"]: r["p"] for r in K.permutation_p(df.repartition(5), "pair", "series", "t", "x", "y", 200).collect()}
    assert again == {k: r["p"] for k, r in got.items()}


def locus(seed, n_sites=12, n_reads=30, tract=(4, 8), share=0.5):
    rng = np.random.default_rng(seed)
    rows = []
    for r in range(n_reads):
        converted = rng.random() < share
        for s in range(n_sites):
            donor = converted and tract and tract[0] <= s <= tract[1]
            rows.append((r, 100 * (s + 1), "D" if donor != (rng.random() < 0.01) else "A", 30))
    return pd.DataFrame(rows, columns=["read", "pos", "allele", "qual"])


def test_implanted_tracts_are_found_and_nothing_else():
    p = K.TractParams()
    for seed in range(4):
        found = K.segment(*K.evidence_matrix(locus(seed), p), p)
        assert found and found[0]["verdict"] == "gene_conversion" and found[0]["start"] == 500 and found[0]["end"] == 900
        assert found[0]["start_lo"] <= 500 <= found[0]["start_hi"] and found[0]["end_lo"] <= 900 <= found[0]["end_hi"]
        clean = K.segment(*K.evidence_matrix(locus(seed, tract=None), p), p)
        assert not [t for t in clean if t["verdict"] == "gene_conversion"]


def test_tract_properties():
    p = K.TractParams()
    g = locus(9)
    a = K.segment(*K.evidence_matrix(g, p), p)[0]
    b = K.segment(*K.evidence_matrix(g.sample(frac=1, random_state=1), p), p)[0]
    assert a["log10_bf"] == pytest.approx(b["log10_bf"]) and np.isfinite(list(v for v in a.values() if not isinstance(v, str))).all()
    double = pd.concat([g, g.assign(read=g["read"] + 1000)])
    assert K.segment(*K.evidence_matrix(double, p), p)[0]["bf_null"] > 1.5 * a["bf_null"]
    other = K.TractParams(prior=0.5)
    assert K.segment(*K.evidence_matrix(g, other), other)[0]["log10_bf"] == pytest.approx(a["log10_bf"])
    small = K.TractParams(chunk=100)
    assert K.segment(*K.evidence_matrix(g, small), small)[0]["log10_bf"] == pytest.approx(a["log10_bf"])


def test_molecules():
    seq, qual = "AACCGGTT", list(range(10, 18))
    assert K.walk_cigar(100, "2S3M2D2M1I", seq, qual, [99, 100, 102, 103, 104, 105, 106, 107]) == {100: ("C", 12), 102: ("G", 14), 103: ("-", 20), 104: ("-", 20), 105: ("G", 15), 106: ("T", 16)}
    assert K.walk_cigar(1, "2M3N2M", "ACGT", [1, 2, 3, 4], [2, 4, 6, 7]) == {2: ("C", 2), 6: ("G", 3), 7: ("T", 4)}
    assert K.count_bases("..,A^].$+2ACt-12NNNNNNNNNNNNg*,") == (5, 3)


def test_leaf_order():
    assert K.leaf_order([("a", "c", 1.0), ("b", "d", 2.0), ("a", "b", 3.0)], ["a", "b", "c", "d", "e"]) == ["a", "c", "b", "d", "e"]
