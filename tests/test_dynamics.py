"""Trajectories and pairs that move together, against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strandwise.operators.dynamics import EpistasisParams, TrajectoryParams, epistasis, pair_correlations, trajectories

SAMPLES = "group string, sample string, time string"
CALLS = "sample string, site int, af double, depth int, gene string, effect string, impact string"


def frames(spark, samples, calls):
    return spark.createDataFrame(samples, SAMPLES), spark.createDataFrame(calls, CALLS).repartition(4)


def got(df):
    return {(r["group"], r["site"]): r for r in df.collect()}


def test_absent_calls_are_zero(spark):
    """Called at the second time only: it emerges and is fixed."""
    s, c = frames(spark, [("g", "a", "1"), ("g", "b", "2")], [("a", 1, 0.5, 9, "x", "", ""), ("b", 7, 0.9, 30, "rpoB", "missense_variant", "HIGH")])
    out = got(trajectories(s, c))
    r = out["g", 7]
    assert (r["traj"], r["depths"], r["flags"], r["label"]) == ([0.0, 0.9], [None, 30], ["emergence", "fixation", "nonsyn", "high_impact"], "sweep")
    assert (out["g", 1]["traj"], out["g", 1]["flags"], out["g", 1]["nth"]) == ([0.5, 0.0], ["loss"], 2) and r["nth"] == 1


def test_a_group_needs_two_different_times(spark):
    s, c = frames(spark, [("g", "a", "1"), ("g", "b", "1"), ("h", "c", None), ("h", "d", "2"), (None, "e", "1"), ("i", None, "1")], [(x, 1, v, None, None, None, None) for x, v in (("a", 0.0), ("b", 1.0), ("c", 0.9), ("d", 0.0), ("e", 1.0))])
    out = got(trajectories(s, c))
    assert set(out) == {("h", 1)} and out["h", 1]["traj"] == [0.0, 0.9]  # a null time comes last
    assert got(trajectories(s, c, TrajectoryParams(least_times=1)))["g", 1]["traj"] == [0.0, 1.0]


def test_moves_and_order(spark):
    rows = [("a", 1, 0.5), ("b", 1, 0.6), ("a", 2, 0.2), ("b", 2, 0.4), ("a", 3, 0.3), ("b", 3, 0.5), ("a", 4, 0.05), ("b", 4, 0.25), ("a", 4, 0.01), ("b", 5, None), ("b", None, 1.0)]
    s, c = frames(spark, [("g", "a", "1"), ("g", "b", "2")], [(x, i, v, None, "", "synonymous", "LOW") for x, i, v in rows])
    out = got(trajectories(s, c))
    assert {k[1]: r["nth"] for k, r in out.items()} == {4: 1, 2: 2, 3: 3}  # equal moves: most flags, then the site
    assert out["g", 4]["traj"] == [0.05, 0.25] and out["g", 4]["flags"] == ["emergence"] and out["g", 2]["label"] == "rising"


def moving(seed, groups=3, n=6, sites=9):
    rng = random.Random(seed)
    samples = [(f"g{g}", f"s{g}.{t}", str(t)) for g in range(groups) for t in range(n)]
    calls = []
    for g in range(groups):
        base = [rng.random() for _ in range(n)]
        for site in range(sites):
            if rng.random() < 0.2:
                continue
            for t in range(n):
                af = [base[t], 1 - base[t], rng.random()][site % 3] * 0.9 + rng.random() * 0.1
                if rng.random() > 0.1:
                    calls.append((f"s{g}.{t}", site, af, 10, f"gene{site % 4}" if site % 4 else None, "", ""))
    return samples, calls


def plain(traj, shuffles, least_r):
    pairs = defaultdict(list)
    own = defaultdict(dict)
    for r in traj:
        own[r["group"]][str(r["site"])] = r["traj"]
    for g in sorted(own):
        for a in sorted(own[g]):
            for b in sorted(own[g]):
                if a < b:
                    pairs[a, b].append((float(np.corrcoef(own[g][a], own[g][b])[0, 1]), own[g][a], own[g][b]))
    out = {}
    for (a, b), x in pairs.items():
        m = np.mean([r for r, *_ in x])
        if abs(m) < least_r:
            continue
        rng, hits = random.Random(zlib.crc32(f"{a}|{b}".encode())), 0
        for _ in range(shuffles):
            rs = []
            for _, ta, tb in x:
                mixed = list(ta)
                rng.shuffle(mixed)
                rs.append(np.corrcoef(mixed, tb)[0, 1])
            hits += abs(np.mean(rs)) >= abs(m) - 1e-12
        out[a, b] = (m, len(x), min(r for r, *_ in x), max(r for r, *_ in x), (hits + 1) / (shuffles + 1))
    ranked = sorted(out, key=lambda k: out[k][4])
    q, best = {}, 1.0
    for rank in range(len(ranked), 0, -1):
        best = min(best, out[ranked[rank - 1]][4] * len(ranked) / rank)
        q[ranked[rank - 1]] = best
    return out, q, pairs


@pytest.mark.parametrize("tile", [2, 64])
def test_epistasis_against_a_plain_version(spark, tile):
    s, c = frames(spark, *moving(1))
    t = trajectories(s, c).cache()
    got = epistasis(t, EpistasisParams(least_r=0.5, shuffles=200, tile=tile))
    want, q, pairs = plain(t.collect(), 200, 0.5)
    rows = got.pairs.collect()
    assert {(r["a"], r["b"]) for r in rows} == set(want)
    for r in rows:
        m, n, lo, hi, p = want[r["a"], r["b"]]
        assert (r["n_series"], r["direction"], r["consistent"]) == (n, "concordant" if m > 0 else "discordant", lo > 0 or hi <= 0)
        assert np.allclose([r["r"], r["r_min"], r["r_max"]], [m, lo, hi], atol=6e-4) and abs(r["p"] - p) <= 6e-5 and abs(r["q"] - q[r["a"], r["b"]]) <= 6e-5
        assert r["tier"] == ("strong" if r["q"] <= 0.05 else "moderate" if p <= 0.05 else "weak")
    cells = got.matrix.collect()
    assert len(cells) == len(pairs) and all(abs(c["r"] - np.mean([x for x, *_ in pairs[c["a"], c["b"]]])) < 6e-4 and c["i"] < c["j"] for c in cells)
    at = {x: n for c in cells for x, n in ((min((c["a"], c["b"]), key=lambda v: (f"gene{int(v) % 4}" if int(v) % 4 else "zzz", v)), c["i"]),)}
    assert all(n == sorted(at.values())[k] for k, n in enumerate(sorted(at.values())))
    one = got.summary.first()
    assert (one["n_series"], one["n_candidates"], one["sites_limited"], one["pairs_limited"]) == (3, len(want), False, False)


def test_limits_are_said(spark):
    s, c = frames(spark, *moving(2))
    t = trajectories(s, c)
    got = epistasis(t, EpistasisParams(least_r=0.1, shuffles=5, sites=4, tested=3, top=2, nodes=2))
    one = got.summary.first()
    assert got.pairs.count() == 2 and one["sites_limited"] and one["pairs_limited"] and got.matrix.count() <= 1
    kept = {(r["group"], str(r["site"])) for r in t.where("nth <= 4").collect()}
    assert {(r["group"], x) for r in pair_correlations(t, EpistasisParams(sites=4)).collect() for x in (r["a"], r["b"])} == kept


def test_empty(spark):
    t = trajectories(*frames(spark, [], []))
    assert t.count() == 0
    got = epistasis(t)
    assert got.pairs.count() == got.matrix.count() == 0 and got.summary.first()["n_series"] == 0


def gains(spark, samples, calls, cells=None, **kw):
    from strandwise.operators.dynamics import SeriesParams, series_gains

    s = spark.createDataFrame(samples, "group string, sample string, time string, tnum double, excluded boolean")
    c = spark.createDataFrame(calls, "sample string, site string, af double")
    m = None if cells is None else spark.createDataFrame(cells, "sample string, site string, af double, dp int, called boolean")
    return sorted((r["sample"], r["site"], r["change"]) for r in series_gains(s, c, m, SeriesParams(**kw)).collect())


PAIR = [("g", "a", "0", 0.0, False), ("g", "b", "5", 5.0, False)]


def test_series(spark):
    calls = [("b", x, 0.95) for x in "npqruif"] + [("a", "p", 0.3), ("a", "i", 0.9), ("a", "l", 1.0), ("a", "m", 1.0), ("a", "k", 0.95), ("b", "k", 0.1)]
    cells = [("a", "n", None, 20, False), ("a", "q", None, 7, False), ("a", "r", None, None, False), ("a", "u", None, 30, True), ("a", "f", 0.2, 9, False), ("b", "l", None, 8, False), ("b", "m", None, 7, False)]
    assert gains(spark, PAIR, calls, cells) == [("b", "f", "risen"), ("b", "l", "lost"), ("b", "n", "new"), ("b", "p", "risen"), ("b", "q", "unknown"), ("b", "r", "unknown"), ("b", "u", "unknown")]


def test_a_series_without_cells(spark):
    calls = [("b", "n", 0.95), ("a", "p", 0.4), ("b", "p", 1.0), ("a", "l", 1.0)]
    assert gains(spark, PAIR, calls) == [("b", "n", "unknown"), ("b", "p", "risen")]
    assert gains(spark, PAIR, calls, checked=False) == [("b", "n", "new"), ("b", "p", "risen")]


def test_the_start_of_a_series(spark):
    calls, cells = [("b", "x", 1.0), ("c", "x", 1.0), ("c", "y", 1.0), ("d", "y", 1.0)], [(s, v, None, 50, False) for s in "abcd" for v in "xy"]
    both = [("g", "a", "0", 0.0, False), ("g", "b", "0", 0.0, False), ("g", "c", "2", 2.0, False)]
    assert gains(spark, both, calls, cells) == [("c", "y", "new")]  # every sample of the first time is the start
    assert gains(spark, both[:2], calls, cells) == []
    failed = [("g", "a", "0", 0.0, True), ("g", "b", "1", 1.0, False), ("g", "c", "2", 2.0, True), ("g", "d", "3", 3.0, False)]
    assert gains(spark, failed, calls, cells) == [("c", "y", "new"), ("d", "x", "lost"), ("d", "y", "new")]
    odd = [*PAIR, ("g", "c", "soon", None, False)]
    assert {s for s, *_ in gains(spark, odd, calls, cells)} == {"b"}  # a time that is no number has no place
    text = [("g", "a", "early", None, False), ("g", "c", "late", None, False)]
    assert gains(spark, text, calls, cells) == [("c", "x", "new"), ("c", "y", "new")]
