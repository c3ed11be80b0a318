"""Anchors by one aggregation, and chains of runs of anchors."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strandwise.operators import lift as L
from strandwise.operators.kernels import longest_increasing
from strandwise.operators.lift import LiftParams
from tests.test_lift import flip, letters

ANCHORS = "src_contig string, src_pos long, tgt_contig string, tgt_pos long, strand string"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def plain_anchors(source, target, k):
    def once(seqs):
        at = [(s[i : i + k], c, i + 1) for c, s in seqs for i in range(len(s) - k + 1) if set(s[i : i + k]) <= set("ACGT")]
        n = Counter(x[0] for x in at)
        return {w: (c, i + k - 1 - k // 2) for w, c, i in at if n[w] == 1}

    s, t = once(source), once(target)
    out = []
    for w, (c, i) in s.items():
        plus, minus = t.get(w), t.get(flip(w))
        if plus and not minus:
            out.append((c, i, *plus, "+"))
        if minus and not plus:
            out.append((c, i, minus[0], minus[1] + 1 - k % 2, "-"))
    return sorted(out)


def test_anchors_against_a_plain_version(spark):
    a, b, short = letters(300, 1), letters(200, 2), letters(500, 5)
    source = [("a", a + "N" + b[:100]), ("b", b + flip(a[20:60])), ("c", "ACGT" * 12), ("d", short), ("e", a[:90]), ("e", a[:90])]
    target = [("T", flip(a[100:]) + b + "ACGTACGT"), ("U", a[:120] + flip(b[50:90])), ("V", short[::2] + flip(short[:200])), ("W", "")]
    frame = lambda rows: spark.createDataFrame(rows, "contig string, seq string")
    for k in (4, 5, 6, 20, 21, 31, 32, 33, 65):
        got = sorted(tuple(r) for r in L.unique_anchors(frame(source), frame(target), LiftParams(k=k)).collect())
        assert got == plain_anchors(source, target, k), k


def test_contigs_are_cut_into_words_once(spark):
    """The driver keeps the plan of all that is read again."""
    s = spark.createDataFrame([("a", letters(300, 1))], "contig string, seq string")
    assert plan(L.unique_anchors(s, s)).count("posexplode(") == 2
    q = spark.createDataFrame([("a", 100)], "contig string, pos long")
    assert plan(L.lift_positions(q, s, s, LiftParams(align=True))).count("posexplode(") == 0


def plain_links(rows, p):
    """Anchor by anchor, of one source contig."""
    rows = sorted(rows, key=lambda r: (r[1], r[2], r[3], r[4]))
    value = [(r[2], r[3]) for r in rows]
    rank = {v: n for n, v in enumerate(sorted(set(value)))}
    forward, backward = ([n for n, r in enumerate(rows) if r[4] == x] for x in "+-")
    found = [[forward[i] for i in longest_increasing([rank[value[n]] for n in forward])]] if forward else []
    while len(picked := longest_increasing([-rank[value[n]] for n in backward])) >= max(2, p.min_chain):
        own = [backward[i] for i in picked]
        backward = [n for n in backward if n not in set(own)]
        if len(own) >= p.density * (rows[own[-1]][1] - rows[own[0]][1] + 1):
            found.append(own)
    out = []
    for chain, own in enumerate(found):
        for n, after in zip(own, [*own[1:], None], strict=True):
            there = (rows[after][1], rows[after][2], rows[after][3]) if after is not None else (None, None, None)
            out.append((rows[n][0], chain, rows[n][4], rows[n][1], rows[n][2], rows[n][3], *there, after is not None and after == n + 1))
    return out


def test_runs_make_the_same_chains(spark):
    rng = random.Random(4)
    for trial in range(8):
        rows, at = [], 0
        for _ in range(60):
            n, strand, back = rng.randint(1, 12), rng.choice("++-"), rng.randint(0, 700)
            at += rng.choice((0, 0, 1, 5))
            rows += [("A", at + i, rng.choice("TTTU") if trial == 3 else "T", back + (i if strand == "+" else n - 1 - i), strand) for i in range(n)]
            at += n
        if trial % 2:  # else places of the target come again
            seen = set()
            rows = [r for r in rows if not ((r[2], r[3], r[4]) in seen or seen.add((r[2], r[3], r[4])))]
        rows = [(a, b + 4096 - 200, c, d + 10, e) for a, b, c, d, e in rows]
        p = LiftParams(min_chain=3, density=0.05)
        links = L.chain_links(spark.createDataFrame(rng.sample(rows, len(rows)), ANCHORS), p).cache()
        columns = ["src_contig", "chain", "strand", "src_pos", "tgt_contig", "tgt_pos", "next_src", "next_contig", "next_tgt", "clean"]
        got = sorted((tuple(r) for r in L.each_anchor(links).select(columns).collect()), key=lambda r: (r[1], r[3]))
        assert got == sorted(plain_links(rows, p), key=lambda r: (r[1], r[3])), trial
        assert trial % 2 == 0 or links.count() < len(got)
        q = spark.range(3800, 5200).select(F.lit("A").alias("contig"), F.col("id").alias("pos"))
        exact = sorted((r["pos"], r["tgt_contig"], r["tgt_pos"], r["strand"]) for r in L.place(q, links).where("exact").collect())
        assert exact == sorted((r[3], r[4], r[5], r[2]) for r in got)


def test_lists_of_runs():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = rng.integers(1, 6, 30)
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        order = rng.permutation(30) if rng.random() < 0.5 else np.argsort(np.arange(30) + rng.normal(size=30) * 3)
        v, m = first[order], n[order]
        flat = np.concatenate([np.arange(a, a + b) for a, b in zip(v, m, strict=True)])
        at = L.increasing(v, m)
        assert np.concatenate([np.arange(v[i], v[i] + m[i]) for i in at]).tolist() == flat[longest_increasing(flat.tolist())].tolist()


def test_collinear_anchors_are_few_rows(spark):
    """One row for each anchor went through the kernel of a contig, and through all plans behind it."""
    seq = letters(6000, 8)
    s, t = (spark.createDataFrame([("A", x)], "contig string, seq string") for x in (seq, seq[:2000] + seq[2100:]))
    links = L.chain_links(L.unique_anchors(s, t), backbone=True).cache()
    assert links.count() <= 4 and links.agg(F.sum("n")).first()[0] == 5860
    ((contig, left, right),) = L.lost_regions(links).collect()
    assert contig == "A" and 1980 <= left <= 2000 and right - left >= 101
    assert L.lost_regions(links, LiftParams(lost=0)).count() == 5859
