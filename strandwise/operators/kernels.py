"""Kernels for what is sequential by nature: one group at a time in numpy, fed by Arrow.

A group (a contig's stretches, a pair's molecules, two sequences) must fit its task; groups spread over tasks by key.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.ordered import joined
from strandwise.session import staged


def _kinds(df: DataFrame, cols: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


def _values(g: pd.DataFrame, keys: Sequence[str]) -> dict:
    return {k: g[k].iloc[0] for k in keys}


# -- founder clusters ---------------------------------------------------------------------------------------------


def regions_of(starts: np.ndarray, ends: np.ndarray, share: float = 0.5) -> np.ndarray:
    """The region number of each stretch, in order of (start, end, carrier).

    A region stays open while stretches begin within its first one, its head. A stretch goes to the earliest open region
    where the positions that it has in common with the head are `share` of both; else it heads a region of its own.
    """
    length = ends - starts + 1
    region = np.empty(len(starts), np.int64)
    heads = np.empty(0, np.int64)
    n = 0
    for i in range(len(starts)):
        heads = heads[ends[heads] >= starts[i]]
        shared = np.minimum(ends[heads], ends[i]) - starts[i] + 1  # a head never begins later
        fits = shared >= share * np.maximum(length[heads], length[i])
        if fits.any():
            region[i] = region[heads[fits.argmax()]]
        else:
            region[i], heads, n = n, np.append(heads, i), n + 1
    return region


def founder_clusters(df: DataFrame, keys: Sequence[str], start: str, end: str, carrier: str) -> DataFrame:
    """(keys, region, carriers, start, end): ends are upper medians over the carriers' least starts and largest ends.

    Which region a stretch joins depends on those before it, so a key's stretches are one task's; the rest is aggregation.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values([start, end, carrier], kind="stable")
        return g.assign(region=regions_of(g[start].to_numpy(), g[end].to_numpy()))

    own = df.select(*keys, start, end, carrier)
    placed = own.groupBy(*keys).applyInPandas(run, f"{_kinds(own, own.columns)}, region long")
    each = placed.groupBy(*keys, "region", carrier).agg(F.min(start).alias("_s"), F.max(end).alias("_e"))
    upper = lambda c: F.get(F.array_sort(F.collect_list(c)), F.floor(F.count(F.lit(1)) / 2).cast("int")).cast("long")  # noqa: E731  as long as the cohort
    return each.groupBy(*keys, "region").agg(F.count(F.lit(1)).alias("carriers"), upper("_s").alias("start"), upper("_e").alias("end"))


def deletion_class(carriers, n):
    """private, shared, cohort (most of the cohort), or alone where there is no cohort."""
    return F.when(n < 2, "alone").when(carriers >= F.greatest(F.lit(2), F.ceil(0.9 * n)), "cohort").when(carriers >= 2, "shared").otherwise("private")


# -- chains ---------------------------------------------------------------------------------------------------------


def longest_increasing(values: Sequence[float]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[float] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back[i] = at[k - 1] if k else -1
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def chains(df: DataFrame, keys: Sequence[str], a: str, b: str, least: int = 10, density: float = 0.0) -> DataFrame:
    """(keys, chain, strand, n, a_start, a_end): one increasing chain and decreasing ones while they have `least` anchors."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.drop_duplicates([a, b]).sort_values([a, b], kind="stable")
        x, y = g[a].to_numpy(), g[b].to_numpy()
        rows = []

        def take(strand: str, sign: int) -> bool:
            nonlocal x, y
            # of one place on a, the increasing walk may use one partner only: later ones come first
            order = np.lexsort((-sign * y, x))
            picked = order[longest_increasing((sign * y[order]).tolist())]
            if len(picked) < least:
                return False
            lo, hi = x[picked].min(), x[picked].max()
            if hi > lo and len(picked) / (hi - lo + 1) < density:
                return False
            rows.append(_values(g, keys) | {"chain": len(rows), "strand": strand, "n": len(picked), "a_start": int(lo), "a_end": int(hi)})
            rest = np.ones(len(x), bool)
            rest[picked] = False
            x, y = x[rest], y[rest]
            return True

        take("+", 1)
        while take("-", -1):
            pass
        return pd.DataFrame(rows, columns=[*keys, "chain", "strand", "n", "a_start", "a_end"])

    return df.groupBy(*keys).applyInPandas(run, f"{_kinds(df, keys)}, chain int, strand string, n long, a_start long, a_end long")


# -- permutation test ---------------------------------------------------------------------------------------------------


def _r(x: np.ndarray, y: np.ndarray) -> float | None:
    if len(x) < 3 or np.ptp(x) <= 1e-9 or np.ptp(y) <= 1e-9:
        return None
    return float(np.corrcoef(x, y)[0, 1])


def permutation_p(df: DataFrame, pair: str, series: str, time: str, x: str, y: str, rounds: int = 2000, block: int = 512) -> DataFrame:
    """(pair, r, n_series, p): the mean correlation over series against shuffles of x within series, seeded by the pair's name.

    A task shuffles `block` of a pair's series in all rounds and returns the sums of their correlations; a round's mean is
    the sum over blocks. The first block's generator is seeded by the name alone, a later one's by its number as well.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        name, number = str(g[pair].iloc[0]), int(g["_block"].iloc[0])
        seed = zlib.crc32(name.encode())
        rng = np.random.default_rng([seed, number] if number else seed)
        own = [(s[x].to_numpy(float), s[y].to_numpy(float)) for _, s in g.sort_values([series, time], kind="stable").groupby(series, sort=True)]
        rs = [_r(a, b) for a, b in own]
        # shuffles change neither mean nor deviation: a correlation is one product of unit vectors; flat series only use the generator
        unit = lambda v: (v - v.mean()) / np.linalg.norm(v - v.mean())
        units = [(a, None) if r is None else (unit(a), unit(b)) for (a, b), r in zip(own, rs, strict=True)]
        sums = np.zeros(rounds)
        if number:
            alike: dict[int, list] = {}  # series of one length are shuffled as rows of a matrix
            for a, b in units:
                if b is not None:
                    alike.setdefault(len(a), []).append((a, b))
            for _, members in sorted(alike.items()):
                left, right = np.array([a for a, _ in members]), np.array([b for _, b in members])
                for i in range(rounds):
                    sums[i] += np.einsum("ij,ij->", rng.permuted(left, axis=1), right)
        elif any(r is not None for r in rs):
            for i in range(rounds):
                sums[i] = sum(float(m @ b) for a, b in units if (m := rng.permutation(a)) is not None and b is not None)
        some = [r for r in rs if r is not None]
        return pd.DataFrame([{pair: g[pair].iloc[0], "_block": number, "_r": float(np.sum(some)), "_n": len(some), "_sums": sums.tolist()}])

    nth = F.row_number().over(Window.partitionBy(pair).orderBy(series))
    placed = df.select(pair, series).distinct().withColumn("_block", F.floor((nth - 1) / block).cast("int"))
    own = joined(df.select(pair, series, time, x, y), placed, [pair, series])
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = own.repartition(n, pair, "_block").groupBy(pair, "_block").applyInPandas(run, f"{_kinds(df, [pair])}, _block int, _r double, _n long, _sums array<double>")
    parts = staged(parts, "shuffles")
    seen = parts.groupBy(pair).agg(F.try_divide(F.sum("_r"), F.sum("_n")).alias("r"), F.sum("_n").alias("n_series"))
    mixed = parts.select(pair, F.posexplode("_sums").alias("_round", "_s")).groupBy(pair, "_round").agg(F.sum("_s").alias("_s"))
    both = joined(mixed, seen, [pair])
    hit = F.abs(F.try_divide("_s", "n_series")) >= F.abs("r") - 1e-12
    out = both.groupBy(pair).agg(F.first("r").alias("r"), F.first("n_series").alias("n_series"), F.count_if(hit).alias("_hits"))
    return out.select(pair, "r", "n_series", F.when(F.col("n_series") > 0, (1 + F.col("_hits")) / F.lit(rounds + 1)).alias("p"))


# -- alignment ------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class AlignParams:
    match: int = 1
    mismatch: int = -4
    gap_open: int = -6
    gap_extend: int = -1
    band: int = 64  #: beside the difference of the lengths
    most_cells: int = 50_000_000  #: of a band, a byte each; beyond there is no alignment


def affine_columns(a: str, b: str, p: AlignParams = AlignParams()) -> tuple[float, np.ndarray, np.ndarray] | None:
    """Score and columns of a global alignment with affine gaps: for each column the places in a and b, -1 in a gap.

    Only cells of the band are kept; None if they are more than `most_cells`. Of equal ways the last steps are pairs, so a
    gap in a repeat lies as far left as the scores allow. N pairs with nothing.
    """
    n, m = len(a), len(b)
    low, high = min(0, m - n) - p.band, max(0, m - n) + p.band
    width = high - low + 1
    if (n + 1) * width > p.most_cells:
        return None
    x, y = np.frombuffer(a.encode("utf-32-le"), np.uint32), np.frombuffer(b.encode("utf-32-le"), np.uint32)
    # row i has cell c for the first i letters of a and i + low + c of b
    none, c = -1e9, np.arange(width)
    padded = np.concatenate([np.full(max(0, -low), 1 << 30, np.int64), y.astype(np.int64), np.full(n + width, 1 << 30, np.int64)])
    first = low + c
    h = np.where((first >= 0) & (first <= m), np.where(first > 0, p.gap_open + p.gap_extend * first.astype(float), 0.0), none)
    up = np.full(width, none)
    came = np.zeros((n + 1, width), np.uint8)  # bits 0-1: a pair, a gap in b, a gap in a; 4, 8: that gap goes on
    came[0] = np.where(first > 0, 2, 0) | np.where(first > 1, 8, 0)
    for i in range(1, n + 1):
        j = i + low + c
        fits = (j >= 0) & (j <= m)
        above = np.append(h[1:], none) + (p.gap_open + p.gap_extend)
        on = np.append(up[1:], none) + p.gap_extend
        up = np.where(fits, np.maximum(above, on), none)
        at = i + low - 1 + max(0, -low)  # where b's letter of cell 0 lies in `padded`
        other = padded[max(at, 0) : max(at, 0) + width]
        if at < 0:
            other = np.concatenate([np.full(-at, 1 << 30, np.int64), padded[: width + at]])
        pair = h + np.where((other == x[i - 1]) & (x[i - 1] != 78), p.match, p.mismatch)
        pair = np.where(fits & (j > 0), pair, none)
        best = np.maximum(pair, up)
        # a gap in a: the best start before it, by a running maximum
        start = np.maximum.accumulate(best - p.gap_extend * c)
        side = np.full(width, none)
        side[1:] = start[:-1] + p.gap_open + p.gap_extend * c[1:]
        side = np.where(fits & (j > 0), side, none)
        h = np.maximum(best, side)
        longer = np.zeros(width, bool)
        longer[1:] = side[1:] <= side[:-1] + p.gap_extend + 1e-6
        came[i] = np.where(side > best, 2, np.where(up > pair, 1, 0)) | (on >= above).astype(np.uint8) << 2 | longer.astype(np.uint8) << 3
    i, k, state = n, m, 0
    left, right = [], []
    while i or k:
        code = int(came[i, k - i - low])
        if state == 0:
            state = code & 3
            if state == 0:
                i, k = i - 1, k - 1
                left.append(i)
                right.append(k)
                continue
        if state == 1:
            i -= 1
            left.append(i)
            right.append(-1)
            state = 1 if code & 4 else 0
        else:
            k -= 1
            left.append(-1)
            right.append(k)
            state = 2 if code & 8 else 0
    return float(h[m - n - low]), np.array(left[::-1], np.int64), np.array(right[::-1], np.int64)


def affine(a: str, b: str, p: AlignParams = AlignParams()) -> tuple[float, str] | None:
    """Score and CIGAR of `affine_columns`; a gap of n costs open + n x extend."""
    got = affine_columns(a, b, p)
    if got is None:
        return None
    score, i, j = got
    ops = np.where(i < 0, "I", np.where(j < 0, "D", "M"))
    cuts = np.flatnonzero(ops[1:] != ops[:-1]) + 1
    starts, ends = np.concatenate([[0], cuts]).astype(int), np.concatenate([cuts, [len(ops)]]).astype(int)
    return score, "".join(f"{e - s}{ops[s]}" for s, e in zip(starts, ends, strict=True) if e > s)


def cigar_score(a: str, b: str, cigar: str, p: AlignParams = AlignParams()) -> float:
    """What an alignment is worth, for tests and checks."""
    import re

    i = k = 0
    total = 0.0
    for n, op in re.findall(r"(\d+)([MDI])", cigar):
        n = int(n)
        if op == "M":
            total += sum(p.match if a[i + t] == b[k + t] else p.mismatch for t in range(n))
            i, k = i + n, k + n
        else:
            total += p.gap_open + n * p.gap_extend
            i, k = (i + n, k) if op == "D" else (i, k + n)
    assert (i, k) == (len(a), len(b))
    return total


def align(df: DataFrame, id_col: str, a: str, b: str, params: AlignParams = AlignParams()) -> DataFrame:
    """(id, score, cigar) of each row's two texts; null where the band would have too many cells.

    Rows with the same two texts share one alignment. The pairs are dealt by hash to as many tasks as shuffles have: they
    are small for their work, and would else lie in a task or two.
    """
    own = df.select(id_col, F.coalesce(a, F.lit("")).alias("_a"), F.coalesce(b, F.lit("")).alias("_b"))

    def run(parts):
        for g in parts:
            got = [affine(x, y, params) or (None, None) for x, y in zip(g["_a"], g["_b"], strict=True)]
            yield pd.DataFrame({"_a": g["_a"], "_b": g["_b"], "score": [s for s, _ in got], "cigar": [c for _, c in got]})

    pairs = own.select("_a", "_b").distinct().repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_a", "_b")
    return own.join(pairs.mapInPandas(run, "_a string, _b string, score double, cigar string"), ["_a", "_b"]).select(id_col, "score", "cigar")


# -- conversion tracts ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TractParams:
    min_bf: float = 3.0
    report_bf: float = 1.0
    prior: float = 0.01
    mean_span: float = 1000.0
    max_span: int = 10_000
    tracts: int = 2
    mutation: float = 3e-4
    max_rate: float = 0.25
    deletion_rate: float = 0.1
    tract_af: float = 0.25
    mismap: float = 0.2
    min_qual: int = 13
    max_phred: int = 30
    deletion_llr: float = 4.0
    measured: float = 10.0
    exact_sites: int = 150
    short: int = 8
    chunk: int = 4_000_000  #: numbers in a working array
    mismaps: tuple[float, ...] = field(default_factory=lambda: tuple(np.concatenate([[1e-4], np.linspace(0.02, 0.8, 16)]).round(6).tolist()))
    fractions: tuple[float, ...] = tuple(k / 10 for k in range(1, 11))
    fraction_scale: float = 0.18


def _lse(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    top = np.max(x, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    out = np.log(np.sum(np.exp(x - top), axis=axis, keepdims=True)) + top
    return out.reshape(()) if axis is None else np.squeeze(out, axis=axis)


def evidence_matrix(g: pd.DataFrame, p: TractParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Reads x sites of log-likelihood ratios donor : acceptor, the sites' places, and which are deletion markers.

    g: read, pos, allele (D, A, anything else for neither), qual, and maybe is_del.
    """
    out, sites, marker = _every_read(g, p)
    return out[np.abs(out).sum(axis=1) > 0], sites, marker


def _every_read(g: pd.DataFrame, p: TractParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`evidence_matrix` with the reads that say nothing, in the order in which they come."""
    g = g[g["qual"] >= p.min_qual]
    sites = np.sort(g["pos"].unique())
    reads = g["read"].unique()
    out = np.zeros((len(reads), len(sites)))
    r = pd.Index(reads).get_indexer(g["read"])
    s = np.searchsorted(sites, g["pos"])
    e = 10.0 ** (-np.minimum(g["qual"].to_numpy(float), p.max_phred) / 10)
    size = np.log(3 * (1 - e) / e)
    is_del = g["is_del"].to_numpy(bool) if "is_del" in g else np.zeros(len(g), bool)
    size = np.where(is_del, p.deletion_llr, size)
    sign = np.where(g["allele"] == "D", 1.0, np.where(g["allele"] == "A", -1.0, 0.0))
    out[r, s] = sign * size
    marker = np.zeros(len(sites), bool)
    marker[s[is_del]] = True
    return out, sites, marker


def candidate_intervals(sites: np.ndarray, free: np.ndarray, p: TractParams) -> np.ndarray:
    """(first, last) site of each interval inside a run of free sites, in order, that spans `max_span` bases at most.

    All of them while there are few sites; else those whose ends lie on a grid laid from each run's first site, which its
    last site belongs to as well, and all intervals of up to `short` sites.
    """
    stride = max(1, -(-int(free.sum()) // p.exact_sites))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
    found = [np.empty((0, 2), np.int64)]
    for a, b in zip(edge[::2], edge[1::2] - 1, strict=True):
        grid = np.unique(np.append(np.arange(a, b + 1, stride), b))
        at = np.searchsorted(sites[grid], sites[grid] + p.max_span)  # only ends within the span, not all pairs
        found.append(np.array([(i, j) for k, i in enumerate(grid.tolist()) for j in grid[k : at[k]].tolist()], np.int64).reshape(-1, 2))
        i = np.repeat(np.arange(a, b + 1), p.short)
        j = i + np.tile(np.arange(p.short), b + 1 - a)
        found.append(np.column_stack([i, j])[j <= b])
    every = np.unique(np.concatenate(found), axis=0)
    return every[sites[every[:, 1]] - sites[every[:, 0]] + 1 <= p.max_span]


def _scores(delta: np.ndarray, cand: np.ndarray, p: TractParams, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates x mismaps x fractions of weighted log evidence, and the null's by mismap; a row of delta counts `times`."""
    total = delta.sum(axis=1)
    prefix = np.concatenate([np.zeros((len(delta), 1)), np.cumsum(delta, axis=1)], axis=1)
    ms, fs = np.array(p.mismaps), np.array(p.fractions)
    wm = np.full(len(ms), -np.log(len(ms)))
    wf = -(1 - fs) / p.fraction_scale
    wf = wf - _lse(wf)
    null = np.array([np.logaddexp(np.log(m) + total, np.log1p(-m)) @ times for m in ms]) + wm
    out = np.empty((len(cand), len(ms), len(fs)))
    step = max(1, p.chunk // max(1, len(delta)))
    for at in range(0, len(cand), step):
        c = cand[at : at + step]
        gain = (prefix[:, c[:, 1] + 1] - prefix[:, c[:, 0]]).T  # candidates x reads
        for b, f in enumerate(fs):
            inner = gain if f >= 1 else np.logaddexp(np.log(f) + gain, np.log1p(-f))
            for a, m in enumerate(ms):
                out[at : at + step, a, b] = np.logaddexp(np.log(m) + total, np.log1p(-m) + inner) @ times + wm[a] + wf[b]
    return out, null


def _interval(weights: np.ndarray, values: np.ndarray, must: int, mass: float = 0.95) -> tuple[int, int]:
    """The span of the heaviest values that make up `mass`, with `must` among them."""
    order = np.argsort(-weights, kind="stable")
    k = int(np.searchsorted(np.cumsum(weights[order]), mass, "left")) + 1
    own = np.append(values[order[:k]], must)
    return int(own.min()), int(own.max())


def search_tract(delta: np.ndarray, sites: np.ndarray, marker: np.ndarray, free: np.ndarray, p: TractParams, times: np.ndarray | None = None) -> dict | None:
    """The best interval with its Bayes factors against no tract and against independent mutations; see `segment` for `times`."""
    times = np.ones(len(delta)) if times is None else times
    cand = candidate_intervals(sites, free, p)
    if not len(cand) or not len(delta):
        return None
    score, null = _scores(delta, cand, p, times)
    span = -(sites[cand[:, 1]] - sites[cand[:, 0]]) / p.mean_span
    span = span - _lse(span)
    best = int((_lse(score.reshape(len(cand), -1), axis=1) + span).argmax())
    sums = times @ delta
    outside = np.ones(len(sites), bool)
    outside[cand[best, 0] : cand[best, 1] + 1] = False
    measured = np.abs(sums) > p.measured
    local = (outside & measured & (sums > 0)).sum() / max(1, measured.sum())
    rate = np.where(marker, p.deletion_rate, 1.0) * max(p.mutation, min(p.max_rate, local))
    stay, change = np.log1p(-rate), np.log(rate)
    cs, cc = np.concatenate(([0], np.cumsum(stay))), np.concatenate(([0], np.cumsum(change)))
    inside = lambda c: c[cand[:, 1] + 1] - c[cand[:, 0]]
    flat = _lse(score.reshape(len(cand), -1), axis=1)
    conv = flat + span + cs[-1] - inside(cs)
    mut = flat + inside(cc) + cs[-1] - inside(cs)
    ev_null = float(_lse(null)) + cs[-1]
    ev_conv, ev_mut = float(_lse(conv)), float(_lse(mut))
    ln10 = np.log(10)
    bf_null, bf_mut = (ev_conv - ev_null) / ln10, (ev_conv - ev_mut) / ln10
    bf = (ev_conv - float(np.logaddexp(ev_null, ev_mut))) / ln10
    weight = np.exp(conv - ev_conv)
    top = int(conv.argmax())
    grid = np.exp(score[top] - _lse(score[top]))
    ends = []
    for side in (0, 1):
        marginal = np.bincount(cand[:, side], weight, len(sites))
        ends += _interval(marginal, sites, int(sites[cand[top, side]]))
    odds = p.prior / (1 - p.prior) * 10.0 ** np.clip(bf, -300, 300)
    return {
        "first": int(cand[top, 0]), "last": int(cand[top, 1]), "start": int(sites[cand[top, 0]]), "end": int(sites[cand[top, 1]]), "start_lo": ends[0], "start_hi": ends[1], "end_lo": ends[2], "end_hi": ends[3],
        "log10_bf": float(bf), "bf_null": float(bf_null), "bf_mut": float(bf_mut), "posterior": float(odds / (1 + odds)), "mismap": float(grid.sum(axis=1) @ np.array(p.mismaps)), "fraction": float(grid.sum(axis=0) @ np.array(p.fractions)),
    }


def tract_verdict(t: dict, n_sites: int, p: TractParams) -> str:
    if t["fraction"] < p.tract_af:
        return "ambiguous"
    if t["log10_bf"] >= p.min_bf:
        return "gene_conversion"
    if t["last"] - t["first"] + 1 >= n_sites or t["bf_mut"] <= t["bf_null"]:
        return "ambiguous"
    return "mismapping" if t["mismap"] >= p.mismap else "ambiguous"


def segment(delta: np.ndarray, sites: np.ndarray, marker: np.ndarray, p: TractParams, times: np.ndarray | None = None) -> list[dict]:
    """Tracts one after the other: an accepted one's sites no longer speak, and the rest is searched again.

    `times`: how many reads a row of delta stands for, one if None.
    """
    free, out, delta = np.ones(len(sites), bool), [], delta.copy()
    for _ in range(p.tracts):
        t = search_tract(delta, sites, marker, free, p, times)
        if t is None or t["log10_bf"] < p.report_bf:
            break
        out.append(t | {"verdict": tract_verdict(t, len(sites), p)})
        free[t["first"] : t["last"] + 1] = False
        delta[:, t["first"] : t["last"] + 1] = 0
    return out


def conversion_tracts(obs: DataFrame, keys: Sequence[str], params: TractParams = TractParams()) -> DataFrame:
    """(keys, start, end, their intervals, Bayes factors, posterior, mismap, fraction, verdict, n_sites, n_reads).

    A group's reads that show the same are one row that counts as often; they are counted before the group is one task's.
    """
    cols = ["start", "end", "start_lo", "start_hi", "end_lo", "end_hi", "log10_bf", "bf_null", "bf_mut", "posterior", "mismap", "fraction", "verdict"]

    def run(g: pd.DataFrame) -> pd.DataFrame:
        delta, sites, marker = _every_read(g, params)
        times = g.drop_duplicates("read")["_times"].to_numpy(float)
        some = np.abs(delta).sum(axis=1) > 0
        delta, times = delta[some], times[some]
        rows = [_values(g, keys) | {c: t[c] for c in cols} | {"n_sites": len(sites), "n_reads": int(times.sum())} for t in segment(delta, sites, marker, params, times)] if len(delta) else []
        return pd.DataFrame(rows, columns=[*keys, *cols, "n_sites", "n_reads"])

    kinds = ", ".join(f"`{c}` long" for c in cols[:6]) + ", " + ", ".join(f"{c} double" for c in cols[6:12])
    shows = ["pos", "allele", "qual", *(["is_del"] if "is_del" in obs.columns else [])]
    reads = obs.where(F.col("qual") >= params.min_qual).groupBy(*keys, "read").agg(F.array_sort(F.collect_list(F.struct(*shows))).alias("_shows"))
    alike = reads.groupBy(*keys, "_shows").agg(F.count(F.lit(1)).alias("_times")).withColumn("read", F.monotonically_increasing_id())
    return alike.select(*keys, "read", "_times", F.inline("_shows")).groupBy(*keys).applyInPandas(run, f"{_kinds(obs, keys)}, {kinds}, verdict string, n_sites long, n_reads long")


# -- molecules --------------------------------------------------------------------------------------------------------------


def walk_cigar(pos: int, cigar: str, seq: str, qual: Sequence[int] | None, wanted: Sequence[int], deletion_qual: int = 20, no_qual: int = 60) -> dict[int, tuple[str, int]]:
    """Base, in capitals, and quality at the wanted reference places; a deletion reads as `-`, a skip as nothing.

    Without qualities all are `no_qual`; places beyond the bases, or beyond qualities that end early, are left out.
    """
    import re

    out, q, want = {}, 0, sorted(wanted)
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        n = int(n)
        if op in "M=XDN":
            for w in want[bisect_left(want, pos) : bisect_left(want, pos + n)]:
                at = q + w - pos
                if op == "D":
                    out[w] = ("-", deletion_qual)
                elif op != "N" and at < len(seq) and (qual is None or at < len(qual)):
                    out[w] = (seq[at].upper(), no_qual if qual is None else int(qual[at]))
            pos += n
        if op in "MIS=X":
            q += n
    return out


def observations(reads: DataFrame, sites: DataFrame) -> DataFrame:
    """(qname, pos, base, qual) of reads over sites, by a bucketed join of spans and places, then the walk along each read."""
    from strandwise.functions.genomics import cigar_span
    from strandwise.operators.intervals import interval_join

    r = reads.withColumn("_end", F.col("pos") + cigar_span(F.col("cigar")) - 1).select("qname", "rname", F.col("pos").alias("_pos"), "_end", "cigar", "seq", "qual")
    met = interval_join(r, sites.select(F.col("contig").alias("rname"), F.col("pos").alias("site")), ["rname"], ("_pos", "_end"), ("site", "site"), 500)
    by = met.groupBy("qname", "_pos", "cigar", "seq", "qual").agg(F.collect_set("site").alias("sites"))

    def run(parts):
        for g in parts:
            rows = []
            for name, pos, cigar, seq, qual, own in g.itertuples(index=False):
                got = walk_cigar(pos, cigar, seq, None if qual in (None, "", "*") else [ord(c) - 33 for c in qual], list(own))
                rows += [(name, w, b, q) for w, (b, q) in got.items()]
            yield pd.DataFrame(rows, columns=["qname", "pos", "base", "qual"])

    return by.mapInPandas(run, "qname string, pos long, base string, qual int")


def count_bases(text: str) -> tuple[int, int]:
    """(reference, other) bases of a pileup string; read starts with their quality, ends, indels and gaps don't count."""
    ro = ao = i = 0
    while i < len(text):
        c = text[i]
        if c == "^":
            i += 2
            continue
        if c in "+-":
            k = i + 1
            while k < len(text) and text[k].isdigit():
                k += 1
            i = k + int(text[i + 1 : k] or 0)
            continue
        ro += c in ".,"
        ao += c in "ACGTNacgtn"
        i += 1
    return ro, ao


def pileup_counts(df: DataFrame, bases: str) -> DataFrame:
    """`ro` and `ao` of each row's pileup string."""

    @F.pandas_udf("struct<ro: int, ao: int>")
    def count(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([count_bases(t or "") for t in x], columns=["ro", "ao"])

    return df.withColumn("_c", count(bases)).withColumn("ro", F.col("_c.ro")).withColumn("ao", F.col("_c.ao")).drop("_c")


def leaf_order(pairs: Sequence[tuple[str, str, float]], nodes: Sequence[str]) -> list[str]:
    """Leaves of a single-linkage tree: groups are concatenated in the order in which their links join them."""
    group = {n: [n] for n in sorted(nodes)}
    for a, b, _ in sorted(pairs, key=lambda x: (x[2], x[0], x[1])):
        ga, gb = group[a], group[b]
        if ga is not gb:
            ga += gb
            for n in gb:
                group[n] = ga
    out: list[str] = []
    for n in sorted(nodes):
        if n not in out:
            out += group[n]
    return out
