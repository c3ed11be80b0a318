"""Coordinate lift between two assemblies: unique k-mer anchors, chains, brackets, and a two-sided identity gate."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.functions.genomics import revcomp
from strandwise.operators.intervals import interval_join
from strandwise.operators.kernels import AlignParams, affine_columns
from strandwise.operators.ordered import joined
from strandwise.session import staged


@dataclass(frozen=True)
class LiftParams:
    k: int = 21
    sample: int = 1  #: one in so many k-mers, by hash
    tolerance: int = 0  #: bases by which the two gaps of a bracket may differ
    min_chain: int = 10
    density: float = 0.2  #: anchors per anchor place of a reverse chain
    identity: float = 0.9  #: on each side of a lifted place
    max_gap: int | None = None  #: between the anchors of a bracket; None: 2 k + 2 sample + 2
    lost: int = 50  #: bases that the target lacks between two anchors of the backbone make a lost region
    align: bool = False  #: align the gaps that can't be interpolated
    align_identity: float = 0.9
    align_gap: int = 20_000  #: longer gaps aren't aligned
    align_cells: int = 20_000_000  #: of a band

    @property
    def gap(self) -> int:
        return self.max_gap if self.max_gap is not None else 2 * self.k + 2 * self.sample + 2

    @property
    def half(self) -> int:
        return self.k // 2


def cut(seqs: DataFrame, step: int, more: int) -> DataFrame:
    """(contig, at, part) from (contig, seq): pieces of `step` letters, with `more` from the next ones, that begin after `at` letters.

    A substring is sought from its text's start on, so a contig is cut by levels and no text is gone through for each of
    very many pieces; the pieces are dealt to tasks before they get short.
    """
    own = seqs.where(F.length("seq") > 0).select("contig", F.lit(0).cast("bigint").alias("at"), F.col("seq").alias("part"))
    n = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = sorted({max(1 << size, step) for size in (22, 16, 11)} | {step}, reverse=True)
    for size in levels:
        last = size == step
        # the letters beyond a piece's own stretch begin no piece: they are those that all later levels may add
        reach = F.least(F.length("part"), F.coalesce(F.col("own"), F.length("part"))) if "own" in own.columns else F.length("part")
        starts = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), reach - 1), F.lit(size)))
        got = own.select("contig", "at", "part", reach.alias("reach"), starts.alias("i"))
        own = got.select("contig", (F.col("at") + F.col("i")).alias("at"), F.substring(F.col("part"), F.col("i") + 1, F.lit(size + more)).alias("part"), F.least(F.lit(size), F.col("reach") - F.col("i")).alias("own"))
        if size >= 1 << 16 and not last and max((s for s in levels if s < size), default=0) < 1 << 16:
            own = own.repartition(n, "contig", "at")
    return own.select("contig", "at", "part")


def kmers(seqs: DataFrame, k: int, sample: int = 1, piece: int = 128) -> DataFrame:
    """(contig, pos, kmer) from (contig, seq), positions from 1; k-mers with other letters than bases are left out.

    Contigs are cut into short overlapping pieces first: finding a place costs as many steps as letters before it. A sampled
    k-mer is chosen by the hash of the lesser of it and its reverse complement: both strands agree.
    """
    p = cut(seqs, piece, k - 1).where(F.length("part") >= k)
    rows = p.select("contig", "at", F.posexplode(F.transform(F.sequence(F.lit(1), F.length("part") - k + 1), lambda i: F.substring(F.col("part"), i, F.lit(k)))).alias("i", "kmer"))
    out = rows.where(~F.col("kmer").rlike("[^ACGT]")).select("contig", (F.col("at") + F.col("i") + 1).cast("bigint").alias("pos"), "kmer")
    return out if sample <= 1 else out.where(F.pmod(F.xxhash64(F.least("kmer", revcomp(F.col("kmer")))), F.lit(sample)) == 0)


def unique_anchors(source: DataFrame, target: DataFrame, p: LiftParams = LiftParams()) -> DataFrame:
    """(src_contig, src_pos, tgt_contig, tgt_pos, strand): k-mers that each side has once; places on both strands are left out.

    Places are those of a k-mer's middle base, of an even k the one before the middle; on the other strand that is one on.
    A k-mer and its reverse complement are one key with a count and a place for each side and strand, so both sides meet
    in one aggregation that begins before the shuffle. Keys are numbers, 31 letters each; a place is its contig's number
    and 31 bits, as many as a text's length has.
    """
    names = source.select("contig").union(target.select("contig")).distinct()
    names = staged(names.select("contig", F.row_number().over(Window.orderBy("contig")).cast("bigint").alias("_id")), "contigs")
    middle = p.k - 1 - p.half

    def keyed(seqs: DataFrame, side: str) -> DataFrame:
        own = kmers(joined(seqs.select("contig", "seq"), names, ["contig"]).select(F.col("_id").alias("contig"), "seq"), p.k, p.sample)
        own = own.withColumn("back", revcomp(F.col("kmer"))).where("kmer <> back")  # one that is its own reverse complement lies on both strands
        key = F.least("kmer", "back")
        words = [F.conv(F.translate(F.substring(key, i + 1, 31), "ACGT", "0123"), 4, 10).cast("bigint").alias(f"k{i // 31}") for i in range(0, p.k, 31)]
        strand = F.when(F.col("kmer") < F.col("back"), side + "+").otherwise(side + "-")
        return own.select(*words, strand.alias("on"), F.shiftleft("contig", 31).bitwiseOR(F.col("pos")).alias("at"))

    both = keyed(source, "s").unionByName(keyed(target, "t"))
    sides = [side + strand for side in "st" for strand in "+-"]
    counted = [F.count_if(F.col("on") == x).alias("n" + x) for x in sides] + [F.min(F.when(F.col("on") == x, F.col("at"))).alias("at" + x) for x in sides]
    found = both.groupBy(*[c for c in both.columns if c not in ("on", "at")]).agg(*counted)
    once = lambda x: F.col("n" + x) == 1
    met = [F.when(once("s" + a) & once("t" + b) & ~once("t" + other), F.struct(F.col("at" + "s" + a).alias("s"), F.col("at" + "t" + b).alias("t"), F.lit("+" if a == b else "-").alias("strand"))) for a in "+-" for b, other in ("+-", "-+")]
    rows = found.select(F.explode(F.array_compact(F.array(*met))).alias("x"))
    number, pos = (lambda c: F.shiftright(c, 31)), (lambda c: c.bitwiseAND(F.lit((1 << 31) - 1)) + middle)
    on = F.when(F.col("x.strand") == "-", 1 - p.k % 2).otherwise(0)
    rows = rows.select(number(F.col("x.s")).alias("_s"), pos(F.col("x.s")).alias("src_pos"), number(F.col("x.t")).alias("_t"), (pos(F.col("x.t")) + on).alias("tgt_pos"), F.col("x.strand").alias("strand"))
    for side, name in (("_s", "src_contig"), ("_t", "tgt_contig")):
        rows = rows.join(names.select(F.col("_id").alias(side), F.col("contig").alias(name)), side)
    return rows.select("src_contig", "src_pos", "tgt_contig", "tgt_pos", "strand")


def _apart(v: np.ndarray) -> list[np.ndarray]:
    """Places of the stretches of v such that all values of one are less than all of the next: the fewest inversions can't leave one."""
    if not len(v):
        return []
    cuts = np.flatnonzero(np.maximum.accumulate(v)[:-1] < np.minimum.accumulate(v[::-1])[::-1][1:]) + 1
    return np.split(np.arange(len(v)), cuts)


def _longest(v: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places of the runs that `longest_increasing` takes of the values v[i], v[i] + 1 and so on, n[i] of them, of all i.

    Values come once, or all n are 1. A run's values lie on piles that follow each other, and whatever is put on the
    first of them takes as many off as it has values; so a run is taken as a whole or not at all.
    """
    tops: list[int] = []  # a value, the run and the number of piles up to it of each run that still has some
    runs: list[int] = []
    ends: list[int] = []
    back = [-1] * len(v)
    for i, (x, m) in enumerate(zip(v.tolist(), n.tolist(), strict=True)):
        k = bisect_left(tops, x)
        back[i], end = (runs[k - 1], ends[k - 1] + m) if k else (-1, m)
        j = bisect_right(ends, end, k)
        tops[k:j], runs[k:j], ends[k:j] = [x], [i], [end]
    out, i = [], runs[-1] if runs else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return np.array(out[::-1], np.int64)


def increasing(v: np.ndarray, n: np.ndarray | None = None) -> np.ndarray:
    """`longest_increasing` by stretches, one after the other: only those of more than one value are walked.

    With n each v is a run that begins with it and ascends by one, as for `_longest`.
    """
    n = np.ones(len(v), np.int64) if n is None else n
    return np.concatenate([s if len(s) == 1 else s[_longest(v[s], n[s])] for s in _apart(v)]) if len(v) else np.empty(0, np.int64)


def decreasing_chains(v: np.ndarray, least: int, n: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Places of a longest decreasing subsequence, then of one of what is left and so on, while they have `least` values.

    A decreasing subsequence lies in one stretch of `_apart`, so each removal looks at what its stretch keeps, not at all
    values. Of equally long ones that in the last stretch comes first, as it does in one walk over everything. With n each
    v is a run that begins with it and descends by one.
    """
    n = np.ones(len(v), np.int64) if n is None else n
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []

    def put(own: np.ndarray) -> None:
        for s in _apart(v[own]):
            part = own[s]
            if n[part].sum() >= least:
                picked = _longest(-v[part], n[part])
                if (size := int(n[part[picked]].sum())) >= least:
                    heappush(heap, (-size, -int(part[0]), part, picked))

    put(np.arange(len(v)))
    while heap:
        _, _, part, picked = heappop(heap)
        yield part[picked]
        put(np.delete(part, picked))


_LINKS = "src_contig string, chain long, strand string, src_pos long, tgt_contig string, tgt_pos long, next_src long, next_contig string, next_tgt long, clean boolean, n long"


def anchor_runs(anchors: DataFrame, block: int = 1 << 12) -> DataFrame:
    """(src_contig, src_pos, tgt_contig, tgt_pos, strand, n): n anchors, the first one given, of which each is one place on from the last.

    No other anchor lies between them on the source. Runs end with blocks of the source contig, so that tasks share a contig.
    """
    own = anchors.withColumn("_block", F.floor(F.col("src_pos") / block))
    at = Window.partitionBy("src_contig", "_block").orderBy("src_pos", "tgt_contig", "tgt_pos", "strand")
    before = lambda c: F.lag(c).over(at)
    step = F.when(F.col("strand") == "+", 1).otherwise(-1)
    on = (before("src_pos") + 1 == F.col("src_pos")) & before("strand").eqNullSafe(F.col("strand")) & before("tgt_contig").eqNullSafe(F.col("tgt_contig")) & (before("tgt_pos") + step == F.col("tgt_pos"))
    own = own.withColumn("_new", F.when(F.coalesce(on, F.lit(False)), 0).otherwise(1))
    own = own.withColumn("_run", F.sum("_new").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    runs = own.groupBy("src_contig", "_block", "_run", "tgt_contig", "strand").agg(F.min("src_pos").alias("src_pos"), F.min("tgt_pos").alias("_low"), F.max("tgt_pos").alias("_high"), F.count(F.lit(1)).alias("n"))
    return runs.select("src_contig", "src_pos", "tgt_contig", F.when(F.col("strand") == "+", F.col("_low")).otherwise(F.col("_high")).alias("tgt_pos"), "strand", "n")


def _single(v: np.ndarray, n: np.ndarray) -> bool:
    """Whether values of runs v, v + 1 and so on come once."""
    order = np.argsort(v, kind="stable")
    return bool((v[order][1:] >= (v + n)[order][:-1]).all())


def chain_links(anchors: DataFrame, p: LiftParams = LiftParams(), backbone: bool = False) -> DataFrame:
    """Each run of anchors on a chain of its source contig with the chain's next one: columns as in `_LINKS`.

    A row has the last of `n` anchors that follow each other place by place on both contigs, and the chain's next anchor.

    Chain 0 is the longest increasing one, the backbone. The others are longest decreasing ones, each of the anchors that
    those before it left, as long as they hold `min_chain` (two at least); sparse ones are left out. Target contigs follow
    each other by name. `clean`: no other anchor of any strand, on a chain or not, lies between the two. A chain's last
    anchor has no next one. A contig's runs must fit a task. With `backbone` chain 0 is the only one.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["src_pos", "tgt_contig", "tgt_pos", "strand"], kind="stable")
        n = g["n"].to_numpy()
        names, order = np.unique(g["tgt_contig"].to_numpy().astype(str), return_inverse=True)
        sign = np.where(g["strand"] == "+", 1, -1)
        value = (order.astype(np.int64) << 40) + g["tgt_pos"].to_numpy()
        low = np.where(sign > 0, value, value - n + 1)
        if not all(_single(low[sign == x], n[sign == x]) for x in (1, -1)):  # some place of the target comes again: anchor by anchor
            i, m = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            g, sign, order, n = g.iloc[i], sign[i], order[i], np.ones(len(i), np.int64)
            g = g.assign(src_pos=g["src_pos"].to_numpy() + m, tgt_pos=g["tgt_pos"].to_numpy() + sign * m)
            value = (order.astype(np.int64) << 40) + g["tgt_pos"].to_numpy()
        a, b = g["src_pos"].to_numpy(), g["tgt_pos"].to_numpy()
        forward, backward = np.flatnonzero(sign > 0), np.flatnonzero(sign < 0)
        found = [("+", forward[increasing(value[forward], n[forward])])] if len(forward) else []
        for picked in () if backbone else decreasing_chains(value[backward], max(2, p.min_chain), n[backward]):
            own = backward[picked]
            if n[own].sum() * p.sample >= p.density * (a[own[-1]] + n[own[-1]] - a[own[0]]):
                found.append(("-", own))
        out = []
        for c, (strand, own) in enumerate(found):
            after = np.append(own[1:], -1)
            some = after >= 0
            out.append(
                pd.DataFrame(
                    {
                        "src_contig": g["src_contig"].iloc[0], "chain": c, "strand": strand, "src_pos": a[own] + n[own] - 1, "tgt_contig": names[order[own]], "tgt_pos": b[own] + sign[own] * (n[own] - 1),
                        "next_src": pd.array(np.where(some, a[after], 0), "Int64"), "next_contig": np.where(some, names[order[after]], None), "next_tgt": pd.array(np.where(some, b[after], 0), "Int64"),
                        "clean": after - own == 1, "n": n[own],
                    }
                )
            )
            out[-1].loc[~some, ["next_src", "next_tgt"]] = pd.NA
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _LINKS.split(", ")])

    return anchor_runs(anchors).groupBy("src_contig").applyInPandas(run, _LINKS)


def each_anchor(links: DataFrame) -> DataFrame:
    """Links with a row for each anchor of a run; `n` is 1."""
    own = links.withColumn("_back", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    last, step = F.col("_back") == 0, F.when(F.col("strand") == "+", 1).otherwise(-1)
    src, tgt = F.col("src_pos") - F.col("_back"), F.col("tgt_pos") - step * F.col("_back")
    after = {"next_src": F.when(last, F.col("next_src")).otherwise(src + 1), "next_contig": F.when(last, F.col("next_contig")).otherwise(F.col("tgt_contig")), "next_tgt": F.when(last, F.col("next_tgt")).otherwise(tgt + step)}
    return own.withColumns(after | {"src_pos": src, "tgt_pos": tgt, "clean": F.col("clean") | ~last, "n": F.lit(1).cast("bigint")}).drop("_back")


def lost_regions(links: DataFrame, p: LiftParams = LiftParams()) -> DataFrame:
    """(contig, left, right): neighbouring anchors of the backbone between which the target lacks `lost` bases and more."""
    links = links if p.lost > 2 else each_anchor(links)  # inside a run the target lacks two places at most, of a reverse one
    less = (F.col("next_src") - F.col("src_pos")) - (F.col("next_tgt") - F.col("tgt_pos"))
    rows = links.where((F.col("chain") == 0) & (F.col("tgt_contig") == F.col("next_contig")) & (less >= p.lost))
    return rows.select(F.col("src_contig").alias("contig"), F.col("src_pos").alias("left"), F.col("next_src").alias("right"))


def _wanted(positions: DataFrame) -> DataFrame:
    return positions.select(F.col("contig").alias("src_contig"), F.col("pos").alias("p")).where(F.col("p").isNotNull()).distinct()


def place(positions: DataFrame, links: DataFrame, p: LiftParams = LiftParams()) -> DataFrame:
    """(contig, pos, tgt_contig, tgt_pos, strand, exact): places on an anchor of a chain, or between two whose gaps agree.

    A gap that holds another anchor crosses a rearrangement and places nothing, so a bracket is a pair of neighbours among
    all anchors: brackets don't overlap, and a place has one at most. Places outside of the chains are left out.
    """
    q = _wanted(positions)
    back = F.col("src_pos") - F.col("p")
    own = interval_join(q, links.withColumns({"first": F.col("src_pos") - F.col("n") + 1, "last": F.col("src_pos")}), ["src_contig"], ("p", "p"), ("first", "last"), 64)
    exact = own.select(F.col("src_contig").alias("contig"), F.col("p").alias("pos"), "tgt_contig", (F.col("tgt_pos") - F.when(F.col("strand") == "+", back).otherwise(-back)).alias("tgt_pos"), "strand", F.lit(True).alias("exact"))
    run, step = F.col("next_src") - F.col("src_pos"), F.col("next_tgt") - F.col("tgt_pos")
    along = F.when(F.col("strand") == "+", step).otherwise(-step)
    spans = links.where(F.col("clean") & (run > 1) & (run <= p.gap) & (F.abs(run - along) <= p.tolerance) & (F.col("tgt_contig") == F.col("next_contig")))
    spans = spans.withColumns({"first": F.col("src_pos") + 1, "last": F.col("next_src") - 1})
    met = interval_join(q, spans, ["src_contig"], ("p", "p"), ("first", "last"), max(64, p.gap))
    at = F.rint(F.col("tgt_pos") + (F.col("p") - F.col("src_pos")) * step / run).cast("bigint")
    return exact.unionByName(met.select(F.col("src_contig").alias("contig"), F.col("p").alias("pos"), "tgt_contig", at.alias("tgt_pos"), "strand", F.lit(False).alias("exact")))


def windows(rows: DataFrame, seqs: DataFrame, contig: str, first: Column, length: Column, name: str, most: int, step: int = 1 << 14) -> DataFrame:
    """`rows` with `name`: `length` letters, `most` at most, of its contig from place `first` on; blanks where there are none.

    Contigs are cut into overlapping pieces, so that a row meets one piece and not a whole contig.
    """
    pieces = cut(seqs, step, most).select(F.col("contig").alias(contig), F.floor(F.col("at") / step).cast("int").alias("_piece"), F.col("part").alias("_part"))
    own = rows.withColumns({"_from": F.greatest(first, F.lit(1)), "_first": first, "_length": length}).withColumn("_piece", F.floor((F.col("_from") - 1) / step).cast("int"))
    met = own.join(pieces, [contig, "_piece"], "left")
    lead = F.least(F.col("_from") - F.col("_first"), F.col("_length")).cast("int")
    inner = F.substring(F.coalesce("_part", F.lit("")), (F.col("_from") - F.col("_piece").cast("bigint") * step).cast("int"), (F.col("_length") - lead).cast("int"))
    return met.withColumn(name, F.rpad(F.concat(F.repeat(F.lit(" "), lead), inner), F.col("_length").cast("int"), " ")).drop("_from", "_first", "_length", "_piece", "_part")


def identity_gate(placed: DataFrame, source: DataFrame, target: DataFrame, p: LiftParams = LiftParams()) -> DataFrame:
    """Placed rows whose k // 2 bases before and after agree well enough on each side by itself, and the exact ones.

    Bases that either contig lacks don't count; those that count must be k // 2 at least.
    """
    h = p.half
    both = windows(placed, source, "contig", F.col("pos") - h, F.lit(2 * h + 1), "_s", 2 * h + 1)
    both = windows(both, target, "tgt_contig", F.col("tgt_pos") - h, F.lit(2 * h + 1), "_t", 2 * h + 1)
    other = F.when(F.col("strand") == "+", F.col("_t")).otherwise(revcomp(F.col("_t")))
    pairs = F.zip_with(F.split("_s", ""), F.split(other, ""), lambda a, b: F.when((a == " ") | (b == " "), 0).when(a == b, 1).otherwise(-1))
    both = both.withColumns({"_before": F.slice(pairs, 1, h), "_after": F.slice(pairs, h + 2, h)})
    counted, fine = F.lit(0), F.col("exact")
    sides = F.lit(True)
    for side in ("_before", "_after"):
        n, same = F.size(F.filter(side, lambda x: x != 0)), F.size(F.filter(side, lambda x: x == 1))
        counted, sides = counted + n, sides & ((n == 0) | (same >= p.identity * n))
    return both.where(fine | (sides & (counted >= h))).drop("_s", "_t", "_before", "_after")


def between(s: str, t: str, clean: bool, p: LiftParams = LiftParams()) -> dict[int, int | None]:
    """Places in t of the places in s, from 0, by aligning the stretch between two anchors; None: t has no counterpart.

    A place is carried by an anchor if no gap and enough matches lie between them, so that what gap there is lies beyond
    it; between two gaps it could be either one's and is left out. The bases beside it must agree as well, or a short gap
    begins there, or a long one where the bases on its other side occur only once in t. What t lacks is known only where
    that is the one gap, the bases beside it agree and no other anchor lies in the stretch.
    """
    got = affine_columns(s, t, AlignParams(band=16, most_cells=p.align_cells))
    if got is None:
        return {}
    _, i, j = got
    x, y = np.frombuffer(s.encode("utf-32-le"), np.uint32), np.frombuffer(t.encode("utf-32-le"), np.uint32)
    paired = (i >= 0) & (j >= 0)
    same = paired & (x[np.maximum(i, 0)] == y[np.maximum(j, 0)]) & (x[np.maximum(i, 0)] != 78)
    breaks = np.flatnonzero(~paired)
    first, last = (int(breaks[0]), int(breaks[-1])) if len(breaks) else (len(i), -1)
    at, good, seen = np.arange(len(i)), np.cumsum(same), np.cumsum(paired)
    left = (at < first) & (good - same >= p.align_identity * (seen - paired))
    right = (at > last) & (good[-1] - good >= p.align_identity * (seen[-1] - seen))

    def agrees(c: int, step: int, w: int = 10) -> bool:
        a, b = int(i[c]) + step * np.arange(1, w + 1), int(j[c]) + step * np.arange(1, w + 1)
        inside = (a >= 0) & (a < len(x)) & (b >= 0) & (b < len(y))
        if inside.all() and ((x[a] == y[b]) & (x[a] != 78)).sum() >= p.align_identity * w:
            return True
        near = c + step  # the nearest gap with fewer than w pairs before it
        pairs = 0
        while 0 <= near < len(i) and pairs < w and paired[near]:
            near, pairs = near + step, pairs + 1
        if pairs == w or not 0 <= near < len(i):
            return False
        run = 0
        while 0 <= near < len(i) and not paired[near]:
            near, run = near + step, run + 1
        return run <= 20 or alone(int(i[c]), -step)

    def alone(a: int, step: int, w: int = 20) -> bool:
        low, high = (max(0, a - w), a) if step < 0 else (a, min(len(x) - 1, a + w))
        n = high - low + 1
        if n < 11 or len(y) < n:
            return False
        views = np.lib.stride_tricks.sliding_window_view(y, n)
        return int(((views == x[low : high + 1]).sum(1) >= p.align_identity * n).sum()) == 1

    out: dict[int, int | None] = {int(i[c]): int(j[c]) for c in np.flatnonzero(left | right) if agrees(int(c), -1) and agrees(int(c), 1)}
    lacking = len(breaks) and last - first + 1 == len(breaks) and (j[breaks] < 0).all()
    if lacking and clean and first >= 10 and last + 10 < len(i) and same[first - 10 : first].sum() >= 9 and same[last + 1 : last + 11].sum() >= 9:
        out |= {int(i[c]): None for c in breaks}
    return out


def align_gaps(positions: DataFrame, links: DataFrame, source: DataFrame, target: DataFrame, p: LiftParams = LiftParams()) -> DataFrame:
    """(contig, pos, tgt_contig, tgt_pos, strand) of places between two anchors of a chain, by aligning what lies between them.

    Each gap that holds a place is aligned once, in the task of its row. Of several chains the tightest gap that places
    counts; a place that none gives and that some gap's target lacks has nulls. `align_gap` bounds a gap on both sides.
    """
    run, step = F.col("next_src") - F.col("src_pos"), F.abs(F.col("next_tgt") - F.col("tgt_pos"))
    spans = links.where((run > 1) & (run <= p.align_gap) & (step <= p.align_gap) & (F.col("tgt_contig") == F.col("next_contig")))
    spans = spans.withColumns({"first": F.col("src_pos") + 1, "last": F.col("next_src") - 1})
    own = ["src_contig", "chain", "strand", "src_pos", "next_src", "tgt_contig", "tgt_pos", "next_tgt", "clean"]
    met = interval_join(_wanted(positions), spans, ["src_contig"], ("p", "p"), ("first", "last"), 1024)
    gaps = met.groupBy(*own).agg(F.collect_list("p").alias("places"))  # `align_gap` places at most
    h = p.half
    low, high = F.least("tgt_pos", "next_tgt") - h, F.greatest("tgt_pos", "next_tgt") + h
    gaps = gaps.withColumns({"low": low, "high": high})
    most = p.align_gap + 2 * h + 1
    gaps = windows(gaps, source, "src_contig", F.col("src_pos") - h, F.col("next_src") - F.col("src_pos") + 2 * h + 1, "s", most)
    gaps = windows(gaps, target, "tgt_contig", F.col("low"), F.col("high") - F.col("low") + 1, "t", most)
    gaps = gaps.withColumn("t", F.when(F.col("strand") == "+", F.col("t")).otherwise(revcomp(F.col("t"))))

    def aligned(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in parts:
            rows = []
            for r in g.itertuples(index=False):
                if " " in r.s or " " in r.t:
                    continue
                found, s0 = between(r.s, r.t, bool(r.clean), p), r.src_pos - h
                for x in r.places:
                    if x - s0 in found:
                        y = found[x - s0]
                        there = None if y is None else r.low + y if r.strand == "+" else r.high - y
                        rows.append((r.src_contig, x, r.tgt_contig if there is not None else None, there, r.strand if there is not None else None, r.next_src - r.src_pos, r.chain))
            yield pd.DataFrame(rows, columns=["contig", "pos", "tgt_contig", "tgt_pos", "strand", "gap", "chain"]).astype({"tgt_pos": "Int64"})

    got = gaps.select("src_contig", "chain", "strand", "src_pos", "next_src", "tgt_contig", "clean", "places", "low", "high", "s", "t").mapInPandas(aligned, "contig string, pos long, tgt_contig string, tgt_pos long, strand string, gap long, chain long")
    best = F.min_by(F.struct("tgt_contig", "tgt_pos", "strand"), F.struct(F.col("tgt_pos").isNull(), "gap", "chain"))
    return got.groupBy("contig", "pos").agg(best.alias("b")).select("contig", "pos", "b.*")


def lift_positions(positions: DataFrame, source: DataFrame, target: DataFrame, p: LiftParams = LiftParams(), links: DataFrame | None = None) -> DataFrame:
    """Anchors, chains, brackets, gate and, with `align`, alignments in one: (contig, pos, tgt_contig, tgt_pos, strand).

    Links, and with `align` the places that need none, are written to the shared folder: what reads them several times
    would be one plan of many stages, which the driver keeps whole while it runs.

    Positions without an answer are left out; those that the target lacks have null in the target's columns.
    """
    columns = ["contig", "pos", "tgt_contig", "tgt_pos", "strand"]
    links = staged(chain_links(unique_anchors(source, target, p), p), "links") if links is None else links
    sure = identity_gate(place(positions, links, p), source, target, p).select(*columns)
    if not p.align:
        return sure
    sure = staged(sure, "sure")
    open_ = positions.join(sure, ["contig", "pos"], "left_anti")
    return sure.unionByName(align_gaps(open_, links, source, target, p).select(*columns))


def spacer_offsets(contigs: Sequence[tuple[str, int]], spacer: int = 100) -> list[tuple[str, int, int]]:
    """(contig, first, last) of contigs laid end to end with spacers, from 1."""
    out, at = [], 1
    for name, n in contigs:
        out.append((name, at, at + n - 1))
        at += n + spacer
    return out


def to_local(positions: DataFrame, layout: DataFrame, pos: str = "pos", bucket: int = 100_000) -> DataFrame:
    """(pos, contig, local) of global places; those in a spacer are left out."""
    both = interval_join(positions, layout, [], (pos, pos), ("first", "last"), bucket)
    return both.select(pos, "contig", (F.col(pos) - F.col("first") + 1).alias("local"))


def classify_synteny(anchors: DataFrame, max_shift: int = 50_000, margin: int = 1_000) -> DataFrame:
    """Per source place with several target hits the nearest one to the diagonal, if near and clear enough of the next."""
    from pyspark.sql import Window

    d = F.abs(F.col("src_pos") - F.col("tgt_pos"))
    by = Window.partitionBy("src_contig", "src_pos").orderBy("d", "tgt_contig", "tgt_pos")
    out = anchors.withColumn("d", d).withColumn("_n", F.row_number().over(by)).withColumn("_next", F.lead("d").over(by))
    return out.where((F.col("_n") == 1) & (F.col("d") <= max_shift) & (F.col("_next").isNull() | (F.col("_next") - F.col("d") >= margin))).drop("_n", "_next", "d")

