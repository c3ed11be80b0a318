"""Trajectories of calls over a group's samples, and pairs of calls that move together."""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.ordered import in_blocks, running
from strandwise.operators.stats import bh_fdr
from strandwise.session import staged

#: Effects that change the protein; fixed by the format of the annotations.
_CHANGES = r"(?i)missense|stop_gained|stop_lost|start_lost|frameshift|inframe|splice|initiator"


@dataclass(frozen=True)
class TrajectoryParams:
    emerge: float = 0.25
    fix: float = 0.90
    loss: float = 0.10
    least_times: int = 2  #: different times of a group
    move: float = 0.15  #: between a trajectory's ends of range


def trajectories(samples: DataFrame, calls: DataFrame, p: TrajectoryParams = TrajectoryParams()) -> DataFrame:
    """(group, site, gene, effect, impact, traj, depths, flags, label, amplitude, n_times, nth): calls that move, by group.

    samples: (group, sample, time); calls: (sample, site, af) and, if they are there, depth, gene, effect, impact. A group's
    samples are ordered by time, nulls last, then by name; those without a group or a name are left out, and so are groups
    with fewer than `least_times` different times. A sample without the call counts as 0.0, its depth as null. Of several
    calls of one sample at a site the one with the largest fraction counts. `nth` numbers a group's sites from the widest
    move on, then from the most flags, then by site.

    What a site's ends and range are follows from its calls and the number of samples alone, so absences are filled in
    for the sites that move only. A group's samples must fit a row.
    """
    named = samples.where(F.col("group").isNotNull() & F.col("sample").isNotNull()).groupBy("group", "sample").agg(F.min("time").alias("time"))
    order = Window.partitionBy("group").orderBy(F.col("time").asc_nulls_last(), "sample")
    whole = Window.partitionBy("group")
    at = named.withColumns({"i": F.row_number().over(order) - 1, "n": F.count(F.lit(1)).over(whole), "n_times": F.size(F.collect_set(F.coalesce(F.col("time").cast("string"), F.lit(""))).over(whole))})
    at = at.where(F.col("n_times") >= p.least_times).select("group", "sample", "i", "n", "n_times")
    for c in ("depth", "gene", "effect", "impact"):
        if c not in calls.columns:
            calls = calls.withColumn(c, F.lit(None).cast("int" if c == "depth" else "string"))
    own = calls.where(F.col("af").isNotNull() & F.col("site").isNotNull()).select("sample", "site", F.struct("af", "depth", "gene", "effect", "impact").alias("c"))
    one = own.groupBy("sample", "site").agg(F.max("c").alias("c"))
    met = one.join(at, "sample").groupBy("group", "site").agg(
        F.max("n").alias("n"), F.max("n_times").alias("n_times"), F.count(F.lit(1)).alias("called"), F.max("c.af").alias("top"), F.min("c.af").alias("low"),
        F.min_by("c", "i").alias("head"), F.collect_list(F.struct("i", "c.af", "c.depth")).alias("seen"),
    )
    low = F.when(F.col("called") < F.col("n"), F.least(F.col("low"), F.lit(0.0))).otherwise(F.col("low"))
    top = F.when(F.col("called") < F.col("n"), F.greatest(F.col("top"), F.lit(0.0))).otherwise(F.col("top"))
    moved = met.withColumns({"amplitude": top - low, "top": top}).where(F.col("amplitude") >= p.move)
    found = F.map_from_entries(F.transform("seen", lambda x: F.struct(x["i"], x)))
    fill = lambda name, empty: F.transform(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), lambda i: F.coalesce(F.try_element_at("found", i)[name], empty))
    full = moved.withColumn("found", found).withColumns({"traj": fill("af", F.lit(0.0)), "depths": F.transform(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), lambda i: F.try_element_at("found", i)["depth"])})
    first, last = F.element_at("traj", 1), F.element_at("traj", -1)
    is_ = {
        "emergence": (first <= p.loss) & (F.col("top") >= p.emerge),
        "fixation": (last >= p.fix) & (first < p.fix),
        "loss": (first >= p.emerge) & (last <= p.loss),
        "nonsyn": F.coalesce(F.col("head.effect").rlike(_CHANGES), F.lit(False)),
        "high_impact": F.coalesce(F.col("head.impact") == "HIGH", F.lit(False)),
    }
    flags = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in is_.items()]), lambda x: x.isNotNull())
    label = F.when(is_["emergence"] & is_["fixation"], "sweep").when(is_["emergence"], "emerge").when(is_["loss"], "lost").when(last > first, "rising").when(last < first, "declining").otherwise("stable")
    out = full.select("group", "site", "head.gene", "head.effect", "head.impact", F.transform("traj", lambda x: F.round(x, 4)).alias("traj"), "depths", flags.alias("flags"), label.alias("label"), "n_times", F.lit(1).alias("one"))
    out = out.withColumns({"amplitude": F.array_max("traj") - F.array_min("traj"), "n_flags": F.size("flags")})
    rank = [F.col("amplitude").desc(), F.col("n_flags").desc(), F.col("site")]
    return running(in_blocks(out, ["group"], rank), ["group"], rank, "one", "nth").drop("one", "n_flags", "_block")


@dataclass(frozen=True)
class EpistasisParams:
    least_r: float = 0.8
    least_times: int = 3
    top: int | None = 300  #: pairs in the report; None: all
    shuffles: int = 2000
    sites: int | None = 250  #: of a series, those with the widest moves; None: all
    tested: int | None = 800  #: strongest pairs that get a p-value; None: all
    nodes: int = 50  #: best connected sites of the matrix
    tile: int = 64  #: sites of a block of the matrix of a series


class Epistasis(NamedTuple):
    pairs: DataFrame
    matrix: DataFrame
    summary: DataFrame


def pair_correlations(traj: DataFrame, p: EpistasisParams = EpistasisParams()) -> DataFrame:
    """(group, a, b, r) of (group, site, traj, n_times, nth): Pearson's r of each two sites of a series, a before b as text.

    A series' matrix of trajectories is cut into blocks of `tile` sites, in the order of their moves; a row of the plan is
    a pair of blocks, and its correlations are one product of unit vectors. Flat trajectories have none.
    """
    own = traj.where((F.col("n_times") >= p.least_times) & (F.size("traj") >= 3))
    if p.sites is not None:
        own = own.where(F.col("nth") <= p.sites)
    rows = own.select("group", F.floor((F.col("nth") - 1) / p.tile).alias("tile"), F.struct(F.col("site").cast("string").alias("site"), "traj").alias("x"))
    tiles = staged(rows.groupBy("group", "tile").agg(F.sort_array(F.collect_list("x")).alias("x")), "tiles")  # `tile` sites at most
    both = tiles.join(tiles.select("group", F.col("tile").alias("tile_b"), F.col("x").alias("y")), "group").where("tile <= tile_b")

    def unit(x: list) -> tuple[np.ndarray, np.ndarray]:
        m = np.array([r["traj"] for r in x])
        m = m - m.mean(1, keepdims=True)
        norm = (m * m).sum(1)
        return np.where(norm[:, None] > 1e-9, m / np.sqrt(np.maximum(norm, 1e-300))[:, None], np.nan), np.array([r["site"] for r in x], object)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in parts:
            for r in g.itertuples(index=False):
                (x, a), (y, b) = unit(r.x), unit(r.y)
                if r.tile == r.tile_b:
                    i, j = np.triu_indices(len(a), 1)
                else:
                    i, j = (k.ravel() for k in np.indices((len(a), len(b))))
                c = np.clip((x @ y.T)[i, j], -1, 1)
                ok = ~np.isnan(c)
                a, b, c = a[i[ok]], b[j[ok]], c[ok]
                swap = a > b
                yield pd.DataFrame({"group": r.group, "a": np.where(swap, b, a), "b": np.where(swap, a, b), "r": c})

    kind = traj.schema["group"].dataType.simpleString()
    return both.mapInPandas(run, f"group {kind}, a string, b string, r double")


def _shuffled(g: pd.DataFrame, p: EpistasisParams) -> float:
    """The share of shuffles of a's values within each series whose mean correlation reaches the one seen."""
    seen = abs(g["r"].mean())
    rng = random.Random(zlib.crc32(f"{g['a'].iloc[0]}|{g['b'].iloc[0]}".encode()))
    own = []
    for x, y in zip(g["x"], g["y"], strict=True):
        x, y = np.asarray(x) - np.mean(x), np.asarray(y) - np.mean(y)
        own.append(((x / np.sqrt((x * x).sum())).tolist(), y / np.sqrt((y * y).sum())))
    hits = 0
    for _ in range(p.shuffles):
        total = 0.0
        for x, y in own:
            mixed = list(x)
            rng.shuffle(mixed)
            total += float(np.dot(mixed, y))
        hits += abs(total / len(own)) >= seen - 1e-12
    return (hits + 1) / (p.shuffles + 1)


def epistasis(traj: DataFrame, p: EpistasisParams = EpistasisParams()) -> Epistasis:
    """Pairs of sites whose trajectories move together, from `trajectories`.

    pairs: a, b, r (mean over series), n_series, r_min, r_max, direction, consistent, p, q, tier, those with |r| of
    `least_r` and more, by q and then |r|. p comes from shuffles within each series, seeded by the pair's name, q from all
    pairs tested; a pair is strong up to a q of 0.05, moderate up to a p of 0.05, else weak.
    matrix: i, j, a, b, r of the `nodes` sites that have the most partners, whatever their r, in the order of gene and site.
    summary: one row that says how many series, sites and pairs there were and whether `sites` or `tested` left any out.
    """
    traj = staged(traj, "trajectories")
    each = staged(pair_correlations(traj, p), "pairs")
    mean = staged(each.groupBy("a", "b").agg(F.avg("r").alias("r"), F.count(F.lit(1)).alias("n_series"), F.min("r").alias("r_min"), F.max("r").alias("r_max"), F.count_if(F.col("r") > 0).alias("n_up")), "means")
    strong = mean.where(F.abs("r") >= p.least_r)
    found = strong.count()
    if p.tested is not None:
        strong = strong.orderBy(F.abs("r").desc(), "a", "b").limit(p.tested)
    strong = staged(strong, "strong")
    side = lambda name, values: traj.where(F.col("n_times") >= p.least_times).select("group", F.col("site").cast("string").alias(name), F.col("traj").alias(values))
    rows = strong.select("a", "b").join(each, ["a", "b"]).join(side("a", "x"), ["group", "a"]).join(side("b", "y"), ["group", "b"])

    def test(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("group", kind="stable")
        return pd.DataFrame({"a": g["a"].iloc[:1], "b": g["b"].iloc[:1], "p": [_shuffled(g, p)]})

    tested = rows.groupBy("a", "b").applyInPandas(test, "a string, b string, p double")
    q = bh_fdr(staged(tested.withColumn("all", F.lit(1)), "tested"), ["all"], "p", ["a", "b"]).select("a", "b", F.round("q", 4).alias("q"))
    pairs = strong.join(tested, ["a", "b"]).join(q, ["a", "b"]).select(
        "a", "b", F.round("r", 3).alias("r"), "n_series", F.round("r_min", 3).alias("r_min"), F.round("r_max", 3).alias("r_max"),
        F.when(F.col("r") > 0, "concordant").otherwise("discordant").alias("direction"), ((F.col("n_up") == F.col("n_series")) | (F.col("n_up") == 0)).alias("consistent"),
        F.round("p", 4).alias("p"), "q", F.when(F.col("q") <= 0.05, "strong").when(F.col("p") <= 0.05, "moderate").otherwise("weak").alias("tier"),
    )
    if p.top is not None:
        pairs = pairs.orderBy("q", F.abs("r").desc(), "a", "b").limit(p.top)
    pairs = staged(pairs, "epistasis")

    ends = mean.select(F.explode(F.array("a", "b")).alias("site")).groupBy("site").agg(F.count(F.lit(1)).alias("degree"))
    genes = traj.groupBy(F.col("site").cast("string").alias("site")).agg(F.min("gene").alias("gene"))
    nodes = ends.orderBy(F.desc("degree"), "site").limit(p.nodes).join(genes, "site")
    nodes = nodes.withColumn("n", F.row_number().over(Window.orderBy(F.coalesce(F.when(F.col("gene") != "", F.col("gene")), F.lit("zzz")), "site")) - 1)  # `nodes` rows
    nodes = F.broadcast(staged(nodes.select("site", "n"), "nodes"))
    cells = mean.join(nodes.select(F.col("site").alias("a"), F.col("n").alias("x")), "a").join(nodes.select(F.col("site").alias("b"), F.col("n").alias("y")), "b")
    matrix = cells.select(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "a", "b", F.round("r", 3).alias("r"))

    series = traj.where(F.col("n_times") >= p.least_times).groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    one = series.agg(F.count(F.lit(1)).alias("n_series"), F.coalesce(F.max("n"), F.lit(0)).alias("most_sites"))
    tiers = pairs.agg(*[F.count_if(c).alias(n) for n, c in {"n_concordant": F.col("direction") == "concordant", "n_discordant": F.col("direction") == "discordant", "n_strong": F.col("tier") == "strong"}.items()])
    total = ends.agg(F.count(F.lit(1)).alias("n_nodes"))
    limit = lambda most, n: F.lit(False) if most is None else n > most
    summary = one.crossJoin(tiers).crossJoin(total).select("*", F.lit(found).cast("long").alias("n_candidates"), limit(p.sites, F.col("most_sites")).alias("sites_limited"), limit(p.tested, F.lit(found)).alias("pairs_limited"))  # one row each
    return Epistasis(pairs, matrix, summary)


def share_calls(counts: DataFrame, group: Column, sample: Column, site: Column, n: str, times: float = 1.0) -> DataFrame:
    """(group, sample, site, af, depth) of counts: a site's share of its sample's sum, `times` as much and 1 at most."""
    rows = counts.select(group.alias("group"), sample.alias("sample"), site.alias("site"), F.col(n).alias("n"))
    all_ = F.sum("n").over(Window.partitionBy("sample"))
    return rows.select("group", "sample", "site", F.least(F.lit(1.0), times * F.col("n") / all_).alias("af"), F.col("n").alias("depth"))


#: What a sample can show at a site, from the surest presence on; of several samples the first of these counts.
STATES = ("fixed", "minority", "absent", "unread", "unchecked")


@dataclass(frozen=True)
class SeriesParams:
    min_dp: int = 7  #: a site is read above it
    fixed: float = 0.9
    checked: bool = True  #: False: without cells, what the start doesn't call counts as new


def series_members(samples: DataFrame) -> DataFrame:
    """(group, sample, time, tnum, base): the samples of each series from its first time on, in `base` those of that time.

    samples: (group, sample, time, tnum, excluded). Where some times of a group are numbers, samples without one are left
    out. The start is the first time, by number and then by text, with a sample that isn't excluded; excluded samples of
    that time are left out and later ones stay. Groups need two different times among the samples that aren't excluded.
    """
    whole = Window.partitionBy("group")
    own = samples.where(F.col("group").isNotNull() & F.col("sample").isNotNull()).dropDuplicates(["group", "sample"])
    own = own.withColumn("_timed", F.max(F.col("tnum").isNotNull()).over(whole)).where(F.col("tnum").isNotNull() | ~F.col("_timed"))
    order = Window.partitionBy("group").orderBy(F.col("tnum").asc_nulls_last(), F.coalesce("time", F.lit("")), "sample")
    kept = ~F.coalesce("excluded", F.lit(False))
    text = F.coalesce("time", F.lit(""))
    own = own.withColumns({"_i": F.row_number().over(order), "_kept": kept, "_text": text})
    own = own.withColumns({"_start": F.min(F.when(F.col("_kept"), F.col("_i"))).over(whole), "_t0": F.min_by("_text", F.when(F.col("_kept"), F.col("_i"))).over(whole), "_times": F.size(F.collect_set(F.when(F.col("_kept"), F.col("_text"))).over(whole))})
    base = F.col("_kept") & (F.col("_text") == F.col("_t0"))
    out = own.where((F.col("_times") >= 2) & (F.col("_i") >= F.col("_start"))).withColumn("base", base)
    return out.where(F.col("base") | (F.col("_text") != F.col("_t0"))).select("group", "sample", "time", "tnum", "base")


def series_gains(samples: DataFrame, calls: DataFrame, cells: DataFrame | None = None, p: SeriesParams = SeriesParams()) -> DataFrame:
    """(group, sample, time, site, change, checked): what later samples of a series have that its start had not.

    samples: see `series_members`; calls: (sample, site, af); cells: (sample, site, af, dp, called), what a matrix says of
    sites that a sample doesn't call, `called` marking a call of unknown fraction. A site that a later sample has fixed is
    new if the start was read and lacks it, risen if it was a minority there, and unknown if the start wasn't read; fixed
    there it is no change. Of the start's samples the surest presence counts. A site fixed at the start and read without
    it later is lost. A call of unknown fraction is neither absent nor fixed.
    """
    member = staged(series_members(samples), "series")
    own = calls.where(F.col("af").isNotNull()).groupBy("sample", "site").agg(F.max("af").alias("af"))
    call = F.when(F.col("af") >= p.fixed, 0).when(F.col("af") > 0, 1).otherwise(2)
    states = own.select("sample", "site", call.alias("call"), F.lit(None).cast("int").alias("cell"))
    if cells is not None:
        read = F.when(F.coalesce("called", F.lit(False)), 4).when(F.col("af") >= p.fixed, 0).when(F.col("af") > 0, 1).when(F.col("dp").isNull(), 4).when(F.col("dp") > p.min_dp, 2).otherwise(3)
        states = states.union(cells.select("sample", "site", F.lit(None).cast("int"), read))
    states = states.groupBy("sample", "site").agg(F.coalesce(F.min("call"), F.min("cell")).alias("state"))
    base, later = member.where("base").select("group", "sample"), member.where(~F.col("base")).select("group", "sample", "time")
    fixed = own.where(F.col("af") >= p.fixed).select("sample", "site")

    gained = staged(later.join(fixed, "sample"), "gained")
    asked = gained.select("group", "site").distinct().join(base, "group")
    start = asked.join(states, ["sample", "site"], "left").groupBy("group", "site").agg(F.min(F.coalesce("state", F.lit(4))).alias("start"))
    at = gained.join(start, ["group", "site"])
    new = (F.col("start") == 2) | ((F.col("start") == 4) & F.lit(not p.checked))
    change = F.when(F.col("start") == 0, None).when(new, "new").when(F.col("start") == 1, "risen").otherwise("unknown")
    gains = at.select("group", "sample", "time", "site", change.alias("change")).where(F.col("change").isNotNull())

    held = base.join(fixed, "sample").select("group", "site").distinct().join(later, "group")
    lost = held.join(states.where("state = 2"), ["sample", "site"]).select("group", "sample", "time", "site", F.lit("lost").alias("change"))
    return gains.union(lost).withColumn("checked", F.lit(p.checked))
