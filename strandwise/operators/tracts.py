"""What the reads show of tracts that have been found: fractions, molecules and the donor's side."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.operators.ordered import joined


@dataclass(frozen=True)
class EvidenceParams:
    min_depth: int = 5  #: reads that a determined site has
    trickle: float = 0.1  #: half the least fraction that a tract may have
    swap_sites: int = 2  #: readable sites of the donor's side that are needed inside and outside
    swap_af: float = 0.5  #: of the acceptor's bases at the donor, from which it has swapped


def _mean(value: str, where: Column | None = None) -> Column:
    """Mean of a locus' values, added up by place: fractions are often halfway between two rounded ones, where the order counts."""
    x = F.struct("pos", F.col(value).cast("double").alias("v"))
    own = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull() & (F.lit(True) if where is None else where), x)))
    return F.try_divide(F.aggregate(own, F.lit(0.0), lambda s, e: s + e["v"]), F.size(own))


def _round4(x: Column) -> Column:
    """Four places of the double itself, not of its shortest decimals."""
    return F.floor(x * 1e4 + 0.5) / 1e4


def tract_evidence(tracts: DataFrame, sites: DataFrame, observations: DataFrame, keys: Sequence[str], swapped: DataFrame | None = None, p: EvidenceParams = EvidenceParams()) -> DataFrame:
    """One row per tract (keys, start, end) with what its locus' sites and molecules show of it.

    sites: (keys, pos, depth, donor_af); observations: (keys, read, pos, call), call being acceptor, donor or other;
    swapped: (keys, pos, af), the acceptor's share at the donor's matching places. Tracts of a locus don't overlap.

    n_sites, n_undetermined, span_bp, n_sites_outside, donor_af_in, donor_af_outside, lowest_depth: a site is undetermined
    with fewer than `min_depth` reads or without a fraction. It counts among the tract's sites, but nowhere outside, and
    a site of any of the locus' tracts is outside of none.
    cis_reads: molecules with the donor at two sites of the tract; breakpoint_reads: with the donor inside and the acceptor
    outside; donor_only_reads: with the donor inside and outside and the acceptor nowhere outside.
    swap_in, swap_out: means of `swapped` inside and outside, null unless both sides have `swap_sites`; exchange: the donor
    swapped over the tract and only there.
    unreadable: `depth` if over half of the sites are undetermined, `trickle` if the donor's fraction is under `trickle`.
    """
    k = list(keys)
    spans = tracts.select(*k, F.col("start").alias("_start"), F.col("end").alias("_end"))
    # a locus has few tracts: each of its sites looks at all of them
    lists = spans.groupBy(*k).agg(F.collect_list(F.struct(F.col("_start").alias("s"), F.col("_end").alias("e"))).alias("_spans"))
    hit = lambda pos: F.try_element_at(F.filter("_spans", lambda t: (t["s"] <= F.col(pos)) & (F.col(pos) <= t["e"])), F.lit(1))
    sure = (F.coalesce("depth", F.lit(0)) >= p.min_depth) & F.col("donor_af").isNotNull()
    placed = joined(sites, lists, k).select(*k, "pos", "depth", "donor_af", hit("pos").alias("_t"), sure.alias("_sure"))
    inner = placed.where(F.col("_t").isNotNull()).groupBy(*k, F.col("_t.s").alias("_start")).agg(
        F.count(F.lit(1)).alias("n_sites"), F.count_if(~F.col("_sure")).alias("n_undetermined"), F.min("pos").alias("start"), F.max("pos").alias("end"),
        _round4(_mean("donor_af")).alias("donor_af_in"), F.min(F.coalesce("depth", F.lit(0))).alias("lowest_depth"),
    )
    far = placed.where(F.col("_t").isNull() & F.col("_sure"))
    outer = far.groupBy(*k).agg(F.count(F.lit(1)).alias("n_sites_outside"), _round4(_mean("donor_af")).alias("donor_af_outside"))

    # of each molecule: the donor's sites in each tract, and what it shows at determined sites outside
    seen = observations.where(F.col("call").isin("acceptor", "donor")).select(*k, "read", "pos", "call").distinct()
    seen = joined(seen, placed.select(*k, "pos", "_t", "_sure"), [*k, "pos"])
    donor, outside = F.col("call") == "donor", F.col("_t").isNull() & F.col("_sure")
    parts = seen.groupBy(*k, "read", "_t").agg(F.count_if(donor).alias("n"), F.max(outside & ~donor).alias("acc"), F.max(outside & donor).alias("don"))
    reads = parts.groupBy(*k, "read").agg(F.max("acc").alias("acc"), F.max("don").alias("don"), F.collect_list(F.when(F.col("_t").isNotNull() & (F.col("n") > 0), F.struct(F.col("_t.s").alias("s"), "n"))).alias("x"))
    each = reads.select(*k, "acc", "don", F.explode("x").alias("x")).groupBy(*k, F.col("x.s").alias("_start")).agg(
        F.count_if(F.col("x.n") >= 2).alias("cis_reads"), F.count_if("acc").alias("breakpoint_reads"), F.count_if(F.col("don") & ~F.col("acc")).alias("donor_only_reads")
    )

    out = joined(joined(inner, outer, k, "left"), each, [*k, "_start"], "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_sites_outside", "cis_reads", "breakpoint_reads", "donor_only_reads")}
    out = out.withColumns(zero | {"span_bp": F.col("end") - F.col("start") + 1})
    if swapped is not None:
        own = joined(joined(swapped.where(F.col("af").isNotNull()).select(*k, "pos", "af"), placed.select(*k, "pos"), [*k, "pos"]), spans, k)
        inside = F.col("pos").between(F.col("_start"), F.col("_end"))
        both = own.groupBy(*k, "_start").agg(F.count_if(inside).alias("_in"), F.count_if(~inside).alias("_out"), _mean("af", inside).alias("swap_in"), _mean("af", ~inside).alias("swap_out"))
        enough = (F.col("_in") >= p.swap_sites) & (F.col("_out") >= p.swap_sites)
        both = both.select(*k, "_start", *[F.when(enough, F.col(c)).alias(c) for c in ("swap_in", "swap_out")])
        out = joined(out, both, [*k, "_start"], "left")
    else:
        out = out.withColumns({c: F.lit(None).cast("double") for c in ("swap_in", "swap_out")})
    exchange = F.coalesce((F.col("swap_in") >= p.swap_af) & (F.col("swap_out") < p.swap_af), F.lit(False))
    why = F.when(2 * F.col("n_undetermined") > F.col("n_sites"), "depth").when(F.col("donor_af_in") < p.trickle, "trickle")
    return out.select(
        *k, "start", "end", "n_sites", "n_undetermined", "span_bp", "n_sites_outside", "donor_af_in", "donor_af_outside", "lowest_depth",
        "cis_reads", "breakpoint_reads", "donor_only_reads", "swap_in", "swap_out", exchange.alias("exchange"), why.alias("unreadable"),
    )


def final_verdict(tracts: DataFrame, verdict: str = "verdict") -> DataFrame:
    """`final`: the model's verdict unless the evidence overrides it.

    What the donor swapped over the tract alone is a reciprocal_exchange; else, where more polarised sites are ancestral in
    the reads than derived (columns `ancestral` and `derived`, if they are there), it is reference_derived. What the reads
    can't carry is ambiguous, whichever positive reading it had; reference_derived and mismapping stay.
    """
    older = F.coalesce(F.col("ancestral") > F.col("derived"), F.lit(False)) if {"ancestral", "derived"} <= {*tracts.columns} else F.lit(False)
    read = F.when(F.col("exchange"), "reciprocal_exchange").when(older, "reference_derived").otherwise(F.col(verdict))
    weak = F.col("unreadable").isNotNull() & read.isin("gene_conversion", "reciprocal_exchange", "ambiguous")
    return tracts.withColumn("final", F.when(weak, "ambiguous").otherwise(read))
