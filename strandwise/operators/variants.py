"""Variant tables: backbone, genotypes, reads, matrices, consensus and lift."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.functions import genomics as G
from strandwise.functions.scalars import lookup

NEVER_UNIQUE = 65535


def split_alleles(df: DataFrame, alt: str) -> DataFrame:
    """One row per alternative allele, with its place as `nth`."""
    return df.select("*", F.posexplode(F.split(alt, ",")).alias("nth", "allele"))


def atomise(df: DataFrame, pos: str, ref: str, alt: str) -> DataFrame:
    """SNPs and MNPs by changed base; other kinds are left out."""
    same = df.where(G.variant_kind(F.col(ref), F.col(alt)).isin("SNP", "MNP"))
    out = same.withColumn("_x", F.explode(G.changed_bases(F.col(ref), F.col(alt))))
    return out.withColumn(pos, F.col(pos) + F.col("_x.at")).withColumn(ref, F.col("_x.r")).withColumn(alt, F.col("_x.a")).drop("_x")


def revalidate(df: DataFrame, het_min: float = 0.10) -> DataFrame:
    """Depth by info_dp, then ro + ao, then 1; 0/1 with too few reference reads becomes 1/1."""
    some = lambda x: F.when(x != 0, x)
    total = F.col("ro") + F.col("ao")
    af = F.col("ro") / F.when(total > 0, total)
    return df.withColumn("dp", F.coalesce(some(F.col("info_dp")), some(total), F.lit(1))).withColumn("gt", F.when((F.col("gt") == "0/1") & (af < het_min), F.lit("1/1")).otherwise(F.col("gt")))


def backbone(df: DataFrame, mincov: int = 30, gap: int = 12) -> DataFrame:
    """Confident reference or no call by depth; `baq_dropout` where only the strict depth falls to the gap."""
    sure = F.col("dp") >= mincov
    return (
        df.withColumn("gt", F.when(sure, F.lit("0")).otherwise(F.lit("./.")))
        .withColumn("wt", F.when(sure, 1).otherwise(0))
        .withColumn("nc", F.when(sure, 0).otherwise(1))
        .withColumn("filter", F.when((F.col("dp") > gap) & (F.col("dp_baq") <= gap), F.lit("baq_dropout")).otherwise(F.lit("PASS")))
    )


def merge_backbone(back: DataFrame, calls: DataFrame, site: Sequence[str]) -> DataFrame:
    """All positions: the backbone's records where no call is, and the calls."""
    return back.join(calls.select(*site).distinct(), list(site), "left_anti").unionByName(calls, allowMissingColumns=True)


def keep_reads(reads: DataFrame, track: DataFrame, kmin: int = 35) -> DataFrame:
    """`keep`: the read is anchored where it lies, or its mate is in a proper pair. No track there: anchored.

    Anchored: the span reaches the shortest unique length, or is shorter than any modelled and the place is ever unique.
    """

    def anchored(span: str, mul: str) -> Column:
        s, m = F.col(span), F.col(mul)
        return F.when(m.isNull(), True).otherwise((s >= m) | ((s < kmin) & (m != NEVER_UNIQUE)))

    own = track.select(F.col("pos"), F.col("mul").alias("_mul"))
    mate = track.select(F.col("pos").alias("mate_pos"), F.col("mul").alias("_mate_mul"))
    both = reads.join(own, "pos", "left").join(mate, "mate_pos", "left")
    rescue = F.col("paired") & F.col("proper") & anchored("mate_span", "_mate_mul")
    return both.withColumn("keep", anchored("span", "_mul") | rescue).drop("_mul", "_mate_mul")


def polarity(ref: Column, alt: Column, outgroup: Column) -> Column:
    return F.when(outgroup.isNull(), F.lit("unreadable")).when(outgroup == ref, F.lit("derived")).when(outgroup == alt, F.lit("ancestral")).otherwise(F.lit("third"))


def lift(variants: DataFrame, mapping: DataFrame) -> DataFrame:
    """Positions and alleles on the target; what has no place there, or equals its base, is dropped. `opos` keeps the old place."""
    both = variants.withColumnRenamed("pos", "opos").join(mapping.withColumnRenamed("src_pos", "opos"), "opos")
    alt = F.when(F.col("strand") == "-", G.revcomp(F.col("alt"))).otherwise(F.col("alt"))
    return both.withColumn("alt", alt).where(F.col("tgt_pos").isNotNull() & (F.col("alt") != F.col("canon"))).select(*[c for c in variants.columns if c not in ("pos", "alt")], "opos", F.col("tgt_pos").alias("pos"), "alt", F.col("canon").alias("ref"))


def pileup(obs: DataFrame, site: Sequence[str]) -> DataFrame:
    """Counts of acceptor, donor and other bases by site, and the donor's share of the first two."""
    acc, don = F.col("base") == F.col("acceptor"), F.col("base") == F.col("donor")
    out = obs.groupBy(*site).agg(F.count_if(acc).alias("n_acceptor"), F.count_if(don).alias("n_donor"), F.count_if(~acc & ~don).alias("n_other"), F.count(F.lit(1)).alias("depth"))
    both = F.col("n_acceptor") + F.col("n_donor")
    return out.withColumn("donor_af", F.when(both > 0, F.col("n_donor") / both))


def linkage(obs: DataFrame, tract: Sequence[str]) -> DataFrame:
    """Molecules by what they show of a tract: donor inside with acceptor outside, a breakpoint inside, or donor only."""
    n = lambda inside, donor: F.count_if((F.col("inside") == inside) & (F.col("is_donor") == donor))
    reads = obs.groupBy(*tract, "read").agg(n(True, True).alias("din"), n(True, False).alias("ain"), n(False, True).alias("dout"), n(False, False).alias("aout"))
    return reads.groupBy(*tract).agg(
        F.count_if((F.col("din") > 0) & (F.col("ain") == 0) & (F.col("aout") > 0)).alias("cis"),
        F.count_if((F.col("din") > 0) & (F.col("ain") > 0)).alias("breakpoint"),
        F.count_if((F.col("din") > 0) & (F.col("ain") == 0) & (F.col("aout") == 0)).alias("donor_only"),
        F.count(F.lit(1)).alias("molecules"),
    )


def copy_number(depth: DataFrame, genome: DataFrame, locus: Sequence[str], dp: str, keys: Sequence[str] = (), min_depth: float = 5) -> DataFrame:
    """(locus, ratio, copies, expected_af): the median depth of a locus' sites over the sample's genome-wide depth.

    `genome` holds (keys, genome_depth), one row for each sample; without keys it is one row in all. Sites under
    `min_depth` don't count. Copies are one at least, and `expected_af` is the fraction of one of them; where no site or
    no genome depth is left, all three are null. A locus' sites fit one group.
    """
    wide = [*keys, *[c for c in locus if c not in keys]]
    seen = depth.groupBy(*wide).agg(F.median(F.when(F.col(dp) >= min_depth, F.col(dp))).alias("_locus"))
    own = genome.select(*keys, F.when(F.col("genome_depth") > 0, F.col("genome_depth")).alias("_genome"))
    out = seen.join(own, list(keys), "left") if keys else seen.crossJoin(F.broadcast(own))  # one row
    out = out.withColumn("ratio", F.col("_locus") / F.col("_genome"))
    out = out.withColumn("copies", F.when(F.col("ratio").isNotNull(), F.greatest(F.lit(1), F.bround("ratio", 0)).cast("bigint")))
    return out.withColumn("expected_af", 1.0 / F.col("copies")).drop("_genome", "_locus")


@dataclass(frozen=True)
class ConsensusParams:
    min_dp: int = 7
    ref_min_dp: int = 10
    max_ref_altfrac: float = 0.10
    min_alt: int = 2
    del_frac: float = 0.5


def consensus(records: DataFrame, masks: DataFrame, lengths: DataFrame, p: ConsensusParams = ConsensusParams()) -> DataFrame:
    """(contig, pos, base) for every position 1..length.

    records: contig, pos, ref, alts (array; empty for none), gt (array of allele numbers, null: missing), filter, dp, ro, ao.
    masks: contig, pos. Order of rules: masked X; any failed filter X; depth at most min_dp `-`; a lone record
    without alternative gives its base or N; else the union of called alleles as IUPAC letter, X if one isn't a base.
    """
    gap = F.lit("-")
    failed = ~F.coalesce(F.col("filter").isin("", ".", "PASS"), F.lit(True))
    base_dp = F.coalesce(F.col("ro") + F.col("ao"), F.col("dp"))
    mono = (
        F.when(~F.col("ref").isin("A", "C", "G", "T"), F.lit("N"))
        .when(F.col("gt").isNull() | F.exists("gt", lambda g: g.isNull() | (g != 0)), F.lit("N"))
        .when(base_dp < p.ref_min_dp, F.lit("N"))
        .when((F.col("dp") > 0) & ((F.col("dp") - base_dp) / F.when(F.col("dp") > 0, F.col("dp")) >= p.del_frac), F.lit("N"))
        .when((F.coalesce("ao", F.lit(0)) >= p.min_alt) & (F.col("ao") / F.when(base_dp > 0, base_dp) >= p.max_ref_altfrac), F.lit("N"))
        .otherwise(F.col("ref"))
    )
    alleles = F.concat(F.array("ref"), F.col("alts"))
    called = F.transform(F.coalesce("gt", F.array().cast("array<int>")), lambda g: F.struct(g.alias("n"), F.get(alleles, g).alias("b")))
    shaped = records.select("contig", "pos", failed.alias("failed"), "dp", (F.size("alts") == 0).alias("bare"), mono.alias("mono"), called.alias("called"))
    g = shaped.groupBy("contig", "pos").agg(
        F.bool_or("failed").alias("failed"), F.max(F.coalesce("dp", F.lit(0))).alias("dp"), F.count(F.lit(1)).alias("n"), F.bool_and("bare").alias("bare"), F.first("mono").alias("mono"), F.flatten(F.collect_list("called")).alias("called")
    )
    used = F.filter("called", lambda c: ~((F.col("n") > 1) & (c["n"] == 0)) & F.coalesce(c["b"] != "*", F.lit(True)))
    odd = F.exists(used, lambda c: F.coalesce(~c["b"].isin("A", "C", "G", "T"), F.lit(True)))
    union = F.when((F.size(used) == 0) | odd, F.lit("X")).otherwise(G.iupac(F.transform(used, lambda c: c["b"])))
    decided = g.select("contig", "pos", F.when(F.col("failed"), F.lit("X")).when(F.col("dp") <= p.min_dp, gap).when((F.col("n") == 1) & F.col("bare"), F.col("mono")).otherwise(union).alias("own"))
    axis = lengths.select("contig", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("length").cast("bigint"))).alias("pos"))
    marked = masks.select("contig", "pos").distinct().withColumn("_m", F.lit(True))
    out = axis.join(decided, ["contig", "pos"], "left").join(marked, ["contig", "pos"], "left")
    return out.select("contig", "pos", F.when(F.col("_m"), F.lit("X")).otherwise(F.coalesce("own", gap)).alias("base"))


def write_sequence(bases: DataFrame, keys: Sequence[str], width: int = 80) -> DataFrame:
    """(keys, seq, fasta): the bases in order, and wrapped. A sequence is one value: for contigs of bounded length."""
    seq = bases.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("seq"))
    return seq.withColumn("fasta", F.regexp_replace("seq", "(.{%d})(?!$)" % width, "$1\n"))


def snp_cells(calls: DataFrame, depth: DataFrame, samples: DataFrame) -> DataFrame:
    """Long site-by-sample cells with af, dp and state.

    calls: sample, contig, pos, alt, af, dp, ord (first wins). depth: sample, contig, pos, dp, alt, af (alt and af for a
    call to recover, else null). states: CALLED, RECOVERED, ABSENT (depth), UNREAD (depth 0), UNKNOWN (no record).
    """
    site = ["contig", "pos"]
    first = Window.partitionBy("sample", *site).orderBy("ord")
    own = calls.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("sample", *site, F.col("af").alias("_af"), F.col("dp").alias("_dp"), F.lit(True).alias("_own"))
    sites = calls.select(*site).distinct()
    grid = sites.join(F.broadcast(samples.select("sample")))  # the result itself has a row for each site and sample
    near = depth.join(sites, site, "left_semi").groupBy("sample", *site).agg(F.max(F.struct("dp", "alt", "af")).alias("_d"))
    out = grid.join(own, ["sample", *site], "left").join(near, ["sample", *site], "left")
    state = (
        F.when(F.col("_own"), "CALLED").when(F.col("_d.alt").isNotNull(), "RECOVERED").when(F.col("_d.dp") > 0, "ABSENT").when(F.col("_d.dp") == 0, "UNREAD").otherwise("UNKNOWN")
    )
    out = out.withColumn("state", state)
    af = F.when(F.col("state") == "CALLED", F.col("_af")).when(F.col("state") == "RECOVERED", F.col("_d.af")).when(F.col("state") == "ABSENT", F.lit(0.0))
    dp = F.when(F.col("state") == "CALLED", F.col("_dp")).otherwise(F.col("_d.dp"))
    return out.select("sample", *site, af.alias("af"), dp.alias("dp"), "state")


def pairwise_snps(bases: DataFrame) -> DataFrame:
    """(a, b, snps, compared) over variable positions: those where two samples call different bases of A, C, G, T.

    bases: (sample, pos, base), pos from 0. See `distances`: the pairs meet as bit planes, not by position.
    """
    from strandwise.operators.distances import plane_distances, planes_of_bases

    return plane_distances(planes_of_bases(bases))


def codon_change(sites: DataFrame) -> DataFrame:
    """Codon number and amino acids for substitutions in a coding sequence.

    sites: pos, alt, start, end, strand, phase, seq (the contig's). A codon that leaves the sequence gives null.
    """
    plus = F.col("strand") == "+"
    along = F.when(plus, F.col("pos") - F.col("start")).otherwise(F.col("end") - F.col("pos")) - F.col("phase")
    number = F.floor(along / 3)
    low = F.when(plus, F.col("start") + F.col("phase") + number * 3).otherwise(F.col("end") - F.col("phase") - number * 3 - 2)
    inside = (along >= 0) & (low >= F.col("start")) & (low + 2 <= F.col("end"))
    three = F.substring(F.col("seq"), low.cast("int"), F.lit(3))
    at = (F.col("pos") - low).cast("int")
    changed = F.concat(F.substring(three, F.lit(1), at), F.col("alt"), F.substring(three, at + 2, F.lit(3)))
    turn = lambda x: F.when(plus, x).otherwise(G.revcomp(x))
    out = sites.withColumn("codon", F.when(inside, number + 1)).withColumn("ref_aa", F.when(inside, G.codon_aa(turn(three)))).withColumn("alt_aa", F.when(inside, G.codon_aa(turn(changed))))
    return out.withColumn("change", F.when(F.col("ref_aa") == F.col("alt_aa"), "synonymous").when(F.col("ref_aa").isNotNull(), "nonsynonymous"))


#: Deletion, insertion and other marks of a consensus that aren't bases.
GAPS = {"-": "no call", "N": "undetermined", "X": "masked"}


def composition(seq: Column) -> Column:
    """Shares of missing, ambiguous and callable letters in percent, and the longest run of missing ones."""
    n = F.length(seq)
    count = lambda chars: n - F.length(F.translate(seq, chars, ""))
    runs = F.regexp_extract_all(seq, F.lit("([-N]+)"), F.lit(1))
    pct = lambda x: F.when(n > 0, 100.0 * x / n)
    return F.struct(
        pct(count("-N")).alias("missing"), pct(count("RYSWKMBDHV")).alias("ambiguous"), pct(count("ACGT")).alias("callable"),
        F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)).alias("longest"), F.size(runs).alias("runs"),
    )


def mark_name(letter: Column) -> Column:
    return lookup(letter, GAPS)
