"""Changes of a codon that lie on the same molecule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.genomics import codon_aa


def codon_sites(changes: DataFrame, genes: DataFrame) -> DataFrame:
    """(contig, gene, codon, place, pos, strand, ref_codon, alt) of single-base changes (contig, pos, alt) inside genes.

    genes: contig, gene, start, end, strand, phase, seq, seq being the gene's bases on the plus strand. codon counts from
    1 and place from 1 to 3 along the gene; a codon that leaves the gene has no sites, and a place in several genes has
    them in each.
    """
    from strandwise.functions.genomics import revcomp
    from strandwise.operators.intervals import interval_join

    met = interval_join(changes.select("contig", "pos", "alt"), genes, ["contig"], ("pos", "pos"), ("start", "end"), 2000)
    plus = F.col("strand") == "+"
    along = F.when(plus, F.col("pos") - F.col("start")).otherwise(F.col("end") - F.col("pos")) - F.col("phase")
    coding = F.when(plus, F.col("seq")).otherwise(revcomp(F.col("seq")))
    number = F.floor(along / 3)
    codon = F.substring(coding, (F.col("phase") + number * 3 + 1).cast("int"), F.lit(3))
    out = met.where((along >= 0) & F.col("alt").isin("A", "C", "G", "T")).select("contig", "gene", (number + 1).cast("long").alias("codon"), (along % 3 + 1).cast("int").alias("place"), "pos", "strand", codon.alias("ref_codon"), "alt")
    return out.where(F.length("ref_codon") == 3)


def phased_codons(observations: DataFrame, sites: DataFrame, keys: Sequence[str] = (), least: int = 1) -> DataFrame:
    """One row per (keys, contig, gene, codon) with two changed places or three: what its molecules carry together.

    observations: (keys, contig, read, pos, base), bases on the plus strand; sites: (keys and) what `codon_sites` gives.
    Of a molecule that shows a place twice, the alternative counts if either shows it. A molecule takes part if it shows
    each changed place: mnv_reads carry all changes, partial_reads some, total_reads are all. Of several alternatives at
    a place the least letter is looked at. kind: MNV if `least` molecules carry all and none some, SNP/MNV if others
    carry some, SNP otherwise. ref_aa and aa are those of the codon before and with all changes; snp_aas those with each
    change alone, in the order of the places.

    A molecule's places are bits: what it shows and what it carries are two numbers of three bits, so that a codon's
    molecules are one aggregation by molecule and one by codon, both of which begin before the shuffle.
    """
    k = list(keys)
    own = [*k, "contig", "gene", "codon"]
    one = sites.groupBy(*own, "place").agg(F.min("pos").alias("pos"), F.min("strand").alias("strand"), F.min("ref_codon").alias("ref_codon"), F.min("alt").alias("alt"))
    coding = F.when(F.col("strand") == "+", F.col("alt")).otherwise(F.translate("alt", "ACGT", "TGCA"))
    one = one.withColumns({"coded": coding, "ref": F.substring(F.col("ref_codon"), F.col("place"), F.lit(1))}).where(F.col("coded") != F.col("ref"))
    codons = one.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("place", "pos", "ref", "coded", "alt"))).alias("x"), F.min("ref_codon").alias("ref_codon"), F.sum(F.pow(F.lit(2), F.col("place") - 1)).cast("int").alias("full")).where(F.size("x") >= 2)

    bit = F.pow(F.lit(2), F.col("place") - 1).cast("int")
    shown = observations.where(F.upper("base").isin("A", "C", "G", "T") & F.col("read").isNotNull())
    met = shown.join(one.select(*own, "place", "pos", "alt"), [*k, "contig", "pos"])
    reads = met.groupBy(*own, "read").agg(F.bit_or(bit).alias("shows"), F.bit_or(F.when(F.upper("base") == F.col("alt"), bit).otherwise(0)).alias("carries"))
    states = reads.groupBy(*own, "shows", "carries").agg(F.count(F.lit(1)).alias("n"))  # 64 rows a codon at most
    whole = states.join(codons.select(*own, "full"), own).where(F.col("shows") == F.col("full"))
    counts = whole.groupBy(*own).agg(F.sum(F.when(F.col("carries") == F.col("full"), F.col("n")).otherwise(0)).alias("mnv_reads"), F.sum(F.when((F.col("carries") > 0) & (F.col("carries") < F.col("full")), F.col("n")).otherwise(0)).alias("partial_reads"), F.sum("n").alias("total_reads"))

    put = lambda c, x: F.concat(F.substring(c, F.lit(1), x["place"] - 1), x["coded"], F.substring(c, x["place"] + 1, F.lit(3)))
    every = F.aggregate("x", F.col("ref_codon"), put)
    listed = lambda name: F.array_join(F.transform("x", lambda x: x[name].cast("string")), ",")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    out = codons.join(counts, own, "left").select(
        *own, listed("pos").alias("positions"), listed("ref").alias("ref_bases"), listed("coded").alias("alt_bases"), "ref_codon", every.alias("mnv_codon"),
        zero("mnv_reads"), zero("partial_reads"), zero("total_reads"), F.transform("x", lambda x: put(F.col("ref_codon"), x)).alias("_alone"),
    )
    kind = F.when(F.col("mnv_reads") < least, "SNP").when(F.col("partial_reads") > 0, "SNP/MNV").otherwise("MNV")
    return out.select(
        *[c for c in out.columns if c != "_alone"], F.when(F.col("total_reads") > 0, F.col("mnv_reads") / F.col("total_reads")).alias("mnv_frequency"), kind.alias("kind"),
        codon_aa(F.col("ref_codon")).alias("ref_aa"), codon_aa(F.col("mnv_codon")).alias("aa"), F.array_join(F.transform("_alone", codon_aa), ",", "?").alias("snp_aas"),
    )
