"""Column builders for variants, alignments and codons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandwise.functions.scalars import chained, lookup


@dataclass(frozen=True)
class CallParams:
    hom: float = 0.90
    het_min: float = 0.10
    min_dp: int = 30
    alt_fwd: int = 2
    alt_rev: int = 2


def call_rule(kind: str, fmt_dp: Column, info_dp: Column, saf: Column, sar: Column, ao: Column, ro: Column, p: CallParams = CallParams()) -> Column:
    """base, hom, het or either. A null depth or count doesn't pass."""
    af = F.when(ao + ro > 0, ao / (ao + ro))
    base = ((fmt_dp >= p.min_dp) | (info_dp >= p.min_dp)) & (saf >= p.alt_fwd) & (sar >= p.alt_rev) & (ao + ro > 0)
    rule = {"base": base, "hom": base & (af >= p.hom), "het": base & (af >= p.het_min) & (af < p.hom), "either": base & (af >= p.het_min)}[kind]
    return F.coalesce(rule, F.lit(False))


def strand_unsupported(saf: Column, sar: Column, p: CallParams = CallParams()) -> Column:
    return F.coalesce((saf < p.alt_fwd) | (sar < p.alt_rev), F.lit(False))


def variant_kind(ref: Column, alt: Column) -> Column:
    """SNP, MNP (equal lengths), INDEL (lengths differ), or SKIP for `*` and symbolic alleles."""
    return (
        F.when((alt == "*") | alt.startswith("<") | (alt == "") | (ref == ""), F.lit("SKIP"))
        .when((F.length(ref) == 1) & (F.length(alt) == 1), F.lit("SNP"))
        .when(F.length(ref) == F.length(alt), F.lit("MNP"))
        .otherwise(F.lit("INDEL"))
    )


def changed_bases(ref: Column, alt: Column) -> Column:
    """(offset, ref, alt) of the letters that differ in two texts of one length."""
    both = F.arrays_zip(F.sequence(F.lit(0), F.length(ref) - 1).alias("at"), F.split(ref, "").alias("r"), F.split(alt, "").alias("a"))
    return F.filter(both, lambda x: x["r"] != x["a"])


def af_dp(fmt: Column) -> tuple[Column, Column]:
    """Allele fraction and depth from a FORMAT map: AD (two counts or more), else AO and RO, else the genotype's dosage."""
    ad = F.transform(F.split(F.try_element_at(fmt, F.lit("AD")), ","), lambda x: x.try_cast("double"))
    ad = F.when(F.forall(ad, lambda x: x.isNotNull()), ad)
    total = F.aggregate(ad, F.lit(0.0), lambda a, x: a + x)
    rest = total - ad[0]
    ao, ro = (F.try_element_at(fmt, F.lit(k)).try_cast("double") for k in ("AO", "RO"))
    alleles = F.filter(F.split(F.try_element_at(fmt, F.lit("GT")), "[/|]"), lambda x: x != ".")
    dosage = F.when(F.size(alleles) > 0, F.size(F.filter(alleles, lambda x: x != "0")) / F.size(alleles))
    af = F.coalesce(F.when((F.size(ad) >= 2) & (total > 0), rest / total), F.when(ao + ro > 0, ao / (ao + ro)), dosage)
    dp = F.coalesce(F.try_element_at(fmt, F.lit("DP")).try_cast("double"), F.when(F.size(ad) >= 1, total), ao + ro)
    return af, dp


def ann_fields(info: Column) -> Column:
    """The first annotation's gene, effect, impact and changes, from a pipe-separated ANN entry."""
    first = F.split(F.regexp_extract(info, r"(?:^|;)ANN=([^;,]*)", 1), r"\|")
    at = lambda i: F.coalesce(F.get(first, F.lit(i)), F.lit(""))
    return F.struct(at(3).alias("gene"), at(1).alias("effect"), F.when(at(2) == "", F.lit("MODIFIER")).otherwise(at(2)).alias("impact"), at(9).alias("hgvs_c"), at(10).alias("hgvs_p"), at(15).alias("errors"))


#: Fixed order of effect classes: the first fragment found names the class.
EFFECT_CLASSES = (
    ("frameshift", "frameshift"),
    ("stop_gained", "stop_gained"),
    ("stop_lost", "stop_lost"),
    ("start_lost", "start_lost"),
    ("splice", "splice"),
    ("missense", "missense"),
    ("inframe", "inframe"),
    ("synonymous", "synonymous"),
    ("upstream", "upstream"),
    ("intergenic", "intergenic"),
)


def effect_class(effect: Column) -> Column:
    return chained(F.lower(effect), EFFECT_CLASSES, "other")


def cigar_span(cigar: Column) -> Column:
    """Reference bases that M, D, N, = and X operations cover."""
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(F.transform(ops, lambda x: x.cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)


def has_flags(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) != 0


#: IUPAC letters of base sets, sorted and joined (fixed by the standard).
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M",
    "CGT": "B", "AGT": "D", "ACT": "H", "ACG": "V", "ACGT": "N",
}


def iupac(bases: Column) -> Column:
    """Of an array of A, C, G, T; `X` for an empty or foreign set."""
    return lookup(F.array_join(F.array_sort(F.array_distinct(bases)), ""), IUPAC, F.lit("X"))


#: The standard genetic code: amino acids of the 64 codons in the order of the bases T, C, A, G.
_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def codon_aa(codon: Column) -> Column:
    """Amino acid of a codon, by place in the code table; null unless three of A, C, G, T."""
    at = lambda i: F.instr(F.lit("TCAG"), F.substring(codon, i, 1))
    return F.when(codon.rlike("^[ACGT]{3}$"), F.substring(F.lit(_CODE), (at(1) - 1) * 16 + (at(2) - 1) * 4 + at(3), F.lit(1)))


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


#: Three-letter to one-letter amino acids (fixed by the standard).
AMINO = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V", "Ter": "*",
}


def hgvs_short(hgvs: Column) -> Column:
    """p.Ile66Met -> I66M; null if it has another form."""
    part = lambda i: F.regexp_extract(hgvs, r"^p\.([A-Z][a-z]{2})(\d+)([A-Z][a-z]{2}|\*)", i)
    last = F.when(part(3) == "*", F.lit("*")).otherwise(lookup(part(3), AMINO))
    return F.when(part(2) != "", F.concat(lookup(part(1), AMINO), part(2), last))


def is_lof(hgvs: Column) -> Column:
    return F.coalesce(hgvs.rlike(r"(fs|\*|Ter|del|\?)"), F.lit(False))
