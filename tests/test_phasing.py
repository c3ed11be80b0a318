"""Codon changes carried by the same molecule."""

from strandwise.operators.phasing import codon_sites, phased_codons

OBS = "sample string, contig string, read string, pos long, base string"


def test_phased_codons(spark):
    genes = spark.createDataFrame([("c", "up", 11, 19, "+", 0, "ATGAAGAAA"), ("c", "down", 31, 40, "-", 1, "GTTTCTTCAT")], "contig string, gene string, start long, `end` long, strand string, phase int, seq string")
    # up: codon 2 is AAG at 14..16; down: read from 39 on, ATG AAG AAA -> codons of TGAAGAAAC ... by its phase
    changes = spark.createDataFrame([("c", 14, "C"), ("c", 16, "T"), ("c", 17, "G"), ("c", 14, "N"), ("c", 36, "A"), ("c", 35, "G"), ("c", 5, "A"), ("c", 32, "A")], "contig string, pos long, alt string")
    sites = codon_sites(changes, genes).cache()
    got = {(r["gene"], r["codon"], r["place"]): (r["pos"], r["ref_codon"], r["alt"]) for r in sites.collect()}
    assert got == {("up", 2, 1): (14, "AAG", "C"), ("up", 2, 3): (16, "AAG", "T"), ("up", 3, 1): (17, "AAA", "G"), ("down", 2, 1): (36, "AGA", "A"), ("down", 2, 2): (35, "AGA", "G"), ("down", 3, 2): (32, "AAC", "A")}
    reads = {
        "both": {14: "C", 16: "T", 36: "A", 35: "G"},
        "both2": {14: "c", 16: "T"},
        "first": {14: "C", 16: "G"},
        "none": {14: "A", 16: "G"},
        "third": {14: "A", 16: "A"},
        "short": {14: "C"},
        "unread": {14: "C", 16: "N"},
    }
    obs = [("s", "c", r, x, b) for r, own in reads.items() for x, b in own.items()] + [("s", "c", "first", 14, "A"), ("s", "c", None, 14, "C"), ("s", "d", "both", 14, "A"), ("t", "c", "lone", 14, "C"), ("t", "c", "lone", 16, "T")]
    every = sites.crossJoin(spark.createDataFrame([("s",), ("t",), ("u",)], "sample string"))
    rows = {(r["sample"], r["gene"]): r for r in phased_codons(spark.createDataFrame(obs, OBS).repartition(4), every, ["sample"]).collect()}
    assert set(rows) == {(s, g) for s in "stu" for g in ("up", "down")}  # codons with one changed place are none
    r = rows["s", "up"]
    assert (r["codon"], r["positions"], r["ref_bases"], r["alt_bases"], r["ref_codon"], r["mnv_codon"]) == (2, "14,16", "A,G", "C,T", "AAG", "CAT")
    assert (r["mnv_reads"], r["partial_reads"], r["total_reads"], r["mnv_frequency"], r["kind"]) == (2, 1, 5, 0.4, "SNP/MNV")
    assert (r["ref_aa"], r["aa"], r["snp_aas"]) == ("K", "H", "Q,N")
    assert (rows["t", "up"]["mnv_reads"], rows["t", "up"]["kind"]) == (1, "MNV")
    d = rows["s", "down"]
    assert (d["alt_bases"], d["mnv_codon"], d["mnv_reads"], d["total_reads"]) == ("T,C", "TCA", 1, 1)
    u = rows["u", "up"]
    assert (u["mnv_reads"], u["total_reads"], u["mnv_frequency"], u["kind"]) == (0, 0, None, "SNP")


def test_least_reads(spark):
    sites = spark.createDataFrame([("c", "g", 1, p, p, "+", "AAA", "C") for p in (1, 2)], "contig string, gene string, codon long, place int, pos long, strand string, ref_codon string, alt string")
    obs = spark.createDataFrame([("c", "r", 1, "C"), ("c", "r", 2, "C")], "contig string, read string, pos long, base string")
    assert phased_codons(obs, sites, least=2).first()["kind"] == "SNP" and phased_codons(obs, sites).first()["kind"] == "MNV"
    assert phased_codons(obs.limit(0), sites).first()["total_reads"] == 0 and phased_codons(obs, sites.limit(0)).count() == 0
