import pytest
from pyspark.sql import functions as F

from strandwise.functions import genomics as G
from strandwise.functions import scalars as S
from strandwise.operators import variants as V


def one(spark, **cols):
    row = spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()
    return row[0] if len(cols) == 1 else row


def test_codons(spark):
    for codon, aa in (("ATG", "M"), ("TAA", "*"), ("TGG", "W"), ("GGG", "G"), ("TTT", "F"), ("CAT", "H"), ("AGA", "R"), ("ANG", None), ("AT", None)):
        assert one(spark, a=G.codon_aa(F.lit(codon))) == aa


def test_af_dp(spark):
    fmt = lambda **kv: F.create_map(*[F.lit(x) for p in kv.items() for x in p])
    for m, want in ((fmt(AD="6,2", DP="9"), (0.25, 9.0)), (fmt(AD="5", AO="1", RO="3"), (0.25, 5.0)), (fmt(GT="0/1"), (0.5, None)), (fmt(GT="1"), (1.0, None)), (fmt(GT="./."), (None, None)), (fmt(AD="0,0", GT="1/1", DP="."), (1.0, 0.0))):
        af, dp = G.af_dp(m)
        assert tuple(one(spark, af=af, dp=dp)) == want


def test_text(spark):
    assert one(spark, a=S.nested_path(F.lit("AB00123"))) == "AB/00/12/3"
    assert one(spark, a=S.nested_path(F.lit("AB0012"))) == "AB/00/1/2"
    assert one(spark, a=S.infer_run_id(F.lit("/x/y/r_1.fq.bz2"))) == "r_1"
    assert one(spark, a=G.hgvs_short(F.lit("p.Ile66Met"))) == "I66M" and one(spark, a=G.hgvs_short(F.lit("c.1A>G"))) is None
    assert dict(one(spark, a=S.kv_map(F.lit("A=1;FLAG;B=x=y")))) == {"A": "1", "FLAG": "", "B": "x=y"}
    for text, want in (("2020-01-02", 737426.0), ("02/01/2020", 737426.0), ("01/13/2020", 737437.0), ("baseline", 0.0), ("week 3.5", 3.5), ("none", None), ("2020-13-45", 2020.0)):
        assert one(spark, a=S.parse_date_ordinal(F.lit(text))) == want, text


def test_changes_and_iupac(spark):
    assert [tuple(x) for x in one(spark, a=G.changed_bases(F.lit("ACGT"), F.lit("AGGA")))] == [(1, "C", "G"), (3, "T", "A")]
    for bases, want in ((["A", "G"], "R"), (["T", "G", "C"], "B"), ([], "X"), (["A", "-"], "X"), (["A", "A"], "A")):
        assert one(spark, a=G.iupac(F.array(*map(F.lit, bases)).cast("array<string>"))) == want


RECORDS = [
    # pos, ref, alts, gt, filter, dp, ro, ao
    (1, "A", [], [0], "PASS", 30, 30, 0, "A"), (2, "A", [], [0], "baq", 30, 30, 0, "X"), (3, "A", [], [0], ".", 7, 7, 0, "-"), (4, "A", [], None, ".", 30, 30, 0, "N"), (5, "A", [], [0], ".", 30, 9, 0, "N"),
    (6, "A", [], [0], ".", 30, 14, 1, "N"), (7, "A", [], [0], ".", 30, 26, 4, "N"), (8, "A", [], [0], ".", 30, 29, 1, "A"), (9, "N", [], [0], ".", 30, 30, 0, "N"), (10, "A", ["G"], [0, 1], ".", 30, 15, 15, "R"),
    (11, "A", ["G"], [1, 1], ".", 30, 0, 30, "G"), (12, "A", ["AT"], [1], ".", 30, 0, 30, "X"), (13, "A", ["*", "C"], [1, 2], ".", 30, 0, 30, "C"), (14, "A", ["C"], [3], ".", 30, 0, 30, "X"), (15, "A", ["G"], [1], ".", 30, 0, 30, "X"),
]


def test_consensus(spark):
    schema = "contig string, pos long, ref string, alts array<string>, gt array<int>, filter string, dp int, ro int, ao int"
    rows = [("c", *r[:-1]) for r in RECORDS] + [("c", 16, "A", ["G"], [0, 1], ".", 30, 15, 15), ("c", 16, "A", ["T"], [0, 1], ".", 30, 15, 15)]
    masks = spark.createDataFrame([("c", 15), ("c", 18)], "contig string, pos long")
    lengths = spark.createDataFrame([("c", 18)], "contig string, length int")
    got = V.consensus(spark.createDataFrame(rows, schema), masks, lengths)
    assert [r["base"] for r in got.orderBy("pos").collect()] == [r[-1] for r in RECORDS] + ["K", "-", "X"]
    seq = V.write_sequence(got, ["contig"], 10).first()
    assert len(seq["seq"]) == 18 and seq["fasta"].split("\n") == [seq["seq"][:10], seq["seq"][10:]]


def test_cells(spark):
    calls = spark.createDataFrame([("s1", "c", 5, "G", 0.5, 20, 1), ("s1", "c", 5, "T", 0.9, 21, 2), ("s2", "c", 9, "T", 1.0, 8, 1)], "sample string, contig string, pos long, alt string, af double, dp int, ord int")
    depth = spark.createDataFrame([("s2", "c", 5, 0, None, None), ("s3", "c", 5, 12, None, None), ("s3", "c", 9, 10, "T", 0.3), ("s1", "c", 77, 3, None, None)], "sample string, contig string, pos long, dp int, alt string, af double")
    samples = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sample string")
    got = {(r["sample"], r["pos"]): (r["af"], r["dp"], r["state"]) for r in V.snp_cells(calls, depth, samples).collect()}
    assert got == {("s1", 5): (0.5, 20, "CALLED"), ("s2", 5): (None, 0, "UNREAD"), ("s3", 5): (0.0, 12, "ABSENT"), ("s1", 9): (None, None, "UNKNOWN"), ("s2", 9): (1.0, 8, "CALLED"), ("s3", 9): (0.3, 10, "RECOVERED")}
    from strandwise.sources.sinks import wide_matrix

    w = wide_matrix(V.snp_cells(calls, depth, samples), ["contig", "pos"], ["s1", "s2", "s3"]).collect()
    assert w[0]["s1_AF"] == "0.5000" and w[0]["s2_AF"] == "" and w[0]["s2_DP"] == "0" and w[1]["s1_DP"] == ""


def test_pairwise(spark):
    seqs = {"a": "ACGTN-", "b": "ACCTAA", "c": "TCGTAX"}
    rows = [(s, i, c) for s, seq in seqs.items() for i, c in enumerate(seq)]
    got = {(r["a"], r["b"]): (r["snps"], r["compared"]) for r in V.pairwise_snps(spark.createDataFrame(rows, "sample string, pos long, base string")).collect()}
    assert got == {("a", "b"): (1, 2), ("a", "c"): (1, 2), ("b", "c"): (2, 2)}


@pytest.mark.parametrize(("strand", "pos", "alt", "want"), [("+", 5, "T", (2, "K", "M")), ("+", 2, "G", (1, "M", "R")), ("-", 9, "A", (1, "F", "F")), ("+", 10, "A", (None, None, None))])
def test_codon_change(spark, strand, pos, alt, want):
    seq = "ATGAAGAAAC"  # + : M K K ; - of 1..9: TTT CTT CAT
    df = spark.createDataFrame([(pos, alt, 1, 9 if pos < 10 else 10, strand, 0, seq)], "pos int, alt string, start int, `end` int, strand string, phase int, seq string")
    r = V.codon_change(df).first()
    if strand == "-":
        assert r["codon"] == 1 and r["ref_aa"] == "F"
    else:
        assert (r["codon"], r["ref_aa"], r["alt_aa"]) == want


def test_composition(spark):
    c = one(spark, a=V.composition(F.lit("ACGT--NNRX")))
    assert (c["missing"], c["callable"], c["ambiguous"], c["longest"], c["runs"]) == (40.0, 40.0, 10.0, 4, 1)
