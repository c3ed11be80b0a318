import gzip
import json

import pytest
from pyspark.sql import functions as F

from strandwise.sources import genomes as G
from strandwise.sources import sinks as K
from strandwise.sources import tables as T

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tNAMED
c1\t10\t.\tA\tG\t50\tPASS\tDP=30;FLAG\tGT:AD:DP\t0/1:10,20:31
c1\tbad\t.\tA\tG\t50\tPASS\tDP=30
short\t1
c1\t12\t.\tC\tT\t.\t.\tADP=7\tGT\t1
"""


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        p = tmp_path / name
        p.write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
        return str(p)

    return write


@pytest.mark.parametrize("name", ["s.vcf", "s.vcf.gz"])
def test_vcf(spark, put, name):
    rows = G.read_vcf(spark, put(name, VCF)).orderBy("pos").collect()
    assert [(r["sample"], r["pos"], r["ref"], r["alt"]) for r in rows] == [("NAMED", 10, "A", "G"), ("NAMED", 12, "C", "T")]
    assert dict(rows[0]["fmt"]) == {"GT": "0/1", "AD": "10,20", "DP": "31"} and dict(rows[0]["info"])["FLAG"] == ""
    d = {r["pos"]: r["dp"] for r in G.depths(G.read_vcf(spark, put(name, VCF))).collect()}
    assert d == {10: 31.0, 12: 7.0}


def test_truncated_files_count_as_absent(spark, put, tmp_path):
    good = put("good.vcf.gz", VCF)
    long_ = VCF + "".join(f"c1\t{i}\t.\tA\tG\t{i * 7919 % 997}\tPASS\tDP={i * 31 % 101}\tGT\t1\n" for i in range(20, 20000))
    bad = tmp_path / "bad.vcf.gz"
    bad.write_bytes(gzip.compress(long_.encode())[:-400])
    got = G.read_vcf(spark, str(tmp_path), skip_corrupt=True)
    assert {r["file"].rsplit("/", 1)[-1] for r in got.select("file").distinct().collect()} == {"good.vcf.gz"}
    with pytest.raises(Exception, match="(?i)eof|end of"):
        G.read_vcf(spark, str(tmp_path)).collect()
    assert good


def test_split_files_keep_their_order(spark, put):
    p = put("long.txt", "\n".join(f"k{i}\t{i}" for i in range(5000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = T.lines(spark, p)
        assert df.rdd.getNumPartitions() > 3
        assert [r["text"] for r in df.orderBy("line").collect()] == [f"k{i}\t{i}" for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fasta(spark, put):
    p = put("a.fa", ">c1 some words\nacg\nTT\n>c2\nNN\n")
    fa = G.read_fasta(spark, p)
    assert [(r["contig"], r["seq"]) for r in fa.orderBy("ord").collect()] == [("c1", "ACGTT"), ("c2", "NN")]
    assert G.bases(fa).where("contig = 'c1' AND pos = 3").first()["base"] == "G"
    with pytest.raises(Exception, match="without a name"):
        G.read_fasta(spark, put("b.fa", ">\nACG\n"), strict=True).collect()


def test_gff(spark, put):
    gff = G.read_gff(spark, put("a.gff", "##x\nc1\ts\tgene\t1\t9\t.\t+\t.\tID=g1;Name=nan;gene=abc\nc1\ts\tCDS\t1\t9\t.\t+\t0\tParent=g1;Name=abc\nc1\ts\tCDS\t20\t29\t.\t-\t2\tName=lone\nc2\ts\tCDS\t1\t5\t.\t+\t0\tName=x\n"))
    assert gff.where("type = 'gene'").first()["name"] == "abc"
    assert sorted(r["name"] for r in G.genes(gff, "merged").collect()) == ["abc", "lone", "x"]
    assert sorted(r["name"] for r in G.genes(gff).collect()) == ["abc", "x"]
    assert G.genes(gff, "cds").count() == 3


def test_intervals(spark, put):
    p = put("x.txt", "chrom start end\nchromosome_1 5 2\nchrom a b\nc 7 7\n")
    assert sorted(map(tuple, G.read_intervals(spark, p).collect())) == [("c", 7, 7), ("chromosome_1", 2, 5)]
    assert ("chromosome_1", 3, 5) in set(map(tuple, G.read_intervals(spark, p, bed=True).collect()))
    one, two = (spark.createDataFrame([(c,) for c in cs], "contig string") for cs in (["c"], ["c", "d"]))
    m = put("m.csv", "rv_position,pal,repetitive,blindspot\n4,1,1,0\n5,0,0,0\n6,0,0,1\n")
    assert sorted(map(tuple, G.read_csv_mask(spark, m, one).collect())) == [("c", 4), ("c", 6)]
    with pytest.raises(Exception, match="genome of one"):
        G.read_csv_mask(spark, m, two).collect()


def test_sam_and_reads(spark, put):
    p = put("a.sam", "@HD\nr1\t0\tc\t5\t60\t3M\t*\t0\t0\tACG\tIII\tNM:i:1\nr2\t4\tc\t5\t60\t3M\t*\t0\t0\tACG\tIII\nr3\t0\tc\t5\t60\t*\t*\t0\t0\tACG\tIII\n")
    rows = G.read_sam(spark, p).collect()
    assert [r["qname"] for r in rows] == ["r1"] and dict(rows[0]["tags"]) == {"NM": "1"}
    q = put("a.fq", "@x/1 c\nACG\n+\nIII\n@y/2\nTT\n+\nII\n")
    assert sorted((r["read"], r["seq"]) for r in G.read_reads(spark, q).collect()) == [("x", "ACG"), ("y", "TT")]


def test_tables(spark, put):
    kv = T.read_kv(spark, put("s.log", "depth\t30\nbreadth\tNA\n\nnotab\n"))
    w = T.pivot_kv(kv, ["file"], ["depth", "breadth", "absent"]).first()
    assert (w["depth"], w["breadth"], w["absent"]) == ("30", None, None)
    m = T.read_meta_tsv(spark, put("m.tsv", "# sample=s1 median=3\n# x=y\ncontig\tstart\nc\t5\nd\n")).orderBy("line").collect()
    assert dict(m[0]["meta"]) == {"sample": "s1", "median": "3", "x": "y"} and dict(m[1]["row"]) == {"contig": "d", "start": None}
    lane = json.dumps({"summary": {"before_filtering": {"total_reads": 10}, "after_filtering": {"total_reads": 8, "total_bases": 80, "q30_rate": 0.5}}})
    f = T.read_fastp(spark, put("l.json", lane)).withColumn("sample", F.lit("s"))
    got = T.merge_lanes(f.union(f), ["sample"]).first()
    assert got["raw_reads"] == 20 and got["q30_rate"] == 0.5 and got["gc_content"] is None
    sn, cov = T.parse_stats(T.lines(spark, put("st.txt", "SN\tsequences:\t12\t#x\nCOV\t[1-1]\t1\t7\nCOV\t[5-8]\t8\t2\nCOV\t[1000<]\t1000\t3\n")))
    assert sn.first()["value"] == 12 and sorted((r["depth"], r["n"]) for r in cov.collect()) == [(1.0, 7), (6.5, 2), (1000.0, 3)]
    tax = T.parse_taxonomy(T.lines(spark, put("k.txt", "99\t10\t0\tR\t1\troot\n90\t9\t0\tD\t2\t  Bacteria\n50\t5\t5\tS\t7\t    Sp one\n9\t1\t1\tD\t9\t  Other\n"))).collect()
    assert {r["taxid"]: r["parent"] for r in tax} == {1: None, 2: 1, 7: 2, 9: 1}
    reads = T.parse_assignments(T.lines(spark, put("o.txt", "C\tr1/1\t77\nC\tr2\tSp (taxid 5)\nC\tr3\tA\nU\tr4\t0\n"))).collect()
    assert {r["read"]: r["taxid"] for r in reads} == {"r1": 77, "r2": 5, "r3": 81077}


def test_sheet(spark):
    cols = "sampleId string, r1 string, refId string, refFasta string, refGff string"
    sheet = T.clean_sheet(spark.createDataFrame([("a b", "x.fq", "r", "f1", "g"), ("c", " NA ", "r", "f2", "g"), ("", "", ".", "", "")], cols))
    assert sorted(r["sampleId"] for r in sheet.collect()) == ["a_b", "c"]
    errors = {tuple(r) for r in T.sheet_errors(sheet, spark.createDataFrame([("y",)], "path string")).collect()}
    assert errors == {("c", "empty r1"), ("a_b", "reference conflict"), ("c", "reference conflict"), ("a_b", "no such file in r1")}
    assert {r["rule"] for r in T.sheet_errors(sheet.drop("refGff")).collect()} == {"missing column refGff"}
    assert T.roles(["Sample", "Time point", "timepoint", "PATIENT", "Dose"]) == {"sample": "Sample", "time": "timepoint", "group": "PATIENT", "dose": "Dose"}
    df = spark.createDataFrame([("1", "50.5", "x", "10"), ("2", "", "3", "99")], "a string, b_pct string, c string, d string")
    assert T.metric_kind(df, ["a", "b_pct", "c", "d"], known=["d"]) == {"a": "int", "b_pct": "pct"}
    with pytest.raises(ValueError, match="did you mean min_depth"):
        T.check_params({"min_dept": 3}, ["min_depth", "max_gap"])
    assert T.optional("/x/NO_FILE_2") is None and T.optional("/x/y") == "/x/y"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s2", "WARN"), ("s1", "PASS"), ("s3", "FAIL")], "sample string, verdict string")
    assert [r["sample"] for r in K.flags_table(df, "sample").collect()] == ["s3", "s2", "s1"]
    assert not K.gate(df) and K.gate(df.where("verdict <> 'FAIL'"))
    doc = K.payload(df.groupBy("verdict").count(), ["verdict"], "count").first()["payload"]
    assert json.loads(doc)["n"] == 3 and "<script" in K.html_page(doc)
    log = K.kv_log(df, "sample", ["verdict", "depth"]).where("sample = 's1'").orderBy("nth").collect()
    assert [(r["key"], r["value"]) for r in log] == [("verdict", "PASS"), ("depth", "NA")]
    K.write_tsv(df, f"{tmp_path}/t", {"min_dp": 7})
    assert T.read_tsv(spark, f"{tmp_path}/t").count() == 3 and K.counted(df, f"{tmp_path}/p") == 3
