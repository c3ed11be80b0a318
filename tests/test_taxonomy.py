from pyspark.sql import functions as F

from strandwise.operators import cohort as C
from strandwise.operators import taxonomy as X

TREE = [("R", 1, None, 100, "root"), ("D", 2, 1, 90, "Bacteria"), ("G", 3, 2, 80, "Ga"), ("S", 4, 3, 70, "Ga a"), ("S", 5, 3, 10, "Ga b"), ("G", 6, 2, 9, "Gb"), ("S", 7, 6, 8, "Gb c"), ("D", 8, 1, 5, "Virus")]


def tree(spark):
    rows = [("s", "f1", i, t, p, c, 0, r, n) for i, (r, t, p, c, n) in enumerate(TREE)]
    return spark.createDataFrame(rows + [("s", "f2", 0, 4, 3, 5, 5, "S", "Ga a")], "sample string, file string, line int, taxid long, parent long, clade_reads long, reads long, rank string, name string")


def test_clades_and_reads(spark):
    t = X.merge_runs(tree(spark))
    d = X.dominant_clade(t).first()
    assert (d["primary"]["name"], d["primary"]["reads"], d["secondary"]["name"], d["classified"], d["reads"], d["unclassified"]) == ("Ga a", 75, "Ga b", 100, 100, 0.0)
    assert [x["name"] for x in d["top"]] == ["Ga a", "Ga b", "Gb c", "Virus"]
    vote = X.target_vote(X.dominant_clade(t))
    assert tuple(vote.first()) == (4, "Ga a", "S", 1)
    assert X.target_share(X.dominant_clade(t), t, vote).first()["target_pct"] == 75.0
    reads = spark.createDataFrame([("r1", 4), ("r2", 7), ("r3", 3), ("r4", 1)], "read string, taxid long")
    three = spark.createDataFrame([(3,)], "taxid long")
    own = lambda **kw: sorted(r["read"] for r in X.reads_of(reads, t, three, **kw).collect())
    assert own() == ["r1", "r3"] and own(exclude=True) == ["r2", "r4"] and own(children=False, parents=True) == ["r3", "r4"]


def test_small_reports(spark):
    v = spark.createDataFrame([("a", "PASS"), ("b", "FAIL"), ("c", "PASS")], "sample string, verdict string")
    assert X.findings(v).first()["text"] == "3 samples: 2 pass, 0 to look at, 1 fail"
    typed = spark.createDataFrame([(f"s{i}", "L1") for i in range(6)], "sample string, lineage string")
    calls = spark.createDataFrame([(f"s{i}", "m", 0.5, 1) for i in range(6)] + [("s0", "n", 1.0, 2)], "sample string, mutation string, af double, grade int")
    assert {r["mutation"]: r["wide"] for r in X.lineage_wide(calls, typed).collect()} == {"m": True, "n": False}
    m = X.majority_lineage(typed.withColumn("ref", F.lit("r")), "ref", "lineage").first()
    assert (m["lineage"], m["n"]) == ("L1", 6)
    sites = spark.createDataFrame([("c", 5, "A"), ("c", 6, "C"), ("c", 60, "G")], "contig string, pos long, ref string")
    out = X.outgroup_state(sites, spark.createDataFrame([("c", 5, "T")], "contig string, pos long, base string"), spark.createDataFrame([("c", 1, 10)], "contig string, start long, `end` long"))
    assert {r["pos"]: r["outgroup"] for r in out.collect()} == {5: "T", 6: "C", 60: None}
    ch = spark.createDataFrame([("c", "5,6", "A1B", "s2", 0.5), ("c", "5", "A1B", "s1", 1.0)], "contig string, positions string, aa_change string, sample string, freq double")
    assert {r["pos"]: r["codon_changes"] for r in X.site_attachment(ch).collect()} == {5: "A1B=s1:1.00,s2:0.50", 6: "A1B=s2:0.50"}
    tr = spark.createDataFrame([("t", "c", 1, 50), ("u", "c", 900, 950)], "tract string, contig string, start long, `end` long")
    ft = spark.createDataFrame([("c", 40, 60, "g2"), ("c", 1, 9, "g1")], "contig string, start long, `end` long, name string")
    cg = spark.createDataFrame([("c", 5, "synonymous", "x"), ("c", 45, "nonsynonymous", "y"), ("c", 99, "nonsynonymous", "z")], "contig string, pos long, change string, label string")
    got = {r["tract"]: (r["genes"], r["n_syn"], r["n_nonsyn"], r["changes"]) for r in X.tract_annotation(tr, ft, cg, 16).collect()}
    assert got == {"t": ("g1,g2", 1, 1, "x,y"), "u": ("", 0, 0, "")}


def test_group_mismatch(spark):
    pairs = spark.createDataFrame([("g", "a", 3.0), ("g", "b", 4.0), ("g", "c", 30.0), ("h", "d", 90.0)], "grp string, m string, d double")
    assert [r["m"] for r in C.group_mismatch(pairs, "m", "grp", "d").collect()] == ["c"]


COLUMNS = "sample string, file string, line int, taxid long, parent long, clade_reads long, reads long, rank string, name string, pct double"


def report(sample, rows):
    return [(sample, "f", i, t, p, c, 0, r, n, float(c)) for i, (r, t, p, c, n) in enumerate(rows)]


def test_the_walk_is_forced_through_root_ranks_only(spark):
    spread = [("R", 1, None, 99, "root"), ("R1", 131567, 1, 99, "cellular organisms"), ("D", 2, 131567, 99, "Bacteria"), ("P", 3, 2, 34, "pa"), ("P", 4, 2, 33, "pb"), ("P", 5, 2, 32, "pc"), ("S", 6, 3, 12, "sp1"), ("U", 0, None, 1, "unclassified")]
    only = [("R", 1, None, 50, "root"), ("U", 0, None, 50, "unclassified")]
    empty = [("R", 1, None, 50, "root")]
    below = [("R", 1, None, 10, "root"), ("S", 20, 1, 10, "sp"), ("S1", 21, 20, 10, "strain")]
    t = X.merge_runs(spark.createDataFrame(report("a", spread) + report("b", only) + report("c", empty) + report("d", below), COLUMNS))
    got = {r["sample"]: r for r in X.dominant_clade(t).collect()}
    assert set(got) == {"a", "b", "d"}  # a root alone says nothing
    a = got["a"]
    assert (a["primary"]["name"], a["primary"]["pct"], a["unclassified"], a["secondary"]) == ("Bacteria", 99.0, 1.0, None)
    assert (got["b"]["primary"], got["b"]["unclassified"], [x["name"] for x in got["b"]["top"]]) == (None, 50.0, ["root"])
    assert got["d"]["primary"]["name"] == "sp"
    share = {r["sample"]: r["target_pct"] for r in X.target_share(X.dominant_clade(t), t, X.target_vote(X.dominant_clade(t))).collect()}
    assert share["a"] == 100.0 and share["b"] == 0.0 and share["d"] == 0.0


def test_parents_at_any_depth(spark):
    deep = [("f", i, i % 61, i) for i in range(183)] + [("g", 0, 0, 0), ("g", 1, 2, 1), ("g", 2, 1, 2), ("g", 3, 0, 3), ("g", 4, 2, 4), ("g", 5, None, 5)]
    df = spark.createDataFrame(deep, "file string, line int, depth int, taxid long").repartition(4)
    got = {(r["file"], r["line"]): r["parent"] for r in C.parents_by_depth(df, ["file"], "line", "depth", "taxid").collect()}
    assert all(got["f", i] == (i - 1 if i % 61 else None) for i in range(183))
    assert [got["g", i] for i in range(6)] == [None, 0, 0, None, 3, None]
