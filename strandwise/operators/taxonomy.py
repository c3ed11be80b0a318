"""Taxonomy reports, screens and read-outs of a cohort."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.ordered import exact_quantiles
from strandwise.operators.relational import closure
from strandwise.operators.stats import SCALE

def merge_runs(report: DataFrame, sample: str = "sample") -> DataFrame:
    """One tree per sample: reads and percentages added up by taxid; parent, rank, name and place of its first line."""
    pct = F.sum("pct") if "pct" in report.columns else F.lit(0.0)
    first = F.min_by(F.struct("parent", "rank", "name"), F.struct("file", "line"))
    g = report.groupBy(sample, "taxid").agg(F.sum("clade_reads").alias("clade_reads"), F.sum("reads").alias("reads"), pct.alias("pct"), first.alias("x"), F.min(F.struct("file", "line")).alias("place"))
    return g.select(sample, "taxid", "clade_reads", "reads", "pct", "x.parent", "x.rank", "x.name", "place.file", "place.line")


_TAXON = "struct<taxid: long, name: string, rank: string, reads: long, pct: double>"


class _Clades:
    """One sample's tree: children by most reads, then percentage, then place in the report."""

    def __init__(self, g: pd.DataFrame, share: float):
        g = g.sort_values(["clade_reads", "pct", "file", "line"], ascending=[False, False, True, True], kind="stable")
        known = g[g["rank"] != "U"]
        self.share, self.unclassified = share, int(g.loc[g["rank"] == "U", "clade_reads"].sum())
        self.name, self.rank, self.reads = (dict(zip(known["taxid"].astype(int), known[c], strict=True)) for c in ("name", "rank", "clade_reads"))
        self.below: dict = {}
        self.above: dict = {}
        for t, p in zip(known["taxid"].astype(int), known["parent"], strict=True):
            self.above[t] = int(p) if pd.notna(p) and int(p) in self.name else None
            self.below.setdefault(self.above[t], []).append(t)
        self.tops = self.below.get(None, [])
        self.classified = int(sum(self.reads[t] for t in self.tops))
        self.total = self.classified + self.unclassified

    def descend(self, at: int | None) -> int | None:
        """To the largest child as long as it holds the share, in any case out of the top and of root ranks, to a species at most."""
        while self.below.get(at) and not (at is not None and self.rank[at].startswith("S")):
            child = self.below[at][0]
            said_nothing = at is None or self.rank[at].startswith("R")
            if not said_nothing and self.reads[child] < self.share * self.reads[at]:
                break
            at = child
        return at

    def beside(self, at: int | None) -> list[int]:
        """Clades that branch off on the way from the top to `at`, largest first."""
        out = list(self.tops) if at is None else []
        way = []
        while at is not None:
            way.append(at)
            out += [c for c in self.below[self.above[at]] if c != at]
            at = self.above[at]
        place = {t: i for i, t in enumerate(self.name)}  # in order of reads
        return sorted((c for c in out if self.reads[c] > 0), key=place.get)

    def taxon(self, t: int) -> dict:
        return {"taxid": t, "name": self.name[t], "rank": self.rank[t], "reads": int(self.reads[t]), "pct": round(100.0 * self.reads[t] / self.total, 2)}


def dominant_clade(tree: DataFrame, sample: str = "sample", share: float = 0.5, top: int = 6) -> DataFrame:
    """(sample, reads, unclassified, classified, primary, secondary, top) of the samples whose reports say anything.

    The primary is the clade that a walk from the top ends in: to the child with most reads while it holds `share` of its
    parent, always out of root ranks, never below a species. The secondary is where such a walk ends from the largest
    clade beside that path, and `top` lists the primary and the next ones. Shares are of all reads, in percent; a report
    with nothing below its root has no primary. One sample's report, some thousand rows, is one task's group.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        t = _Clades(g, share)
        deep = any(t.below.get(x) or not t.rank[x].startswith("R") for x in t.tops)
        if not t.total or not (deep or t.unclassified):
            return pd.DataFrame(columns=[sample, "reads", "unclassified", "classified", "primary", "secondary", "top"])
        main = t.descend(None) if deep else None
        others = [t.taxon(t.descend(c)) for c in t.beside(main)[: top - 1]]
        primary = None if main is None else t.taxon(main)
        row = {sample: g[sample].iloc[0], "reads": t.total, "unclassified": round(100.0 * t.unclassified / t.total, 2), "classified": t.classified, "primary": primary}
        return pd.DataFrame([row | {"secondary": others[0] if others else None, "top": ([primary] if primary else []) + others}])

    kind = tree.schema[sample].dataType.simpleString()
    return tree.groupBy(sample).applyInPandas(run, f"{sample} {kind}, reads long, unclassified double, classified long, primary {_TAXON}, secondary {_TAXON}, top array<{_TAXON}>")


def target_vote(clades: DataFrame) -> DataFrame:
    """(taxid, name, rank, n): the primary of most samples, ties to more reads, then the lesser taxid. One row at most."""
    g = clades.where("primary IS NOT NULL").groupBy("primary.taxid").agg(F.count(F.lit(1)).alias("n"), F.sum("primary.reads").alias("r"), F.min(F.struct("primary.name", "primary.rank")).alias("x"))
    return g.orderBy(F.desc("n"), F.desc("r"), "taxid").limit(1).select("taxid", "x.name", "x.rank", "n")


def target_share(clades: DataFrame, tree: DataFrame, target: DataFrame, sample: str = "sample") -> DataFrame:
    """(sample, target_pct): the share of each sample's classified reads in the target's clade, in percent; 0 where it
    has none of it or no sample has a primary, null where nothing is classified."""
    own = tree.join(F.broadcast(target.select("taxid")), "taxid").select(sample, F.col("clade_reads").alias("_hit"))  # one taxid
    pct = F.round(100.0 * F.coalesce("_hit", F.lit(0)) / F.when(F.col("classified") > 0, F.col("classified")), 2)
    return clades.join(own, sample, "left").select(sample, pct.alias("target_pct"))


def reads_of(assignments: DataFrame, tree: DataFrame, taxids: DataFrame, children: bool = True, parents: bool = False, exclude: bool = False) -> DataFrame:
    """Reads of the taxids, and of what is below or above them in the tree; exclude: all other reads."""
    edges = tree.select(F.col("taxid").alias("child"), "parent").where("parent IS NOT NULL").distinct()
    wanted = taxids.select(F.col("taxid").alias("node"))
    seeds = taxids.select(F.col("taxid").alias("child"))
    if children:
        wanted = wanted.union(closure(edges, seeds).select("node"))
    if parents:
        wanted = wanted.union(closure(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")), seeds).select("node"))
    return assignments.join(wanted.distinct().withColumnRenamed("node", "taxid"), "taxid", "left_anti" if exclude else "left_semi").select("read", "taxid")


def divergence_screen(df: DataFrame, value: str, floor: float, sigmas: float = 2.5) -> DataFrame:
    """`diverged`: under the floor, or under the median less some robust sigmas."""
    med = exact_quantiles(df, [], value, {"_m": 0.5})
    off = df.crossJoin(F.broadcast(med)).withColumn("_off", F.abs(F.col(value) - F.col("_m")))  # one row
    cut = med.crossJoin(exact_quantiles(off, [], "_off", {"_d": 0.5})).select(F.greatest(F.lit(float(floor)), F.col("_m") - sigmas * SCALE * F.col("_d")).alias("_cut"))
    return df.crossJoin(F.broadcast(cut)).withColumn("diverged", F.col(value) < F.coalesce("_cut", F.lit(float(floor)))).drop("_cut")  # one row


def quadrant(x: Column, y: Column, x_cut: float, y_cut: float, names: Sequence[str] = ("low low", "low high", "high low", "high high")) -> Column:
    return F.when((x < x_cut) & (y < y_cut), names[0]).when((x < x_cut) & (y >= y_cut), names[1]).when((x >= x_cut) & (y < y_cut), names[2]).when((x >= x_cut) & (y >= y_cut), names[3])


def majority_lineage(df: DataFrame, reference: str, lineage: str, least: int = 3) -> DataFrame:
    """The most common lineage of each reference with enough typed samples, ties to the lesser name."""
    n = df.where(F.col(lineage).isNotNull()).groupBy(reference, lineage).agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy(reference)
    out = n.withColumn("typed", F.sum("n").over(by)).withColumn("_k", F.row_number().over(by.orderBy(F.desc("n"), lineage)))
    return out.where((F.col("_k") == 1) & (F.col("typed") >= least)).select(reference, lineage, "n", "typed")


def lineage_wide(calls: DataFrame, typed: DataFrame, share: float = 0.9, least: int = 5) -> DataFrame:
    """Mutations by lineage with carriers, median fraction, and whether nearly all of a large enough lineage have it."""
    size = typed.groupBy("lineage").agg(F.count_distinct("sample").alias("samples"))
    g = calls.join(typed, "sample").groupBy("lineage", "mutation").agg(F.count_distinct("sample").alias("carriers"), F.median("af").alias("af"), F.min("grade").alias("grade"))
    return g.join(size, "lineage").withColumn("wide", (F.col("samples") >= least) & (F.col("carriers") >= share * F.col("samples")))


def multidrug(grades: DataFrame, sample: str, first: str, second: str, worst: int = 2) -> DataFrame:
    """(sample, multi): resistant to both drugs by grades of `worst` or less in a wide grade table."""
    ok = lambda c: F.coalesce(F.col(c) <= worst, F.lit(False))
    return grades.select(sample, (ok(first) & ok(second)).alias("multi"))


def findings(df: DataFrame) -> DataFrame:
    """One row of the numbers that a summary sentence needs, and the sentence. df: sample, verdict."""
    n = lambda v: F.count_if(F.col("verdict") == v)
    g = df.agg(F.count(F.lit(1)).alias("n"), n("PASS").alias("passed"), n("WARN").alias("warned"), n("FAIL").alias("failed"))
    return g.withColumn("text", F.format_string("%d samples: %d pass, %d to look at, %d fail", "n", "passed", "warned", "failed"))


def drop_summary(before: DataFrame, after: DataFrame, keys: Sequence[str], warn_above: float = 8.0) -> DataFrame:
    """(keys, n_before, n_after, dropped_pct, warn) of a read filter."""
    n = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    both = n(before, "n_before").join(n(after, "n_after"), list(keys), "left").fillna(0, ["n_after"])
    pct = 100.0 * (F.col("n_before") - F.col("n_after")) / F.col("n_before")
    return both.withColumn("dropped_pct", pct).withColumn("warn", F.col("dropped_pct") > warn_above)


def mark_duplicates(reads: DataFrame, keys: Sequence[str] = ("rname", "pos", "strand", "mate_pos"), quality: str = "qual_sum", name: str = "qname") -> DataFrame:
    """The best read of each fragment position; ties to the lesser name."""
    by = Window.partitionBy(*keys).orderBy(F.desc(quality), name)
    return reads.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def outgroup_state(sites: DataFrame, differences: DataFrame, coverage: DataFrame, bucket: int = 10_000) -> DataFrame:
    """`outgroup` at each site: the difference where there is one, the reference base where it is covered, else null."""
    from strandwise.operators.intervals import point_in_interval

    covered = point_in_interval(sites.select("contig", "pos").distinct(), coverage, ["contig"], "pos", bucket).withColumn("_cov", F.lit(True))
    d = differences.select("contig", "pos", F.col("base").alias("_d"))
    both = sites.join(d, ["contig", "pos"], "left").join(covered, ["contig", "pos"], "left")
    return both.withColumn("outgroup", F.coalesce("_d", F.when(F.col("_cov"), F.col("ref")))).drop("_d", "_cov")


def readable(df: DataFrame, undetermined: str, sites: str, donor_af: str, least_af: float = 0.10) -> DataFrame:
    """`readable`: at most half of a tract's sites are undetermined and the donor is seen at all."""
    return df.withColumn("readable", (2 * F.col(undetermined) <= F.col(sites)) & (F.col(donor_af) >= least_af))


def consensus_header(sample: Column, contig: Column, n_contigs: Column) -> Column:
    return F.when(n_contigs > 1, F.concat(sample, F.lit("_"), contig)).otherwise(sample)


def site_attachment(changes: DataFrame) -> DataFrame:
    """(contig, pos, codon_changes) from rows with a comma-separated position list: `aa=sample:freq,sample:freq;...`."""
    x = changes.withColumn("p", F.explode(F.split("positions", ","))).withColumn("pos", F.trim("p").try_cast("bigint"))
    per = x.groupBy("contig", "pos", "aa_change").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sample", "freq"))), lambda s: F.concat_ws(":", s["sample"], F.format_string("%.2f", s["freq"]))), ",").alias("who"))
    return per.groupBy("contig", "pos").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "aa_change", "who"))), ";").alias("codon_changes"))


def tract_annotation(tracts: DataFrame, features: DataFrame, changes: DataFrame, bucket: int = 10_000) -> DataFrame:
    """Genes under each tract in order, and its synonymous and nonsynonymous counts. tracts: tract, contig, start, end.

    Equal features are one, equal changes one with their number; what a tract meets is added up by name or label before
    any list is made, so lists are as long as a tract has genes or labels.
    """
    from strandwise.operators.intervals import interval_join

    spots = features.select("contig", F.col("start").alias("f_start"), F.col("end").alias("f_end"), "name").distinct()
    g = interval_join(tracts, spots, ["contig"], ("start", "end"), ("f_start", "f_end"), bucket)
    firsts = g.groupBy("tract", "name").agg(F.min("f_start").alias("f_start"))
    genes = firsts.groupBy("tract").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f_start", "name"))), lambda x: x["name"]), ",").alias("genes"))
    n = lambda v: F.count_if(F.col("change") == v)
    alike = changes.groupBy("contig", "pos", "label").agg(n("synonymous").alias("syn"), n("nonsynonymous").alias("nonsyn"))
    c = interval_join(tracts, alike, ["contig"], ("start", "end"), ("pos", "pos"), bucket)
    labels = c.groupBy("tract", "label").agg(F.sum("syn").alias("syn"), F.sum("nonsyn").alias("nonsyn"))
    counts = labels.groupBy("tract").agg(F.sum("syn").alias("n_syn"), F.sum("nonsyn").alias("n_nonsyn"), F.array_join(F.array_sort(F.collect_list("label")), ",").alias("changes"))
    return tracts.join(genes, "tract", "left").join(counts, "tract", "left").fillna(0, ["n_syn", "n_nonsyn"]).fillna("", ["genes", "changes"])
