"""Cohort reports: verdicts, depth, series, lineages, calls and screens."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strandwise.operators.ordered import joined


def parents_by_depth(df: DataFrame, keys: Sequence[str], order: str, depth: str, node: str) -> DataFrame:
    """`parent`: the node of the nearest row before that is shallower; null where there is none.

    Rows of a group pass one by one in order with a stack of the open ones, so any depth will do and a task holds no
    more than one path. A null depth has no parent and is none.
    """
    at, deep, label = (df.columns.index(c) for c in (order, depth, node))
    own = [df.columns.index(k) for k in keys]
    assert at >= 0

    def run(batches):
        group, stack = None, []
        for batch in batches:
            parents = []
            key_columns = [batch.column(i).to_pylist() for i in own]
            for *key, d, n in zip(*key_columns, batch.column(deep).to_pylist(), batch.column(label).to_pylist(), strict=True):
                if key != group:
                    group, stack = key, []
                if d is None:
                    parents.append(None)
                    continue
                while stack and stack[-1][0] >= d:
                    stack.pop()
                parents.append(stack[-1][1] if stack else None)
                stack.append((d, n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parents, batch.schema.field(label).type)], names=[*batch.schema.names, "parent"])

    sorted_ = df.repartition(*keys).sortWithinPartitions(*keys, order)
    return sorted_.mapInArrow(run, StructType([*df.schema.fields, StructField("parent", df.schema[node].dataType)]))


@dataclass(frozen=True)
class QcThresholds:
    depth: float = 10
    breadth: float = 90
    missing: float = 10
    mapping: float = 80
    dup: float = 40
    iupac: float = 2
    titv: float = 0
    snp_z: float = 3
    het_pct: float = 3
    het_least: int = 50
    damage: float = 0.05


#: A second set for degraded samples.
ANCIENT = QcThresholds(depth=3, breadth=30, missing=70, dup=60, iupac=5, mapping=20)
FAILING = ("NO_DATA", "LOW_DEPTH", "LOW_BREADTH", "HIGH_MISSING")


def qc_flags(c: dict[str, Column], p: QcThresholds = QcThresholds(), ancient: QcThresholds = ANCIENT) -> Column:
    """An array of flags. c: depth, breadth, missing, mapping, dup, iupac, titv, snp_z, het, hom, mixed, mismatch, damage,
    and `ancient`, a condition.

    Each row is judged by its own set of thresholds, so both kinds of sample stand in one table. Counts of SNPs and
    heterozygous calls say nothing of an ancient sample and raise no flag there, too little damage raises one only
    there. Columns that are left out raise no flag; a null metric raises none of its own; without depth, breadth,
    missing and mapping there is only NO_DATA.
    """
    none = F.lit(None).cast("double")
    g = lambda k: c.get(k, none)
    old = F.coalesce(c["ancient"], F.lit(False)) if "ancient" in c else F.lit(False)
    t = lambda k: F.when(old, F.lit(float(getattr(ancient, k)))).otherwise(F.lit(float(getattr(p, k))))
    calls = g("het") + g("hom")
    flags = [
        F.when(g("depth") < t("depth"), "LOW_DEPTH"),
        F.when(g("breadth") < t("breadth"), "LOW_BREADTH"),
        F.when(g("missing") > t("missing"), "HIGH_MISSING"),
        F.when(g("mapping") < t("mapping"), "MAPPING_LOW"),
        F.when(g("dup") > t("dup"), "HIGH_DUP"),
        F.when(g("iupac") > t("iupac"), "HIGH_IUPAC"),
        F.when((F.lit(float(p.titv)) > 0) & (g("titv") < p.titv), "TITV_LOW"),
        F.when(old, None).when(g("snp_z") > p.snp_z, "SNP_HIGH").when(g("snp_z") < -p.snp_z, "SNP_LOW"),
        F.when(~old & (calls >= p.het_least) & (100 * g("het") / F.when(calls > 0, calls) > p.het_pct), "HET_HIGH"),
        F.when(c.get("mixed", F.lit(False)), "MIXED"),
        F.when(c.get("mismatch", F.lit(False)), "LINEAGE_MISMATCH"),
        F.when(old & (g("damage") < ancient.damage), "DAMAGE_LOW"),
    ]
    empty = g("depth").isNull() & g("breadth").isNull() & g("missing").isNull() & g("mapping").isNull()
    return F.when(empty, F.array(F.lit("NO_DATA"))).otherwise(F.array_compact(F.array(*flags)))


def verdict(flags: Column) -> Column:
    return F.when(F.arrays_overlap(flags, F.array(*map(F.lit, FAILING))), "FAIL").when(F.size(flags) > 0, "WARN").otherwise("PASS")


def severity(verdict_col: Column) -> Column:
    return F.when(verdict_col == "FAIL", 0).when(verdict_col == "WARN", 1).otherwise(2)


def purity_state(share: Column, rest: Column, off: float = 50, mixed: float = 90, unclassified: float = 15) -> Column:
    """off, mixed, many-unclassified or pure, by the target's share and what has no class."""
    return F.when(share < off, "off").when(share < mixed, "mixed").when(rest > unclassified, "many-unclassified").otherwise("pure")


def depth_summary(df: DataFrame, keys: Sequence[str], dp: Column, callable_at: float = 30, zero_below: float = 1) -> DataFrame:
    n = F.count(dp)
    return df.groupBy(*keys).agg(F.median(dp).alias("med"), F.avg(dp).alias("mean"), (F.count_if(dp < zero_below) / n).alias("zero"), (F.count_if(dp >= callable_at) / n).alias("callable"))


def guarded_fraction(a: Column, b: Column, least: int) -> Column:
    return F.when((a + b >= least) & (a + b > 0), a / (a + b))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole)


@dataclass(frozen=True)
class LiveThresholds:
    high_z: float = 3
    lof_z: float = 3
    pnps: float = 1
    annotated: float = 50


def live_flags(c: dict[str, Column], p: LiveThresholds = LiveThresholds()) -> Column:
    """The further flags of an interactive view, whose thresholds are the viewer's. c: high_z, lof_z, pnps, annotated, outlier."""
    none = F.lit(None).cast("double")
    g = lambda k: c.get(k, none)
    return F.array_compact(
        F.array(
            F.when(g("high_z") > p.high_z, "HIGH_IMPACT_EXCESS"), F.when(g("lof_z") > p.lof_z, "LOF_EXCESS"), F.when(g("pnps") > p.pnps, "PNPS_PROXY_HIGH"),
            F.when(g("annotated") < p.annotated, "ANNOTATION_POOR"), F.when(c.get("outlier", F.lit(False)), "QC_OUTLIER"),
        )
    )


def compile_filter(x: Column, text: str) -> Column:
    """A column filter: >x >=x <x <=x =x, a-b, a..b, `a to b`, else a part of the text in any case."""
    import re

    number = r"(-?\d+(?:\.\d+)?)"
    t = text.strip()
    if m := re.fullmatch(r"(>=|<=|>|<|=)\s*" + number, t):
        v = F.lit(float(m[2]))
        return {">": x > v, ">=": x >= v, "<": x < v, "<=": x <= v, "=": x == v}[m[1]]
    if m := re.fullmatch(number + r"\s*(?:-|\.\.|to)\s*" + number, t):
        a, b = sorted((float(m[1]), float(m[2])))
        return x.between(a, b)
    return F.contains(F.lower(x.cast("string")), F.lit(t.lower()))


def burden(df: DataFrame, sample: str, gene: str, impact: str, effect: str, k: int = 40) -> DataFrame:
    """Per sample the k genes with most HIGH, then MODERATE hits, with the most common effect (ties to the lesser)."""
    by_effect = df.groupBy(sample, gene, effect).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(impact) == "HIGH").alias("h"), F.count_if(F.col(impact) == "MODERATE").alias("m"))
    g = by_effect.groupBy(sample, gene).agg(F.sum("h").alias("high"), F.sum("m").alias("moderate"), F.min(F.struct((-F.col("n")).alias("n"), F.col(effect).alias("e")))["e"].alias("effect"))
    top = Window.partitionBy(sample).orderBy(F.desc("high"), F.desc("moderate"), gene)
    return g.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= k)


def cov_histogram(hist: DataFrame, keys: Sequence[str], depth: str, n: str, total: Column, at: int = 1) -> DataFrame:
    """Breadth, weighted median and evenness from counts by depth; positions that aren't counted have depth 0."""
    own = hist.groupBy(*keys).agg(F.sum(n).alias("_cov"), F.sum(F.col(n) * F.col(depth)).alias("_s1"), F.sum(F.col(n) * F.col(depth) * F.col(depth)).alias("_s2"), F.sum(F.when(F.col(depth) >= at, F.col(n)).otherwise(0)).alias("_at"), F.max(total).alias("_g"))
    own = own.withColumn("_zero", F.greatest(F.lit(0), F.col("_g") - F.col("_cov"))).withColumn("_total", F.col("_cov") + F.col("_zero"))
    up = Window.partitionBy(*keys).orderBy(depth).rowsBetween(Window.unboundedPreceding, 0)
    run = hist.withColumn("_run", F.sum(n).over(up)).join(own.select(*keys, "_zero", "_total"), list(keys))
    med = run.groupBy(*keys).agg(F.min(F.when(F.col("_zero") + F.col("_run") >= F.col("_total") / 2, F.col(depth))).alias("_m"))
    out = own.join(med, list(keys))
    mean = F.col("_s1") / F.col("_total")
    median = F.when(F.col("_zero") >= F.col("_total") / 2, F.lit(0)).otherwise(F.col("_m"))
    even = F.sqrt(F.greatest(F.lit(0.0), F.col("_s2") / F.col("_total") - mean * mean)) / F.when(mean != 0, mean)
    return out.select(*keys, (100.0 * F.col("_at") / F.col("_total")).alias("breadth"), median.alias("median"), even.alias("evenness"))


def windows(df: DataFrame, keys: Sequence[str], pos: str, dp: str, size: int = 1000, callable_at: float = 30) -> DataFrame:
    """Per fixed window over the positions that have a record: mean, zero and callable shares."""
    w = F.floor((F.col(pos) - 1) / size)
    return df.groupBy(*keys, w.alias("window")).agg(F.avg(dp).alias("mean"), (F.count_if(F.col(dp) == 0) / F.count(dp)).alias("zero"), (F.count_if(F.col(dp) >= callable_at) / F.count(dp)).alias("callable"))


def feature_depth(points: DataFrame, features: DataFrame, feature: str, dp: str, callable_at: float = 30) -> DataFrame:
    """Per feature of joined points: breadth, callable share, mean, and mean relative to the median of all points."""
    genome = points.agg(F.median(dp).alias("_g"))
    g = features.groupBy(feature).agg((F.count_if(F.col(dp) > 0) / F.count(dp)).alias("breadth"), (F.count_if(F.col(dp) >= callable_at) / F.count(dp)).alias("callable"), F.avg(dp).alias("mean"))
    return g.join(F.broadcast(genome)).withColumn("relative", F.col("mean") / F.when(F.col("_g") != 0, F.col("_g"))).drop("_g")  # one row


def lineage_fractions(df: DataFrame, keys: Sequence[str], lineage: Column, count: Column, cut: float = 2.0, least: int = 3) -> DataFrame:
    """Shares of main lineages (before the first dot), and how many reach `cut` percent with `least` counts."""
    n = df.groupBy(*keys, F.split_part(lineage, F.lit("."), F.lit(1)).alias("main")).agg(F.sum(count).alias("n"))
    by = Window.partitionBy(*keys)
    out = n.withColumn("fraction", F.col("n") / F.sum("n").over(by))
    return out.withColumn("lineages", F.count_if((100 * F.col("fraction") >= cut) & (F.col("n") >= least)).over(by))


def bands(x: Column, edges: Sequence[float]) -> Column:
    """i for (edges[i], edges[i + 1]]; null outside."""
    out = None
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        hit = (x > a) & (x <= b)
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return out


MINORITY_EDGES = (0.0, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)


def reproducibility(pairs: DataFrame, af: str, dp: str, hit: str, min_dp: float = 7, least_alt: float = 5) -> DataFrame:
    """Per band of allele fraction how many sites could be seen again, and how many were."""
    fair = pairs.where((F.col(dp) > min_dp) & (F.col(af) * F.col(dp) >= least_alt))
    return fair.groupBy(bands(F.col(af), (*MINORITY_EDGES, 1.0)).alias("band")).agg(F.count(F.lit(1)).alias("tested"), F.count_if(hit).alias("seen")).where("band IS NOT NULL")


def rank_donors(rows: DataFrame, event: Sequence[str], span: tuple[str, str], score: str, markers: str, margin: float = 1.0, ties: Sequence[str] = ()) -> DataFrame:
    """`rows` with donor_rank, n_donors, margin, is_representative and donor_call: where an event's stretch came from.

    Rows of an event whose donor spans overlap name the same stretch and are one candidate; a row without a span is one of
    its own. A candidate is worth its best score per marker, null without either; candidates rank by it, nulls last, ties
    by place. margin: of the first to the second, null unless both have a worth. The first candidate is resolved from a
    margin of `margin` on; a single one is the only candidate, all others are ambiguous. The first candidate's row with
    the best score represents it, the earliest span of equal ones. Rows alike in span, score and markers come in the order of
    `ties`.
    """
    k, (a, b) = list(event), span
    own = rows.withColumns({"_a": F.when(F.col(b).isNotNull(), F.col(a)), "_b": F.when(F.col(a).isNotNull(), F.col(b)), "_each": F.try_divide(F.col(score), F.col(markers))})
    by = Window.partitionBy(*k).orderBy(F.col("_a").asc_nulls_last(), "_b", F.desc_nulls_last(score), markers, *ties)
    before = F.max("_b").over(by.rowsBetween(Window.unboundedPreceding, -1))
    own = own.withColumn("_n", F.row_number().over(by)).withColumn("_new", F.when(F.col("_a").isNull() | before.isNull() | (F.col("_a") > before), 1).otherwise(0))
    own = own.withColumn("_candidate", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    best = own.groupBy(*k, "_candidate").agg(F.max("_each").alias("_worth"), F.min_by("_n", F.struct(F.col(score).isNull(), -F.col(score), "_n")).alias("_first"))
    whole = Window.partitionBy(*k)
    order = whole.orderBy(F.desc_nulls_last("_worth"), "_candidate")
    ranked = best.withColumns({"donor_rank": F.row_number().over(order), "n_donors": F.count(F.lit(1)).over(whole), "_next": F.lead("_worth").over(order)})
    ranked = ranked.withColumn("margin", F.max(F.when(F.col("donor_rank") == 1, F.col("_worth") - F.col("_next"))).over(whole))
    call = F.when((F.col("donor_rank") == 1) & (F.col("margin") >= margin), "resolved").when(F.col("n_donors") == 1, "only candidate").otherwise("ambiguous")
    out = joined(own, ranked.select(*k, "_candidate", "_first", "donor_rank", "n_donors", "margin", call.alias("donor_call")), [*k, "_candidate"])
    return out.withColumn("is_representative", (F.col("donor_rank") == 1) & (F.col("_n") == F.col("_first"))).drop("_a", "_b", "_each", "_n", "_new", "_candidate", "_first")


def revise(df: DataFrame, n_cohort: Column, fraction: Column, others: Column, verdict_col: Column, bf: Column, unreadable: Column, divergent: Column, least: int = 5, ubiquitous: float = 0.9, strong: float = 2.0) -> DataFrame:
    """`revised`: divergent sample, artefact that nearly all have, unreadable, corroborated by others, else as it was."""
    out = (
        F.when(divergent, "divergent_sample")
        .when((n_cohort >= least) & (fraction >= ubiquitous), "reference_artifact")
        .when(unreadable, "ambiguous")
        .when((verdict_col == "ambiguous") & (bf >= strong) & (others >= 1), "gene_conversion")
        .otherwise(verdict_col)
    )
    return df.withColumn("revised", out)


@dataclass(frozen=True)
class DepletionParams:
    min_depth: int = 5  #: the acceptor's, from which a site is covered
    max_ratio: float = 0.4  #: the acceptor's share of a lopsided site's reads
    least: int = 3  #: sites of a run
    max_local: float = 0.6  #: of the acceptor's depth elsewhere
    enrichment: float = 1.25  #: of the donor's depth elsewhere


def depleted_runs(sites: DataFrame, keys: Sequence[str], pos: str, acceptor: str, donor: str, excluded: str | None = None, p: DepletionParams = DepletionParams()) -> DataFrame:
    """(keys, start, end, n, acceptor_level, donor_here, donor_elsewhere): runs of sites whose reads went to the donor.

    A site is lopsided if the acceptor has fewer reads than `min_depth` and at most `max_ratio` of both sides' reads, of
    which there are twice `min_depth` at least. A run is made of consecutive lopsided sites that also have at most
    `max_local` of the acceptor's level: the median of the sites that are not lopsided, if there are two. Over a run the
    donor's median must be `enrichment` times that of the locus' other sites. Excluded sites end a run and count nowhere.
    Null depths are 0. A locus' medians gather its sites, so these must fit a task.
    """
    k = list(keys)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    use = ~F.coalesce(F.col(excluded), F.lit(False)) if excluded else F.lit(True)
    rows = sites.where(F.col(pos).isNotNull()).select(*k, F.col(pos).alias("_pos"), zero(acceptor).alias("_acc"), zero(donor).alias("_don"), use.alias("_use"))
    both = F.col("_acc") + F.col("_don")
    rows = rows.withColumn("_lop", F.col("_use") & (F.col("_acc") < p.min_depth) & (both >= 2 * p.min_depth) & (F.col("_acc") <= p.max_ratio * both))
    healthy = F.col("_use") & ~F.col("_lop")
    level = rows.groupBy(*k).agg(F.when(F.count_if(healthy) >= 2, F.median(F.when(healthy, F.col("_acc")))).alias("_level"), F.count_if("_use").alias("_usable")).where(F.col("_usable") >= p.least)
    known = joined(rows, level, k)
    by = Window.partitionBy(*k).orderBy("_pos")
    low = F.col("_lop") & (F.col("_level").isNull() | (F.col("_acc") <= p.max_local * F.col("_level")))
    marked = known.withColumns({"_i": F.row_number().over(by), "_low": low})
    own = marked.where("_low").withColumn("_run", F.col("_i") - F.row_number().over(by))
    runs = own.groupBy(*k, "_run").agg(F.min("_pos").alias("start"), F.max("_pos").alias("end"), F.count(F.lit(1)).alias("n"), F.first("_level").alias("acceptor_level"), F.median("_don").alias("donor_here")).where(F.col("n") >= p.least)
    # the other sites of each run's locus
    rest = joined(rows.where("_use").select(*k, "_pos", "_don"), runs.select(*k, "_run", "start", "end"), k).where(~F.col("_pos").between(F.col("start"), F.col("end")))
    elsewhere = rest.groupBy(*k, "_run").agg(F.median("_don").alias("donor_elsewhere"))
    found = joined(runs, elsewhere, [*k, "_run"])
    return found.where((F.col("donor_elsewhere") > 0) & (F.col("donor_here") >= p.enrichment * F.col("donor_elsewhere"))).drop("_run")


def inside_outside(df: DataFrame, keys: Sequence[str], inside: Column, value: str, least: int = 2) -> DataFrame:
    """Means on both sides; null on a side with fewer than `least` sites."""
    side = lambda cond, name: F.when(F.count_if(cond & F.col(value).isNotNull()) >= least, F.avg(F.when(cond, F.col(value)))).alias(name)
    return df.groupBy(*keys).agg(side(inside, "inside"), side(~inside, "outside"))


def acquired_kept_lost(df: DataFrame, group: str, time: str, item: str) -> DataFrame:
    """(group, acquired, kept, lost): sets of the last time against the first."""
    ends = df.groupBy(group).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    s = df.join(ends, group).groupBy(group).agg(F.collect_set(F.when(F.col(time) == F.col("_a"), F.col(item))).alias("_x"), F.collect_set(F.when(F.col(time) == F.col("_b"), F.col(item))).alias("_y"))
    n = lambda a: F.size(a)
    return s.select(group, n(F.array_except("_y", "_x")).alias("acquired"), n(F.array_intersect("_x", "_y")).alias("kept"), n(F.array_except("_x", "_y")).alias("lost"))


def worst_grades(df: DataFrame, sample: str, drug: str, grade: str, drugs: Sequence[str]) -> DataFrame:
    """One row per sample with the least grade of each drug as a column, null where there is none."""
    return df.groupBy(sample).pivot(drug, list(drugs)).agg(F.min(grade))


def composite_parts(label: Column, known: Sequence[str]) -> Column:
    """The parts of a_b_c if every part is a known code, else the whole label."""
    parts = F.split(label, "_")
    return F.when(F.forall(parts, lambda p: p.isin(*known)), parts).otherwise(F.array(label))


def background(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], sample: str) -> DataFrame:
    """Medians of a locus over the cohort, and how many samples it rests on."""
    return df.groupBy(*keys).agg(*[F.median(m).alias("med_" + m) for m in metrics], F.count_distinct(sample).alias("samples"))


def divergent(df: DataFrame, sample: str, event: str, called: Column, share: float = 0.1, events: int = 20, least: int = 5) -> DataFrame:
    """Samples with more than `share` of their events called, over `events` events and `least` calls at least."""
    g = df.groupBy(sample).agg(F.count_distinct(F.when(called, F.col(event))).alias("called"), F.count_distinct(event).alias("events"))
    return g.where((F.col("events") >= events) & (F.col("called") >= least) & (F.col("called") / F.col("events") > share))


def group_mismatch(pairs: DataFrame, member: str, group: str, distance_in: str, limit: float = 12, least: int = 3) -> DataFrame:
    """Members far from a tight group: the upper median of its members' nearest distances is within the limit, theirs isn't."""
    v = F.array_sort(F.collect_list(distance_in))
    g = pairs.groupBy(group).agg(F.count(distance_in).alias("_n"), F.get(v, (F.size(v) / 2).cast("int")).alias("_m"))
    tight = g.where((F.col("_n") >= least) & (F.col("_m") <= limit)).select(group)
    return pairs.join(tight, group, "left_semi").where(F.col(distance_in) > limit)
