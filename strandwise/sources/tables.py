"""Delimited tables: sample sheets, key-value logs, headed tables, statistics and typing reports."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.scalars import nullif_in, sanitize_id, whole
from strandwise.operators.relational import violations

SHEET_REQUIRED = ("sampleId", "r1", "refId", "refFasta", "refGff")
SHEET_NULLS = ("", ".", "NA", "N/A", "null", "-")


def lines(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """(file, line, text): text lines; `line` is (block start, row), which orders a file's lines but doesn't number them.

    Plain files are split over tasks, gzip files are one task's stream each. A file that ends too early fails the read,
    or, with skip_corrupt, gives no line at all: it is read once before to see that.
    """
    raw = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower()).text(path)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = raw.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), row.alias("row")).alias("line"), F.regexp_replace("value", r"\r$", "").alias("text"))
    if not skip_corrupt:
        return rows
    whole_ = spark.read.option("ignoreCorruptFiles", "true").text(path, wholetext=True).where(F.length("value") >= 0).select(F.col("_metadata.file_path").alias("file"))
    return rows.join(whole_.distinct(), "file", "left_semi")


def read_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A headed table; short rows are padded with nulls, # lines skipped."""
    options = {"sep": "\t", "header": "true", "comment": "#", "mode": "PERMISSIVE"}
    return spark.read.options(**options).schema(schema).csv(path) if schema else spark.read.options(**options).csv(path)


def read_meta_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(file, meta, row): tables headed by `# k=v k=v` lines, a column line, then rows as maps."""
    raw = lines(spark, path).where(F.trim("text") != "")
    is_meta = F.col("text").startswith("#")
    pairs = F.filter(F.split(F.regexp_replace("text", r"^#\s*", ""), r"\s+"), lambda x: F.contains(x, F.lit("=")))
    meta = raw.where(is_meta).select("file", F.explode(pairs).alias("x")).groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct(F.substring_index("x", "=", 1).alias("k"), F.substring_index("x", "=", -1).alias("v")))).alias("meta"))
    body = raw.where(~is_meta)
    head = body.groupBy("file").agg(F.min_by(F.split("text", "\t"), "line").alias("head"), F.min("line").alias("first"))
    cells = body.join(head, "file").where(F.col("line") > F.col("first")).withColumn("cells", F.split("text", "\t"))
    row = F.map_from_entries(F.transform("head", lambda h, i: F.struct(h.alias("k"), F.get("cells", i).alias("v"))))
    return cells.select("file", "line", row.alias("row")).join(meta, "file", "left").select("file", "line", "meta", "row")


def clean_sheet(sheet: DataFrame) -> DataFrame:
    """Trimmed, with this parser's words for missing as nulls; blank rows left out."""
    out = sheet.select(*[nullif_in(F.col(c), SHEET_NULLS).alias(c) for c in sheet.columns])
    blank = None
    for c in out.columns:
        blank = F.col(c).isNull() if blank is None else blank & F.col(c).isNull()
    return out.where(~blank).withColumn("sampleId", sanitize_id(F.col("sampleId")))


def sheet_errors(sheet: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(sampleId, rule) of all broken rules of a sample sheet at once, columns that are missing included."""
    absent = [c for c in SHEET_REQUIRED if c not in sheet.columns]
    if absent:
        return sheet.sparkSession.createDataFrame([(None, f"missing column {c}") for c in absent], "sampleId string, rule string")
    rules = {f"empty {c}": F.col(c).isNull() for c in SHEET_REQUIRED}
    out = violations(sheet, "sampleId", rules)
    conflict = sheet.groupBy("refId").agg(F.count_distinct("refFasta").alias("n")).where("n > 1").select("refId")
    out = out.union(sheet.join(conflict, "refId", "left_semi").select("sampleId", F.lit("reference conflict")))
    if existing is not None:  # a table (path) of the files that are there
        for c in ("r1", "r2"):
            if c in sheet.columns:
                out = out.union(sheet.where(F.col(c).isNotNull()).join(existing.withColumnRenamed("path", c), c, "left_anti").select("sampleId", F.lit(f"no such file in {c}")))
    return out


#: Roles of metadata columns by their names, the first that fits.
ROLES = {
    "sample": r"^(sample|sample_?id|id)$",
    "time": r"^(time|time_?point|day|week|month|passage|generation)s?$",
    "group": r"^(group|series|patient|host|line|lineage_group|individual)$",
    "dose": r"^(dose|conc|concentration|mic)$",
    "treatment": r"^(treatment|drug|condition|arm)$",
    "replicate": r"^(replicate|rep|library|dna_?id|extract)$",
    "date": r"^(date|collection_?date|sampled)$",
}


def roles(columns: Sequence[str]) -> dict[str, str]:
    """Role to column, by pattern on the names in any case."""
    out: dict[str, str] = {}
    for role, pattern in ROLES.items():
        for c in columns:
            if re.search(pattern, c.strip(), re.IGNORECASE) and c not in out.values():
                out[role] = c
                break
    return out


def metric_kind(df: DataFrame, columns: Sequence[str], known: Sequence[str] = ()) -> dict[str, str]:
    """int, float or pct for each unknown column that is numeric wherever it has a value; one pass."""
    new = [c for c in columns if c not in known]
    if not new:
        return {}
    v = lambda c: F.col(c).try_cast("double")
    got = df.agg(*[F.struct(F.count(v(c)).alias("n"), F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias("all"), F.bool_and(v(c) == F.floor(v(c))).alias("whole"), F.min(v(c)).alias("lo"), F.max(v(c)).alias("hi")).alias(c) for c in new]).first()
    out = {}
    for c in new:
        x = got[c]
        if x["n"] and x["n"] == x["all"]:
            named = re.search(r"(pct|percent|%|rate)", c, re.IGNORECASE)
            out[c] = "pct" if named and 0 <= x["lo"] and x["hi"] <= 100 else "int" if x["whole"] else "float"
    return out


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """(file, key, value) of key-tab-value logs; NA is null."""
    t = F.split("text", "\t", 2)
    return lines(spark, path).where(F.contains("text", F.lit("\t"))).select("file", t[0].alias("key"), nullif_in(t[1], ["", "NA"]).alias("value"))


def pivot_kv(kv: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Wide rows with a fixed list of columns, so no pass to find the names is needed."""
    return kv.groupBy(*keys).pivot("key", list(names)).agg(F.first("value", ignorenulls=True))


def read_fastp(spark: SparkSession, path: str) -> DataFrame:
    """Read counts and rates of trimming reports, one row per lane file; missing keys are null."""
    after = "total_reads bigint, total_bases bigint, read1_mean_length double, q20_rate double, q30_rate double, gc_content double"
    schema = f"summary struct<before_filtering: struct<total_reads: bigint>, after_filtering: struct<{after.replace(' bigint', ': bigint').replace(' double', ': double')}>>, duplication struct<rate: double>"
    j = spark.read.schema(schema).json(path, multiLine=True)
    a = F.col("summary.after_filtering")
    return j.select(F.col("_metadata.file_path").alias("file"), F.col("summary.before_filtering.total_reads").alias("raw_reads"), *[a[c].alias(c) for c in ("total_reads", "total_bases", "read1_mean_length", "q20_rate", "q30_rate", "gc_content")], F.col("duplication.rate").alias("dup_rate"))


def merge_lanes(lanes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts added up, rates weighted by reads or bases."""
    from strandwise.operators.stats import weighted_mean

    w = lambda v, by: weighted_mean(F.col(v), F.col(by)).alias(v)
    return lanes.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("raw_reads", "total_reads", "total_bases")], w("read1_mean_length", "total_reads"), w("q20_rate", "total_bases"), w("q30_rate", "total_bases"), w("gc_content", "total_bases"), w("dup_rate", "total_reads")
    )


def parse_stats(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (file, text): the SN section as (file, key, value), and COV as (file, depth, n); an open bin has its low edge."""
    f = F.split("text", "\t")
    sn = text.where(F.col("text").startswith("SN\t")).select("file", F.regexp_replace(f[1], r":\s*$", "").alias("key"), f[2].try_cast("double").alias("value"))
    lo, hi = (F.regexp_extract(f[1], r"\[(\d+)-?(\d*)", i) for i in (1, 2))
    open_end = F.contains(f[1], F.lit("<"))
    depth = F.when(open_end, lo.try_cast("double")).otherwise((lo.try_cast("double") + F.coalesce(hi.try_cast("double"), lo.try_cast("double"))) / 2)
    cov = text.where(F.col("text").startswith("COV\t")).select("file", depth.alias("depth"), whole(F.get(f, F.lit(3))).alias("n"))
    return sn, cov.where("n IS NOT NULL")


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, contig, length, offset) of FASTA indexes; bad rows are skipped."""
    from strandwise.operators.intervals import offsets

    f = F.split("text", "\t")
    rows = lines(spark, path).select("file", F.col("line").alias("ord"), f[0].alias("contig"), whole(F.get(f, F.lit(1))).alias("length")).where("length IS NOT NULL")
    return offsets(rows, ["file"], ["ord"], "length")


def parse_taxonomy(text: DataFrame) -> DataFrame:
    """(file, line, pct, clade_reads, reads, rank, taxid, name, parent) of an indented report of six columns."""
    from strandwise.operators.cohort import parents_by_depth

    f = F.split("text", "\t")
    name = f[5]
    depth = (F.floor(F.length(F.regexp_extract(name, r"^( *)", 1)) / 2)).cast("int")
    rows = text.where(F.size(f) >= 6).select("file", "line", F.trim(f[0]).try_cast("double").alias("pct"), whole(f[1]).alias("clade_reads"), whole(f[2]).alias("reads"), F.trim(f[3]).alias("rank"), whole(f[4]).alias("taxid"), F.trim(name).alias("name"), depth.alias("depth"))
    return parents_by_depth(rows, ["file"], "line", "depth", "taxid")


def parse_assignments(text: DataFrame) -> DataFrame:
    """(read, taxid) of classified reads: a bare number, `name (taxid N)`, or the letter for artificial sequences."""
    f = F.split("text", "\t")
    t = F.coalesce(F.when(f[2] == "A", F.lit(81077)), whole(f[2]), whole(F.regexp_extract(f[2], r"taxid (\d+)\)", 1)))
    return text.where((F.size(f) >= 3) & (f[0] == "C")).select(F.regexp_replace(f[1], "/[12]$", "").alias("read"), t.cast("bigint").alias("taxid"))


def split_lineage(summary: Column) -> Column:
    """[(lineage, count)] of `L4.1:12;L2:3`."""
    return F.transform(F.filter(F.split(summary, "[;,]"), lambda x: F.contains(x, F.lit(":"))), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("lineage"), whole(F.substring_index(x, ":", -1)).alias("n")))


def resistance_calls(details: DataFrame) -> DataFrame:
    """sample, drug, gene, mutation, grade, marker_name, af, dp of rows whose packed path has up to six parts."""
    p = F.split("lineage_path", ";", 6)
    at = lambda i: nullif_in(F.get(p, F.lit(i)), [""])
    grade = F.regexp_extract(F.coalesce(at(3), F.lit("")), r"(\d)", 1).try_cast("int")
    return details.select("sample", at(0).alias("drug"), at(1).alias("gene"), at(2).alias("mutation"), grade.alias("grade"), at(4).alias("marker_name"), F.col("alt_fraction").try_cast("double").alias("af"), (whole(F.col("ref_count")) + whole(F.col("alt_count"))).alias("dp"))


def codon_rows(table: DataFrame, min_reads: int = 2) -> DataFrame:
    """Rows of a codon-change table whose type names an MNV with enough reads."""
    return table.where(F.contains(F.col("change_type"), F.lit("MNV")) & (F.coalesce(whole(F.col("mnv_reads")), F.lit(0)) >= min_reads))


def self_alignments(coords: DataFrame, identity: float = 90, length: int = 200) -> DataFrame:
    """Paralog pairs of a self-alignment: s1 e1 s2 e2 len1 idy ref qry; the diagonal is left out, `-` where s2 > e2."""
    own = (F.col("ref") == F.col("qry")) & (F.col("s1") == F.least("s2", "e2")) & (F.col("e1") == F.greatest("s2", "e2"))
    kept = coords.where((F.col("idy") >= identity) & (F.col("len1") >= length) & ~own)
    return kept.withColumn("strand", F.when(F.col("s2") > F.col("e2"), "-").otherwise("+")).withColumn("d1", F.least("s2", "e2")).withColumn("d2", F.greatest("s2", "e2"))


def damage_profile(text: DataFrame) -> DataFrame:
    """(file, pos, freq) of two-column files split by tabs, commas or spaces."""
    f = F.split(F.trim("text"), r"[\t, ]+")
    return text.select("file", whole(F.get(f, F.lit(0))).alias("pos"), F.get(f, F.lit(1)).try_cast("double").alias("freq")).where("pos IS NOT NULL AND freq IS NOT NULL")


def belongs_to(path: Column, samples: Sequence[str]) -> Column:
    """The sample whose name is a component of the path; the longest where several are."""
    out = None
    for s in sorted(samples, key=len, reverse=True):
        hit = F.array_contains(F.split(path, "/"), s)
        out = F.when(hit, F.lit(s)) if out is None else out.when(hit, F.lit(s))
    return F.lit(None).cast("string") if out is None else out


def optional(path: str | None) -> str | None:
    """None for the names that stand for no file."""
    return None if not path or path.rsplit("/", 1)[-1].startswith("NO_FILE") else path


def suggest(name: str, known: Sequence[str]) -> str | None:
    """The nearest known parameter name by edit distance, if near enough."""

    def distance(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    best = min(known, key=lambda k: (distance(name.lower(), k.lower()), k), default=None)
    return best if best is not None and distance(name.lower(), best.lower()) <= max(2, len(name) // 3) else None


def check_params(given: dict, known: Sequence[str]) -> dict:
    """`given`, or an error that names every unknown parameter with a suggestion."""
    wrong = [f"{k} (did you mean {s}?)" if (s := suggest(k, known)) else k for k in given if k not in known]
    if wrong:
        raise ValueError("unknown parameters: " + ", ".join(wrong))
    return given
