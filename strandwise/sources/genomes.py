"""Sequence, feature, interval, variant and alignment files as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise.functions.scalars import kv_map, whole
from strandwise.sources.tables import lines


def read_fasta(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(file, ord, contig, seq): upper-cased; the name is the header's first word. strict: a header without one fails.

    A file is one task's text: for genomes of up to some hundred megabases.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    recs = raw.select("file", F.posexplode(F.split("value", r"(?m)^>")).alias("ord", "rec")).where("ord > 0")
    head = F.substring_index("rec", "\n", 1)
    seq = F.upper(F.regexp_replace(F.when(F.instr("rec", "\n") > 0, F.substring(F.col("rec"), F.instr("rec", "\n") + F.lit(1), F.length("rec"))).otherwise(F.lit("")), r"\s+", ""))
    name = F.regexp_extract(head, r"^\s*(\S*)", 1)
    if strict:
        name = F.when(name != "", name).otherwise(F.raise_error(F.lit("a FASTA header without a name")))
    return recs.select("file", "ord", name.alias("contig"), seq.alias("seq"))


def bases(fasta: DataFrame) -> DataFrame:
    """(contig, pos, base), positions from 1."""
    return fasta.select("contig", F.posexplode(F.split("seq", "")).alias("i", "base")).where("base <> ''").select("contig", (F.col("i") + 1).cast("bigint").alias("pos"), "base")


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows with the attributes Name, gene, locus_tag, ID and Parent."""
    f = F.split("text", "\t")
    rows = lines(spark, path).where(~F.col("text").startswith("#")).where(F.size(f) >= 9)
    attr = lambda k: F.nullif(F.regexp_extract(f[8], rf"(?:^|;)\s*{k}=([^;]*)", 1), F.lit(""))
    name = F.coalesce(*[F.when(~F.lower(attr(k)).isin("nan", "none", ""), attr(k)) for k in ("gene", "Name", "locus_tag", "ID")])
    return rows.select("file", F.col("line").alias("ord"), f[0].alias("contig"), f[2].alias("type"), whole(f[3]).alias("start"), whole(f[4]).alias("end"), f[6].alias("strand"), F.coalesce(f[7].try_cast("int"), F.lit(0)).alias("phase"), name.alias("name"), attr("locus_tag").alias("locus_tag"), attr("ID").alias("id"), attr("Parent").alias("parent")).where("start IS NOT NULL AND `end` IS NOT NULL")


def genes(gff: DataFrame, policy: str = "gene_else_cds") -> DataFrame:
    """cds: coding rows with phase. gene_else_cds: genes where a contig has any, else its coding rows. merged: genes, and
    coding rows that no gene covers by parent or by name and place."""
    gene, cds = gff.where("type = 'gene'"), gff.where("type = 'CDS'")
    if policy == "cds":
        return cds
    if policy == "gene_else_cds":
        return gene.unionByName(cds.join(gene.select("contig").distinct(), "contig", "left_anti"))
    by_parent = cds.join(gene.where("id IS NOT NULL").select(F.col("id").alias("parent")).distinct(), "parent", "left_anti").select(*cds.columns)
    g = gene.select(F.col("contig").alias("_c"), F.col("name").alias("_n"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    same = (F.col("contig") == F.col("_c")) & (F.col("name") == F.col("_n")) & (F.col("start") <= F.col("_e")) & (F.col("_s") <= F.col("end"))
    return gene.unionByName(by_parent.join(g, same, "left_anti"))


def read_intervals(spark: SparkSession, path: str, bed: bool = False) -> DataFrame:
    """(contig, start, end), closed and 1-based. Rows count if their coordinates are numbers; swapped ends are put right."""
    f = F.split("text", r"[\t ]+")
    num = lambda i: F.when(F.get(f, F.lit(i)).rlike("^[0-9]+$"), F.get(f, F.lit(i)).cast("bigint"))
    rows = lines(spark, path).where(~F.col("text").startswith("#")).select(f[0].alias("contig"), num(1).alias("a"), num(2).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    return rows.select("contig", (lo + 1 if bed else lo).alias("start"), hi.alias("end"))


def read_csv_mask(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    """(contig, pos) flagged as repetitive or blind spot; such a file has no contigs, so there must be exactly one."""
    t = spark.read.csv(path, header=True)
    flagged = F.coalesce(F.lower("repetitive").isin("1", "true", "yes"), F.lit(False)) | F.coalesce(F.lower("blindspot").isin("1", "true", "yes"), F.lit(False))
    one = contigs.agg(F.count(F.lit(1)).alias("n"), F.first("contig").alias("contig"))
    name = F.when(F.col("n") == 1, F.col("contig")).otherwise(F.raise_error(F.lit("a mask without contigs needs a genome of one")))
    return t.where(flagged).join(F.broadcast(one)).select(name.alias("contig"), whole(F.col("rv_position")).alias("pos")).where("pos IS NOT NULL")  # one row


def read_vcf(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """sample, contig, pos, ref, alt, qual, filter, info and fmt (maps), file, ord. Malformed rows are skipped.

    The sample is the tenth column's name, else the file's stem. skip_corrupt: a truncated gzip file counts as absent.
    """
    raw = lines(spark, path, skip_corrupt)
    f = F.split("text", "\t")
    stem = F.regexp_replace(F.regexp_extract("file", r"([^/]*)$", 1), r"\.vcf(\.gz)?$", "")
    heads = raw.where(F.col("text").startswith("#CHROM")).select("file", F.get(f, F.lit(9)).alias("named"))
    rows = raw.where(~F.col("text").startswith("#")).withColumn("f", f).where((F.size("f") >= 8) & whole(F.get("f", F.lit(1))).isNotNull())
    fmt = F.when(F.size("f") >= 10, F.map_from_entries(F.filter(F.transform(F.split(F.get("f", F.lit(8)), ":"), lambda k, i: F.struct(k.alias("k"), F.get(F.split(F.get("f", F.lit(9)), ":"), i).alias("v"))), lambda x: x["v"].isNotNull())))
    out = rows.join(F.broadcast(heads), "file", "left")  # one row per file
    col = lambda i: F.get("f", F.lit(i))
    return out.select(F.coalesce(F.nullif(F.trim("named"), F.lit("")), stem).alias("sample"), col(0).alias("contig"), whole(col(1)).alias("pos"), col(3).alias("ref"), col(4).alias("alt"), col(5).try_cast("double").alias("qual"), col(6).alias("filter"), kv_map(col(7)).alias("info"), fmt.alias("fmt"), "file", F.col("line").alias("ord"))


def depths(vcf: DataFrame) -> DataFrame:
    """(sample, contig, pos, dp): a record without a stated depth has null, which isn't 0; no record, no row."""
    at = lambda m, k: F.try_element_at(F.col(m), F.lit(k)).try_cast("double")
    return vcf.select("sample", "contig", "pos", F.coalesce(at("fmt", "DP"), at("info", "DP"), at("info", "ADP")).alias("dp"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Mapped primary alignments with their tags; unmapped, secondary and supplementary ones, `*` and place 0 are left out."""
    f = F.split("text", "\t")
    rows = lines(spark, path).where(~F.col("text").startswith("@")).where(F.size(f) >= 11)
    tags = F.map_from_entries(F.transform(F.slice(f, F.lit(12), F.greatest(F.lit(0), F.size(f) - 11)), lambda x: F.struct(F.substring(x, 1, 2).alias("k"), F.substring(x, F.lit(6), F.length(x)).alias("v"))))
    out = rows.select(f[0].alias("qname"), whole(f[1]).cast("int").alias("flag"), f[2].alias("rname"), whole(f[3]).alias("pos"), whole(f[4]).cast("int").alias("mapq"), f[5].alias("cigar"), f[6].alias("rnext"), whole(f[7]).alias("pnext"), whole(f[8]).alias("tlen"), f[9].alias("seq"), f[10].alias("qual"), tags.alias("tags"))
    return out.where((F.col("flag").bitwiseAND(F.lit(0x904)) == 0) & (F.col("cigar") != "*") & (F.col("pos") > 0))


def read_reads(spark: SparkSession, path: str) -> DataFrame:
    """(file, read, seq, qual) of four-line records; the name loses its comment and its /1 or /2.

    Lines are numbered by a sort of each file, which spills.
    """
    n = F.row_number().over(Window.partitionBy("file").orderBy("line"))
    rec = lines(spark, path).withColumn("r", F.floor((n - 1) / 4)).groupBy("file", "r").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("x")).where(F.size("x") == 4)
    t = lambda i: F.col("x")[i]["text"]
    return rec.where(t(0).startswith("@")).select("file", F.regexp_replace(F.regexp_extract(t(0), r"^@(\S+)", 1), "/[12]$", "").alias("read"), t(1).alias("seq"), t(3).alias("qual"))


def coordinate_map(table: DataFrame) -> DataFrame:
    """src and tgt places with `present`; a dot is an absent target."""
    tgt = F.when(F.col("tgt_pos") != ".", whole(F.col("tgt_pos")))
    return table.select("src_contig", whole(F.col("src_pos")).alias("src_pos"), F.when(F.col("tgt_contig") != ".", F.col("tgt_contig")).alias("tgt_contig"), tgt.alias("tgt_pos"), "strand", tgt.isNotNull().alias("present"))


def ordered_contigs(fasta: DataFrame, df: DataFrame) -> DataFrame:
    """`df` in the order of the FASTA file, for the formats that need it."""
    o = fasta.select("contig", "ord")
    return df.join(F.broadcast(o) if fasta.isEmpty() else o, "contig", "left").orderBy(F.asc_nulls_last("ord"), "pos").drop("ord")


def collapse_indel_rows(snps: DataFrame) -> DataFrame:
    """One row per indel of a base-by-base difference table: (contig, start, end, kind); a `.` stands for a missing base."""
    kind = F.when(F.col("ref") == ".", "insertion").when(F.col("alt") == ".", "deletion").otherwise("snp")
    rows = snps.withColumn("kind", kind)
    by = Window.partitionBy("contig", "kind").orderBy("pos", "alt_pos")
    gap = F.when(F.col("kind") == "insertion", F.col("alt_pos") - F.row_number().over(by)).when(F.col("kind") == "deletion", F.col("pos") - F.row_number().over(by)).otherwise(F.monotonically_increasing_id())
    return rows.withColumn("g", gap).groupBy("contig", "kind", "g").agg(F.min("pos").alias("start"), F.max("pos").alias("end"), F.count(F.lit(1)).alias("length")).drop("g")
