"""Writers: wide matrices, headed tables, sequences, intervals, payloads and gates."""

from __future__ import annotations

import base64
import gzip
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_matrix(cells: DataFrame, site: Sequence[str], samples: Sequence[str]) -> DataFrame:
    """One row per site with <sample>_AF and <sample>_DP as text: NA where the value is unknown, blank where unread."""
    af = F.when(F.col("state").isin("CALLED", "RECOVERED") & F.col("af").isNull(), "NA").when(F.col("af").isNotNull(), F.format_string("%.4f", "af")).otherwise("")
    dp = F.coalesce(F.col("dp").cast("bigint").cast("string"), F.lit(""))
    p = cells.withColumn("_af", af).withColumn("_dp", dp).groupBy(*site).pivot("sample", list(samples)).agg(F.first("_af").alias("AF"), F.first("_dp").alias("DP"))
    return p.orderBy(*site)


def write_tsv(df: DataFrame, path: str, meta: dict[str, object] | None = None) -> None:
    """Tab-separated with a header; the settings that moved a number go to `path`_meta as JSON."""
    df.write.csv(path, sep="\t", header=True, mode="overwrite")
    if meta is not None:
        rows = [(str(k), str(v)) for k, v in sorted(meta.items())]
        df.sparkSession.createDataFrame(rows, "key string, value string").coalesce(1).write.json(path + "_meta", mode="overwrite")


def bed_lines(runs: DataFrame) -> DataFrame:
    """Closed 1-based runs as half-open 0-based lines."""
    return runs.select(F.concat_ws("\t", "contig", (F.col("start") - 1).cast("string"), F.col("end").cast("string")).alias("value"))


def vcf_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.coalesce("filter", F.lit("PASS")), F.coalesce("info", F.lit("."))).alias("value"))


def kv_log(df: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """(id, nth, key, value) in a fixed order of keys, NA for missing."""
    parts = [F.struct(F.lit(i).alias("nth"), F.lit(k).alias("key"), F.coalesce(F.col(k).cast("string") if k in df.columns else F.lit(None).cast("string"), F.lit("NA")).alias("value")) for i, k in enumerate(order)]
    return df.select(id_col, F.explode(F.array(*parts)).alias("x")).select(id_col, "x.*")


def flags_table(df: DataFrame, sample: str) -> DataFrame:
    """FAIL, WARN, PASS; then by sample."""
    rank = F.when(F.col("verdict") == "FAIL", 0).when(F.col("verdict") == "WARN", 1).otherwise(2)
    return df.orderBy(rank, sample)


def payload(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row: a nested JSON document of a summary table."""
    items = F.array_sort(F.collect_list(F.struct(*keys, value)))
    return df.agg(F.to_json(F.struct(items.alias("rows"), F.count(F.lit(1)).alias("n"))).alias("payload"))


def html_page(doc: str, title: str = "report") -> str:
    """A page that holds its data as base64 of gzip; `doc` is the one row of `payload`, a summary of bounded size."""
    packed = base64.b64encode(gzip.compress(doc.encode(), mtime=0)).decode()
    return f'<!doctype html><meta charset="utf-8"><title>{title}</title><script type="application/octet-stream" id="data">{packed}</script>'


def gate(df: DataFrame) -> bool:
    """Whether no row fails; an exit code can follow it."""
    return df.where("verdict = 'FAIL'").isEmpty()


def counted(df: DataFrame, path: str) -> int:
    """Write, read again and compare the counts; the number of rows."""
    df.write.parquet(path, mode="overwrite")
    back, wrote = df.sparkSession.read.parquet(path).count(), df.count()
    if back != wrote:
        raise ValueError(f"{path}: {wrote} rows written, {back} read")
    return back
