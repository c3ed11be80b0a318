"""Per-position tracks: shortest unique length and masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.operators.variants import NEVER_UNIQUE


def collapse_sweep(sweep: DataFrame, axis: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, mul): the least k at which a place is unique, 65535 for never. sweep: keys, k, unique; axis: all places."""
    least = sweep.where("unique").groupBy(*keys).agg(F.min("k").alias("mul"))
    return axis.select(*keys).join(least, list(keys), "left").select(*keys, F.coalesce("mul", F.lit(NEVER_UNIQUE)).cast("int").alias("mul"))


def read_bedgraphs(spark, paths: dict[int, str], unique_at: float = 0.999999) -> DataFrame:
    """(contig, pos0, k, unique) of one mappability bedgraph per k; half-open ranges become positions."""
    out = None
    for k, path in sorted(paths.items()):
        one = spark.read.csv(path, sep="\t", schema="contig string, start long, `end` long, mappability double")
        one = one.where("`end` > start").select("contig", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos0"), F.lit(k).alias("k"), (F.col("mappability") >= unique_at).alias("unique"))
        out = one if out is None else out.unionByName(one)
    return out


def repeat_mask(track: DataFrame, width: int) -> DataFrame:
    """(contig, pos0) covered by no unique read of `width`: the last start that is unique at it is `width` away or more."""
    from strandwise.operators.intervals import last_anchor_mask

    m = last_anchor_mask(track, ["contig"], ["pos0"], "pos0", F.col("mul") <= width, width)
    return m.where("masked").select("contig", "pos0")
