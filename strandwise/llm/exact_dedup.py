"""Exact dedup on an extendible-hash index in shared files.

1. The keys of all texts (64-bit hashes) are written to the shared folder with their number of rows.
2. The directory starts with one bucket. A bucket with more keys than its capacity splits by the next leading bits of its
   keys, and the directory doubles whenever a bucket as deep as the directory splits, until no bucket is overfull. It is
   a table, built by counting; nothing of it but two numbers a round reaches the driver.
3. The directory deals the rows: a bucket is a range of keys, and its rows go to one owner task. There each key's chain,
   the rows with that key in order of their texts, is walked, and bytes are compared with bytes: each run of equal texts
   is a group. A key with more than `hot_rows` rows has its rows dealt to several owners.
4. Each owner writes its part of the index: id, digest, place in the chain, group. The groups of divided keys are put
   together by comparing the texts of one row from each owner.

Nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.session import staged


@dataclass(frozen=True)
class ExactDedupParams:
    bucket_capacity: int = 4096  #: keys in a bucket before it splits
    hot_rows: int = 4096  #: rows of one key that one owner takes; more are shared out
    broadcast_rows: int = 1 << 20  #: the directory, and the list of divided keys, are broadcast up to so many rows and joined by sorting beyond
    key_bits: int = 64  #: tests shorten the key to force chains


def _key(body: Column, bits: int) -> Column:
    h = F.xxhash64(body)
    return h if bits >= 64 else F.shiftleft(h, 64 - bits)


def _prefix(key: str, depth: str | int) -> Column:
    """The leading `depth` bits of a key."""
    return F.expr(f"CASE WHEN {depth} = 0 THEN 0L ELSE shiftrightunsigned({key}, 64 - {depth}) END")


def _looked_up(df: DataFrame, table: DataFrame, on: str, rows: int, params: ExactDedupParams, how: str = "inner") -> DataFrame:
    return df.join(F.broadcast(table) if rows <= params.broadcast_rows else table, on, how)


def slots(buckets: DataFrame, depth: int) -> DataFrame:
    """(slot, bucket, local_depth) for each slot of a directory of global depth `depth`: a shallow bucket has several.

    A bucket is named by its local depth and leading bits.
    """
    free = F.expr(f"shiftleft(1L, {depth} - local_depth)")
    own = F.explode(F.sequence(F.col("prefix") * free, (F.col("prefix") + 1) * free - 1))
    return buckets.select(own.alias("slot"), F.struct("local_depth", "prefix").alias("bucket"), "local_depth")


def directory(keys: DataFrame, n: int, params: ExactDedupParams = ExactDedupParams()) -> tuple[int, DataFrame]:
    """Global depth and buckets (prefix, local_depth, keys) of `n` different keys: no bucket that can split is overfull.

    A bucket is as deep as its keys' bits at most; buckets without keys are left out.
    """
    deep = min(params.key_bits, max(0, ceil(log2(max(1, n) / params.bucket_capacity))))
    count = lambda df: df.groupBy("prefix", "local_depth").agg(F.count(F.lit(1)).alias("keys"))
    # the first doublings at once: with fewer, an average bucket would be overfull
    buckets = staged(count(keys.select(_prefix("key", deep).alias("prefix"), F.lit(deep).alias("local_depth"))), "buckets")
    while True:
        over = buckets.where((F.col("keys") > params.bucket_capacity) & (F.col("local_depth") < params.key_bits))
        seen = over.agg(F.count(F.lit(1)).alias("n"), F.max("local_depth").alias("deepest"), F.max("keys").alias("most")).first()
        if not seen["n"]:
            return buckets.agg(F.max("local_depth")).first()[0] or 0, buckets
        more = max(1, ceil(log2(seen["most"] / params.bucket_capacity)) - 1)
        full = slots(over, seen["deepest"])
        met = _looked_up(keys.withColumn("slot", _prefix("key", seen["deepest"])), full, "slot", seen["n"] << 4, params)
        deeper = met.withColumn("local_depth", F.least(F.lit(params.key_bits), F.col("local_depth") + more))
        split = count(deeper.select(_prefix("key", "local_depth").alias("prefix"), "local_depth"))
        buckets = staged(buckets.where((F.col("keys") <= params.bucket_capacity) | (F.col("local_depth") >= params.key_bits)).union(split), "buckets")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), params: ExactDedupParams = ExactDedupParams()) -> DataFrame:
    """One row per row of `docs`: id_col, keep_id, group_size, kept, text_sha256, bucket, and `carried` with `carry`'s columns.

    Null text counts as empty; texts are equal when their bytes are. The largest id of equal texts stays. Of rows that
    repeat both id and text one stays; a null id stays only if no other id has its text. Other columns are ignored, so
    they may have any names. An empty table gives no rows. One text may have any number of rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"), F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("int").alias("carried"))
    keyed = rows.withColumn("key", _key(F.col("body"), params.key_bits))
    keys = staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")
    seen = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n") > params.hot_rows).alias("hot")).first()
    depth, buckets = directory(keys.select("key"), seen["n"], params)
    hot = keys.where(F.col("n") > params.hot_rows).select("key", F.ceil(F.col("n") / params.hot_rows).alias("owners"))

    placed = _looked_up(keyed.withColumn("slot", _prefix("key", depth)), slots(buckets, depth).drop("local_depth"), "slot", 2 * seen["n"] // params.bucket_capacity, params)
    placed = _looked_up(placed, hot, "key", seen["hot"], params, "left").withColumn("owners", F.coalesce("owners", F.lit(1)))
    # rows of a divided key stay together by input partition: a retried task deals them as before
    dealt = placed.withColumn("owner", F.pmod(F.spark_partition_id(), "owners").cast("int")).repartition("bucket", "owner")

    place = ["bucket", "owner", "key"]
    same = Window.partitionBy(*place, "body")
    walked = (
        dealt.withColumn("nth", F.row_number().over(same.orderBy(F.desc_nulls_last("id"))))
        .withColumn("copies", F.count(F.lit(1)).over(same))
        .withColumn("largest", F.max("id").over(same))
        .withColumn("link", F.dense_rank().over(Window.partitionBy(*place).orderBy("body")))
    )
    divided = F.col("owners") > 1
    index = staged(walked.select(*place, "owners", "link", "nth", "id", "copies", "largest", F.sha2("body", 256).alias("digest"), F.when(divided & (F.col("nth") == 1), F.col("body")).alias("text"), "carried"), "index")

    heads = index.where(divided & F.col("text").isNotNull())
    joint = heads.groupBy("bucket", "key", "text").agg(F.max("largest").alias("keep_id"), F.sum("copies").alias("group_size"), F.max_by("owner", F.struct(F.col("largest").isNotNull(), "largest", "owner")).alias("winner"))
    joint = heads.select(*place, "link", "text").join(joint, ["bucket", "key", "text"]).drop("text")
    alone = index.where(~divided).withColumns({"keep_id": F.col("largest"), "group_size": F.col("copies"), "winner": F.col("owner")})
    found = alone.unionByName(index.where(divided).join(joint, [*place, "link"]))
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        ((F.col("nth") == 1) & (F.col("owner") == F.col("winner"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "bucket",
        *(["carried"] if carry else []),
    )


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


OP1_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)
"""
