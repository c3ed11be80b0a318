"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.session import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge; root is the least node of its component, roots included.

    Each round shuffles the edges twice and writes them to the shared folder; the number of rounds grows with the
    logarithm of the longest chain. Nothing but two totals of a round reaches the driver. Rows with a null end and
    loops carry no link.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    e = staged(e.distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        total = e.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 31) - 1))).alias("s")
        ).first()
        if total["n"] == 0 or (total["n"], total["s"]) == before:
            break
        before = (total["n"], total["s"])
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = staged(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "edges",
        )
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
