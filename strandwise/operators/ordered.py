"""Running totals, ranks and exact quantiles over few large groups.

A window by three keys puts a table into three tasks. Here rows are dealt by ranges of (keys, order) into blocks, a
window runs inside each block, and what a block carries over from those before it comes from the blocks' totals: one
row for each block and key that meet. Equal (keys, order) share a block. The blocks are written to the shared folder,
since Spark samples the bounds of ranges anew whenever it plans them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.session import staged


def in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """`df` with `_block`, a number that ascends with (keys, order)."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *[F.col(c) if isinstance(c, str) else c for c in order])
    return staged(ranged.withColumn("_block", F.spark_partition_id()), "blocks")


def joined(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join by keys in which nulls are equal; b's copies of the keys go."""
    other, on = b, F.lit(True)
    for k in keys:
        other = other.withColumnRenamed(k, "_other_" + k)
        on = on & F.col(k).eqNullSafe(F.col("_other_" + k))
    return a.join(other, on, how).drop(*["_other_" + k for k in keys])


_FOLDS = {"sum": F.sum, "min": F.min, "max": F.max, "xor": F.bit_xor}


def _folded(how: str, a: Column, b: Column) -> Column:
    if how in ("min", "max"):
        return (F.least if how == "min" else F.greatest)(a, b)
    a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return a + b if how == "sum" else a.bitwiseXOR(b)


def running_all(blocks: DataFrame, keys: Sequence[str], order: Sequence[str | Column], values: dict[str, tuple[str, str]], backwards: bool = False, inclusive: bool = True) -> DataFrame:
    """`running` for several {name: (value, how)} in one pass."""
    turn = lambda c: (F.col(c) if isinstance(c, str) else c).desc() if backwards else c
    inside = Window.partitionBy(*keys, "_block").orderBy(*[turn(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    totals = blocks.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"), *[_FOLDS[how](value).alias(f"_total_{n}") for n, (value, how) in enumerate(values.values())])
    over = Window.partitionBy(*keys).orderBy(turn("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_block", F.sum("_rows").over(over).alias("_rows"), *[_FOLDS[how](f"_total_{n}").over(over).alias(f"_carried_{n}") for n, (_, how) in enumerate(values.values())])
    # only the first key of a block can go on from another one: a row for each block at most
    carried = F.broadcast(carried.where(F.col("_rows").isNotNull()).drop("_rows"))
    here = blocks.withColumns({name: _FOLDS[how](value).over(inside) for name, (value, how) in values.items()})
    out = joined(here, carried, [*keys, "_block"], "left")
    whole = {name: _folded(how, F.col(name), F.col(f"_carried_{n}")) for n, (name, (_, how)) in enumerate(values.items())}
    return out.withColumns(whole).drop(*[f"_carried_{n}" for n in range(len(values))])


def running(blocks: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str, how: str = "sum", backwards: bool = False, inclusive: bool = True) -> DataFrame:
    """`name`: the sum, least, largest or exclusive or (`how`) of a group's `value` up to each row, or from it on (`backwards`).

    `blocks` comes from `in_blocks` with the same keys and order. Exclusive sums begin with 0.
    """
    return running_all(blocks, keys, order, {name: (value, how)}, backwards, inclusive)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, `_n`, `_before`, `_block`): how many rows have a value and how many a lesser one; nulls stay out."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return running(in_blocks(counts, keys, [value]), keys, [value], "_n", "_before", inclusive=False)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(keys, one column for each share): quantiles by linear interpolation; null for groups without values."""
    counts = value_counts(df, keys, value)
    total = counts.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    both = joined(counts, total, keys) if keys else counts.crossJoin(F.broadcast(total))  # one row
    at = {}
    for name, share in shares.items():
        place = share * (F.col("_all") - 1)
        for side, spot in (("l", F.floor(place)), ("u", F.ceil(place))):
            at[f"_{side}_{name}"] = F.max(F.when((F.col("_before") <= spot) & (spot < F.col("_before") + F.col("_n")), F.col(value).cast("double")))
    got = both.groupBy(*keys).agg(F.max("_all").alias("_all"), *[c.alias(n) for n, c in at.items()])
    mix = {n: (s * (F.col("_all") - 1)) - F.floor(s * (F.col("_all") - 1)) for n, s in shares.items()}
    return got.select(*keys, *[(F.col(f"_l_{n}") + (F.col(f"_u_{n}") - F.col(f"_l_{n}")) * mix[n]).alias(n) for n in shares])


def upper_medians(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """(keys, name): value n // 2, counted from 0, of a group's n sorted values."""
    counts = value_counts(df, keys, value)
    total = counts.groupBy(*keys).agg(F.floor(F.sum("_n") / 2).alias("_spot"))
    both = joined(counts, total, keys) if keys else counts.crossJoin(F.broadcast(total))  # one row
    hit = (F.col("_before") <= F.col("_spot")) & (F.col("_spot") < F.col("_before") + F.col("_n"))
    return both.where(hit).select(*keys, F.col(value).alias(name))
