"""Intervals, runs and nearest neighbours on a line. Positions are whole numbers, intervals closed at both ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", slack: int = 1) -> DataFrame:
    """Merged intervals by keys: (keys, start, end, n). One begins a new group if it starts after the end so far + slack.

    slack 1 lets touching intervals merge, 0 asks for a shared position. One window by keys: one sort.
    """
    by = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(start) > before + slack), 1).otherwise(0)
    grouped = df.withColumn("_new", new).withColumn("_group", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*keys, "_group").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("n")).drop("_group")


def gaps_islands(df: DataFrame, keys: Sequence[str], pos: str, least: int = 1) -> DataFrame:
    """Maximal runs of consecutive positions: (keys, start, end, length), those of `least` positions and more."""
    by = Window.partitionBy(*keys).orderBy(pos)
    own = df.select(*keys, pos).distinct().withColumn("_island", F.col(pos) - F.row_number().over(by))
    runs = own.groupBy(*keys, "_island").agg(F.min(pos).alias("start"), F.max(pos).alias("end"), F.count(F.lit(1)).alias("length"))
    return runs.where(F.col("length") >= least).drop("_island")


def to_bed(runs: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Closed 1-based runs as half-open 0-based ones."""
    return runs.withColumn(start, F.col(start) - 1).withColumn(end, F.col(end))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_range: tuple[str, str], right_range: tuple[str, str], bucket: int, how: str = "inner") -> DataFrame:
    """Pairs whose ranges share a position, by an equi-join on (keys, bucket) instead of a nested loop.

    Both sides are put in every bucket that they touch; a pair counts only in the bucket where its overlap begins, so
    none comes twice. `bucket` should be about the usual length of the ranges. how: inner, left_semi or left_anti.
    """
    ls, le = left_range
    rs, re_ = right_range
    spread = lambda df, a, b: df.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(a) / bucket), F.floor(F.col(b) / bucket))))
    a, b = left.where(F.col(ls) <= F.col(le)), right.where(F.col(rs) <= F.col(re_))
    if how == "inner":
        one = spread(a, ls, le).alias("l").join(spread(b, rs, re_).alias("r"), [*keys, "_bucket"])
        hit = (F.col(ls) <= F.col(re_)) & (F.col(rs) <= F.col(le)) & (F.floor(F.greatest(F.col(ls), F.col(rs)) / bucket) == F.col("_bucket"))
        return one.where(hit).drop("_bucket")
    spare = spread(b.select(*keys, F.col(rs).alias("_rs"), F.col(re_).alias("_re")), "_rs", "_re")
    met = spread(a.distinct(), ls, le).join(spare, [*keys, "_bucket"]).where((F.col(ls) <= F.col("_re")) & (F.col("_rs") <= F.col(le)))
    met = met.select(*[F.col(c).alias("_m_" + c) for c in left.columns]).distinct()  # equal rows share their answer
    same = None
    for c in left.columns:
        one = F.col(c).eqNullSafe(F.col("_m_" + c))
        same = one if same is None else same & one
    return left.join(met, same, how)


def point_in_interval(points: DataFrame, intervals: DataFrame, keys: Sequence[str], pos: str, bucket: int, start: str = "start", end: str = "end", how: str = "left_semi") -> DataFrame:
    """Points inside (left_semi) or outside (left_anti) of any interval, for points and intervals with equal keys.

    Points lie in one bucket each, so they aren't multiplied and the join is a plain semi or anti join.
    """
    spare = intervals.where(F.col(start) <= F.col(end)).select(
        *keys, F.col(start).alias("_s"), F.col(end).alias("_e"), F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket))).alias("_b")
    )
    p = points.withColumn("_b0", F.floor(F.col(pos) / bucket))
    on = (F.col("_b0") == F.col("_b")) & (F.col(pos) >= F.col("_s")) & (F.col(pos) <= F.col("_e"))
    for k in keys:
        spare = spare.withColumnRenamed(k, "_k_" + k)
        on = on & (F.col(k) == F.col("_k_" + k))
    return p.join(spare, on, how).drop("_b0")


def bucket_argmin(left: DataFrame, right: DataFrame, keys: Sequence[str], pos: str, right_range: tuple[str, str], bucket: int, cost: Column, unique: Sequence[str], order: Sequence[str], reads: Sequence[str] | None = None) -> DataFrame:
    """Of the right ranges around each left position the one of least `cost`, ties by `order`; one row per `unique`.

    `reads` are the left columns that the cost reads besides keys and position, all if None: left rows that agree in them
    are searched for once. `order` tells right rows apart. The least cost is a hash aggregation that begins before the
    shuffle and keeps no pairs; then the pairs are met again and only those of least cost go on.
    """
    rs, re_ = right_range
    same = list(dict.fromkeys([*keys, pos, *(left.columns if reads is None else reads)]))
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes and much work: tasks aren't merged
    a = left.select(*same).distinct().withColumn("_bucket", F.floor(F.col(pos) / bucket)).repartition(n, *keys, "_bucket")
    b = right.where(F.col(rs) <= F.col(re_)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(rs) / bucket), F.floor(F.col(re_) / bucket))))
    both = a.join(b, [*keys, "_bucket"]).where((F.col(pos) >= F.col(rs)) & (F.col(pos) <= F.col(re_))).withColumn("_cost", cost)
    others = [c for c in right.columns if c not in keys]
    least = both.groupBy(*same).agg(F.min("_cost").alias("_least"), F.bool_or(F.col("_cost").isNull()).alias("_null"))
    least = least.select(*[F.col(c).alias("_k_" + c) for c in same], F.when(~F.col("_null"), F.col("_least")).alias("_least"))  # nulls come first
    on = F.lit(True)
    for c in same:
        on = on & (F.col(c) == F.col("_k_" + c) if c in (*keys, pos) else F.col(c).eqNullSafe(F.col("_k_" + c)))
    near = both.join(least, on).where(F.col("_cost").eqNullSafe(F.col("_least")))
    # order first: of equal costs the least struct is the best row
    best = near.groupBy(*same).agg(F.first("_cost").alias("_cost"), F.min(F.struct(*order, F.struct(*others).alias("_row"))).alias("_best"))
    best = best.select(*same, "_cost", "_best._row.*")
    met = left.join(best.withColumnsRenamed({c: "_k_" + c for c in same}), on).drop(*["_k_" + c for c in same])
    first = Window.partitionBy(*unique).orderBy("_cost", *order)
    return met.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_cost")


def bracket(df: DataFrame, keys: Sequence[str], order: Sequence[str], is_anchor: Column, value: Column) -> DataFrame:
    """`previous` and `next`: the value of the nearest anchor row strictly before and after each row, by one sort."""
    marked = F.when(is_anchor, value)
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("previous", F.last(marked, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "next", F.first(marked, ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing))
    )


def last_anchor_mask(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos: str, is_anchor: Column, width: int) -> DataFrame:
    """`masked`: the last anchor at or before the row is `width` away or more, or there is none."""
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(is_anchor, F.col(pos))).over(by)
    return df.withColumn("last_anchor", last).withColumn("masked", F.coalesce(F.col(pos) - last >= width, F.lit(True)))


def dense_fill(df: DataFrame, keys: Sequence[str], pos: str, low: int, high: int, defaults: dict[str, object]) -> DataFrame:
    """One row for each position low..high of each key, missing values by `defaults`."""
    grid = df.select(*keys).distinct().withColumn(pos, F.explode(F.sequence(F.lit(low), F.lit(high)).cast("array<bigint>")))
    return grid.join(df.withColumn(pos, F.col(pos).cast("bigint")), [*keys, pos], "left").fillna(defaults)


def profile_bins(df: DataFrame, keys: Sequence[str], place: Column, total: Column | int, bins: int = 200) -> DataFrame:
    """Counts by bin min(bins - 1, place * bins // total) of a 0-based place."""
    at = F.least(F.lit(bins - 1), F.floor(place * bins / total)).cast("bigint")
    return df.withColumn("bin", at).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))


def spread_over_bins(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """An interval's mass by bin: one row per bin that it touches, with the positions in it as `share`."""
    out = df.withColumn("bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return out.withColumn("share", F.least(F.col(end), (F.col("bin") + 1) * width - 1) - F.greatest(F.col(start), F.col("bin") * width) + 1)


def offsets(df: DataFrame, keys: Sequence[str], order: Sequence[str], length: str) -> DataFrame:
    """`offset`: the lengths of the rows before, in order."""
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(length).over(by), F.lit(0)))
