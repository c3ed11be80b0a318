"""Joins with checks, upserts, closures and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.session import staged


def checked_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A full join by `keys` that fails at run time if a key is missing or repeated on either side."""
    by = Window.partitionBy(*keys)
    a = left.withColumn("_in_a", F.count(F.lit(1)).over(by))
    b = right.withColumn("_in_b", F.count(F.lit(1)).over(by))
    both = a.join(b, list(keys), "full")
    fine = (F.col("_in_a") == 1) & (F.col("_in_b") == 1)
    ok = F.when(F.coalesce(fine, F.lit(False)), True).otherwise(F.raise_error(F.concat(F.lit("not one to one at "), F.to_json(F.struct(*keys)))))
    return both.where(ok).drop("_in_a", "_in_b")


def mismatches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_left, n_right) of all keys that aren't one to one."""
    n = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return n(left, "n_left").join(n(right, "n_right"), list(keys), "full").fillna(0, ["n_left", "n_right"]).where("n_left <> 1 OR n_right <> 1")


def complete_groups(df: DataFrame, keys: Sequence[str], expected: Column) -> DataFrame:
    """(keys, n) of the groups that have as many rows as `expected`, an aggregate, says."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), expected.alias("_expected")).where("n = _expected").drop("_expected")


def left_with_placeholder(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """A left join in which a row without a match gets `defaults`; what matched rows hold, nulls and NaN too, stays."""
    both = left.join(right.withColumn("_matched", F.lit(True)), list(keys), "left")
    for c, v in defaults.items():
        both = both.withColumn(c, F.when(F.col("_matched"), F.col(c)).otherwise(F.lit(v)))
    return both.drop("_matched")


def upsert(base: DataFrame, news: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`base` with `columns` replaced where `news` has the key and a value, and rows for keys only `news` has."""
    other = news.select(*keys, *[F.col(c).alias("_new_" + c) for c in columns])
    both = base.join(other, list(keys), "full")
    for c in columns:
        both = both.withColumn(c, F.coalesce("_new_" + c, c)) if c in base.columns else both.withColumn(c, F.col("_new_" + c))
    return both.drop(*["_new_" + c for c in columns])


def fallback_join(df: DataFrame, steps: Sequence[tuple[DataFrame, Sequence[tuple[str, str]], str]], name: str) -> DataFrame:
    """`name`: the value of the first (table, [(own key, its key)], value column) that has the row's keys.

    Each table must have its keys once; a row is never multiplied.
    """
    out, found = df, []
    for i, (table, on, value) in enumerate(steps):
        renamed = table.select(*[F.col(b).alias(f"_k{i}_{j}") for j, (_, b) in enumerate(on)], F.col(value).alias(f"_v{i}"))
        cond = None
        for j, (a, _) in enumerate(on):
            one = F.col(a) == F.col(f"_k{i}_{j}")
            cond = one if cond is None else cond & one
        out = out.join(renamed, cond, "left").drop(*[f"_k{i}_{j}" for j in range(len(on))])
        found.append(f"_v{i}")
    return out.withColumn(name, F.coalesce(*found)).drop(*found)


def by_priority(df: DataFrame, keys: Sequence[Column], catalogue: DataFrame, key: str, id_cols: Sequence[str]) -> DataFrame:
    """The catalogue's row for the first of several keys that it has; rows without one are left out."""
    tried = df.select("*", F.posexplode(F.array(*keys)).alias("priority", key)).join(catalogue, key)
    best = Window.partitionBy(*id_cols).orderBy("priority")
    return tried.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def closure(edges: DataFrame, seeds: DataFrame, child: str = "child", parent: str = "parent", max_depth: int = 64) -> DataFrame:
    """(seed, node, depth): the seeds and all below them. A step joins the newest nodes only and is written to the shared folder."""
    new = staged(seeds.select(F.col(child).alias("seed"), F.col(child).alias("node"), F.lit(0).alias("depth")), "closure")
    found = new
    for depth in range(1, max_depth + 1):
        step = new.join(edges, F.col("node") == F.col(parent)).select("seed", F.col(child).alias("node"), F.lit(depth).alias("depth"))
        new = staged(step.join(found.select("seed", "node"), ["seed", "node"], "left_anti").distinct(), "closure")
        if new.isEmpty():
            return found
        found = found.union(new)
    raise RuntimeError(f"deeper than {max_depth}")


def ancestors(edges: DataFrame, seeds: DataFrame, child: str = "child", parent: str = "parent", max_depth: int = 64) -> DataFrame:
    """(seed, node, depth): the seeds and all above them."""
    return closure(edges.select(F.col(parent).alias("_c"), F.col(child).alias("_p")), seeds.select(F.col(child).alias("_c")), "_c", "_p", max_depth)


def aligned(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two tables of one key set side by side; a key that one lacks fails at run time."""
    both = left.withColumn("_a", F.lit(True)).join(right.withColumn("_b", F.lit(True)), list(keys), "full")
    fine = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return both.where(F.when(fine, True).otherwise(F.raise_error(F.lit("the two sides have other keys")))).drop("_a", "_b")


def violations(df: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """(id, rule) of all broken rules of all rows, in one pass."""
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.select(F.col(id_col), F.explode(broken).alias("rule"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def suffix_repeats(df: DataFrame, keys: Sequence[str], token: str, order: Sequence[str]) -> DataFrame:
    """Repeated tokens get _2, _3 and so on, in order."""
    n = F.row_number().over(Window.partitionBy(*keys, token).orderBy(*order))
    return df.withColumn(token + "_unique", F.when(n > 1, F.concat(F.col(token), F.lit("_"), n.cast("string"))).otherwise(F.col(token)))


def nearest_in_out(pairs: DataFrame, node: str, other: str, same_group: Column, distance: str) -> DataFrame:
    """Of a symmetric pair table the nearest other node inside and outside of the own group, ties to the lesser."""
    best = lambda cond: F.min(F.when(cond, F.struct(F.col(distance).alias("d"), F.col(other).alias("o"))))
    out = pairs.groupBy(node).agg(best(same_group).alias("i"), best(~same_group).alias("x"))
    return out.select(node, F.col("i.o").alias("nearest_in"), F.col("i.d").alias("distance_in"), F.col("x.o").alias("nearest_out"), F.col("x.d").alias("distance_out"))


def nearest_on_line(rows: DataFrame, keys: Sequence[str], node: str, group: str, place: str) -> DataFrame:
    """`nearest_in_out` of all pairs of a key's nodes by the distance of their places on a line, by sorting instead of pairs.

    The nearest one lies at the own place or at the next one on either side that has a node of the own group, or of another;
    of each place and group only the two least nodes count. Nodes are different and `place` is a whole number. Nodes alone
    in their key have no row, as they have no pair; a node without a place has nulls and is nobody's nearest one.
    """
    k = list(keys)
    known = rows.where(F.col(group).isNotNull())
    for c in k:
        known = known.where(F.col(c).isNotNull())
    own = known.select(*k, F.col(group).alias("_g"), F.col(place).alias("_p"), F.col(node).alias("_node"))
    spot = [*k, "_g", "_p"]
    nth = Window.partitionBy(*spot).orderBy("_node")
    two = own.where(F.col("_p").isNotNull()).withColumn("_n", F.row_number().over(nth)).where("_n <= 2")
    two = two.groupBy(*spot).agg(F.min("_node").alias("_a"), F.max(F.when(F.col("_n") == 2, F.col("_node"))).alias("_b"))

    def near(w, step, c):  # the neighbouring place and its least node
        return F.struct(F.abs(F.col("_p") - step("_p").over(w)).alias("d"), step(c).over(w).alias("o"))

    inner = Window.partitionBy(*k, "_g").orderBy("_p")
    sides = F.array(near(inner, F.lag, "_a"), near(inner, F.lead, "_a"))
    inside = two.withColumn("_in", F.array_min(F.filter(sides, lambda x: x["d"].isNotNull())))

    # of each place the least node and the least one of another group; of a run of places that have one and the same
    # group only, the places before and after it are those with another one
    tops = two.groupBy(*k, "_p").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.col("_a").alias("o"), F.col("_g").alias("g")))), 1, 2).alias("_top"))  # a place's groups
    line = Window.partitionBy(*k).orderBy("_p")
    only = F.when(F.size("_top") == 1, F.col("_top")[0]["g"])
    here = F.struct("_p", "_top", "_only")
    tops = tops.withColumn("_only", only).withColumns({"_before": F.lag(here).over(line), "_after": F.lead(here).over(line)})
    begins = ~F.coalesce(F.col("_only") == F.col("_before._only"), F.lit(False))
    ends = ~F.coalesce(F.col("_only") == F.col("_after._only"), F.lit(False))
    past, ahead = line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(0, Window.unboundedFollowing)
    # wrapped, so that a run at the line's end, which has nothing beyond it, isn't passed over as a null
    wrap = lambda c: F.struct(F.col(c).alias("x"))
    tops = tops.withColumns({"_run_before": F.last(F.when(begins, wrap("_before")), ignorenulls=True).over(past)["x"], "_run_after": F.first(F.when(ends, wrap("_after")), ignorenulls=True).over(ahead)["x"]})
    tops = tops.withColumns({"_far_before": F.lag("_run_before").over(line), "_far_after": F.lead("_run_after").over(line)})
    met = inside.join(tops, [*k, "_p"])

    def other(c: str) -> Column:  # the least node of another group at a place
        return F.struct(F.abs(F.col("_p") - F.col(f"{c}._p")).alias("d"), F.array_min(F.transform(F.filter(F.col(f"{c}._top"), lambda x: x["g"] != F.col("_g")), lambda x: x["o"])).alias("o"))

    def beyond(c: str) -> Column:
        return F.when(F.col(f"_{c}._only") == F.col("_g"), other(f"_far_{c}")).otherwise(other(f"_{c}"))

    self_ = F.struct(F.lit(0).cast("long").alias("d"), F.array_min(F.transform(F.filter("_top", lambda x: x["g"] != F.col("_g")), lambda x: x["o"])).alias("o"))
    met = met.withColumn("_out", F.array_min(F.filter(F.array(self_, beyond("before"), beyond("after")), lambda x: x["d"].isNotNull() & x["o"].isNotNull())))
    got = met.select(*spot, "_a", "_b", "_in", "_out")
    several = own.groupBy(*k).agg(F.count(F.lit(1)).alias("_all")).where("_all > 1").drop("_all")
    all_ = own.join(several, k).join(got, spot, "left")
    mate = F.when(F.col("_node") != F.col("_a"), F.col("_a")).otherwise(F.col("_b"))
    own_in = F.when(mate.isNotNull(), F.struct(F.lit(0).cast("long").alias("d"), mate.alias("o"))).otherwise(F.col("_in"))
    out = all_.withColumn("_i", own_in)
    return out.select(F.col("_node").alias(node), F.col("_i.o").alias("nearest_in"), F.col("_i.d").alias("distance_in"), F.col("_out.o").alias("nearest_out"), F.col("_out.d").alias("distance_out"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).union(b.subtract(a))
