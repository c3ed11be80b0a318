"""Mixing sources to target weights by iterative proportional fitting.

The tokens of the corpus are added up by (source, language, topic); the cells, a bounded number, are raked on the
driver until their weights meet all three marginal targets; a document is then sampled with the probability of its
cell, by a hash of its id, so that a rerun samples the same documents.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.session import staged

AXES = ("source", "lang", "topic")
NONE, REST = "(none)", "(rest)"


@dataclass(frozen=True)
class MixParams:
    targets: dict[str, dict[str, float]] = field(default_factory=dict)  #: axis -> category -> share; shares are normalised
    flatten: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.7, "topic": 1.0})
    #: without a target, an axis gets its own shares of tokens to this power, which lifts small categories
    budget: float = 0.5  #: share of the corpus's tokens to sample
    categories: dict[str, int] = field(default_factory=lambda: {"source": 1024, "lang": 64, "topic": 16})
    #: the largest by tokens, and all that have a target; others are raked as one "(rest)", whose goal is the sum of theirs, and split
    #: it by the same power. The product of these numbers bounds the cells
    rounds: int = 1000
    tolerance: float = 1e-9
    seed: int = 5


def topic_of(text: Column, tokens: Column) -> Column:
    """A form class as the default topic: tabular, marked, short, long or prose."""
    marks = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    return (
        F.when(marks("|") * 50 > F.length(text), F.lit("tabular"))
        .when(marks("#$%&*!") * 50 > F.length(text), F.lit("marked"))
        .when(tokens < 50, F.lit("short"))
        .when(tokens > 1000, F.lit("long"))
        .otherwise(F.lit("prose"))
    )


def rake(cells: list[tuple[str, ...]], tokens: np.ndarray, goals: list[dict[str, float]], budget: float, rounds: int, tolerance: float) -> np.ndarray:
    """Tokens to take from each cell: at most all, `budget` of them together, by marginal shares as near as can be.

    Each step scales the cells of one axis to its target and cuts cells at what they hold; a target for a category
    without tokens is dropped and the others are normalised. A margin that can't be met, since its cells hold too little
    or the rounds run out, is as near as the last round came, and a warning says by how much.
    """
    if not len(tokens) or not tokens.sum():
        return np.zeros(len(tokens))
    total = budget * tokens.sum()
    axes = []
    for k, goal in enumerate(goals):
        names = sorted({c[k] for c in cells})
        index = np.array([names.index(c[k]) for c in cells]) if len(names) < 50 else np.searchsorted(names, [c[k] for c in cells])
        held = np.bincount(index, tokens, len(names))
        want = np.array([goal.get(x, 0.0) for x in names]) * (held > 0)
        axes.append((index, total * want / want.sum() if want.sum() > 0 else budget * held))
    w = tokens * budget
    for _ in range(rounds):
        before = w
        for index, want in axes:
            have = np.bincount(index, w, len(want))
            w = np.minimum(w * np.divide(want, have, out=np.zeros_like(have), where=have > 0)[index], tokens)
        if np.abs(w - before).max() <= tolerance * total:
            break
    miss = max(float(np.abs(np.bincount(index, w, len(want)) - want).max()) for index, want in axes) / total if total else 0.0
    if miss > 1e-3:
        warnings.warn(f"a marginal target is missed by {miss:.2%} of the mixture", RuntimeWarning, stacklevel=2)
    return w


def _axis(prefix: str, axis: str) -> str:
    """The column that holds an axis: the topic's is a result, the others' are dropped again."""
    return prefix + axis if axis == "topic" else f"_{prefix}axis_{axis}"


def measure(docs: DataFrame, text_col: str = "text", prefix: str = "mix_") -> DataFrame:
    """`docs` with tokens and topic of each text, after `prefix`; with them, `mix` needs no text."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.drop(prefix + "tokens", prefix + "topic").withColumn(prefix + "tokens", F.regexp_count(body, F.lit(r"\S+")).cast("long"))
    return out.withColumn(prefix + "topic", topic_of(body, F.col(prefix + "tokens")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: MixParams = MixParams(), prefix: str = "mix_", measured: bool = False) -> DataFrame:
    """`docs` with the columns topic, tokens, weight, probability and sampled, each after `prefix`.

    `weight` is the share of the mixture that the document's cell gets. Null source or language is "(none)"; null and
    empty texts have no tokens, the topic "short", and go with their cell. Rows that repeat an id share its decision;
    a null id has one of its own. Columns of these names are replaced; no rows give no rows. measured: `docs` comes from
    `measure`.
    """
    spark = docs.sparkSession
    named = (docs if measured else measure(docs, text_col, prefix)).drop(*[prefix + c for c in ("weight", "probability", "sampled")])
    for axis in ("source", "lang"):
        named = named.withColumn(_axis(prefix, axis), F.coalesce(F.col(axis).cast("string"), F.lit(NONE)))

    goals, pools, lifts = [], {}, {}
    # unless measured, texts are read twice, here and for the result; all that the plan needs comes from these sums
    sums = staged(named.groupBy(*[_axis(prefix, a) for a in AXES]).agg(F.sum(prefix + "tokens").alias("tokens")), "mix-sums")
    for axis in AXES:
        fixed, most = params.targets.get(axis, {}), params.categories[axis]
        by = sums.groupBy(F.col(_axis(prefix, axis)).alias("c")).agg(F.sum("tokens").alias("t"))
        largest = by.orderBy(F.desc("t"), "c").limit(most + 1).collect()
        held = {r["c"]: float(r["t"]) for r in largest[:most]}
        if len(largest) > most:
            pools[axis] = {*held, *fixed}
        power = params.flatten.get(axis, 1.0)
        goal = dict(fixed) or {k: v**power for k, v in held.items() if v > 0}
        if axis in pools and not fixed:
            small = by.where(~F.col("c").isin(*held) & (F.col("t") > 0))
            rest = float(small.agg(F.sum(F.col("t").cast("double") ** power)).first()[0] or 0)
            goal |= {REST: goal.get(REST, 0.0) + rest} if rest else {}
            lifts[axis] = small.select(F.col("c").alias(_axis(prefix, axis)), (F.col("t").cast("double") ** (power - 1)).alias(_axis(prefix, axis) + "_lift"))
        goals.append(goal)
    own = sums
    for axis, known in pools.items():
        sums = sums.withColumn(_axis(prefix, axis), F.when(F.col(_axis(prefix, axis)).isin(*known), F.col(_axis(prefix, axis))).otherwise(F.lit(REST)))
    keys = [_axis(prefix, a) for a in AXES]
    got = sums.groupBy(*keys).agg(F.sum("tokens").alias("tokens")).orderBy(*keys).collect()  # the product of `categories` at most
    cells, tokens = [tuple(r)[:3] for r in got], np.array([r["tokens"] for r in got], float)
    take = rake(cells, tokens, goals, params.budget, params.rounds, params.tolerance)
    share = np.divide(take, tokens, out=np.full(len(tokens), params.budget), where=tokens > 0)
    whole = take.sum() or 1.0
    table = spark.createDataFrame(
        [(*c, float(t / whole), float(min(1.0, s))) for c, t, s in zip(cells, take, share, strict=True)],
        ", ".join(f"{k} string" for k in keys) + f", {prefix}weight double, {prefix}probability double",
    )
    if pools:
        table = _split(own, table, keys, pools, lifts, prefix)
    found = named.join(F.broadcast(table) if not pools and len(cells) <= 100_000 else table, keys, "left")
    u = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(params.seed)), 11) / F.lit(float(1 << 53))
    found = found.withColumn(prefix + "sampled", u < F.col(prefix + "probability"))
    return found.select(*[c for c in named.columns if c not in (_axis(prefix, "source"), _axis(prefix, "lang"))], prefix + "weight", prefix + "probability", prefix + "sampled")


def _split(sums: DataFrame, table: DataFrame, keys: list[str], pools: dict[str, set], lifts: dict[str, DataFrame], prefix: str) -> DataFrame:
    """`table` for the categories themselves: what a pooled cell takes goes to its members by tokens * lift.

    A member gives all it has at most; the others of the cell share what it can't give, so the cell's sum stays.
    """
    weight, chance = prefix + "weight", prefix + "probability"
    parts = sums.withColumn("_lift", F.lit(1.0))
    for axis, lift in lifts.items():
        name = _axis(prefix, axis)
        parts = parts.join(lift, name, "left").withColumn("_lift", F.col("_lift") * F.coalesce(name + "_lift", F.lit(1.0))).drop(name + "_lift")
    cell = [k + "_cell" for k in keys]
    for axis in AXES:
        name = F.col(_axis(prefix, axis))
        parts = parts.withColumn(_axis(prefix, axis) + "_cell", F.when(name.isin(*pools[axis]), name).otherwise(F.lit(REST)) if axis in pools else name)
    parts = staged(parts, "mix-parts")
    whole = parts.groupBy(*cell).agg(F.sum("tokens").alias("_all"))
    whole = whole.join(table.select(*[F.col(k).alias(c) for k, c in zip(keys, cell, strict=True)], F.col(weight).alias("_w"), F.col(chance).alias("_p")), cell)
    up = Window.partitionBy(*cell).orderBy("_lift", *keys).rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.where("tokens > 0").withColumn("_x", F.sum("tokens").over(up)).withColumn("_xl", F.sum(F.col("tokens") * F.col("_lift")).over(up)).join(whole, cell)
    left = F.col("_p") * F.col("_all") - (F.col("_all") - F.col("_x"))  # if all members of larger lifts give all they have
    free = rows.withColumn("_scale", left / F.col("_xl")).where(F.col("_scale") * F.col("_lift") < 1)
    scale = free.groupBy(*cell).agg(F.max_by("_scale", F.struct("_lift", "_x")).alias("_scale"))
    out = parts.join(whole, cell).join(scale, cell, "left")
    p = F.when(F.col("tokens") == 0, F.col("_p")).otherwise(F.least(F.lit(1.0), F.coalesce(F.col("_scale") * F.col("_lift"), F.lit(1.0))))
    w = F.when(F.col("_p") * F.col("_all") > 0, F.col("_w") * p * F.col("tokens") / (F.col("_p") * F.col("_all"))).otherwise(0.0)
    return out.select(*keys, w.alias(weight), p.alias(chance))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    out = mix(staged(measure(docs).drop("text"), "measured"), measured=True)
    return out.select("doc_id", "source", "lang", *[F.col("mix_" + c).alias(c) for c in ("topic", "tokens", "weight", "probability", "sampled")])
