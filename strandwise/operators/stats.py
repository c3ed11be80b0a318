"""Robust statistics, ranks, tests and multiple-testing correction."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.ordered import exact_quantiles, in_blocks, joined, running, value_counts
from strandwise.session import staged

SCALE = 1.4826


def robust_stats(df: DataFrame, keys: Sequence[str], value: str, accuracy: int | None = None) -> DataFrame:
    """(keys, med, sigma): midpoint median and 1.4826 MAD; else the population SD; else 1.

    Exact medians come from counts in ordered blocks, so a group may be of any size; `accuracy` takes approximate ones,
    cheaper, instead.
    """
    if accuracy is None:
        mid = lambda d, c, name: exact_quantiles(d, keys, c, {name: 0.5})
    else:
        mid = lambda d, c, name: d.groupBy(*keys).agg(F.approx_percentile(c, 0.5, accuracy).alias(name))
    own = df.select(*keys, F.col(value).alias("_v"))
    med = staged(mid(own, "_v", "med"), "medians")  # read three times below
    near = joined(own, med, keys) if keys else own.crossJoin(F.broadcast(med))  # one row
    mad = mid(near.withColumn("_off", F.abs(F.col("_v") - F.col("med"))), "_off", "mad")
    sd = own.groupBy(*keys).agg(F.stddev_pop("_v").alias("sd"))
    both = joined(joined(sd, med, keys, "left"), mad, keys, "left") if keys else sd.crossJoin(F.broadcast(med)).crossJoin(F.broadcast(mad))  # one row each
    sigma = F.when(F.col("mad") > 0, SCALE * F.col("mad")).when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0))
    return both.select(*keys, "med", sigma.alias("sigma"))


def robust_z(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    stats = robust_stats(df, keys, value)
    return df.join(stats, list(keys)).withColumn("z", (F.col(value) - F.col("med")) / F.col("sigma"))


def weighted_mean(value: Column, weight: Column) -> Column:
    """By weight over rows that have both; the plain mean if the weights add up to 0."""
    w = F.when(value.isNotNull(), weight)
    total = F.sum(w)
    return F.when(total > 0, F.sum(value * w) / total).otherwise(F.avg(value))


def fences(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles by linear interpolation, Tukey fences and Bowley skewness."""
    q = exact_quantiles(df, keys, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.withColumn("low", F.col("q1") - 1.5 * iqr).withColumn("high", F.col("q3") + 1.5 * iqr).withColumn("bowley", F.when(iqr > 0, (F.col("q3") + F.col("q1") - 2 * F.col("q2")) / iqr))


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """(keys, value, `name`): the average rank, from 1, of each different value."""
    return value_counts(df, keys, value).select(*keys, value, (F.col("_before") + (F.col("_n") + 1) / 2.0).alias(name))


def rank_avg(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """Ranks from 1, ties averaged; a null has none."""
    return joined(df, value_ranks(df, keys, value, name), [*keys, value], "left")


def pearson(x: Column | str, y: Column | str, least: int = 3) -> Column:
    """Null below `least` pairs or where a side is flat."""
    x, y = (F.col(v) if isinstance(v, str) else v for v in (x, y))
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    flat = (F.max(xs) - F.min(xs) <= 1e-9) | (F.max(ys) - F.min(ys) <= 1e-9)
    spread = F.stddev_pop(xs) * F.stddev_pop(ys)
    r = F.covar_pop(xs, ys) / F.when(spread > 0, spread)  # corr() itself fails on a flat side where ANSI mode is on
    return F.when((F.count(xs) >= least) & ~flat, r)


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 4) -> DataFrame:
    """(keys, rho, n): Pearson's r of average ranks, over the counts of different pairs; null below `least` or if flat."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_w"))
    both = staged(both, "pairs")
    rank = lambda v, name: value_ranks_of_counts(both, keys, v, name)
    ranked = joined(joined(both, rank("_x", "_rx"), [*keys, "_x"]), rank("_y", "_ry"), [*keys, "_y"])
    size = both.groupBy(*keys).agg(F.sum("_w").alias("_size"))
    ranked = joined(ranked, size, keys) if keys else ranked.crossJoin(F.broadcast(size))  # one row
    a, b, w = F.col("_rx") - (F.col("_size") + 1) / 2, F.col("_ry") - (F.col("_size") + 1) / 2, F.col("_w")
    sums = ranked.groupBy(*keys).agg(F.sum(w * a * b).alias("_ab"), F.sum(w * a * a).alias("_aa"), F.sum(w * b * b).alias("_bb"), F.sum(w).alias("n"))
    spread = F.sqrt(F.col("_aa")) * F.sqrt(F.col("_bb"))
    return sums.select(*keys, F.when((F.col("n") >= least) & (spread > 0), F.col("_ab") / spread).alias("rho"), "n")


def value_ranks_of_counts(pairs: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """As `value_ranks`, for rows that stand for `_w` equal ones."""
    counts = pairs.groupBy(*keys, value).agg(F.sum("_w").alias("_n"))
    run = running(in_blocks(counts, keys, [value]), keys, [value], "_n", "_before", inclusive=False)
    return run.select(*keys, value, (F.col("_before") + (F.col("_n") + 1) / 2.0).alias(name))


def kruskal_h(df: DataFrame, keys: Sequence[str], group: str, value: str) -> DataFrame:
    """(keys, h, df): Kruskal-Wallis with the tie correction, over the counts of different (group, value)."""
    counts = staged(df.where(F.col(value).isNotNull()).groupBy(*keys, group, value).agg(F.count(F.lit(1)).alias("_w")), "counts")
    ranks = staged(value_ranks_of_counts(counts, keys, value, "_r"), "ranks")
    ranked = joined(counts, ranks, [*keys, value])
    tied = counts.groupBy(*keys, value).agg(F.sum("_w").cast("double").alias("_t")).groupBy(*keys).agg(F.sum(F.col("_t") ** 3 - F.col("_t")).alias("_ties"))
    groups = ranked.groupBy(*keys, group).agg(F.sum(F.col("_r") * F.col("_w")).alias("_s"), F.sum("_w").alias("_n"))
    sums = groups.groupBy(*keys).agg(F.sum(F.col("_s") ** 2 / F.col("_n")).alias("_q"), F.sum("_n").cast("double").alias("_all"), (F.count(F.lit(1)) - 1).alias("df"))
    both = joined(sums, tied, keys) if keys else sums.crossJoin(F.broadcast(tied))  # one row each
    n = F.col("_all")
    raw = 12 / (n * (n + 1)) * F.col("_q") - 3 * (n + 1)
    return both.select(*keys, (raw / (1 - F.col("_ties") / (n**3 - n))).alias("h"), "df")


def bh_fdr(df: DataFrame, keys: Sequence[str], p: str, order: Sequence[str]) -> DataFrame:
    """`q` by Benjamini and Hochberg: the least p * m / rank among equal or larger p. A family may be of any size.

    A null p takes no part: it isn't counted in m and has no q.
    """
    own = in_blocks(df.where(F.col(p).isNotNull()).withColumn("_one", F.lit(1)), keys, [p, *order])
    ranked = running(own, keys, [p, *order], "_one", "_rank")
    size = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    sized = joined(ranked, size, keys) if keys else ranked.crossJoin(F.broadcast(size))  # one row
    scaled = staged(sized.withColumn("_scaled", F.col(p) * F.col("_m") / F.col("_rank")), "scaled")
    q = running(scaled, keys, [p, *order], "_scaled", "q", how="min", backwards=True).withColumn("q", F.least(F.lit(1.0), "q"))
    none = df.where(F.col(p).isNull()).withColumn("q", F.lit(None).cast("double"))
    return q.select(*df.columns, "q").union(none)


def ols(x: Column, y: Column) -> tuple[Column, Column]:
    """Slope and r squared."""
    return F.regr_slope(y, x), F.regr_r2(y, x)


def logit(x: Column, low: float = 0.02, high: float = 0.98) -> Column:
    c = F.least(F.lit(high), F.greatest(F.lit(low), x))
    return F.log(c / (1 - c))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= k)


def mode_with_tie(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most common value by key, ties to the lesser."""
    n = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return top_k(n, keys, [F.desc("n"), F.asc(value)], 1).drop("nth")


def share_below(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The share of a group's values that are less; a null has none and counts as none."""
    counts = value_counts(df, keys, value)
    size = counts.groupBy(*keys).agg(F.sum("_n").alias("_m"))
    shares = (joined(counts, size, keys) if keys else counts.crossJoin(F.broadcast(size))).select(*keys, value, (F.col("_before") / F.col("_m")).alias(name))  # one row
    return joined(df, shares, [*keys, value], "left")


def elevated(df: DataFrame, value: str, factor: float = 2.0) -> DataFrame:
    """Rows at max(1, factor x median) and above: `severe` from max(2, 4 x median) on, else `elevated`."""
    med = df.agg(F.median(value).alias("_med"))
    out = df.join(F.broadcast(med)).where(F.col(value) >= F.greatest(F.lit(1.0), factor * F.col("_med")))  # one row
    return out.withColumn("level", F.when(F.col(value) >= F.greatest(F.lit(2.0), 4 * F.col("_med")), "severe").otherwise("elevated")).drop("_med")


def dose_scan(df: DataFrame, site: Sequence[str], dose: str, af: str, carriers: int = 3, least: int = 6) -> DataFrame:
    """Spearman's rho of allele fraction and dose by site, for sites with enough carriers and samples."""
    by = Window.partitionBy(*site)
    fit = df.withColumn("_c", F.count_if(F.col(af) > 0).over(by)).withColumn("_n", F.count(F.lit(1)).over(by)).where((F.col("_c") >= carriers) & (F.col("_n") >= least))
    return spearman(fit, site, dose, af, least)


def highest_density(df: DataFrame, keys: Sequence[str], value: str, weight: str, order: Sequence[str], mass: float = 0.95) -> DataFrame:
    """(keys, low, high) of the values that, heaviest first, make up `mass` of a group's weight."""
    down = [F.col(weight).desc(), *order]
    blocks = in_blocks(df.select(*keys, value, weight, *[c for c in order if c not in (value, weight)]), keys, down)
    before = running(blocks, keys, down, weight, "_before", inclusive=False)
    total = blocks.groupBy(*keys).agg(F.sum(weight).alias("_whole"))
    kept = (joined(before, total, keys) if keys else before.crossJoin(F.broadcast(total))).where(F.col("_before") < mass * F.col("_whole"))  # one row
    return kept.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def chi2_quantile_975(k: int) -> float:
    """By Wilson and Hilferty's cube."""
    z = 1.959963984540054
    return k * (1 - 2 / (9 * k) + z * (2 / (9 * k)) ** 0.5) ** 3


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(48)


def student_p(t: float, df: float) -> float:
    """Two-sided p of Student's t, by quadrature of its density.

    With t = sqrt(df) cot(phi) the density is sin(phi) ** (df - 1) up to a factor, and p its integral from 0. The stretches
    go from the upper end down, each some decay lengths wide, until nothing is left.
    """
    t = abs(t)
    if t == 0 or math.isnan(t):
        return 1.0 if t == 0 else math.nan
    high = math.atan2(math.sqrt(df), t)
    width = 4 / ((df + 1) / math.sqrt(df) * t + math.sqrt(df + 1))
    front = 2 / math.sqrt(math.pi) * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2))
    total, top = 0.0, high
    while top > 0:
        low = max(0.0, top - width)
        phi = low + (top - low) * (_NODES + 1) / 2
        part = (top - low) / 2 * float(_WEIGHTS @ np.exp((df - 1) * np.log(np.sin(phi))))
        total += part
        if part <= 1e-17 * total:
            break
        top = low
    return min(1.0, front * total)


def chi2_tail(x: float, k: int) -> float:
    """P(chi2 with k degrees >= x) by the finite sum for a whole k: densities of Poisson counts, shifted by a half if k is odd."""
    if x <= 0:
        return 1.0
    y = x / 2
    at = np.arange(k // 2) + (0.5 if k % 2 else 0.0)
    logs = at * math.log(y) - y - np.array([math.lgamma(a + 1) for a in at])
    return min(1.0, float(np.exp(logs).sum()) + (math.erfc(math.sqrt(y)) if k % 2 else 0.0))


def spearman_p(df: DataFrame, rho: str = "rho", n: str = "n") -> DataFrame:
    """`p` of a rank correlation by Student's t; an Arrow UDF, since no built-in has the distribution."""
    @F.pandas_udf("double")
    def p(r: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or b < 4 else 0.0 if abs(a) >= 1 else student_p(a * ((b - 2) / (1 - a * a)) ** 0.5, b - 2) for a, b in zip(r, k, strict=True)], dtype="float64")

    return df.withColumn("p", p(rho, n))
