"""Metric matrices: principal axes, Mahalanobis distances, pairs and histograms."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.operators.stats import SCALE, pearson, robust_stats


def robust_columns(df: DataFrame, metrics: Sequence[str], present: float = 0.5, clip: float = 8.0) -> tuple[DataFrame, list[str]]:
    """Robust z-scores of the metrics that at least `present` of the rows have; missing ones are 0, the median. Clipped."""
    seen = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(m).alias(m) for m in metrics], *[F.median(m).alias("med_" + m) for m in metrics]).first()
    kept = [m for m in metrics if seen["n"] and seen[m] >= present * seen["n"]]
    mads = df.agg(*[F.median(F.abs(F.col(m) - F.lit(seen["med_" + m]))).alias(m) for m in kept], *[F.stddev_pop(m).alias("sd_" + m) for m in kept]).first() if kept else {}
    out = df
    for m in kept:
        sigma = SCALE * mads[m] if mads[m] else mads["sd_" + m] or 1.0
        z = (F.col(m) - F.lit(seen["med_" + m])) / F.lit(float(sigma))
        out = out.withColumn(m, F.coalesce(F.greatest(F.lit(-clip), F.least(F.lit(clip), z)), F.lit(0.0)))
    return out, kept


def _covariance(df: DataFrame, metrics: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariances in one pass: a row of metrics x metrics numbers reaches the driver."""
    pairs = [(i, j) for i in range(len(metrics)) for j in range(i, len(metrics))]
    got = df.agg(*[F.avg(m).alias("m" + m) for m in metrics], *[F.covar_samp(metrics[i], metrics[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(metrics), len(metrics)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = got[f"c{i}_{j}"] or 0.0
    return np.array([got["m" + m] or 0.0 for m in metrics]), cov


def _axis(cov: np.ndarray, steps: int = 500) -> tuple[float, np.ndarray]:
    """The largest eigenvalue and its vector by power iteration, the largest component positive."""
    v = np.ones(len(cov)) / np.sqrt(len(cov)) + 1e-3 * np.arange(len(cov))
    for _ in range(steps):
        w = cov @ v
        n = np.linalg.norm(w)
        if n < 1e-15:
            break
        if np.abs(w / n - v).max() < 1e-14:
            v = w / n
            break
        v = w / n
    v = v * np.sign(v[np.abs(v).argmax()] or 1)
    return float(v @ cov @ v), v


def principal_axes(df: DataFrame, id_col: str, metrics: Sequence[str]) -> DataFrame:
    """(id, pc1, pc2): robust z-scores on the two main axes of their covariance."""
    z, kept = robust_columns(df, metrics)
    mean, cov = _covariance(z, kept)
    axes = []
    for _ in range(2):
        value, v = _axis(cov)
        axes.append(v)
        cov = cov - value * np.outer(v, v)
    on = lambda v: sum(((F.col(m) - F.lit(float(a))) * F.lit(float(w)) for m, a, w in zip(kept, mean, v, strict=True)), F.lit(0.0))
    return z.select(id_col, on(axes[0]).alias("pc1"), on(axes[1]).alias("pc2"))


def mahalanobis(df: DataFrame, id_col: str, metrics: Sequence[str], ridge: float = 0.05) -> DataFrame:
    """(id, d2, outlier): squared distances under the ridged covariance of robust z-scores, cut at median + 3 robust sigmas.

    Where most distances are equal the standard deviation takes the place of the MAD; if all are, there is no outlier.
    """
    z, kept = robust_columns(df, metrics)
    mean, cov = _covariance(z, kept)
    inverse = np.linalg.inv(cov + ridge * max(np.trace(cov) / max(1, len(kept)), 1e-12) * np.eye(len(kept)))
    d = [F.col(m) - F.lit(float(a)) for m, a in zip(kept, mean, strict=True)]
    d2 = sum((d[i] * d[j] * F.lit(float(inverse[i, j])) for i in range(len(d)) for j in range(len(d))), F.lit(0.0))
    out = z.select(id_col, d2.alias("d2"))
    spread = robust_stats(out, [], "d2").crossJoin(F.broadcast(out.agg(F.max("d2").alias("hi"), F.min("d2").alias("lo")))).first()  # one row each
    flat = spread is None or spread["med"] is None or spread["hi"] == spread["lo"]
    return out.withColumn("outlier", F.lit(False) if flat else F.col("d2") > F.lit(spread["med"] + 3 * spread["sigma"]))


def ellipse(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """The axes' variances and the main one's angle of each group's two-dimensional spread."""
    g = df.groupBy(*keys).agg(F.var_samp(x).alias("sx"), F.var_samp(y).alias("sy"), F.covar_samp(x, y).alias("c"))
    half, gap = (F.col("sx") + F.col("sy")) / 2, (F.col("sx") - F.col("sy")) / 2
    root = F.sqrt(gap * gap + F.col("c") * F.col("c"))
    return g.select(*keys, (half + root).alias("major"), (half - root).alias("minor"), (F.atan2(2 * F.col("c"), F.col("sx") - F.col("sy")) / 2).alias("angle"))


def metric_pairs(df: DataFrame, id_col: str, metrics: Sequence[str], coupled: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson's r of all metric pairs but the coupled ones, in one pass over the wide table."""
    skip = {frozenset(p) for p in coupled}
    pairs = [(a, b) for a in sorted(metrics) for b in sorted(metrics) if a < b and frozenset((a, b)) not in skip]
    wide = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])).alias("x")).select("x.*")


def sqrt_histogram(df: DataFrame, value: str) -> DataFrame:
    """(bin, n) over min(30, max(8, round(sqrt(n)))) equal bins from the least to the largest value."""
    r = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.least(F.lit(30), F.greatest(F.lit(8), F.bround(F.sqrt(F.count(value)), 0))).cast("bigint").alias("nb"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.col("nb") - 1, F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("nb")))).otherwise(0)
    return df.where(F.col(value).isNotNull()).join(F.broadcast(r)).groupBy(at.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # one row


def edge_histogram(df: DataFrame, value: str, edges: Sequence[float], extra: float | None = None) -> DataFrame:
    """(bin, n): bin i holds the values under edge i; `extra`, a live threshold, becomes an edge of its own."""
    cuts = sorted({*edges, *([extra] if extra is not None else [])})
    at = F.lit(len(cuts))
    for i, c in reversed(list(enumerate(cuts))):
        at = F.when(F.col(value) < c, F.lit(i)).otherwise(at)
    return df.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
