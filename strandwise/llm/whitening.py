"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

1. Vectors become whole numbers; the fit list is each different one once, written to the shared folder, with exact sums.
2. A block of directions Q meets the list in passes: each task centres its vectors, X, and adds up Xt(XQ); the driver
   holds matrices of (dimensions x block) only.
3. A round runs a Chebyshev polynomial of the covariance, scaled to stay flat where the block's least Ritz value and
   everything below it lie and to grow above, through the three-term recurrence, one pass a degree. QR and Rayleigh-Ritz
   follow. The residuals certify the wanted directions; where they shrink slowly the block gets more columns, at most
   one for each dimension, where Rayleigh-Ritz is exact.
4. One more pass measures the covariance of the whitened list; then every vector is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.session import staged


@dataclass(frozen=True)
class WhiteningParams:
    components: int = 16  #: directions wanted
    guard: int = 16  #: more columns in the block, for speed
    degree: int = 10  #: of a round's polynomial, at most
    spread: float = 1e8  #: a polynomial grows by no more than this from the least to the largest Ritz value
    tolerance: float = 2e-15  #: residuals, by the largest eigenvalue, that end the rounds at once
    good: float = 1e-10  #: residuals that are enough once rounding keeps them from shrinking
    rounds: int = 200
    scale: int = 64  #: an entry c counts as floor(scale * c) + shift
    shift: int = 1_000_000


@dataclass(frozen=True)
class Whitening:
    n: int  #: vectors in the fit list
    sums: tuple[int, ...]  #: by dimension
    vectors: np.ndarray  #: dimensions x components, unit columns
    values: np.ndarray  #: eigenvalues, falling
    trace: float
    identity_error: float
    passes: int

    @property
    def whole(self) -> np.ndarray:
        """The whole parts of the means."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the sums have besides n times the whole parts."""
        return np.array([s % self.n for s in self.sums], np.int64)


def entries(vector: Column, params: WhiteningParams = WhiteningParams()) -> Column:
    """The vector's whole numbers; null if it is null or empty, or if an entry is null, not finite or beyond 62 bits."""
    most = float(1 << 62) / params.scale
    held = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < most), F.lit(False)))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * params.scale) + F.lit(params.shift).cast("long"))
    return F.when((F.size(vector) > 0) & held, x)


def points(rows: DataFrame, id_col: str, vector_col: str, params: WhiteningParams) -> DataFrame:
    """(id, x) of the rows that take part: those of the commonest length, the longer one of equally common ones."""
    made = rows.select(F.col(id_col).alias("id"), entries(F.col(vector_col), params).alias("x")).where(F.col("x").isNotNull())
    lengths = made.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return made.where(F.size("x") == (lengths["d"] if lengths else 0))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _added(fit: DataFrame, d: int, width: int, of) -> np.ndarray:
    """The sum over the list's tasks of a (d x width) array that `of` makes of a matrix of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = of(_matrix(batch.column(0).slice(at, 4096), d))
                total = part if total is None else total + part
        if total is not None:
            flat = pa.array(total.ravel())
            yield pa.record_batch([pa.array(range(d), pa.int32()), pa.FixedSizeListArray.from_arrays(flat, width).cast(pa.list_(flat.type))], names=["i", "v"])

    kind = "long" if of is _halves else "double"
    parts = fit.select("x").mapInArrow(run, f"i int, v array<{kind}>")
    got = parts.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(width)]).collect()  # d rows
    return np.array([r[1:] for r in sorted(got)])


def _halves(x: np.ndarray) -> np.ndarray:
    """Sums of the upper and the lower 32 bits, which 64 bits hold for 2^31 vectors, and the number of vectors."""
    return np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), np.full(x.shape[1], len(x))], 1)


def fit(listed: DataFrame, params: WhiteningParams = WhiteningParams()) -> Whitening | None:
    """The whitening of a list of different vectors (x); None for an empty list.

    Directions whose eigenvalue is nothing but rounding have no whitening and are left out.
    """
    first = listed.first()
    if first is None:
        return None
    d = len(first["x"])
    halves = _added(listed, d, 3, _halves)
    n = int(halves[0, 2])
    sums = tuple((int(hi) << 32) + int(lo) for hi, lo, _ in halves.tolist())
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])
    passes = 0

    def product(q: np.ndarray) -> tuple[np.ndarray, float]:
        """The covariance times q, and its trace."""
        nonlocal passes
        passes += 1

        def of(x: np.ndarray) -> np.ndarray:
            c = (x - whole) - rest
            return np.concatenate([c.T @ (c @ q), (c * c).sum(0)[:, None]], 1)

        out = _added(listed, d, q.shape[1] + 1, of) / n
        return out[:, :-1], float(out[:, -1].sum())

    rng = np.random.default_rng(11)
    wanted = min(params.components, d)
    q = np.linalg.qr(rng.standard_normal((d, min(d, wanted + params.guard))))[0]
    before = np.inf
    for _ in range(params.rounds):
        z, trace = product(q)
        theta, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        top = theta[0]
        off = float(np.linalg.norm(z - q * theta, axis=0)[:wanted].max()) / top if top > 0 else 0.0
        if off <= params.tolerance or q.shape[1] == d or (off <= params.good and off > before / 2):
            break
        # a block that gains less than four times a round gets more columns
        more = min(d, 2 * q.shape[1]) if off > before / 4 else q.shape[1]
        before = off
        y = _filtered(lambda a: product(a)[0], q, z, theta, params)
        q = np.linalg.qr(np.concatenate([y, rng.standard_normal((d, more - y.shape[1]))], 1))[0]
    else:
        raise RuntimeError(f"the directions did not settle: residual {off:.1e} of the largest eigenvalue")
    keep = int((theta[:wanted] > 1e-13 * max(trace, 0.0)).sum())
    q, theta = q[:, :keep], theta[:keep]
    q = q * np.sign(q[np.abs(q).argmax(0), range(keep)]) if keep else q
    error = 0.0
    if keep:
        w = q / np.sqrt(theta)
        error = float(np.abs(w.T @ product(w)[0] - np.eye(keep)).max())
    return Whitening(n, sums, q, theta, trace, error, passes)


def _filtered(times, q: np.ndarray, z: np.ndarray, theta: np.ndarray, params: WhiteningParams) -> np.ndarray:
    """q under a Chebyshev polynomial of the covariance that is damped over [0, least Ritz value]; z is `times` q.

    The recurrence is scaled by its value at the largest Ritz value, so nothing overflows.
    """
    top, cut = theta[0], max(theta[-1], 1e-12 * theta[0])
    e = c = cut / 2
    reach = np.arccosh(max((top - c) / e, 1 + 1e-12))
    degree = max(1, min(params.degree, int(np.arccosh(params.spread) / reach)))
    first = e / (top - c)
    sigma, old, new = first, q, (z - c * q) * (first / e)
    for _ in range(degree - 1):
        then = 1 / (2 / first - sigma)
        old, new, sigma = new, (times(new) - c * new) * (2 * then / e) - old * (sigma * then), then
    return new


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of (id, x): a row for each component.

    deviation is the exact sum over dimensions of (n * x - sum)^2, null where 64 bits can't hold it.
    """
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, whole, rest, k = model.n, model.whole, model.rest, len(model.values)
        w = model.vectors / np.sqrt(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _matrix(part.column(1), len(whole))
                m = len(x)
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)),
                        pa.array(deviations(x - whole, rest, n), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array((((x - whole) - rest / n) @ w).ravel()),
                        pa.array(np.tile(model.values / model.trace, m)),
                        pa.array(np.full(m * k, model.identity_error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("id", "x").mapInArrow(run, schema)


def deviations(off: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """Sums over dimensions of (n * off - rest)^2."""
    about = ((n * off.astype(float) - rest) ** 2).sum(1)
    small = about < 2.0**62
    out: list[int | None] = [None] * len(off)
    exact = ((n * np.where(small[:, None], off, 0) - rest) ** 2).sum(1).tolist()
    for i, fits in enumerate(small.tolist()):
        if fits:
            out[i] = exact[i]
        elif about[i] < 2.0**64:
            whole = sum((n * int(a) - int(b)) ** 2 for a, b in zip(off[i], rest, strict=True))
            out[i] = whole if whole < 1 << 63 else None
    return out


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", params: WhiteningParams = WhiteningParams()) -> DataFrame:
    """One row per row that takes part and component: id_col and `whiten`'s columns; components count from 1 by falling eigenvalue.

    Vectors that are null or empty, or that hold a null, a non-finite entry or one beyond 62 bits, take no part; nor do
    those of another length than the commonest. Copies count once in the fit and have rows of their own in the result,
    as rows with null ids have. Equal eigenvalues leave their directions free within their space. Directions without
    variance have no rows, so a single vector, like an empty table, gives none. Other columns are ignored.
    """
    used = points(rows, id_col, vector_col, params)
    model = fit(staged(used.select("x").distinct(), "fit-list"), params)
    return whiten(used, model).withColumnRenamed("id", id_col)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
