"""Quality scores by Bradley-Terry pairwise ranking.

Each pair of a good and a bad labelled document says that the first is to be preferred. The model holds that it is
with probability sigmoid(s1 - s2), where s is a linear function of the text's features, and is fitted by logistic loss
on the feature differences of pairs. Features are hashed byte pairs and shares of byte classes, over the whole text and
in its worst window. All labelled rows are learnt from: they are dealt to blocks, each block fits weights to pairs in
which every row of it stands, and the model has the mean of the blocks' weights (parameter mixing). The cut is a quantile
of the scores of all labelled rows: that of the share of bad labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.language import fold
from strandwise.operators.ordered import exact_quantiles, in_blocks, running_all
from strandwise.session import staged

#: Byte classes: every ASCII mark is one of its own, and small letters, capitals, digits, blanks, line ends, controls, the rest.
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 0 if _b >= 128 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c in " \t" else 5 if _c in "\r\n" else 6 if _b < 32 or _b == 127 else 0
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_MARKS] = 7 + np.arange(len(_MARKS))
CLASSES = 7 + len(_MARKS)
BUCKETS = 512  #: of hashed byte pairs
_PAIR = (np.arange(1 << 16, dtype=np.uint32) * np.uint32(2654435761) >> np.uint32(23)).astype(np.int64)
FEATURES = BUCKETS + 2 * CLASSES + 5
WINDOW, CHUNK = 128, 1 << 18
DIGITS, ROUNDING = 9, 1e-9  #: of raw scores that are told apart; of shares


@dataclass(frozen=True)
class QualityParams:
    block_docs: int = 6000  #: labelled rows of a block, about
    least_docs: int = 500  #: rows of the rarer label that a block gets; if there are too few, they are dealt to several blocks
    pairs: int = 40000  #: of a block, but as many as it takes for each row to stand in one
    steps: int = 400
    rate: float = 0.02
    ridge: float = 1e-3
    cut_score: float = 0.3  #: where the quantile cut comes to lie on the scale from 0 to 1
    seed: int = 9
    broadcast_rows: int = 1 << 21  #: labels are broadcast up to so many and joined by sorting beyond


def features(body: bytes) -> np.ndarray:
    """Of a whole text: roots of the shares of hashed byte pairs and byte classes, each class's largest share in any
    window of 128 bytes, and its length, words and repeated lines. All zero for an empty one."""
    out = np.zeros(FEATURES)
    if not body:
        return out
    data = np.frombuffer(body, np.uint8)
    pairs, whole, most = np.zeros(BUCKETS), np.zeros(CLASSES), np.zeros(CLASSES)
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK + 1].astype(np.int64)
        pairs += np.bincount(_PAIR[part[:-1] << 8 | part[1:]], minlength=BUCKETS)
        own = _CLASS[part[:CHUNK]]
        n = -(-len(own) // WINDOW)
        held = np.bincount(np.arange(len(own)) // WINDOW * CLASSES + own, minlength=n * CLASSES).reshape(n, CLASSES)
        whole += held.sum(axis=0)
        most = np.maximum(most, held.max(axis=0))
    lines = [x for x in body.split(b"\n") if x.strip()]
    words = body.split()
    out[:BUCKETS] = np.sqrt(pairs / max(1, len(data) - 1))
    out[BUCKETS : BUCKETS + CLASSES] = np.sqrt(whole / len(data))
    out[BUCKETS + CLASSES : -5] = np.sqrt(most / WINDOW)
    out[-5:] = [1.0, np.log1p(len(words)) / 10, len(body) / (len(words) or 1) / 20, len(set(words)) / (len(words) or 1), 1 - len(set(lines)) / (len(lines) or 1)]
    return out


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float  #: raw score at the quantile
    spread: float
    cut_score: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the quantile cut lies at cut_score."""
        z = (self.raw(x) - self.cut) / self.spread + np.log(self.cut_score / (1 - self.cut_score))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _turns(rng: np.random.Generator, own: np.ndarray, n: int) -> np.ndarray:
    """`n` of `own`, each one as often as any other, or once more."""
    return np.concatenate([rng.permutation(own) for _ in range(-(-n // len(own)))])[:n]


def weigh(z: np.ndarray, y: np.ndarray, params: QualityParams) -> np.ndarray:
    """Weights of one block, which has both labels."""
    rng = np.random.default_rng(params.seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = max(params.pairs, len(good), len(bad))
    first, second = _turns(rng, good, n), _turns(rng, bad, n)
    w, m1, m2 = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES)
    for step in range(1, params.steps + 1):
        s = z @ w
        p = 1 / (1 + np.exp(np.clip(s[first] - s[second], -30, 30)))
        # the gradient on feature differences, added up by document
        g = -(np.bincount(first, p, len(z)) - np.bincount(second, p, len(z))) @ z / n + params.ridge * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w = w - params.rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-9)
    return w


def _scale(deviation: np.ndarray) -> np.ndarray:
    return np.where(deviation > 1e-9, deviation, 1.0)


def _of_one_kind(mean: np.ndarray, scale: np.ndarray, good: bool, params: QualityParams) -> Ranking:
    return Ranking(mean, scale, np.zeros(FEATURES), 0.0 if good else 1e9, 1.0, params.cut_score)


def fit(x: np.ndarray, y: np.ndarray, bad_share: float, params: QualityParams = QualityParams()) -> Ranking:
    """The ranking of a single block. With labels of one kind only, all texts get the score that says so."""
    mean, scale = (x.mean(axis=0), _scale(x.std(axis=0))) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    z = (x - mean) / scale
    good, bad = y == 1, y == 0
    if not good.any() or not bad.any():
        return _of_one_kind(mean, scale, good.any(), params)
    w = weigh(z, y, params)
    raw = np.round(z @ w, DIGITS)
    values, at = np.unique(raw, return_inverse=True)
    # the known rows' labels weigh as much as all labels do
    below = np.cumsum(np.bincount(at, good)) * (1 - bad_share) / good.sum() + np.cumsum(np.bincount(at, bad)) * bad_share / bad.sum()
    k = int(np.flatnonzero(below >= bad_share - ROUNDING)[0])
    cut = (values[k] + values[min(k + 1, len(values) - 1)]) / 2
    return Ranking(mean, scale, w, float(cut), _spread(np.median(raw[good]), np.median(raw[bad])), params.cut_score)


def _spread(good: float, bad: float) -> float:
    return max(1e-6, float(good - bad) / 8)


def _table(bodies: pa.Array) -> np.ndarray:
    return np.array([features((t.as_py() or "").encode("utf-8", "replace")) for t in bodies]).reshape(-1, FEATURES)


def _stacked(x: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, means and squared deviations of a task's rows."""
    n, mean, squares = 0, np.zeros(FEATURES), np.zeros(FEATURES)
    for batch in batches:
        if batch.num_rows:
            x = _stacked(batch.column("x"))
            own = x.mean(axis=0)
            n, mean, squares = _together((n, mean, squares), (len(x), own, ((x - own) ** 2).sum(axis=0)))
    if n:
        yield pa.record_batch([pa.array([n]), pa.array([mean.tobytes()]), pa.array([squares.tobytes()])], names=["n", "mean", "squares"])


def _together(a: tuple[int, np.ndarray, np.ndarray], b: tuple[int, np.ndarray, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + step**2 * (a[0] * b[0] / n)


def _dealt(rows: DataFrame, counts: dict[int, int], params: QualityParams) -> DataFrame:
    """`rows` with their block. Few rows of a label are dealt to several blocks each, so that no block is without both."""
    blocks = max(1, round(sum(counts.values()) / params.block_docs))
    copies = F.lit(1)
    for y, n in counts.items():
        copies = F.when(F.col("_y") == y, F.lit(min(blocks, max(1, -(-params.least_docs * blocks // n))))).otherwise(copies)
    turns = F.explode(F.sequence(F.lit(0), copies - 1))
    return rows.select("_y", "x", F.pmod(F.xxhash64("_id", F.lit(params.seed)), F.lit(blocks)).alias("_first"), turns.alias("_turn")).select("_y", "x", ((F.col("_first") + F.col("_turn")) % blocks).alias("_block"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", params: QualityParams = QualityParams()) -> Ranking:
    """A ranking from all rows of `labels` that are 0 or 1.

    Labels without a document and documents without a label play no part; an id with both labels counts as each. Of
    documents that share an id one is learnt from. Null and empty texts have no features. Ties are ties; other columns may
    have any names. No labels, or one kind only: see `fit`; up to one and a half blocks give the same as `fit`.

    Labels come to the texts, which lie where they are; what is shuffled are features of labelled rows, which are written
    once. Their moments and their scores' quantiles are those of all rows; a task of the fit holds one block. What reaches
    the driver is a row for each task and for each block.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return fit(np.empty((0, FEATURES)), np.empty(0), 0.0, params)
    given = known.distinct()
    bodies = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_body"))
    bodies = bodies.join(F.broadcast(given) if total <= params.broadcast_rows else given, "_id").select("_id", "_y", F.xxhash64("_body").alias("_hash"), "_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [v.tobytes() for v in _table(batch.column("_body")).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_y", "_hash")), pa.array(x, pa.binary())], names=["_id", "_y", "_hash", "x"])

    found = bodies.mapInArrow(run, f"_id {bodies.schema['_id'].dataType.simpleString()}, _y int, _hash long, x binary")
    rows = staged(found.groupBy("_id", "_y").agg(F.min_by("x", "_hash").alias("x")), "labelled-features")

    parts = [(r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["squares"])) for r in rows.select("x").mapInArrow(_moments, "n long, mean binary, squares binary").collect()]
    if not parts:
        return fit(np.empty((0, FEATURES)), np.empty(0), 0.0, params)
    n, mean, squares = parts[0]
    for part in parts[1:]:
        n, mean, squares = _together((n, mean, squares), part)
    scale = _scale(np.sqrt(squares / n))
    held = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(held) < 2:
        return _of_one_kind(mean, scale, 1 in held, params)

    def weighed(table: pa.Table) -> pa.Table:
        # in an order of their own, so that the same rows always give the same pairs
        own = pa.table(table.select(["x", "_y"])).sort_by([("x", "ascending"), ("_y", "ascending")])
        y = own["_y"].to_numpy()
        if y.min() == y.max():
            return pa.table({"n": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "w": pa.array([], pa.binary())})
        w = weigh((_stacked(own["x"]) - mean) / scale, y, params)
        return pa.table({"n": [len(y)], "block": [table["_block"][0].as_py()], "w": [w.tobytes()]})

    fitted = sorted((r["block"], r["n"], bytes(r["w"])) for r in _dealt(rows, held, params).groupBy("_block").applyInArrow(weighed, "n long, block long, w binary").collect())
    w = np.average([np.frombuffer(v) for _, _, v in fitted], axis=0, weights=[n for _, n, _ in fitted])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = (_stacked(batch.column("x")) - mean) / scale @ w
            yield pa.RecordBatch.from_arrays([batch.column("_y"), pa.array(np.round(raw, DIGITS) + 0.0)], names=["_y", "raw"])

    scores = staged(rows.select("_y", "x").mapInArrow(scored, "_y int, raw double"), "labelled-scores")
    bad_share = counts.get(0, 0) / total
    values = scores.groupBy("raw").agg(F.count_if(F.col("_y") == 1).alias("good"), F.count_if(F.col("_y") == 0).alias("bad"))
    sums = running_all(in_blocks(values, [], ["raw"]), [], ["raw"], {"goods": ("good", "sum"), "bads": ("bad", "sum")})
    enough = F.col("goods") * (1 - bad_share) / held[1] + F.col("bads") * bad_share / held[0] >= bad_share - ROUNDING
    low = [r["raw"] for r in sums.where(enough).orderBy("raw").limit(2).collect()]
    medians = {r["_y"]: r["middle"] for r in exact_quantiles(scores, ["_y"], "raw", {"middle": 0.5}).collect()}
    return Ranking(mean, scale, w, (low[0] + low[-1]) / 2, _spread(medians[1], medians[0]), params.cut_score)


def rate(docs: DataFrame, ranking: Ranking, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns of `docs` with score and predicted. Null text counts as empty; every row gets a score, repeated rows
    and equal texts the same one. Columns not in `keep` are ignored; no rows give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = ranking(_table(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(s, pa.float64()), pa.array((s >= ranking.cut_score).astype(np.int32))], names=[*keep, "score", "predicted"]
            )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, f"{kinds}, score double, predicted int")


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 5) != 0)
    held = docs.withColumn("held_out", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)))
    return rate(held, learn(docs, labels), ["doc_id", "held_out"])
