"""Approximate nearest neighbours by a hash-prefix forest.

A tree gives each vector a long string of symbols. A symbol names the nearest of several random directions and their
opposites: 1,024 for the first, 16 for each of the eleven after it. The tree is the sorted array of its strings. A query
descends every tree to its longest matching prefix. Then all trees ascend together, symbol by symbol and within a symbol
tree by tree, and stop as soon as their ranges hold as many different candidates as asked for: vectors that several trees
meet count once, so that near copies, which all trees meet, never end the ascent early. Only the candidates are scored,
exactly and in double precision.

The index is cut into shards by a hash of the vector. A vector lies in one shard and is never copied; queries stream
past the shards, each task holding one shard and one block of queries. How many candidates a query meets grows slower
than the index: with vectors ** 0.75 by default.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.session import staged


@dataclass(frozen=True)
class ForestParams:
    k: int = 20
    trees: int = 320
    directions: tuple[int, ...] = (512, *(8,) * 11)  #: by symbol; a symbol is a direction or its opposite
    rate: float = 1.4  #: a query meets rate * n ** (1 - shrink) of n vectors, each counted once
    shrink: float = 0.25
    least: int = 250  #: different candidates that a query meets in any case, if there are so many
    shard_rows: int = 16384
    block_rows: int = 512  #: queries held at once
    seed: int = 3

    def need(self, held: int, n: int) -> int:
        """Different candidates to ask of a shard that holds `held` of `n` vectors."""
        share = max(self.rate * max(1, n) ** -self.shrink, self.least / max(1, n))
        return min(held, max(2 * self.k, int(np.ceil(share * held))))


class Forest:
    """Sorted hash strings of a shard's different vectors."""

    def __init__(self, vectors: np.ndarray, params: ForestParams):
        self.params, self.n = params, len(vectors)
        scaled = vectors / np.abs(vectors).max()
        norms = np.linalg.norm(scaled, axis=1)
        top = norms.max()
        # one more component makes all norms equal, so that the largest inner product is the smallest angle
        spare = np.sqrt(np.maximum(0, 1 - (norms / top) ** 2))
        self.order, self.keys = [], []
        for codes in self.codes(np.column_stack([scaled / top, spare])):
            order = np.argsort(codes, kind="stable").astype(np.int32)
            self.order.append(order)
            self.keys.append(codes[order])
        self.sizes = [2 * m for m in params.directions]
        self.flat = np.concatenate(self.order)

    def codes(self, points: np.ndarray) -> Iterator[np.ndarray]:
        """Tree by tree the strings of all points, a number each, first symbol foremost."""
        points, d = points.astype(np.float32), points.shape[1]
        rotation = np.linalg.qr(np.random.default_rng(self.params.seed).normal(size=(d, d)))[0].astype(np.float32)
        signs = np.array([-1, 1], np.float32)
        for t in range(self.params.trees):
            rng = np.random.default_rng((self.params.seed, t))
            code = np.zeros(len(points), np.int64)
            for m in self.params.directions:
                # orthogonal directions tell vectors apart better than independent ones: one rotation, its axes dealt anew
                turns = [rotation[rng.permutation(d)] * rng.choice(signs, size=(d, 1)) for _ in range(-(-m // d))]
                at = points @ np.concatenate(turns, axis=1)[:, :m]
                own = np.abs(at).argmax(axis=1)
                code = code * (2 * m) + 2 * own + (np.take_along_axis(at, own[:, None], 1)[:, 0] < 0)
            yield code

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """trees x levels x queries: the ranges that share all symbols with a query, all but the last, ..., none."""
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
        scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
        low = np.empty((len(self.keys), len(self.sizes) + 1, len(queries)), np.int32)
        high = np.empty_like(low)
        for t, (keys, code) in enumerate(zip(self.keys, self.codes(np.column_stack([scaled, np.zeros(len(scaled))])), strict=True)):
            span = 1
            for level, size in enumerate([*self.sizes[::-1], None]):
                if size is None:  # the root: no symbol need match
                    low[t, level], high[t, level] = 0, self.n
                    break
                first = code // span * span
                low[t, level], high[t, level] = np.searchsorted(keys, first), np.searchsorted(keys, first + span)
                span *= size
        return low, high

    def candidates(self, queries: np.ndarray, need: int) -> Iterator[np.ndarray]:
        """For each query the different vectors that it meets: `need` of them at least, all if there are fewer."""
        low, high = self.ranges(queries)
        trees, levels, _ = low.shape
        totals = (high - low).sum(axis=0, dtype=np.int64)
        first = np.empty(self.n, np.int64)  # where a query's sequence has a vector first; only what was written is read
        for q in range(len(queries)):
            # ranges of one level hold no more different vectors than rows
            for level in range(int(np.argmax(totals[:, q] >= need)), levels):
                if level == levels - 1:
                    yield np.arange(self.n)
                    break
                whole = self._gathered(low[:, level, q], high[:, level, q])
                under = self._gathered(low[:, level - 1, q], high[:, level - 1, q]) if level else whole[:0]
                met = np.concatenate([under, whole])  # what a level up adds comes after, tree by tree
                at = np.arange(len(met))
                first[met[::-1]] = at[::-1]
                new = first[met] == at
                count = np.cumsum(new)
                if count[-1] >= need:
                    last = max(int(np.searchsorted(count, need)) - len(under), 0)
                    ends = np.cumsum(high[:, level, q] - low[:, level, q])
                    end = len(under) + int(ends[np.searchsorted(ends, last, "right")])  # the tree is ascended in full
                    yield np.sort(met[:end][new[:end]])
                    break

    def _gathered(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The vectors of a range of each tree, tree by tree."""
        size = (high - low).astype(np.int64)
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(low - (ends - size) + np.arange(len(low)) * self.n, size)
        return self.flat[at]


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that hold one shard and one kind of row each."""
    for b in batches:
        tag = np.asarray(b.column("part")) * 2 + np.asarray(b.column("kind"))
        cuts = [0, *(np.flatnonzero(np.diff(tag)) + 1).tolist(), len(tag)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            if y > x:
                yield b.slice(x, y - x)


def _matrix(tables: list[pa.RecordBatch]) -> np.ndarray:
    flat = [np.asarray(t.column("vec").flatten()) for t in tables]
    return np.concatenate(flat).reshape(sum(t.num_rows for t in tables), -1)


def _column(tables: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([np.asarray(t.column(name)) for t in tables])


class _Shard:
    def __init__(self, tables: list[pa.RecordBatch], params: ForestParams):
        self.params = params
        self.vectors = _matrix(tables)
        self.ids = np.concatenate([np.asarray(t.column("ids").flatten()) for t in tables])
        counts = np.concatenate([np.diff(np.asarray(t.column("ids").offsets)) for t in tables])
        self.start = np.concatenate([[0], np.cumsum(counts)])
        self.need = params.need(len(self.vectors), int(tables[0].column("n")[0].as_py()))
        self.forest = Forest(self.vectors, params)

    def search(self, block: list[pa.RecordBatch], keep: int) -> pa.RecordBatch:
        queries, q, h = _matrix(block), _column(block, "id"), _column(block, "h")
        out: list[tuple] = []
        for i, own in enumerate(self.forest.candidates(queries, self.need)):
            score = (self.vectors[own] * queries[i]).sum(axis=1)
            rank = np.where(np.isnan(score), -np.inf, score)
            if len(own) > keep:
                fit = rank >= np.partition(rank, len(rank) - keep)[len(rank) - keep]
                own, score, rank = own[fit], score[fit], rank[fit]
            many = self.start[own + 1] - self.start[own]
            ids = np.concatenate([self.ids[self.start[v] : self.start[v + 1]] for v in own])
            best = np.lexsort((ids, -np.repeat(rank, many)))[:keep]
            out.append((np.full(len(best), q[i]), np.full(len(best), h[i]), ids[best], np.repeat(score, many)[best], np.full(len(best), len(rank), np.int64)))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols[:4]], names=["q", "h", "vec_id", "score"])


def _searcher(params: ForestParams, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, held, block = None, None, [], []

        def flush():
            nonlocal block, shard, held
            if block:
                if shard is None:
                    shard, held = _Shard(held, params), []
                yield shard.search(block, keep)
            block = []

        for b in _streams(batches):
            if b.column("part")[0].as_py() != part:
                yield from flush()
                part, shard, held = b.column("part")[0].as_py(), None, []
            if b.column("kind")[0].as_py() == 0:
                held.append(b)
            elif held or shard is not None:
                block.append(b)
                if sum(x.num_rows for x in block) >= params.block_rows:
                    yield from flush()
        yield from flush()

    return run


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", params: ForestParams = ForestParams()) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k nearest by inner product, ties to smaller ids.

    Rows with a null id or vector, a zero vector, or null or non-finite components take no part. Vectors meet those of
    their own length. Rows with the query's own id are no candidates; equal vectors share one place in the trees and all
    count. Rows that repeat an id and a vector count once; where one id has several vectors, the best of them counts, for
    a candidate as for a query, and a query lists an id once. A product that overflows is infinite as it is in double
    precision; one that is no number comes last. Extra columns are ignored; no queries, or no vectors, give no rows.
    """
    x = F.col(vec_col).cast("array<double>")

    def clean(df: DataFrame) -> DataFrame:
        own = df.select(F.col(id_col).cast("long").alias("id"), x.alias("vec"))
        fine = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
        return own.where(F.col("id").isNotNull() & fine)

    # of equal vectors the k + 1 smallest ids can be among the k nearest of a query: one of them may be its own
    # a much repeated vector's ids are ranked by parts first
    own = clean(vectors).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(256)))
    for by in (Window.partitionBy("vec", "part").orderBy("id"), Window.partitionBy("vec").orderBy("id")):
        own = own.withColumn("nth", F.dense_rank().over(by)).where(F.col("nth") <= params.k + 1)
    least = own.select("vec", "id")
    base = staged(least.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids")), "vectors")
    asked = clean(queries)
    firsts = asked.groupBy("vec").agg(F.min("id").alias("id"))  # equal queries are asked once

    most = base.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    keep = (params.k + 1) * most  # as many rows hold k + 1 different ids
    lengths = base.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect()
    rows, total = [], 0
    for r in lengths:
        shards = -(-r["n"] // params.shard_rows)
        rows.append((r["d"], r["n"], shards, total))
        total += shards
    plan = F.broadcast(vectors.sparkSession.createDataFrame(rows, "d int, n long, shards int, first int"))  # one row for each length

    hashed = F.xxhash64("vec")
    left = base.join(plan, F.size("vec") == F.col("d")).select((F.col("first") + F.pmod(hashed, F.col("shards")).cast("int")).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("h"), "vec", "ids", "n")
    right = firsts.join(plan, F.size("vec") == F.col("d")).select(F.explode(F.sequence(F.col("first"), F.col("first") + F.col("shards") - 1)).alias("part"), F.lit(1).alias("kind"), "id", hashed.alias("h"), "vec", F.lit(None).cast("array<long>").alias("ids"), "n")
    dealt = left.union(right).repartitionById(max(1, total), "part").sortWithinPartitions("part", "kind")
    found = dealt.mapInArrow(_searcher(params, keep), "q long, h long, vec_id long, score double")

    worth = F.nanvl("score", F.lit(float("-inf")))
    best = Window.partitionBy("q", "h").orderBy(worth.desc(), "vec_id")
    top = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= keep).drop("nth")
    members = asked.join(firsts.withColumnRenamed("id", "q"), "vec").select("q", hashed.alias("h"), F.col("id").alias("query_id")).distinct()
    pairs = top.join(members, ["q", "h"]).where("vec_id <> query_id")
    once = pairs.groupBy("query_id", "vec_id").agg(F.max_by("score", worth).alias("score"))
    order = Window.partitionBy("query_id").orderBy(worth.desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k).select("query_id", "rank", "vec_id", "score")


def op4_nearest(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
