"""Distances of aligned sequences by bit planes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.session import staged


@dataclass(frozen=True)
class DistanceParams:
    tile: int = 1 << 15  #: positions of a plane
    block: int = 64  #: samples that meet others together


_CODES = np.zeros(256, np.uint8)
for _i, _b in enumerate("ACGT"):
    _CODES[[ord(_b), ord(_b.lower())]] = _i + 1


def packed(codes: np.ndarray) -> bytes:
    """Four planes of a tile: where A, C, G and T are."""
    return b"".join(np.packbits(codes == k).tobytes() for k in (1, 2, 3, 4))


def planes_of_sequences(seqs: DataFrame, group: Sequence[str] = (), p: DistanceParams = DistanceParams()) -> DataFrame:
    """(group, sample, tile, planes) of (group, sample, seq); other signs than A, C, G and T are no call."""
    n = F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / p.tile).cast("int")))
    parts = seqs.where(F.length("seq") > 0).select(*group, "sample", n.alias("tile"), "seq").select(*group, "sample", "tile", F.substring(F.col("seq"), F.col("tile") * p.tile + 1, F.lit(p.tile)).alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                codes = np.zeros(p.tile, np.uint8)
                codes[: len(text)] = _CODES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
                out.append(packed(codes))
            yield pa.record_batch([*batch.columns[:-1], pa.array(out, pa.binary())], names=[*batch.schema.names[:-1], "planes"])

    return parts.mapInArrow(run, _head(parts, [*group, "sample", "tile"]) + ", planes binary")


def planes_of_bases(bases: DataFrame, group: Sequence[str] = (), p: DistanceParams = DistanceParams()) -> DataFrame:
    """The same of (group, sample, pos, base), pos from 0; of several bases of a sample at a place the greatest counts."""
    own = bases.where(F.upper("base").isin("A", "C", "G", "T") & (F.col("pos") >= 0)).select(*group, "sample", F.floor(F.col("pos") / p.tile).cast("int").alias("tile"), F.struct((F.col("pos") % p.tile).cast("int").alias("at"), F.instr(F.lit("ACGT"), F.upper("base")).alias("code")).alias("x"))
    parts = own.groupBy(*group, "sample", "tile").agg(F.sort_array(F.collect_set("x")).alias("x"))  # four times `tile` at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(batch.num_columns - 1):
                codes = np.zeros(p.tile, np.uint8)
                codes[x.values.field("at").to_numpy()] = x.values.field("code").to_numpy()
                out.append(packed(codes))
            yield pa.record_batch([*batch.columns[:-1], pa.array(out, pa.binary())], names=[*batch.schema.names[:-1], "planes"])

    return parts.mapInArrow(run, _head(parts, [*group, "sample", "tile"]) + ", planes binary")


def _head(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


def plane_distances(planes: DataFrame, group: Sequence[str] = (), p: DistanceParams = DistanceParams()) -> DataFrame:
    """(group, a, b, snps, compared) for each two samples of a group, a before b, that are called together at a variable place.

    A place is variable if two samples of the group call different bases there; `compared` counts those that both call.
    The planes of a tile meet in blocks of `block` samples: a row of the join is a pair of blocks, whose differences are
    exclusive ors and bit counts, and only one row for each two samples and tile is added up. What is shuffled grows with
    samples x tiles, not with positions x samples squared.
    """
    g = list(group)
    own = staged(planes, "planes")

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, total = None, None

        def out() -> pa.RecordBatch:
            return pa.record_batch([*[pa.array([v], t) for v, t in zip(spot, kinds, strict=True)], pa.array([total.tobytes()], pa.binary())], names=[*g, "tile", "any"])

        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(len(g) + 1)]
            for *at, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bits = np.frombuffer(x, np.uint8)
                if at != spot:
                    if spot is not None:
                        yield out()
                    spot, total = at, bits.copy()
                else:
                    total |= bits
        if spot is not None:
            yield out()

    # which bases a tile's samples have: first within each task, then in one
    head = _head(own, [*g, "tile"]) + ", any binary"
    some = own.select(*g, "tile", "planes").sortWithinPartitions(*g, "tile").mapInArrow(united, head)
    union = some.repartition(*g, "tile").sortWithinPartitions(*g, "tile").mapInArrow(united, head)
    # blocks of samples, numbered within the group by a hash of their names
    names = own.select(*g, "sample").distinct()
    sizes = names.groupBy(*g).agg(F.ceil(F.count(F.lit(1)) / p.block).cast("int").alias("blocks"))
    placed = _met(own, sizes, g).withColumn("block", F.pmod(F.xxhash64("sample"), F.col("blocks")).cast("int"))
    rows = placed.groupBy(*g, "tile", "block").agg(F.sort_array(F.collect_list(F.struct("sample", "planes"))).alias("x"))  # some `block` samples
    rows = staged(rows, "blocks")
    other = rows.select(*g, "tile", F.col("block").alias("block_b"), F.col("x").alias("y"))
    pairs = _met(_met(rows, other, [*g, "tile"]).where("block <= block_b"), union, [*g, "tile"])

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.to_dict("records"):
                any_ = np.frombuffer(r["any"], np.uint8).reshape(4, -1)
                # two of the four planes at least
                one = any_[0] | any_[1] | any_[2] | any_[3]
                two = (any_[0] & any_[1]) | (any_[2] & any_[3]) | ((any_[0] | any_[1]) & (any_[2] | any_[3]))
                keep = np.flatnonzero(one & two)
                if not len(keep):
                    continue
                stacks = []
                for side in (r["x"], r["y"]):
                    m = np.stack([np.frombuffer(s["planes"], np.uint8).reshape(4, -1)[:, keep] for s in side]) & two[keep]
                    stacks.append((np.array([s["sample"] for s in side], object), m, m[:, 0] | m[:, 1] | m[:, 2] | m[:, 3]))
                (a, x, called_x), (b, y, called_y) = stacks
                same_block = r["block"] == r["block_b"]
                for i in range(len(a)):
                    j = slice(i + 1, None) if same_block else slice(None)
                    both = np.bitwise_count(called_x[i] & called_y[j]).sum(1, dtype=np.int64)
                    equal = sum(np.bitwise_count(x[i, k] & y[j, k]).sum(1, dtype=np.int64) for k in range(4))
                    hit = both > 0
                    if hit.any():
                        names_b = b[j][hit]
                        swap = names_b < a[i]
                        yield pd.DataFrame({c: [r[c]] * int(hit.sum()) for c in g} | {"a": np.where(swap, names_b, a[i]), "b": np.where(swap, a[i], names_b), "snps": (both - equal)[hit], "compared": both[hit]})

    kind = own.schema["sample"].dataType.simpleString()
    schema = ", ".join([*[_head(own, [c]) for c in g], f"a {kind}, b {kind}, snps long, compared long"])
    parts = pairs.select(*g, "block", "block_b", "x", "y", "any").mapInPandas(count, schema)
    return parts.groupBy(*g, "a", "b").agg(F.sum("snps").alias("snps"), F.sum("compared").alias("compared"))


def _met(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not keys:
        return a.crossJoin(F.broadcast(b))  # one row
    return a.join(b, list(keys))
