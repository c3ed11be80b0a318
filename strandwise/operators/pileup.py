"""Base counts of every place from aligned reads, tile by tile."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.genomics import cigar_span

COUNTS = ("a", "c", "g", "t", "n", "deleted", "skipped")


@dataclass(frozen=True)
class PileupParams:
    tile: int = 4096  #: places in a tile
    min_qual: int = 13  #: of a base; of a gap's next base
    held: int = 1 << 20  #: bases that are counted at once


@lru_cache(maxsize=4096)
def blocks(cigar: str) -> tuple[tuple[str, int, int, int], ...]:
    """(op, first reference place, first query place, length) of the parts of a CIGAR that cover the reference, from 0."""
    out, r, q = [], 0, 0
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        n = int(n)
        if op in "MDN=X" and n:
            out.append(("M" if op in "=X" else op, r, q, n))
            r += n
        if op in "MIS=X":
            q += n
    return tuple(out)


_CODES = np.full(256, 4, np.uint8)
for _i, _b in enumerate("ACGT"):
    _CODES[[ord(_b), ord(_b.lower())]] = _i


class _Texts:
    """Sequences or qualities of a batch's reads, a byte for each character; null, empty and * are not given."""

    def __init__(self, texts: pa.Array):
        raw = _single_bytes(texts)
        ends = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + raw.offset + 1)[raw.offset :].astype(np.int64)
        self.data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
        self.start, self.size = ends[:-1], np.diff(ends)
        star = np.zeros(len(raw), bool)
        one = np.flatnonzero(self.size == 1)
        star[one] = self.data[self.start[one]] == ord("*")
        self.given = (self.size > 0) & ~star
        self.size = np.where(self.given, self.size, 0)

    def of(self, own: np.ndarray, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(reads x n) bytes from `first` on, and which of them are there."""
        at = first + np.arange(n)
        there = at[None, :] < self.size[own, None]
        if not len(self.data):
            return np.zeros(there.shape, np.uint8), there
        return self.data[np.where(there, self.start[own, None] + at, 0)], there


def _single_bytes(texts: pa.Array) -> pa.Array:
    """Texts as bytes; those with other characters than ASCII by latin-1, with ? for what that lacks, so that a character is a byte."""
    texts = pc.fill_null(texts, "")
    if pc.all(pc.string_is_ascii(texts)).as_py() is not False:
        return texts.cast(pa.binary())
    return pa.array([x.encode("latin-1", "replace") for x in texts.to_pylist()], pa.binary())


class _Tile:
    """Counts of one tile, from the reads of a partition that touch it."""

    def __init__(self, first: int, p: PileupParams):
        self.first, self.p = first, p
        self.counts = np.zeros((5, p.tile), np.int64)
        self.steps = np.zeros((2, p.tile + 1), np.int64)  # where gaps and skips begin and end

    def add(self, pos: np.ndarray, cigars: pa.Array, seqs: _Texts, quals: _Texts) -> None:
        """Counts reads, those of one CIGAR at once."""
        kinds = cigars.dictionary_encode()
        kind = kinds.indices.to_numpy()
        order = np.argsort(kind, kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=len(kinds.dictionary)))
        for k, cigar in enumerate(kinds.dictionary.to_pylist()):
            own = order[ends[k - 1] if k else 0 : ends[k]]
            for op, r, q, n in blocks(cigar):
                for low in range(0, n, self.p.tile):
                    width = min(n - low, self.p.tile)
                    some = max(1, self.p.held // width)
                    for at in range(0, len(own), some):
                        self._block(own[at : at + some], op, pos, r + low, q + low if op == "M" else q, width, r, n, low, seqs, quals)

    def _block(self, own: np.ndarray, op: str, pos: np.ndarray, r: int, q: int, n: int, whole_r: int, whole_n: int, low: int, seqs: _Texts, quals: _Texts) -> None:
        tile, least = self.p.tile, 33 + self.p.min_qual
        if op != "M":
            if low:
                return  # a gap is taken whole
            lows = np.maximum(0, pos[own] + whole_r - self.first)
            highs = np.minimum(tile, pos[own] + whole_r + whole_n - self.first)
            qual, there = quals.of(own, q, 1)
            keep = (lows < highs) & (~quals.given[own] | (there & (qual >= least))[:, 0])
            steps = self.steps[int(op == "N")]
            steps += np.bincount(lows[keep], minlength=tile + 1) - np.bincount(highs[keep], minlength=tile + 1)
            return
        places = (pos[own] + r - self.first)[:, None] + np.arange(n)
        keep = (places >= 0) & (places < tile)
        if not keep.any():
            return
        base, there = seqs.of(own, q, n)
        qual, good = quals.of(own, q, n)
        keep &= there | ~seqs.given[own, None]
        keep &= (good & (qual >= least)) | ~quals.given[own, None]
        codes = np.where(there, _CODES[base], 4)[keep].astype(np.int64)
        self.counts += np.bincount(codes * tile + places[keep], minlength=5 * tile).reshape(5, tile)

    def all(self) -> np.ndarray:
        return np.concatenate([self.counts, np.cumsum(self.steps, 1)[:, :-1]])


def _runs(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[int, int]]:
    """(first row, number) of the runs of rows whose first `keys` columns are alike."""
    n = batch.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for c in batch.columns[:keys]:
        ids = c.dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= ids[1:] != ids[:-1]
    first = np.flatnonzero(new)
    return zip(first.tolist(), np.diff(np.append(first, n)).tolist(), strict=True)


def dense_pileup(reads: DataFrame, axis: DataFrame, keys: Sequence[str] = (), p: PileupParams = PileupParams()) -> DataFrame:
    """(keys, contig, pos, a, c, g, t, n, deleted, skipped, depth) for every place of `axis` (keys, contig, length).

    `reads` are (keys, rname, pos, cigar, seq, qual). Bases under `min_qual` don't count; gaps and skips count by the base
    after them. A read without qualities counts in full, one without bases as n; depth is the sum of all. Reads without a
    place or CIGAR and what lies outside of the axis are left out; null keys are a group of their own.

    A read is dealt to each tile that it touches. Tiles lie in ranges of (keys, contig, tile, hash of the read), so one
    with very many reads spreads over several tasks, and a task holds the counts of one tile. A tile's counts from all
    tasks are added in its one task, which also fills the tiles that no read touches.
    """
    tile = p.tile
    spots = [*keys, "contig", "_tile"]
    own = reads.where(F.col("pos").isNotNull() & F.col("cigar").isNotNull() & (F.col("cigar") != "*"))
    last = F.col("pos") + F.greatest(cigar_span(F.col("cigar")), F.lit(1)) - 1
    number = lambda c: F.floor((c - 1) / tile).cast("bigint")
    dealt = own.where(last >= 1).select(
        *keys, F.col("rname").alias("contig"), F.explode(F.sequence(F.greatest(number(F.col("pos")), F.lit(0).cast("bigint")), number(last))).alias("_tile"),
        F.col("pos").cast("bigint").alias("pos"), "cigar", "seq", "qual",
    )
    dealt = dealt.repartitionByRange(*spots, F.xxhash64("pos", "cigar", "seq", "qual")).sortWithinPartitions(*spots)
    k = len(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, spot, kinds = None, None, None
        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(k + 2)]
            done = []
            for first, size in _runs(batch, k + 2):
                part = batch.slice(first, size)
                at = [c[0].as_py() for c in part.columns[: k + 2]]
                if at != spot:
                    if now is not None:
                        done.append((spot, now.all()))
                    spot, now = at, _Tile(at[-1] * tile + 1, p)
                pos, cigars, seqs, quals = part.columns[k + 2 :]
                now.add(pos.to_numpy(), cigars, _Texts(seqs), _Texts(quals))
                if len(done) == 64:
                    yield rows(done, kinds)
                    done = []
            if done:
                yield rows(done, kinds)
        if now is not None:
            yield rows([(spot, now.all())], kinds)

    def rows(done: list, kinds: list) -> pa.RecordBatch:
        cols = [pa.array([s[i] for s, _ in done], t) for i, t in enumerate(kinds)]
        return pa.record_batch([*cols, pa.array([x.astype("<i8").tobytes() for _, x in done], pa.binary()), pa.array([None] * len(done), pa.int64())], names=[*spots, "counts", "length"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.select(*keys, "contig").schema)
    part = dealt.mapInArrow(count, f"{head}, _tile long, counts binary, length long")
    whole = axis.where("length > 0").select(*keys, "contig", F.explode(F.sequence(F.lit(0).cast("bigint"), number(F.col("length")))).alias("_tile"), F.lit(None).cast("binary").alias("counts"), F.col("length").cast("bigint").alias("length"))
    met = part.unionByName(whole).repartition(*spots).sortWithinPartitions(*spots)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, total, length, kinds = None, None, None, None
        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(k + 1)]
            for *at, counts, own_length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != spot:
                    if length is not None:
                        yield dense(spot, total, length, kinds)
                    spot, total, length = at, np.zeros((len(COUNTS), tile), np.int64), None
                length = own_length if own_length is not None else length
                if counts is not None:
                    total += np.frombuffer(counts, "<i8").reshape(len(COUNTS), tile)
        if length is not None:
            yield dense(spot, total, length, kinds)

    def dense(spot: list, total: np.ndarray, length: int, kinds: list) -> pa.RecordBatch:
        first = spot[-1] * tile + 1
        n = min(tile, length - first + 1)
        cols = [pa.array([x] * n, t) for x, t in zip(spot[:-1], kinds, strict=True)]
        return pa.record_batch([*cols, pa.array(np.arange(first, first + n)), *[pa.array(c[:n]) for c in total], pa.array(total[:, :n].sum(0))], names=[*keys, "contig", "pos", *COUNTS, "depth"])

    return met.mapInArrow(fill, f"{head}, pos long, " + ", ".join(f"{c} long" for c in COUNTS) + ", depth long")
