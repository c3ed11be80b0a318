"""Shortest length from which each place of an assembly is unique, on both strands."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.operators.variants import NEVER_UNIQUE
from strandwise.session import staged


@dataclass(frozen=True)
class UniqueParams:
    longest: int = 150  #: no longer stretch is looked at
    first: int = 16  #: length of the first test
    piece: int = 1 << 16  #: places of a contig that one row has


_CODES = np.zeros(256, np.uint64)
for _i, _b in enumerate("ACGT"):
    _CODES[ord(_b)] = _i + 1


def _mixed(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """64 bits of an ordered pair of names."""
    odd = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))[lane]
    x = (a ^ (a >> np.uint64(31))) * odd + (b ^ (b >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + odd
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


class Names:
    """128-bit names of a piece's stretches that are alike exactly for stretches alike on either strand.

    Stretches of 2^j letters are named by the names of their halves; any other length by the two stretches of the next
    lesser power of two that cover it. The other strand's names are made in the same way from the end on.
    """

    def __init__(self, text: str):
        codes = _CODES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
        back = np.where(codes > 0, 5 - codes, 0).astype(np.uint64)
        self.levels = [[(_mixed(codes, codes, k), _mixed(back, back, k)) for k in (0, 1)]]
        bad = np.flatnonzero(codes == 0)
        ends = np.append(bad, len(codes))
        self.room = ends[np.searchsorted(ends, np.arange(len(codes)), "left")] - np.arange(len(codes))  # letters up to the next other sign

    def of(self, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two halves of the names, and how often the place itself has the stretch: twice if it is its own reverse complement."""
        while 2 << (len(self.levels) - 1) <= k:
            half = 1 << (len(self.levels) - 1)
            self.levels.append([(_mixed(f[:-half], f[half:], i), _mixed(r[half:], r[:-half], i)) for i, (f, r) in enumerate(self.levels[-1])])
        level = k.bit_length() - 1
        after = places + k - (1 << level)
        lanes = [(_mixed(f[places], f[after], i), _mixed(r[after], r[places], i)) for i, (f, r) in enumerate(self.levels[level])]
        (fa, ra), (fb, rb) = lanes
        own = (fa < ra) | ((fa == ra) & (fb <= rb))
        return np.where(own, fa, ra).view(np.int64), np.where(own, fb, rb).view(np.int64), 1 + ((fa == ra) & (fb == rb)).astype(np.int32)


def _pieces(seqs: DataFrame, p: UniqueParams) -> DataFrame:
    n = F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / p.piece).cast("int")))
    cut = seqs.where(F.length("seq") > 0).select("contig", n.alias("piece"), F.upper("seq").alias("seq"))
    return cut.select("contig", "piece", F.substring(F.col("seq"), F.col("piece") * p.piece + 1, F.lit(p.piece + p.longest)).alias("part"))


def least_unique_lengths(seqs: DataFrame, p: UniqueParams = UniqueParams()) -> DataFrame:
    """(contig, pos, mul, room) for each place of (contig, seq), from 1: the least length from which its stretch is unique.

    A stretch is unique if both strands together have it once; one that is its own reverse complement is there twice. mul is null where no stretch is: not up to `longest`, or not before the contig's end or another
    letter than A, C, G and T, `room` letters on. Contigs have different names; small letters count as capitals.

    What is unique at a length is so at each longer one, and no longer stretch of it is any other place's. So the places
    are tested at doubling lengths, each time only those that are not unique yet, and then by halving the bracket of
    lengths between two tests. A test counts the names of the stretches of all places that the bracket's lower end leaves
    alike; all tests of a round are one aggregation. In all, a place has one row for each length tested up to its repeat's.
    Between rounds the brackets of a piece are one row beside its text; what is unique comes back to it as a list.
    """
    state = _pieces(seqs, p).select(F.monotonically_increasing_id().alias("id"), "contig", "piece", "part")
    state = staged(state.withColumns({"lo": F.lit(None).cast("binary"), "hi": F.lit(None).cast("binary")}), "places")
    steps = []
    k = min(p.first, p.longest)
    while True:
        steps.append(k)
        if k == p.longest:
            break
        k = min(2 * k, p.longest)
    for before, k in zip([0, *steps], steps, strict=False):
        state = _tested(state, [(before, k)], lambda lo, hi, before=before, k=k: np.where((lo == before) & (hi == 0), k, 0), p)
    while True:
        spans = state.select("part", "lo", "hi").mapInArrow(_spans(p), "lo int, hi int").distinct().collect()  # `longest` at most
        if not spans:
            break
        state = _tested(state, [(r["lo"], (r["lo"] + r["hi"]) // 2) for r in spans], lambda lo, hi: np.where(hi - lo > 1, (lo + hi) // 2, 0), p)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for contig, piece, part, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                room = _room(Names(part), p)
                n = len(room)
                _, least = _bracket(lo, hi, n)
                found = (least > 0) & (least <= room)
                yield pa.record_batch([pa.array([contig] * n, pa.string()), pa.array(np.arange(n) + piece * p.piece + 1), pa.array(least, mask=~found), pa.array(room)], names=["contig", "pos", "mul", "room"])

    return _spread(state.select("contig", "piece", "part", "lo", "hi")).mapInArrow(opened, "contig string, pos long, mul int, room int")


def _spread(pieces: DataFrame) -> DataFrame:
    """Pieces are few and small rows with much work each, which a reader would put into a single task."""
    return pieces.repartition(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _room(names: Names, p: UniqueParams) -> np.ndarray:
    return np.minimum(names.room[: p.piece], p.longest).astype(np.int32)


def _bracket(lo: bytes | None, hi: bytes | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The longest length at which each place is known not to be unique, and the least at which it is or is out of reach; 0: none yet."""
    return tuple(np.zeros(n, np.int32) if x is None else np.frombuffer(x, np.int32).copy() for x in (lo, hi))


def _spans(p: UniqueParams):
    """The different brackets of a task's pieces that are still to be halved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, *ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                room = _room(Names(part), p)
                lo, hi = _bracket(*ends, len(room))
                both = np.unique(np.stack([lo, hi])[:, (hi - lo > 1) & (room > lo)], axis=1)
                yield pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["lo", "hi"])

    return run


def _tested(state: DataFrame, tests: list[tuple[int, int]], own_of, p: UniqueParams) -> DataFrame:
    """`state` after one round: (lower end, length) are the tests, `own_of` brackets gives each place's own length or 0.

    Only places with as many letters as a test's length can take it; for the others that length is out of reach, as a
    unique one is, and their bracket closes towards their room.
    """
    least: dict[int, int] = {}
    for low, k in tests:
        least[k] = min(low, least.get(k, low))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part, *ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names = Names(part)
                room = _room(names, p)
                lo, hi = _bracket(*ends, len(room))
                own = own_of(lo, hi)
                for k in sorted(least):
                    at = np.flatnonzero((lo >= least[k]) & (room >= k))
                    if len(at):
                        a, b, times = names.of(at, k)
                        yield pa.record_batch([pa.array(np.full(len(at), key)), pa.array(at.astype(np.int32)), pa.array(np.full(len(at), k, np.int32)), pa.array(a), pa.array(b), pa.array(times), pa.array(own[at] == k)], names=["id", "at", "k", "a", "b", "times", "own"])

    rows = _spread(state.select("id", "part", "lo", "hi")).mapInArrow(named, "id long, at int, k int, a long, b long, times int, own boolean")
    once = rows.groupBy("k", "a", "b").agg(F.sum("times").alias("n"), F.min("id").alias("id"), F.min("at").alias("at"), F.min("own").alias("own")).where("n = 1 AND own")
    lists = once.groupBy("id").agg(F.collect_list("at").alias("unique"))  # a piece's places at most

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            los, his = [], []
            ends = zip(*(batch.column(c).to_pylist() for c in ("part", "lo", "hi")), strict=True)
            for row, (part, *bracket) in enumerate(ends):
                room = _room(Names(part), p)
                lo, hi = _bracket(*bracket, len(room))
                own = own_of(lo, hi)
                above = own > room
                at = batch.column("unique")[row]
                if at.is_valid:
                    above[at.values.to_numpy()] = True
                hi = np.where((own > 0) & above, own, hi)
                lo = np.where((own > 0) & ~above, own, lo)
                los.append(lo.astype(np.int32).tobytes())
                his.append(hi.astype(np.int32).tobytes())
            yield pa.record_batch([*batch.columns[:4], pa.array(los, pa.binary()), pa.array(his, pa.binary())], names=["id", "contig", "piece", "part", "lo", "hi"])

    met = state.join(lists, "id", "left").select("id", "contig", "piece", "part", "lo", "hi", "unique")
    return staged(met.mapInArrow(moved, "id long, contig string, piece int, part string, lo binary, hi binary"), "places")


def unique_track(lengths: DataFrame, shortest: int, keep_ends: bool = True) -> DataFrame:
    """(contig, pos0, mul) as masks and read filters take it: lengths from `shortest` on, a never-unique place as 65535.

    Places with fewer than `shortest` letters were never looked at: 0 with `keep_ends`, which keeps all reads there.
    """
    mul = F.when(F.col("room") < shortest, 0 if keep_ends else NEVER_UNIQUE).when(F.col("mul").isNull(), NEVER_UNIQUE).otherwise(F.greatest("mul", F.lit(shortest)))
    return lengths.select("contig", (F.col("pos") - 1).alias("pos0"), mul.cast("int").alias("mul"))
