"""Removal of every byte that a repeated 200-byte string covers, by suffix arrays.

1. Each 200-byte window of a text is led by the least hash among its 32-byte strings, its anchor: equal windows have
   equal anchors. Neighbouring windows with the same anchor make one segment, named by the anchor and a hash of its
   bytes. Segments whose anchor occurs once in the corpus can't repeat and end here.
2. The others meet by anchor. Of equal segments one goes on, with the news that it has copies, so copies cost nothing.
   The rows of anchors that many rows have (they are counted, nothing is sampled) aren't moved: they are added up where
   they lie. An anchor with many different segments, such as a phrase that all use, is given up: its windows meet by their own hash.
3. Tasks cut the sorted anchors into shards of bounded size. A shard's suffix array comes from Larsson-Sadakane
   refinement: unresolved groups are re-sorted by the rank of what follows, doubling the depth, with rank pair and
   position in one machine word. Kasai's walk, one lane per segment, gives the common prefix of each window with its
   predecessor. Windows of 200 common bytes repeat. An anchor too common for one shard has its shards merged: the
   distinct windows of each are looked up in those before by binary search. `common` bounds how many those can be.
4. What repeats goes back to all copies of a segment and from there to its document.

Windows never cross documents, since segments never do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.session import staged

_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_U = np.uint64


@dataclass(frozen=True)
class SubstringParams:
    length: int = 200  #: bytes that make a repeat; 33 at least, and less than 800
    chunk: int = 1 << 20  #: bytes scanned for anchors at once
    shard: int = 1 << 18  #: bytes in a suffix array, 2 ** 20 - 2 at most
    common: int = 4096  #: rows, and different segments, that one task takes of one anchor; the rest is dealt otherwise
    listed: int = 10000  #: a list of common anchors up to this length is a set in the plan, and up to a hundred times of it a broadcast table


ANCHOR = 32


def anchored(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows) of the runs of windows with one anchor, over texts data[begin:end]."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(length + ANCHOR, np.uint8)])
    words = np.ndarray(n + length + ANCHOR - 7, np.uint64, buffer=padded, strides=(1,))
    m = length - ANCHOR + 1
    size = n + m
    h = words[:size] * _ODD[0]
    for j in (1, 2, 3):
        h ^= h >> _U(29)
        h += words[8 * j : 8 * j + size] * _ODD[j]
    h ^= h >> _U(32)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(31)
    low = _U((1 << 26) - 1)
    key = np.full(-(-size // m) * m, ~_U(0))
    key[:size] = (h & ~low) | np.arange(size, dtype=np.uint64)  # equal hashes: the first place wins
    key = key.reshape(-1, m)
    right = np.minimum.accumulate(key, axis=1).reshape(-1)
    left = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    at = (np.minimum(left[:n], right[m - 1 : m - 1 + n]) & low).astype(np.int64)
    new = np.empty(n, bool)
    new[:1] = True
    np.not_equal(at[1:], at[:-1], out=new[1:])
    count = np.maximum(0, end - begin - length + 1)
    full = count > 0
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, begin[full], 1)
    np.add.at(edge, (begin + count)[full], -1)
    valid = np.cumsum(edge[:-1]) > 0
    new[begin[full]] = True
    new[(begin + count)[full & (begin + count < n)]] = True
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, n))
    kept = valid[first]
    first, many = first[kept], many[kept]
    return h[at[first]].view(np.int64), first, many


def _pieces(bodies: list[bytes], chunk: int, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, bytes) in lots of about `chunk` bytes; a long text is cut so that each window lies in one piece."""
    lot, size = [], 0
    for i, body in enumerate(bodies):
        for at in range(0, max(1, len(body) - length + 1), chunk):
            part = body[at : at + chunk + length - 1]
            if len(part) >= length:
                lot.append((i, at, part))
                size += len(part)
                if size >= chunk:
                    yield lot
                    lot, size = [], 0
    if lot:
        yield lot


def _scan(length: int, chunk: int):
    """Rows (k1, k2, body) to rows (h, g, k1, k2, place): place is 1024 x first window + windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bodies = [x.as_py() or b"" for x in batch.column(2).cast(pa.binary())]
            for lot in _pieces(bodies, chunk, length):
                whole = b"".join(p for _, _, p in lot)
                end = np.cumsum([len(p) for _, _, p in lot])
                begin = np.concatenate(([0], end[:-1]))
                h, first, many = anchored(np.frombuffer(whole, np.uint8), begin, end, length)
                g = np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(first.tolist(), (first + many + length - 1).tolist(), strict=True)), np.uint64, len(first))
                of = np.searchsorted(end, first, "right")
                doc = np.array([i for i, _, _ in lot])[of]
                place = (first - begin[of] + np.array([o for _, o, _ in lot])[of]) << 10 | many
                yield pa.record_batch([pa.array(x) for x in (h, g.view(np.int64), k1[doc], k2[doc], place)], names=["h", "g", "k1", "k2", "place"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, g) those whose h occurs again; `lead` marks the first of a (h, g), `copies` if it has more."""
    names = ["h", "g", "k1", "k2", "place"]

    def out(cols: list[np.ndarray], before: tuple | None, after: tuple | None) -> pa.RecordBatch:
        h, g = cols[0], cols[1]
        same_h, same_g = np.zeros(len(h) + 1, bool), np.zeros(len(h) + 1, bool)
        same_h[1:-1] = h[1:] == h[:-1]
        same_g[1:-1] = same_h[1:-1] & (g[1:] == g[:-1])
        for at, row, other in ((0, 0, before), (len(h), -1, after)):
            if other is not None:
                same_h[at], same_g[at] = other[0] == h[row], other == (h[row], g[row])
        kept = np.flatnonzero(same_h[:-1] | same_h[1:])
        lead = ~same_g[:-1]
        return pa.record_batch([*(pa.array(c[kept]) for c in cols), pa.array(lead[kept]), pa.array((lead & same_g[1:])[kept])], names=[*names, "lead", "copies"])

    before, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy() for i in range(5)]
        if held is not None:
            yield out(held, before, (cols[0][0], cols[1][0]))
            before = (held[0][-1], held[1][-1])
        held = cols
    if held is not None:
        yield out(held, before, None)


def suffix_array(data: np.ndarray, left: np.ndarray, deepest: int) -> np.ndarray:
    """Positions in the order of their suffixes, each of which ends after left[i] bytes; equal ones by position.

    Larsson-Sadakane: a group's rank is its first place in the array; only groups of more than one are sorted again, by
    the rank of the suffix `depth` further on. `deepest` bounds left.
    """
    n = len(data)
    used = np.flatnonzero(np.bincount(data, minlength=256))
    code = np.zeros(256, np.uint64)
    code[used] = np.arange(1, len(used) + 1)
    width = int(len(used)).bit_length()
    depth = min(44 // width, deepest)
    c = np.concatenate([code[data], np.zeros(depth, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(depth):
        key = key << _U(width) | np.where(left > j, c[j : j + n], _U(0))
    bits, place = _U(20), np.arange(n, dtype=np.uint64)
    low = _U((1 << 20) - 1)
    key = key << bits | place
    rank = np.zeros(n, np.int64)
    sa = np.empty(n, np.int64)
    slots = np.arange(n)
    while True:
        key.sort()
        at = (key & low).astype(np.int64)
        group = key >> bits
        new = np.ones(len(key), bool)
        new[1:] = group[1:] != group[:-1]
        sa[slots] = at
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
        single = new & np.append(new[1:], True)
        if depth >= deepest or single.all():
            return sa
        at, slots = at[~single], slots[~single]
        ahead = np.where(left[at] > depth, rank[np.minimum(at + depth, n - 1)], 0)
        key = rank[at].astype(np.uint64) << _U(40) | ahead.astype(np.uint64) << bits | at.astype(np.uint64)
        depth *= 2


def common_prefixes(data: np.ndarray, left: np.ndarray, sa: np.ndarray, begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the first `count` positions of each segment, their predecessor in `sa` (-1: none) and common prefix with it.

    Kasai: a position's common prefix is at most one less than that of the position before it, so each segment is
    walked from its start; all segments walk together, eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    words = np.ndarray(n, np.uint64, buffer=np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    common = np.zeros(n, np.int64)
    order = np.argsort(-count, kind="stable")
    lanes, steps = begin[order], count[order]
    carry = np.zeros(len(lanes), np.int64)
    for t in range(int(steps[0]) if len(steps) else 0):
        live = int(np.searchsorted(-steps, -t, "left"))  # lanes with more than t steps
        i = lanes[:live] + t
        j = before[i]
        got = np.maximum(carry[:live] - 1, 0)
        most = np.where(j >= 0, np.minimum(left[i], left[j]), 0)
        todo = np.flatnonzero(got < most)
        while len(todo):
            at = got[todo]
            diff = words[i[todo] + at] ^ words[j[todo] + at]
            equal = np.where(diff == 0, 8, np.bitwise_count((diff & (~diff + _U(1))) - _U(1)).astype(np.int64) >> 3)
            got[todo] = np.minimum(at + equal, most[todo])
            todo = todo[(equal == 8) & (got[todo] < most[todo])]
        got = np.minimum(got, most)
        common[i] = got
        carry[:live] = got
    return before, common


class _Merged:
    """The distinct windows of a common anchor's earlier shards, sorted."""

    def __init__(self, length: int):
        self.windows = np.empty(0, f"S{length}")
        self.owner = np.empty((0, 3), np.int64)  # (h, g, window) of the first one; h and g as they are
        self.known = np.empty(0, bool)  # whether it has been told of as repeated

    def add(self, windows: np.ndarray, owner: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`windows`, sorted: which of them were here before; owners that repeat now and were not told of."""
        at = np.searchsorted(self.windows, windows)
        met = np.zeros(len(windows), bool)
        inside = at < len(self.windows)
        met[inside] = self.windows[at[inside]] == windows[inside]
        old = at[met]
        late = self.owner[old[~self.known[old]]]
        self.known[old] = True
        new = ~met
        where = at[new]
        self.windows = np.insert(self.windows, where, windows[new])
        self.owner = np.insert(self.owner, where, owner[new], axis=0)
        self.known = np.insert(self.known, where, known[new])
        return met, late


def repeats(rows: list[tuple[int, int, bool, bytes]], length: int, merged: _Merged | None = None) -> list[tuple[int, int, int, int]]:
    """(h, g, from, to) of the bytes that repeated windows cover, of one shard's segments (h, g, copies, bytes)."""
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    size = np.array([len(r[3]) for r in rows])
    end = np.cumsum(size)
    begin, count = end - size, size - length + 1
    left = np.repeat(end, size) - np.arange(len(data))
    sa = suffix_array(data, left, int(size.max()))
    before, common = common_prefixes(data, left, sa, begin, count)
    long_ = common >= length
    twice = long_.copy()
    twice[before[long_]] = True
    of = np.repeat(np.arange(len(rows)), size)
    window = left >= length
    twice |= np.array([r[2] for r in rows])[of] & window
    late: list[tuple[int, int, int, int]] = []
    if merged is not None:
        ordered = sa[window[sa]]
        head = ordered[~long_[ordered]]  # one of each set of equal windows, in order
        strings = np.lib.stride_tricks.sliding_window_view(data, length)[head]
        strings = np.ascontiguousarray(strings).view(f"S{length}").reshape(-1)
        owner = np.array([(rows[s][0], rows[s][1], p) for s, p in zip(of[head].tolist(), (head - begin[of[head]]).tolist(), strict=True)], np.int64).reshape(-1, 3)
        sets = np.cumsum(~long_[ordered]) - 1
        told = np.zeros(len(head), bool)
        np.logical_or.at(told, sets, twice[ordered])
        met, missed = merged.add(strings, owner, told)
        twice[ordered] |= met[sets]
        late = [(h, g, p, p + length) for h, g, p in missed.tolist()]
    hit = np.flatnonzero(twice & window)
    if not len(hit):
        return late
    cut = np.flatnonzero((np.diff(hit) != 1) | (of[hit[1:]] != of[hit[:-1]])) + 1
    first, last = hit[np.concatenate(([0], cut))], hit[np.concatenate((cut - 1, [len(hit) - 1]))]
    s = of[first]
    return late + [(rows[k][0], rows[k][1], a, b) for k, a, b in zip(s.tolist(), (first - begin[s]).tolist(), (last - begin[s] + length).tolist(), strict=True)]


def _windows(length: int):
    """Rows (k1, k2, id, body, segments of it) to a row (w1, w2, h, g, p, copies) for each window of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, own in zip(batch.column(3).cast(pa.binary()), batch.column(4), strict=True):
                body, own = body.as_py(), own.as_py()
                spots = [(x["h"], x["g"], p, x["copies"], (x["place"] >> 10) + p) for x in own for p in range(x["place"] & 1023)]
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(body[at : at + length]) for *_, at in spots), np.int64)
                h, g, p, copies, _ = zip(*spots, strict=True)
                cols = [pa.array(digests[::2]), pa.array(digests[1::2]), *(pa.array(c, pa.int64()) for c in (h, g, p)), pa.array(copies)]
                yield pa.record_batch(cols, names=["w1", "w2", "h", "g", "p", "copies"])

    return run


def _covered(length: int):
    """Rows (h, g, windows that repeat) to a row (h, g, a, b) for each maximal run that they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, g, p in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                at = np.array(p, np.int64)
                out += [(h, g, a, b) for a, b in zip(*(x.tolist() for x in spans(at, at + length)), strict=True)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4, names=["h", "g", "a", "b"])

    return run


def _chosen(df: DataFrame, by: Column, table: DataFrame, listed: int) -> tuple[int, DataFrame, DataFrame]:
    """How many values `table`, one column, has; the rows of `df` whose `by` is among them; and the others."""
    n = table.count()
    if n <= listed:
        among = by.isin([r[0] for r in table.collect()])
        return n, df.where(among), df.where(~among)
    side = table.select(F.col(table.columns[0]).alias("_listed"))
    side = F.broadcast(side) if n <= 100 * listed else side
    return n, df.join(side, by == F.col("_listed"), "left_semi"), df.join(side, by == F.col("_listed"), "left_anti")


def common_anchors(runs: DataFrame, common: int, listed: int) -> DataFrame:
    """(h) of the anchors that more than `common` rows have: counted exactly, but only where 2 ** 20 coarse counts let it be."""
    cell = F.pmod(F.xxhash64("h"), F.lit(1 << 20))
    full = staged(runs.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > common).select("cell"), "full-cells")
    _, some, _ = _chosen(runs.select("h"), cell, full, listed)
    return some.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > common).select("h")


def _shards(length: int, shard: int):
    """Over segments sorted by anchor: shards of whole anchors as far as they fit, and several merged ones where not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bool, bytes]] = []
        size = start = 0  # start: where the rows of the last anchor begin
        anchor: int | None = None
        merged: _Merged | None = None  # of that anchor, if it had a shard before

        def out(part: list, own: _Merged | None) -> Iterator[pa.RecordBatch]:
            if part and (found := repeats(part, length, own)):
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["h", "g", "a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if row[0] != anchor:
                    if merged is not None:  # the common anchor ends
                        yield from out(rows, merged)
                        rows, size, merged = [], 0, None
                    anchor, start = row[0], len(rows)
                if rows and size + len(row[3]) > shard:
                    if start:  # whole anchors before this one
                        yield from out(rows[:start], None)
                        rows, start = rows[start:], 0
                        size = sum(len(r[3]) for r in rows)
                    if rows and size + len(row[3]) > shard:
                        merged = merged or _Merged(length)
                        yield from out(rows, merged)
                        rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        yield from out(rows, merged)

    return run


def _segments(length: int):
    """Rows (k1, k2, id, body, segments of it) to rows (h, g, copies, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {"h": [], "g": [], "copies": [], "bytes": []}
            size = 0

            def made(cols: dict) -> pa.RecordBatch:
                kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                return pa.record_batch([pa.array(v, t) for v, t in zip(cols.values(), kinds, strict=True)], names=list(cols))

            for body, own in zip(batch.column(3).cast(pa.binary()), batch.column(4), strict=True):
                body = body.as_py()
                for x in own.as_py():
                    at, many = x["place"] >> 10, x["place"] & 1023
                    part = body[at : at + many + length - 1]
                    for k, v in zip(cols, (x["h"], x["g"], x["copies"], part), strict=True):
                        cols[k].append(v)
                    size += len(part)
                if size > 1 << 23:
                    yield made(cols)
                    cols, size = {k: [] for k in cols}, 0
            if cols["h"]:
                yield made(cols)

    return run


def spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that the given ranges cover; touching ones are one run."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], a[1:] > b[:-1]))
    return a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)]


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, body, ranges) to the result and the kept spans' complement as arrays."""
    for batch in batches:
        n_bytes, removed, runs, shas = [], [], [], []
        for body, own in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
            body, own = body.as_py() or b"", own.as_py()
            cut: list[tuple[int, int]] = []
            if own:
                cut = list(zip(*(x.tolist() for x in spans(np.array([x["a"] for x in own]), np.array([x["b"] for x in own]))), strict=True))
            digest, at = hashlib.sha256(), 0
            for a, b in cut:
                digest.update(body[at:a])
                at = b
            digest.update(body[at:])
            n_bytes.append(len(body))
            removed.append(sum(b - a for a, b in cut))
            runs.append([{"start": a, "end": b} for a, b in cut])
            shas.append(digest.hexdigest())
        yield pa.record_batch(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["id", "n_bytes", "n_removed", "kept_sha256", "spans"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SubstringParams = SubstringParams()) -> DataFrame:
    """One row per row of `docs`: id_col, n_bytes, n_removed, kept_sha256, spans (maximal removed runs, in bytes).

    Null text counts as empty. A text under `length` bytes loses nothing. Copies lose everything, all of them; a row
    that repeats id and text is a copy as well. Null ids are ids like others; extra columns are ignored; no rows give
    no rows. Nothing is sampled. Texts are scanned in pieces, but a row, its text and what was found in it, must fit a
    task. Segments are taken for equal if a hash of their anchor and another one of all their bytes agree, 128 bits in
    all, and the windows of a given-up anchor if their 128-bit hashes do; all other windows are compared by bytes.
    """
    integral = docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        (F.coalesce(F.col(id_col).cast("long"), F.lit(-1)) if integral else F.xxhash64(id_col)).alias("k1"),
        F.xxhash64(body).alias("k2"),
        F.col(id_col).alias("id"),
        body.alias("body"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    length = params.length
    runs = staged(rows.select("k1", "k2", "body").mapInArrow(_scan(length, params.chunk), "h long, g long, k1 long, k2 long, place long"), "anchors")

    hot = staged(common_anchors(runs, params.common, params.listed), "common-anchors")
    n_hot, hot_runs, usual = _chosen(runs, F.col("h"), hot, params.listed)
    sorted_ = usual.repartition("h").sortWithinPartitions("h", "g")
    again = staged(sorted_.mapInArrow(_repeated, "h long, g long, k1 long, k2 long, place long, lead boolean, copies boolean"), "repeated-anchors")
    leads = again.where("lead").select("h", "g", "copies", "k1", "k2", "place")
    again = again.select("h", "g", "k1", "k2", "place")
    split = None
    if n_hot:
        # common anchors repeat for sure; rows with equal segments are added up before anything moves
        hot_runs = hot_runs.select("h", "g", "k1", "k2", "place")
        one = hot_runs.groupBy("h", "g").agg((F.count(F.lit(1)) > 1).alias("copies"), F.min(F.struct("k1", "k2", "place")).alias("x"))
        one = staged(one.select("h", "g", "copies", "x.k1", "x.k2", "x.place"), "common-segments")
        wide = staged(one.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > params.common).select("h"), "wide-anchors")
        n_wide, given_up, met = _chosen(one, F.col("h"), wide, params.listed)
        again = again.unionByName(hot_runs)
        leads = leads.unionByName(met)
        split = given_up if n_wide else None

    gathered = lambda df: df.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "g", "copies", "place")).alias("own"))
    fetched = lambda df: rows.join(gathered(df), ["k1", "k2"]).select("k1", "k2", "id", "body", "own")
    segments = fetched(leads).mapInArrow(_segments(length), "h long, g long, copies boolean, bytes binary")
    found = segments.repartition("h").sortWithinPartitions("h", "g").mapInArrow(_shards(length, params.shard), "h long, g long, a long, b long")
    if split is not None:
        windows = fetched(split).mapInArrow(_windows(length), "w1 long, w2 long, h long, g long, p long, copies boolean")
        met = windows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("w1", "w2"))).where("n > 1 OR copies")
        hits = met.groupBy("h", "g").agg(F.collect_set("p").alias("p"))  # 169 places at most
        found = found.unionByName(hits.mapInArrow(_covered(length), "h long, g long, a long, b long"))
    at = F.shiftright("place", 10)
    back = again.join(found, ["h", "g"]).select("k1", "k2", (at + F.col("a")).alias("a"), (at + F.col("b")).alias("b"))
    ranges = back.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    out = rows.join(ranges, ["k1", "k2"], "left").select("id", "body", "ranges")
    return out.mapInArrow(_result, f"id {kind}, n_bytes long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>").withColumnRenamed("id", id_col)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
