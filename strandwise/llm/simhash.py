"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r each of the 64 bit places gets a random nonzero vector of r + 1 bits, and each nonzero v of r + 1 bits
makes a mask: the places whose vector is not orthogonal to v. Any r places leave a v that is orthogonal to all of their
vectors, so two fingerprints that differ in r bits or fewer agree under one of the 2 ** (r + 1) - 1 masks: no pair is
lost. Fingerprints that agree under a mask form a bucket; each bucket gives a spanning forest of its links, never all
pairs, and the components of all forests are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.operators.components import connected_components
from strandwise.session import staged


@dataclass(frozen=True)
class SimhashParams:
    radius: int = 4  #: bits in which linked fingerprints may differ
    shingle: int = 4  #: words
    seed: int = 7  #: of the masks
    dense: int = 2048  #: buckets up to this size are compared in blocks, larger ones by shared midpoints


def masks(radius: int, seed: int) -> list[int]:
    """The 2 ** (radius + 1) - 1 covering masks, as unsigned 64-bit numbers; each keeps half of the places or so."""
    top = 1 << (radius + 1)
    vectors = np.resize(np.random.default_rng(seed).permutation(np.arange(1, top)), 64)  # each vector as often as can be
    return [sum(1 << i for i, x in enumerate(vectors.tolist()) if (x & v).bit_count() % 2) for v in range(1, top)]


def fingerprint(body: bytes, shingle: int) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; 0 without words."""
    words = body.lower().split()  # for bytes: A-Z, and \x20 \x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    last = min(shingle, len(words)) - 1
    for at in range(0, n, 1 << 16):  # so that a very long text needs little memory
        a, b = starts[at : min(n, at + (1 << 16))].tolist(), ends[at + last : min(n, at + (1 << 16)) + last].tolist()
        h = np.array([digest(joined[x:y], 42) for x, y in zip(a, b, strict=True)], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """(id, fp) of every row, fp as the signed number of the same bits. Null text counts as empty: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in bodies), np.uint64, len(bodies))
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp long")


def settle(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """The least member of the component of each of n nodes, by hooking and pointer jumping."""
    labels = np.arange(n) if labels is None else labels
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while (labels != (up := labels[labels])).any():
            labels = up


def forest(fps: np.ndarray, free: int, radius: int, dense: int) -> np.ndarray:
    """For each of the distinct fingerprints of a bucket the index of its component's first one.

    `free` has the places where members may differ. Small buckets are compared in blocks of rows. In larger ones, for an
    even radius, each member names every number within half the radius of it: two members share such a midpoint exactly
    if they are within the radius, so stars around midpoints replace pairs.
    """
    n = len(fps)
    labels = np.arange(n)
    if n <= dense or radius % 2:
        step = max(1, (1 << 21) // n)
        for at in range(0, n, step):
            near = np.bitwise_count(fps[at : at + step, None] ^ fps[None, :]) <= radius
            a, b = np.nonzero(near)
            labels = settle(n, a + at, b, labels)
        return labels
    places = [i for i in range(64) if free >> i & 1]
    flips = np.array([sum(1 << i for i in c) for k in range(radius // 2 + 1) for c in combinations(places, k)], np.uint64)
    passes = max(1, n * len(flips) >> 21)
    for p in range(passes):  # each pass holds the midpoints of one residue: bounded memory for any bucket
        keys, owner = [], []
        for flip in flips:
            k = fps ^ flip
            keep = np.flatnonzero((k * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(passes) == p)
            keys.append(k[keep])
            owner.append(keep)
        k, o = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(k)
        k, o = k[order], o[order]
        same = np.flatnonzero(k[1:] == k[:-1])
        labels = settle(n, o[same], o[same + 1], labels)
    return labels


def _bucket_forests(radius: int, free: list[int], dense: int):
    """Over rows sorted by (mask, key, fp): the edges of each bucket's forest. Keeps one bucket in memory."""

    def edges(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[list, list]:
        first = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))))
        size = np.diff(np.append(first, len(fp)))
        two = first[size == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
        a, b = [fp[two]], [fp[two + 1]]
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            own = np.unique(fp[at : at + n])
            labels = forest(own, free[mask[at]], radius, dense)
            linked = np.flatnonzero(labels != np.arange(len(own)))
            a.append(own[linked])
            b.append(own[labels[linked]])
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int8), np.empty(0, np.int64), np.empty(0, np.uint64)]
        parts: list[list[np.ndarray]] = []

        def out(cols: list[np.ndarray]) -> pa.RecordBatch:
            a, b = map(np.concatenate, edges(*cols))
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            ends = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = ends[-1] + 1 if len(ends) else 0  # the last bucket may go on in the next batch
            if cut or (parts and (parts[-1][0][-1] != cols[0][0] or parts[-1][1][-1] != cols[1][0])):
                parts.append([c[:cut] for c in cols])
                held = [np.concatenate(x) for x in zip(*parts, strict=True)]
                parts = []
                yield out(held)
            parts.append([c[cut:] for c in cols])
        if parts:
            yield out([np.concatenate(x) for x in zip(*parts, strict=True)])

    return run


def links(nodes: DataFrame, params: SimhashParams) -> DataFrame:
    """Edges (a, b) between distinct fingerprints in column fp: a spanning forest of every bucket's links."""
    kept = masks(params.radius, params.seed)
    free = [~m & (1 << 64) - 1 for m in kept]
    signed = [m - (1 << 64) if m >> 63 else m for m in kept]
    tables = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    rows = nodes.select("fp", F.explode(tables).alias("t")).select("t.mask", "t.key", "fp")
    dealt = rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(_bucket_forests(params.radius, free, params.dense), "a long, b long")


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SimhashParams = SimhashParams()
) -> DataFrame:
    """id_col, fingerprint (16 hex digits) and component_id (the smallest id reachable) of every row.

    Null and empty texts have fingerprint zero, which is linked like any other. Copies share a fingerprint and cost
    nothing beyond it. Repeated rows stay; a null id never names a class unless all of its ids are null; extra columns
    are ignored; no rows give no rows.
    """
    fps = staged(fingerprints(docs, id_col, text_col, params.shingle), "fingerprints")
    nodes = staged(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = connected_components(links(nodes, params))
    found = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = found.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = found.join(named, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
