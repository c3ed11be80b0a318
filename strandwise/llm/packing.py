"""Best-fit packing planned on the histogram of lengths.

1. Every text is tokenised where it lies; each piece of at most `capacity` tokens keeps its length, the number of its
   task and its rank among the task's pieces of that length.
2. The counts by length, at most `capacity` numbers, go to the driver, which packs counts instead of documents: longest
   first, always into the fullest sequences that still fit, whole runs of equal sequences at a time.
3. The rank within the length over all tasks is the task's rank plus the counts of the tasks before it. A piece takes
   the planned slot of its length and rank, so no task ever holds all pieces of a common length.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.session import staged


@dataclass(frozen=True)
class PackingParams:
    capacity: int = 2048  #: tokens in a sequence
    end_id: int = 0  #: follows each document
    tokenizer: str | None = None  #: path of a tokenizers file; None: byte_bpe_50k.json of public_tokenizers
    cache_words: int = 400_000  #: words whose ids a worker remembers; speed only
    with_ids: bool = False  #: also return the ids of each piece, as little-endian unsigned 32-bit numbers


#: ASCII marks that end a word; the tokenizer keeps a run of them apart from the letters before it
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE's letter for each byte: itself if it prints, else the next free one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + n for n, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of byte-level BPE texts, as little-endian unsigned 32-bit bytes, remembered by word.

    Such a tokenizer never merges across a single space or line break between two other characters, so the ids of a
    text with no other white space are those of its words with their leading space, and of the line breaks. A word of
    letters and marks after them is cut there as well. Any other text or word goes to the tokenizer as a whole.
    """

    def __init__(self, path: str, cache_words: int):
        from tokenizers import Tokenizer

        self.inner, self.limit = Tokenizer.from_file(path), cache_words
        self.merge = self.inner.model.tokenize
        self.letters = _byte_letters()
        self.led: dict[str, bytes] = {}  # words after a space
        self.bare: dict[str, bytes] = {}  # words at the start of a line
        self.runs: dict[str, bytes] = {}  # letters with their space, and marks
        self.line = self.whole("\n")

    def whole(self, text: str) -> bytes:
        ids = self.inner.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _run(self, run: str) -> bytes:
        if (known := self.runs.get(run)) is None:
            if len(self.runs) >= self.limit:
                self.runs.clear()
            if run.isascii():
                spelt = run.replace(" ", "\u0120")
            else:
                spelt = run.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.merge(spelt)]
            self.runs[run] = known = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def _learn(self, words: set[str], lead: str, known: dict[str, bytes]) -> None:
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.limit:
            known.clear()
            new = list(words)
        for w in new:
            core = w.rstrip(_MARKS)
            if core.isalpha():
                tail = w[len(core) :]
                known[w] = self._run(lead + core) + (self._run(tail) if tail else b"")
            else:
                known[w] = self.whole(lead + w)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        words = text.replace("\n", " ").split(" ")
        if words != text.split():
            return self.whole(text)
        lines = [x.split(" ") for x in text.split("\n")]
        self._learn({x[0] for x in lines}, "", self.bare)
        self._learn({w for x in lines for w in x[1:]}, " ", self.led)
        led, bare = self.led, self.bare
        return self.line.join(bare[x[0]] + b"".join([led[w] for w in x[1:]]) for x in lines)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first one."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, offset), sorted by length and rank.

    The pieces of a run, in the order of their ranks, lie at `offset` of consecutive sequences.
    """
    runs, made = [], 0
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, count)
    open_: list[int] = []  # the keys of room, sorted
    for length in sorted(counts, reverse=True):
        need, rank = counts[length], 0
        while need:
            at = bisect_left(open_, length)
            if at == len(open_):
                k = -(-need // (capacity // length))
                room[capacity] = [(made, k)]
                insort(open_, capacity)
                made += k
                continue
            r = open_[at]
            first, k = room[r].pop()
            m = min(k, -(-need // (r // length)))
            runs.append((length, rank, m, first, capacity - r))
            if k > m:
                room[r].append((first + m, k - m))
            elif not room[r]:
                del room[r]
                open_.pop(at)
            if r > length:
                if r - length not in room:
                    room[r - length] = []
                    insort(open_, r - length)
                room[r - length].append((first, m))
            rank, need = rank + m, need - m
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, id_col: str, text_col: str, params: PackingParams) -> DataFrame:
    """Every piece with its length, checksum, task and rank among the task's pieces of that length."""
    path, capacity, with_ids = params.tokenizer, params.capacity, params.with_ids
    cache_words, end = params.cache_words, np.array([params.end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path
        if file is None:
            import public_tokenizers

            file = public_tokenizers.path("byte_bpe_50k.json")
        encode = WordTokenizer(file, cache_words)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            take, nth, start, length, crc, rank, ids = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                own = encode(text.as_py() or "") + end
                for k, (s, n) in enumerate(cuts(len(own) // 4, capacity)):
                    part = own[4 * s : 4 * (s + n)]
                    take.append(i)
                    nth.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    rank.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        ids.append(part)
            cols = {
                "id": batch.column(0).take(pa.array(take, pa.int64())),
                "piece": pa.array(nth, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
                "task": pa.array([task] * len(nth), pa.int32()),
                "rank": pa.array(rank, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(cols | ({"ids": pa.array(ids, pa.binary())} if with_ids else {}))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long" + ", ids binary" * with_ids
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: PackingParams = PackingParams()) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null text counts as empty: one piece of just the end id. Repeated rows and null ids are documents of their own;
    extra columns are ignored; no rows give no rows. A longer document is cut so that only its first piece is short.
    """
    cut = staged(pieces(docs, id_col, text_col, params), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs = plan(counts, params.capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("base"))
    kept = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * params.with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 48 | rank, "right") - 1
            place = {"sequence_id": runs[at, 3] + rank - runs[at, 1], "offset": runs[at, 4]}
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in kept} | {k: pa.array(v) for k, v in place.items()})

    kind = cut.schema["id"].dataType.simpleString()
    out = ranked.select(*kept, "rank").mapInArrow(
        run,
        f"id {kind}, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * params.with_ids + "sequence_id long, offset long",
    )
    return out.withColumnRenamed("id", id_col)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
