"""Near duplicates by the exact Jaccard similarity of their word shingles.

1. SimHash classes give each member one candidate, the class's least key. What passes the exact test is linked; this
   settles large groups of near copies by stars, and nothing else depends on it.
2. Two sets of n and m shingles with a similarity of t or more share k or more of the first n - ceil(t * n) + k and
   m - ceil(t * m) + k of them, in any order that all texts have in common (prefix filter). With a k of a fifth of a set
   and the shingles that a sample shows to be common last, few texts share enough with texts of other classes: only
   these, the live ones, can have links that are left.
3. Of the live texts all shingles are counted, and the order is: first those that no other class has, then the rarest.
   Near copies of one text that changed too much to be linked have too many shingles of their own to meet at all.
4. In rounds, the texts of a shingle meet the most central one of them, the one with the least before that shingle in
   this order. Classes grow by what is linked; texts of one class never meet. Pairs that meet by their prefixes (with a k
   of 1) then, unless linked already, hold all that is left: no pair is lost, however far apart the fingerprints are.
5. Candidates are linked if the intersection over the union of their shingles is t or more, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.llm.simhash import SimhashParams, simhash_dedup
from strandwise.operators.components import connected_components
from strandwise.session import staged


@dataclass(frozen=True)
class SimilarParams:
    shingle: int = 5  #: words
    part: int = 4  #: linked texts have a similarity of part / whole or more
    whole: int = 5
    radius: int = 4  #: of the SimHash classes; speed only
    sample: int = 4000  #: documents from which the common shingles are learnt; speed only
    common: int = 1 << 16  #: of these the most that are ordered last; speed only
    extra: int = 5  #: texts must share 1 / extra of their shingles within a prefix that is longer by as much; speed only
    rounds: int = 4  #: in which texts meet central ones, at most; speed only
    slice: int = 1 << 19  #: shingles of a shard, about; memory only
    broadcast_rows: int = 1 << 21  #: keys of linked or met documents are broadcast up to so many and joined by sorting beyond


def shingles(body: bytes, k: int) -> np.ndarray:
    """The distinct 64-bit hashes of a text's word shingles; shorter texts are one shingle, as are those without words."""
    words = body.lower().split()  # for bytes: A-Z, and \x20 \x09-\x0D
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - k + 1)
    a, b = starts[:n].tolist(), (ends[k - 1 :].tolist() if len(words) >= k else [len(joined)])
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[x:y], 42) for x, y in zip(a, b, strict=True)), np.uint64, n)).view(np.int64)


def _sets(k: int, length: Callable[[int], int] | None = None, common: np.ndarray | None = None):
    """Over (key, body): key, the size n of its set and its shingles; with `length` the first `length(n)` in the order with `common` last."""
    common = np.empty(0, np.int64) if common is None else common
    by = np.argsort(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, parts = [], []
            for x in batch.column(1).cast(pa.binary()):
                own = shingles(x.as_py() or b"", k)
                n = len(own)
                sizes.append(n)
                if length:
                    at = np.minimum(np.searchsorted(common, own, sorter=by), max(0, len(common) - 1))
                    late = np.where(common[by[at]] == own, by[at] + 1, 0) if len(common) else np.zeros(n, np.int64)
                    own = own[np.lexsort((own, late))][: length(n)]
                parts.append(own)
            ends = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int32)
            flat = pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64))
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["key", "n", "tokens"])

    return run


_SET = "key long, n int, tokens array<long>"


def _side(table: DataFrame, params: SimilarParams) -> DataFrame:
    """`table`, written, for a join: broadcast after a look at its size, so that the other side's texts lie where they are."""
    table = staged(table, "side")
    return F.broadcast(table) if table.count() <= params.broadcast_rows else table


def _parities(k: int):
    """Over (key, body): key, the size of its set and, for each of 4,096 bins of hashes, if the set has an odd number in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bits = [], []
            for x in batch.column(1).cast(pa.binary()):
                own = shingles(x.as_py() or b"", k)
                sizes.append(len(own))
                odd = np.bincount((own & 4095), minlength=4096) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            flat = pa.array(np.concatenate(bits) if bits else np.empty(0, np.int64))
            ends = pa.array(np.arange(0, len(flat) + 1, 64, dtype=np.int32))
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(ends, flat)], names=["key", "n", "odd"])

    return run


def _of_pairs(pairs: DataFrame, keyed: DataFrame, params: SimilarParams) -> DataFrame:
    """The rows of `keyed` that the pairs (a, b) name; texts lie where they are."""
    need = _side(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), params)
    return keyed.join(need, "key", "left_semi")


def _beside(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    left, right = (sets.select(F.col("key").alias(c), F.col("n").alias("n" + c), F.col(column).alias(column + c)) for c in "ab")
    return pairs.join(left, "a").join(right, "b")


def _verified(pairs: DataFrame, keyed: DataFrame, params: SimilarParams) -> DataFrame:
    """Of the pairs (a, b) of keys those whose shingles have the least similarity.

    Each bin whose parity differs holds a shingle that only one of the two has, so pairs with too many such bins are
    told apart by half a kilobyte; the sets of the others are compared whole.
    """
    p, w = params.part, params.whole
    bins = staged(_of_pairs(pairs, keyed, params).mapInArrow(_parities(params.shingle), "key long, n int, odd array<long>").dropDuplicates(["key"]), "parities")
    differ = F.aggregate(F.zip_with("odda", "oddb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = _beside(pairs, bins, "odd").where(differ * (w + p) <= (F.col("na") + F.col("nb")) * (w - p)).select("a", "b")
    near = staged(near, "near-pairs")
    sets = staged(_of_pairs(near, keyed, params).mapInArrow(_sets(params.shingle), _SET).dropDuplicates(["key"]), "shingle-sets")
    shared = F.size(F.array_intersect("tokensa", "tokensb"))
    return _beside(near, sets, "tokens").where(shared * (w + p) >= (F.col("na") + F.col("nb")) * p).select("a", "b")


def _common(keyed: DataFrame, params: SimilarParams) -> np.ndarray:
    """The shingles that more than one document of a sample has, rarest first."""
    every = max(1, keyed.count() // params.sample)
    some = keyed.where(F.pmod("key", F.lit(every)) == 0).mapInArrow(_sets(params.shingle), _SET)
    counts = some.select(F.explode("tokens").alias("token")).groupBy("token").count().where("count > 1")
    top = counts.orderBy(F.desc("count"), "token").limit(params.common).collect()
    return np.array([r["token"] for r in reversed(top)], np.int64)


def _dealt(sets, common: np.ndarray, shards: int):
    """Over (key, body, label): packed slices of the tokens that `sets` gives, one for each shard that a token's hash names.

    A task's common tokens, which many documents may have, are a shard of its own, numbered below zero.
    """
    common = np.sort(common)

    def packed(held: list[pa.RecordBatch], own: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        key, n, label = (table[c].to_numpy() for c in ("key", "n", "label"))
        lists = table["tokens"].combine_chunks()
        counts, tokens = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
        doc = np.repeat(np.arange(len(counts)), counts)
        shard = (tokens.view(np.uint64) % np.uint64(shards)).astype(np.int64)
        if len(common):
            shard[common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens] = own
        order = np.argsort(shard, kind="stable")
        names, first = np.unique(shard[order], return_index=True)
        rows: list[tuple[int, int, int, bytes]] = []
        for name, lo, hi in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
            sel = order[lo:hi]
            docs, each = np.unique(doc[sel], return_counts=True)
            parts = (key[docs], label[docs] ^ key[docs], n[docs].astype(np.int32), each.astype(np.int32), tokens[sel])
            rows.append((name, len(docs), len(sel), pa.compress(b"".join(x.tobytes() for x in parts), codec="zstd", asbytes=True)))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["shard", "docs", "size", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = -1 - TaskContext.get().partitionId(), [], 0
        for batch in batches:
            for made in sets([batch.select(["key", "body"])]) if batch.num_rows else ():
                held.append(made.append_column("label", batch.column("label")))
                size += len(made.column("tokens").flatten())
            if size >= 1 << 18:
                yield packed(held, own)
                held, size = [], 0
        if held:
            yield packed(held, own)

    return run


_SLICES = "shard long, docs int, size int, body binary"


def _shared_tokens(table: pa.Table) -> pa.Table:
    """The rows of a shard's slices whose token has more than one label, each once, and how many have it; all of them for a shard of common tokens."""
    docs, sizes = table["docs"].to_numpy(), table["size"].to_numpy()
    keys, labels, ns, own, tokens, before = [], [], [], [], [], 0
    for d, m, body in zip(docs.tolist(), sizes.tolist(), table["body"], strict=True):
        raw = memoryview(pa.decompress(body.as_buffer(), decompressed_size=24 * d + 8 * m, codec="zstd", asbytes=True))
        keys.append(np.frombuffer(raw, np.int64, d))
        labels.append(np.frombuffer(raw, np.int64, d, 8 * d) ^ keys[-1])
        ns.append(np.frombuffer(raw, np.int32, d, 16 * d))
        own.append(before + np.repeat(np.arange(d, dtype=np.int32), np.frombuffer(raw, np.int32, d, 20 * d)))
        tokens.append(np.frombuffer(raw, np.int64, m, 24 * d))
        before += d
    key, label, n, doc, token = map(np.concatenate, (keys, labels, ns, own, tokens))
    often = np.ones(len(token), np.int32)
    if table["shard"][0].as_py() >= 0:
        order = np.argsort(token)
        first = np.flatnonzero(np.diff(token[order], prepend=~token[order[0]]))
        by = label[doc[order]]
        apart = np.minimum.reduceat(by, first) != np.maximum.reduceat(by, first)
        kept = order[np.repeat(apart, np.diff(np.append(first, len(order))))]
        kept = kept[np.lexsort((key[doc[kept]], token[kept]))]
        again = (np.diff(token[kept]) == 0) & (np.diff(key[doc[kept]]) == 0)  # rows that repeat
        kept = kept[np.concatenate((np.ones(min(1, len(kept)), bool), ~again))]
        doc, token = doc[kept], token[kept]
        _, at, many = np.unique(token, return_inverse=True, return_counts=True)
        often = many[at].astype(np.int32)
    return pa.table({"key": key[doc], "n": n[doc], "token": token, "often": often})


def _shared_counts(table: pa.Table) -> pa.Table:
    """How many of each document's tokens in a shard `_shared_tokens` keeps."""
    return _shared_tokens(table).group_by(["key", "n"]).aggregate([("token", "count")]).select(["key", "n", "token_count"]).rename_columns(["key", "n", "shared"])


def _labelled(keyed: DataFrame, roots: DataFrame, params: SimilarParams) -> DataFrame:
    """`keyed` with its class so far as `label`."""
    return keyed.join(_side(roots, params), F.col("key") == F.col("node"), "left").select(*keyed.columns, F.coalesce("root", "key").alias("label"))


def _live(keyed: DataFrame, roots: DataFrame, params: SimilarParams) -> DataFrame:
    """The rows of `keyed` that share enough with others than their own class for a link, and `label`.

    Nearly all tokens of a corpus are one document's. So they travel packed, by shards of about `slice` tokens, and only
    counts of those that documents of two labels have become rows. A token that isn't common is in a small share of the
    documents, and its shard is that much larger.
    """
    p, w, extra = params.part, params.whole, params.extra
    common = _common(keyed, params)
    labelled = _labelled(keyed, roots, params)
    total = keyed.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    words = total // 6  # of six bytes each, the space included; a corpus of other words has other shards
    shards = 1 + words * (extra * (w - p) + w) // (extra * w * params.slice)
    sets = _sets(params.shingle, lambda n: n - (p * n + w - 1) // w + max(1, n // extra), common)
    slices = labelled.mapInArrow(_dealt(sets, common, shards), _SLICES)
    counts = slices.groupBy("shard").applyInArrow(_shared_counts, "key long, n int, shared long")
    # the smaller of two texts that are linked sets the number that both must share
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * p / w) / extra))
    enough = counts.groupBy("key").agg(F.max("n").alias("n"), F.sum("shared").alias("shared")).where(F.col("shared") >= least)
    return staged(labelled.join(_side(enough.select("key"), params), "key", "left_semi"), "live-texts")


def _prefixes(live: DataFrame, params: SimilarParams) -> DataFrame:
    """(key, n, at, token): the tokens by which the live texts must meet, `at` their place in the order of all live texts.

    Tokens that one class has come first and aren't kept, so that places begin at their number.
    """
    p, w = params.part, params.whole
    words = (live.agg(F.sum(F.octet_length("body"))).first()[0] or 0) // 6
    slices = live.mapInArrow(_dealt(_sets(params.shingle), np.empty(0, np.int64), 1 + words // params.slice), _SLICES)
    rows = slices.groupBy("shard").applyInArrow(_shared_tokens, "key long, n int, token long, often int")
    of = Window.partitionBy("key")
    at = F.col("n") - F.count(F.lit(1)).over(of) + F.row_number().over(of.orderBy("often", "token")) - 1
    rows = rows.withColumn("at", at.cast("int")).where(F.col("at") < F.col("n") - F.ceil(F.col("n") * p / w) + 1)
    return staged(rows.select("key", "n", "at", "token"), "meeting-shingles")


def _may_be(x: str, y: str, params: SimilarParams):
    """If a pair with the columns of `x` and `y` that shares a token may be linked.

    At the first shared shingle all others that are shared lie behind it in both.
    """
    p, w = params.part, params.whole
    (nx, atx, labelx), (ny, aty, labely) = ([F.col(c + s) for c in ("n", "at", "label")] for s in (x, y))
    right = (labelx != labely) & (F.least(nx, ny) * w >= F.greatest(nx, ny) * p)
    return right & (F.least(nx - atx, ny - aty) * (w + p) >= (nx + ny) * p)


def _named(rows: DataFrame, s: str) -> DataFrame:
    return rows.select("token", *[F.col(c).alias(c + s) for c in ("key", "n", "label", "at")])


def _central(rows: DataFrame, params: SimilarParams) -> DataFrame:
    """Pairs (a, b) of keys: each text of a token and the most central one, at most one for each row."""
    middle = rows.groupBy("token").agg(F.min(F.struct((F.col("at") / F.col("n")).alias("share"), "key", "n", "label", "at")).alias("m"))
    middle = _named(middle.select("token", "m.*"), "y")
    met = _named(rows, "x").join(middle, "token").where(_may_be("x", "y", params))
    return met.select(F.least("keyx", "keyy").alias("a"), F.greatest("keyx", "keyy").alias("b")).distinct()


def _apart(rows: DataFrame, roots: DataFrame, params: SimilarParams) -> tuple[DataFrame, bool]:
    """`rows` with their classes so far, of tokens that more than one has; and if their pairs may outnumber them."""
    found = staged(_labelled(rows, roots, params), "labelled-shingles")
    each = found.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("token")
    each = each.agg(F.sum("c").alias("rows"), (F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))).alias("twice")).where("twice > 0")
    each = staged(each, "shared-tokens")
    total = each.agg(F.sum("rows"), F.sum("twice")).first()
    return found.join(each.select("token"), "token", "left_semi"), (total[1] or 0) > 2 * (total[0] or 0)


def _meeting(rows: DataFrame, params: SimilarParams) -> DataFrame:
    """The pairs (a, b) of keys, not linked yet, that the prefix filter and their sizes leave."""
    p, w = params.part, params.whole
    # the smaller set of a pair needs a shorter prefix, since the larger one has to hold more of it
    small = F.col("at") < F.col("n") - F.ceil(F.col("n") * (2 * p) / (w + p)) + 1
    met = _named(rows.where(small), "x").join(_named(rows, "y"), "token").where((F.col("nx") <= F.col("ny")) & _may_be("x", "y", params))
    return met.select(F.least("keyx", "keyy").alias("a"), F.greatest("keyx", "keyy").alias("b")).distinct()


def _grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of the classes that `links` (a, b) make of those of `roots`."""
    return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def similar_links(keyed: DataFrame, params: SimilarParams = SimilarParams()) -> DataFrame:
    """(node, root) of every key of (key, body) that has a near duplicate."""
    classes = simhash_dedup(keyed, "key", "body", SimhashParams(radius=params.radius, shingle=params.shingle))
    stars = staged(classes.where("key <> component_id").select(F.col("key").alias("a"), F.col("component_id").alias("b")).distinct(), "stars")
    roots = staged(connected_components(_verified(stars, keyed, params)), "star-roots")
    live = _live(keyed, roots, params)
    texts = live.select("key", "body")
    prefixes = _prefixes(live, params)
    rows, many = _apart(prefixes, roots, params)
    for _ in range(params.rounds):
        if not many:
            break
        near = staged(_verified(staged(_central(rows, params), "central-pairs"), texts, params), "central-links")
        if near.isEmpty():
            break
        roots = staged(_grown(roots, near), "roots")
        rows, many = _apart(prefixes, roots, params)
    pairs = staged(_meeting(rows, params), "meeting-pairs")
    return _grown(roots, _verified(pairs, texts, params))


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SimilarParams = SimilarParams()) -> DataFrame:
    """key and root of every distinct (id, text), `key` as `key_of` gives it: classes of near duplicates have one root.

    A class holds what pairs with the least similarity connect. Texts without words are equal; no rows give no rows.
    """
    keyed = docs.select(key_of(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("body"))
    found = similar_links(keyed, params)
    return keyed.select("key").distinct().join(found, F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("root"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SimilarParams = SimilarParams()) -> DataFrame:
    """The rows of `docs` but those of a class of near duplicates whose id isn't its least; a null id counts as the largest.

    Rows are told apart by id and text, so rows that repeat both stay or go together, and an id with two texts is two documents.
    """
    keyed = docs.withColumn("_key", key_of(id_col, text_col))
    linked = staged(similar_links(keyed.select(F.col("_key").alias("key"), F.col(text_col).cast("string").alias("body")), params), "linked")
    ids = keyed.select(F.col("_key").alias("node"), F.col(id_col).alias("_id")).join(_side(linked, params), "node").distinct()
    first = ids.groupBy("root").agg(F.min_by("node", F.struct(F.col("_id").isNull(), "_id", "node")).alias("_first"))
    gone = linked.join(first, "root").where("node <> _first").select(F.col("node").alias("_key"))
    return keyed.join(_side(gone, params), "_key", "left_anti").select(*docs.columns)


def key_of(id_col: str, text_col: str):
    """The key of a row: a hash of its id and text."""
    return F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))
