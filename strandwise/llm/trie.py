"""Prefix trie of conversations with subtree totals by parallel tree contraction.

1. Each turn becomes 128 bits of its place and content. A prefix is the exclusive or of its turns' bits, which a running
   value over ranges of (conversation, place) gives, so the turns of one conversation may lie in many tasks. A node is
   a distinct prefix; texts themselves are never shuffled.
2. Contraction, in join rounds until no node is left: rake adds each leaf's totals to its parent and takes the leaf off;
   compress takes nodes off chains of only children, adds their totals to the node above and links it to the one below.
   A node of a chain goes if its random number of the round is above both neighbours', so no two neighbours go at once.
   Each node holds the exclusive or of its children's ids, which is the last child's id once one is left: no join has
   more than a row a key on either side, however many children a node has.
3. Re-expansion, from the last round to the first: a leaf's totals are those it had when it was raked; a compressed
   node's are its own at that time and the whole of the node that was below it.
4. The ids of the conversations that end at a node are joined to pieces of text where they lie, and the pieces stream in
   order through the node's hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.operators.ordered import in_blocks, running_all
from strandwise.session import staged


@dataclass(frozen=True)
class TrieParams:
    piece_chars: int = 1 << 16  #: of the pieces in which the ids of a node's ends are hashed


def _half(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("long")


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, a, b, n_bytes): the turns of a conversation counted from 1, their content as 128 bits, their texts' bytes.

    Null turns come first; turns that tie come in the order of their content's digest. Null roles and texts count as
    empty. Rows without a conversation's id are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = rows.select("conv", "turn", _half(F.col("digest"), 1).alias("a"), _half(F.col("digest"), 17).alias("b"), "n_bytes", F.lit(1).alias("one"))
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    return running_all(in_blocks(rows, ["conv"], order), ["conv"], order, {"pos": ("one", "sum")}).select("conv", "pos", "a", "b", "n_bytes")


def prefixes(rows: DataFrame) -> DataFrame:
    """`rows` (conv, pos, a, b, n_bytes) as (conv, pos, a, b, pa, pb, n_bytes): (a, b) names the prefix that ends here, (pa, pb) the one before."""
    own = rows.select("conv", "pos", "n_bytes", F.xxhash64("pos", "a", "b").alias("h"), F.xxhash64(F.lit(1), "b", "a", "pos").alias("g"))
    run = running_all(in_blocks(own, ["conv"], ["pos"]), ["conv"], ["pos"], {"a": ("h", "xor"), "b": ("g", "xor")})
    return run.select("conv", "pos", "a", "b", F.col("a").bitwiseXOR(F.col("h")).alias("pa"), F.col("b").bitwiseXOR(F.col("g")).alias("pb"), "n_bytes")


def subtree_totals(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """(a, b, *sums) for each node of `nodes` (a, b, pa, pb, kids, ca, cb, *sums): each sum over the node's whole subtree.

    (pa, pb) is the parent, null for a root; (ca, cb) the exclusive or of the ids of its `kids` children. The number of
    rounds grows with the logarithm of the number of nodes. Each round writes what is left of the tree, so a lost
    executor costs one round, and only two counts of a round reach the driver.
    """
    alive, rounds = nodes.select("a", "b", "pa", "pb", "kids", "ca", "cb", *sums), []
    key = ["a", "b"]
    while True:
        gone = alive.where("kids = 0").where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"))
        gone = gone.agg(F.count(F.lit(1)).alias("_kids"), F.bit_xor("a").alias("_ca"), F.bit_xor("b").alias("_cb"), *[F.sum(s).alias(f"_{s}") for s in sums])
        fewer = lambda c: F.col(c).bitwiseXOR(F.coalesce(f"_{c}", F.lit(0)))
        left = alive.where("kids > 0").join(gone, key, "left").select(
            *key, "pa", "pb", (F.col("kids") - F.coalesce("_kids", F.lit(0))).alias("kids"), fewer("ca").alias("ca"), fewer("cb").alias("cb"),
            *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums],
        )
        left = staged(left, "raked")
        rake = alive.where("kids = 0").select(*key, *sums)
        spliced = None
        if left.where("kids = 1").count() > 1:
            spliced = staged(_chosen(left, sums, len(rounds)), "compressed")
            if spliced.isEmpty():
                spliced = None
        rounds.append((rake, spliced))
        if spliced is not None:
            left = staged(_compressed(left, spliced, sums), "left")
        if left.isEmpty():
            break
        alive = left
    totals = None
    for rake, spliced in reversed(rounds):
        if spliced is not None:
            below = totals.select(F.col("a").alias("ca"), F.col("b").alias("cb"), *[F.col(s).alias(f"_{s}") for s in sums])
            found = spliced.join(below, ["ca", "cb"]).select(*key, *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in sums])
            totals = totals.union(staged(found, "expanded"))
        totals = rake if totals is None else totals.union(rake)
    return totals


def _chosen(left: DataFrame, sums: list[str], nth: int) -> DataFrame:
    """(a, b, ca, cb, pa, pb, *sums) of the chain nodes that go: only children with one child, above both neighbours by a number of the round."""
    draw = lambda a, b: F.struct(F.xxhash64(F.lit(nth), a, b), a, b)
    chain = left.where("kids = 1")
    above = chain.select(F.col("ca").alias("a"), F.col("cb").alias("b"), F.col("a").alias("xa"), F.col("b").alias("xb"))
    met = chain.join(above, ["a", "b"])  # a row a key on each side: a node is one node's only child
    mine = draw(F.col("a"), F.col("b"))
    return met.where((mine > draw(F.col("xa"), F.col("xb"))) & (mine > draw(F.col("ca"), F.col("cb")))).select("a", "b", "ca", "cb", "pa", "pb", *sums)


def _compressed(left: DataFrame, spliced: DataFrame, sums: list[str]) -> DataFrame:
    none = F.lit(None).cast("long")
    kinds = ["a", "b", "gone", "to_ca", "to_cb", "to_pa", "to_pb", *[f"_{s}" for s in sums]]
    row = lambda a, b, gone, child, parent, plus: F.struct(*[c.alias(k) for c, k in zip([F.col(a), F.col(b), F.lit(gone), *child, *parent, *plus], kinds, strict=True)])
    no, zero = [none, none], [F.lit(0).cast("long")] * len(sums)
    each = F.array(
        row("a", "b", True, no, no, zero),
        row("pa", "pb", False, [F.col("ca"), F.col("cb")], no, [F.col(s) for s in sums]),
        row("ca", "cb", False, no, [F.col("pa"), F.col("pb")], zero),
    )
    changes = spliced.select(F.inline(each)).groupBy("a", "b").agg(F.max("gone").alias("gone"), *[F.max(k).alias(k) for k in kinds[3:7]], *[F.sum(k).alias(k) for k in kinds[7:]])
    met = left.join(changes, ["a", "b"], "left").where(~F.coalesce("gone", F.lit(False)))
    return met.select("a", "b", *[F.coalesce(f"to_{c}", c).alias(c) for c in ("pa", "pb")], "kids", *[F.coalesce(f"to_{c}", c).alias(c) for c in ("ca", "cb")], *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums])


def ends_hashed(ends: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """(a, b, sha256) of (a, b, conv): the hash of a node's ids in decimal, ascending and joined by commas.

    A node's ids become pieces in as many tasks as they lie in; its one hash then reads the pieces in turn and holds one.
    """
    most = params.piece_chars

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, size = None, [], 0
        for batch in batches:
            out = []
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now[:2] != (a, b) or size > most:
                    if now is not None:
                        out.append((*now, ",".join(ids)))
                    now, ids, size = (a, b, conv), [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield rows(out)
        if now is not None:
            yield rows([(*now, ",".join(ids))])

    def rows(out: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["a", "b", "first", "piece"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None

        def made(out: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["a", "b", "sha256"])

        for batch in batches:
            out = []
            for a, b, piece in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if now == (a, b):
                    h.update(f",{piece}".encode())
                    continue
                if now is not None:
                    out.append((*now, h.hexdigest()))
                now, h = (a, b), hashlib.sha256(piece.encode())
            yield made(out)
        if now is not None:
            yield made([(*now, h.hexdigest())])

    dealt = ends.select("a", "b", "conv").repartitionByRange("a", "b", "conv").sortWithinPartitions("a", "b", "conv")
    cut = dealt.mapInArrow(pieces, "a long, b long, first long, piece string")
    return cut.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(hashed, "a long, b long, sha256 string")


def trie(rows: DataFrame, convs: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `rows` are turns as `numbered` gives them, whose places have no gaps; `convs` (conv, n_turns) has every conversation
    once, also those without turns, which are members of the root alone. Without conversations there is no node. Prefixes
    are told apart by 128 bits: two of 10^12 are taken for one with a chance of some 10^-15.
    """
    found = staged(prefixes(rows), "prefixes")
    ends = found.join(convs.select("conv", F.col("n_turns").alias("pos")), ["conv", "pos"]).select("a", "b", "conv")
    zero = F.lit(0).cast("long")
    ends = ends.union(convs.where("n_turns = 0").select(zero, zero, "conv"))
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("n_bytes"))
    made = found.groupBy("a", "b").agg(F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("pos").cast("long").alias("depth"), F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes"))
    nodes = staged(root.unionByName(made), "nodes")
    kids = nodes.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("kids"), F.bit_xor("a").alias("ca"), F.bit_xor("b").alias("cb"))
    tree = nodes.join(kids, ["a", "b"], "left").select(
        "a", "b", "pa", "pb", *[F.coalesce(c, zero).alias(c) for c in ("kids", "ca", "cb")],
        F.when(F.col("kids").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    tree = staged(tree, "tree")
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    # the one join with many rows a key: a parent's id for each child, which Spark may split
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    named = staged(nodes.join(parents, ["pa", "pb"], "left"), "named")
    out = named.join(tree.select("a", "b", F.col("kids").alias("n_children")), ["a", "b"]).join(totals, ["a", "b"]).join(ends_hashed(ends, params), ["a", "b"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", params: TrieParams = TrieParams()) -> DataFrame:
    """`trie` of the conversations of `turns` as they are; `numbered` says what nulls, ties and repeated rows are.

    Other columns are ignored, so they may have any names. A conversation may have any number of turns, a prefix any
    number of members, and a node any number of children.
    """
    rows = staged(numbered(turns, conv_col, turn_col, role_col, text_col), "turns")
    return trie(rows, staged(_lengths(rows), "convs"), params)


def _lengths(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv").agg(F.max("pos").alias("n_turns"))


def rebuilt(rows: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """The turns and conversations that `trie` takes, each conversation c with the first h turns of c - c % family in place of its own.

    h is crc32(c in decimal) % most. The remainder is never negative. All of a shorter conversation's turns are taken, and
    none of one that isn't there; a conversation without further turns may be left without any.
    """
    lengths = _lengths(rows)
    base = F.expr(f"try_subtract(conv, pmod(conv, {family}))")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("long")
    bases = lengths.select(F.col("conv").alias("base"), F.col("n_turns").alias("there"))
    # what is lent: so many turns of at most `family` conversations for each base
    meta = lengths.select("conv", base.alias("base"), h.alias("h"), "n_turns").join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("there", F.lit(0))))
    meta = staged(meta.select("conv", "base", "h", "lent", (F.col("lent") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns")), "families")
    lent = rows.where(F.col("pos") < most).withColumnRenamed("conv", "base").join(meta.where("lent > 0"), "base").where("pos <= h")
    own = rows.join(meta, "conv").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("lent"))
    columns = ["conv", "pos", "a", "b", "n_bytes"]
    return lent.select(columns).union(own.select(columns)), meta.select("conv", "n_turns")


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    rows, convs = rebuilt(staged(numbered(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns"))
    return trie(rows, convs)


#: DuckDB has no CRC-32: it is folded from the id's digits, eight shifts a byte.
OP12_SQL = """
WITH turns AS (
  SELECT conv_id AS conv, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
  FROM conversations WHERE conv_id IS NOT NULL),
counted AS (SELECT conv, text, digest, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, digest) AS pos FROM turns),
sizes AS (SELECT conv, max(pos) AS n, conv - ((conv % 5) + 5) % 5 AS base,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda r, z: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT) % 9 AS h
  FROM counted GROUP BY conv),
families AS (SELECT s.*, least(s.h, coalesce(b.n, 0)) AS lent FROM sizes s LEFT JOIN sizes b ON b.conv = s.base),
rebuilt AS (
  SELECT f.conv, c.pos, c.text, c.digest FROM families f JOIN counted c ON c.conv = f.base AND c.pos <= f.h
  UNION ALL
  SELECT f.conv, c.pos - f.h + f.lent, c.text, c.digest FROM families f JOIN counted c ON c.conv = f.conv AND c.pos > f.h),
pre AS (
  SELECT conv, pos, strlen(text) AS n_bytes, string_agg(digest, '') OVER (PARTITION BY conv ORDER BY pos) AS path FROM rebuilt
  UNION ALL SELECT conv, 0, 0, '' FROM families),
last AS (SELECT conv, max(pos) AS pos FROM pre GROUP BY conv),
nodes AS (SELECT path, min(pos) AS depth, min(conv) AS conv_id, count(*) AS n_convs, min(n_bytes) AS n_bytes,
  CASE WHEN min(pos) > 0 THEN left(path, length(path) - 64) END AS parent FROM pre GROUP BY path),
kids AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
tree AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.parent = n.path),
totals AS (
  SELECT p.path, count(*) FILTER (t.n_children = 0) AS n_leaves, sum((t.n_convs - 1) * t.n_bytes) AS saved
  FROM tree t JOIN pre p ON p.conv = t.conv_id AND p.pos <= t.depth GROUP BY p.path),
ends AS (SELECT p.path, sha256(string_agg(p.conv::VARCHAR, ',' ORDER BY p.conv)) AS hash FROM pre p JOIN last l USING (conv, pos) GROUP BY p.path)
SELECT t.conv_id, t.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, t.n_convs, t.n_children, o.n_leaves,
       o.saved::BIGINT AS saved_tokens, coalesce(e.hash, sha256('')) AS ends_sha256
FROM tree t JOIN totals o ON o.path = t.path LEFT JOIN nodes up ON up.path = t.parent LEFT JOIN ends e ON e.path = t.path
"""
