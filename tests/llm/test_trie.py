import hashlib
import os
import random
import zlib
from collections import defaultdict

import pytest

from strandwise.llm.trie import OP12_SQL, TrieParams, ends_hashed, op12_prefix_trie, prefix_trie, subtree_totals

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(convs):
    """Rows of the trie of {conv: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p))))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items())


def grouped(rows):
    out = defaultdict(list)
    digest = lambda r: hashlib.sha256(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    signed = lambda d: [int.from_bytes(d[k : k + 8], signed=True) for k in (0, 8)]
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, signed(digest(r)))):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return dict(out)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def result(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(4)
    rows = []
    for c in [*range(-7, 90), 2**62, -(2**63), 2**63 - 1]:
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, "user" if t % 2 else "system", rng.choice(["same", "é" * 5, "x" * rng.randint(0, 3)])))
    rows += [(100 + i, t, "user", "copy") for i in range(60) for t in range(3)]  # a hot conversation
    rows += [(300, t, "user", f"long {t % 3}") for t in range(400)]  # a long one
    rows += [(None, 0, "user", "no id"), (400, None, None, None), (400, None, "a", None), (400, 2, "a", "tie"), (400, 2, "b", "tie"), (401, 1, "r", "twice"), (401, 1, "r", "twice"), (402, 0, "ab", "c"), (403, 0, "a", "bc")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("conv", "pos", "a", "b", "depth", "kids", "n_convs"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    return df


def test_trie(spark, turns):
    assert result(prefix_trie(frame(spark, turns), params=TrieParams(piece_chars=20))) == plain(grouped(turns))


def test_query(spark, turns, sf):
    assert result(op12_prefix_trie(spark, sf(conversations=frame(spark, turns)))) == plain(rebuilt(grouped(turns)))


def test_empty(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert result(prefix_trie(spark.createDataFrame([(5, 0, "u", "t")], SCHEMA))) == plain({5: [("u", "t")]})


def test_whole_table_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    import duckdb

    table = f"{folder}/conversations.parquet"
    got = result(op12_prefix_trie(spark, folder))
    assert got == plain(rebuilt(grouped([tuple(r) for r in spark.read.parquet(table).select("conv_id", "turn", "role", "text").collect()])))
    sql = duckdb.connect().execute(OP12_SQL.replace("FROM conversations", f"FROM '{table}'"))
    assert [d[0] for d in sql.description] == COLUMNS and sorted(sql.fetchall()) == got


@pytest.mark.parametrize("shape", ["path", "star", "random", "broom"])
def test_contraction(spark, shape):
    rng = random.Random(shape)
    n = 90
    parent = {i: {"path": i - 1, "star": 0, "random": rng.randrange(i), "broom": i - 1 if i < 45 else rng.randrange(40, 45)}[shape] for i in range(1, n)}
    name = {i: rng.getrandbits(62) for i in range(n)}
    kids = defaultdict(list)
    for i, p in parent.items():
        kids[p].append(i)
    xor = lambda ids: __import__("functools").reduce(int.__xor__, ids, 0)
    rows = [(name[i], i, name[parent[i]] if i else None, parent[i] if i else None, len(kids[i]), xor(name[k] for k in kids[i]), xor(kids[i]), i, 1) for i in range(n)]
    got = subtree_totals(spark.createDataFrame(rows, "a long, b long, pa long, pb long, kids long, ca long, cb long, v long, one long"), ["v", "one"])
    want = {i: [i, 1] for i in range(n)}
    for i in range(n - 1, 0, -1):
        want[parent[i]] = [x + y for x, y in zip(want[parent[i]], want[i], strict=True)]
    assert sorted((r["b"], r["v"], r["one"]) for r in got.collect()) == [(i, *want[i]) for i in range(n)]


def test_ends_stream_in_pieces(spark):
    ids = random.Random(1).sample(range(-(10**6), 10**6), 3000)
    df = spark.createDataFrame([(i % 3, 0, i) for i in ids], "a long, b long, conv long").repartition(7)
    for most in (1, 50, 1 << 16):
        got = {r["a"]: r["sha256"] for r in ends_hashed(df, TrieParams(piece_chars=most)).collect()}
        assert got == {k: hashlib.sha256(",".join(str(i) for i in sorted(ids) if i % 3 == k).encode()).hexdigest() for k in range(3)}
