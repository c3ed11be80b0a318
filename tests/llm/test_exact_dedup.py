import hashlib
from collections import defaultdict

import pytest

from strandwise.llm.exact_dedup import ExactDedupParams, directory, exact_dedup, slots


@pytest.mark.parametrize("bits", [64, 3])  # 3: every bucket is a chain of collisions
@pytest.mark.parametrize("hot_rows", [4096, 2])  # 2: most keys are divided among owners
def test_against_brute_force(docs, rows, bits, hot_rows):
    got = exact_dedup(docs, params=ExactDedupParams(bucket_capacity=4, hot_rows=hot_rows, key_bits=bits, broadcast_rows=0 if bits == 3 else 99)).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    assert len(got) == len(rows)
    for r in got:
        text = next(t for t, ids in groups.items() if r["doc_id"] in ids and hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = groups[text]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    for text, ids in groups.items():
        kept = [r["doc_id"] for r in got if r["kept"] and r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()]
        assert kept == [max((i for i in ids if i is not None), default=None)]


def test_empty(none):
    assert exact_dedup(none).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    top = lambda *bits: sum(b << (63 - i) for i, b in enumerate(bits)) - ((1 << 64) if bits[0] else 0)
    keys = [(top(0, 0, 0) + i,) for i in range(9)] + [(top(0, 0, 1) + i,) for i in range(2)] + [(top(1, 0) + i,) for i in range(2)]
    depth, buckets = directory(spark.createDataFrame(keys, "key long"), 4, ExactDedupParams(bucket_capacity=4))
    own = {(r["local_depth"], r["prefix"]): r["keys"] for r in buckets.collect()}
    assert own[1, 1] == 2  # this half never split, the other one split until its keys, which differ in their last bits, part
    assert depth > 60 and sum(own.values()) == 13 and max(own.values()) <= 4
    shallow = spark.createDataFrame([(0, 2, 1), (1, 2, 1), (1, 1, 1)], "prefix long, local_depth int, keys long")
    assert {(r["slot"], r["local_depth"]) for r in slots(shallow, 2).collect()} == {(0, 2), (1, 2), (2, 1), (3, 1)}


def test_a_chain_is_split_by_bytes(spark):
    rows = [(i, f"text {i % 3}") for i in range(12)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), params=ExactDedupParams(key_bits=1, bucket_capacity=1)).collect()
    assert {tuple(r["bucket"]) for r in got} <= {(1, 0), (1, 1)}  # at most two keys, two buckets for three texts
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in got} == {i: (9 + i % 3, 4, i >= 9) for i, _ in rows}


def test_the_directory_places_the_rows(spark, monkeypatch):
    from strandwise.llm import exact_dedup as m

    df = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string")
    real = m.directory
    monkeypatch.setattr(m, "directory", lambda *a: (lambda d, b: (d, b.where("prefix % 2 = 0")))(*real(*a)))
    assert 0 < m.exact_dedup(df, params=ExactDedupParams(bucket_capacity=8)).count() < 100


def test_repeated_rows_over_owners_and_carried_columns(spark):
    rows = [(7, "hot", 1)] * 30 + [(None, "hot", 2)] * 5 + [(None, "none", 3)] * 4 + [(3, None, 4), (4, "", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, owner int").repartition(6)
    got = exact_dedup(df, carry=df.columns, params=ExactDedupParams(hot_rows=3)).where("kept").select("carried.*", "keep_id", "group_size").collect()
    assert sorted((r["text"] or "", r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [("", 4, 4, 2), ("hot", 7, 7, 35), ("none", None, None, 4)]
