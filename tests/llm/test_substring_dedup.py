import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strandwise.llm.substring_dedup import SubstringParams, common_prefixes, remove_repeats, spans, suffix_array


def brute(docs, n):
    seen = Counter(d[i : i + n] for d in docs for i in range(len(d) - n + 1))
    out = []
    for d in docs:
        cut = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                cut[i : i + n] = b"\1" * n
        runs = len([r for r in bytes(cut).split(b"\0") if r])
        out.append((len(d), sum(cut), runs, hashlib.sha256(bytes(b for b, c in zip(d, cut, strict=True) if not c)).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abc dé\n") for _ in range(rng.randint(30, 300))) for _ in range(12)]
    docs = []
    for _ in range(100):
        d = ""
        for _ in range(rng.randint(0, 6)):
            c = rng.random()
            p = rng.choice(passages)
            if c < 0.4:
                d += p
            elif c < 0.6:
                k = rng.randrange(len(p))
                d += p[:k] + rng.choice("xyz") + p[k + 1 :]
            elif c < 0.7:
                d += rng.choice("ab") * rng.randint(1, 200)
            elif c < 0.75:
                d += "ab\0" * rng.randint(1, 60)
            else:
                d += "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 150)))
        docs.append(d)
    return docs + docs[:5] + [passages[0]] * 30


@pytest.mark.parametrize(("chunk", "shard", "common", "listed"), [(1 << 20, 1 << 19, 4096, 99), (97, 400, 4096, 0), (97, 400, 4, 999), (97, 4000, 30, 0)])  # the others cut texts, merge shards, and know common anchors, wide ones among them
def test_against_brute_force(spark, chunk, shard, common, listed):
    texts = corpus(5)
    rows = [*enumerate(texts), (900, None), (901, ""), (3, texts[3]), (3, "another text with this id"), (None, texts[4]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS h", "1 AS k1", "2 AS spans")
    got = remove_repeats(df, params=SubstringParams(40, chunk, shard, common, listed)).collect()
    want = brute([(t or "").encode() for _, t in rows], 40)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got), key=str) == sorted(((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=str)


def test_empty_and_text_ids(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([("a", "z" * 199), ("b", "q" * 201), ("c", "k" * 500 + "m"), ("d", "z" * 199)], "doc_id string, text string")
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(df).collect()}
    assert got == {"a": 0, "b": 201, "c": 500, "d": 0}


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for letters in (2, 5, 250):
        parts = [bytes(rng.integers(0, letters, rng.integers(1, 60)).astype(np.uint8)) for _ in range(40)] + [b"aaaaaaa", b"aaaaaaa", b"aaaa"]
        size = np.array([len(p) for p in parts])
        end = np.cumsum(size)
        data = np.frombuffer(b"".join(parts), np.uint8)
        left = np.repeat(end, size) - np.arange(len(data))
        sa = suffix_array(data, left, int(size.max()))
        strings = [bytes(data[i : i + left[i]]) for i in range(len(data))]
        assert sa.tolist() == sorted(range(len(data)), key=lambda i: (strings[i], i))
        before, common = common_prefixes(data, left, sa, end - size, size)
        for a, b in zip(sa, sa[1:], strict=False):
            x, y = strings[a], strings[b]
            k = next((t for t in range(min(len(x), len(y))) if x[t] != y[t]), min(len(x), len(y)))
            assert before[b] == a and common[b] == k


def test_spans():
    a, b = spans(np.array([5, 0, 3, 20]), np.array([9, 2, 5, 25]))
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 2), (3, 9), (20, 25)]
