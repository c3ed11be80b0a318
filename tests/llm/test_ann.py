import math

import numpy as np
import pytest

from strandwise.llm.ann import Forest, ForestParams, nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, qids, k=20):
    own = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in own:
        if q in qids:
            out[q] = sorted(((-float((w * v).sum()), i) for i, w in own if i != q))[:k]
    return out


def make(n=600, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(50)]  # a hot vector
    return rows + [(2000, None), (2001, [0.0] * 8), (2002, [math.nan] * 8), (2003, [1.0, None] * 4), (2004, [math.inf] + [1.0] * 7), (2005, [1.0] * 3), (2006, []), (None, [1.0] * 8)]


def test_recall_scores_and_order(spark):
    rows = make()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS rank", "2 AS id", "3 AS shard")
    for params in (ForestParams(trees=60), ForestParams(trees=60, directions=(32, 8), rate=1.2, shard_rows=200, block_rows=20)):
        got = nearest(df, df.where("vec_id % 20 = 0"), params=params).collect()
        want = brute(rows, {i for i, _ in rows if i is not None and i % 20 == 0})
        by = {}
        for r in got:
            by.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
        assert set(by) == set(want)
        hit = 0
        vec = {i: np.array(v, float) for i, v in rows if i in want or (v and len(v) == 8 and None not in v)}
        for q, own in by.items():
            own.sort()
            assert [r for r, _, _ in own] == list(range(1, 21)) and [x[1:] for x in own] == sorted(x[1:] for x in own)
            assert all(i != q and abs(-s - float((np.array(vec[i], np.float32).astype(float) * np.array(vec[q], np.float32).astype(float)).sum())) < 1e-9 for _, s, i in own)
            hit += len({i for _, _, i in own} & {i for _, i in want[q]})
        assert hit / (20 * len(want)) >= 0.9


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (20, [1.0, 1.0])], SCHEMA)
    got = nearest(df, df.where("vec_id % 20 = 0")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, empty).count() == 0
    assert nearest(df, empty).count() == 0


def test_work_and_order_of_the_ascent():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(4000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)  # then a query hashes as its own vector does
    forest = Forest(vectors, ForestParams(trees=200, directions=(128, 16)))
    low, high = forest.ranges(vectors[:5])
    for t, (keys, order) in enumerate(zip(forest.keys, forest.order, strict=True)):
        assert (np.diff(keys) >= 0).all()
        for level, span in enumerate((1, 32, 256 * 32)):  # all symbols, the first, none
            for q in range(5):
                code = keys[np.flatnonzero(order == q)[0]]
                want = set(order[keys // span == code // span].tolist())
                assert want == set(order[low[t, level, q] : high[t, level, q]].tolist())
    met = [set(c.tolist()) for c in forest.candidates(vectors[:5], 300)]
    more = [set(c.tolist()) for c in forest.candidates(vectors[:5], 600)]
    assert all(q in m and m < n and 300 <= len(m) < 600 <= len(n) < 900 for q, (m, n) in enumerate(zip(met, more, strict=True)))
    for q, own in enumerate(met):  # the whole of a level, or of a tree's range of it, and nothing beside
        assert own == set().union(*[set(order[low[t, k, q] : high[t, k, q]].tolist()) for t, order in enumerate(forest.order) for k in range(3) if set(order[low[t, k, q] : high[t, k, q]].tolist()) <= own])


def clustered(n, size, noise, seed=0, d=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(-(-n // size), d))
    return np.repeat(centres, size, 0)[:n] + noise * rng.normal(size=(n, d))


@pytest.mark.parametrize("n, size, noise", [(60, 4, 0.05), (100, 10, 0.05), (400, 10, 0.05), (1000, 10, 0.1), (2000, 10, 0.3), (2000, 1, 1.0), (6000, 10, 0.05), (6000, 6000, 0.02)])
def test_recall_by_density(n, size, noise):
    """Near vectors that all trees meet together count once, so queries go on to 20 others and to the right ones."""
    v = clustered(n, size, noise)
    params, queries = ForestParams(), np.arange(0, n, max(20, n // 60))
    hit = 0
    for q, own in zip(queries, Forest(v, params).candidates(v[queries], params.need(n, n)), strict=True):
        score = v @ v[q]
        score[q] = -np.inf
        own = own[own != q]
        assert len(set(own.tolist())) == len(own) >= min(20, n - 1)
        hit += len(set(np.argsort(-score, kind="stable")[:20].tolist()) & set(own.tolist())) / 20
    assert hit / len(queries) >= 0.9


def test_twenty_rows_for_each_query(spark):
    for n, size in ((60, 4), (100, 10), (400, 10)):
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(clustered(n, size, 0.05))], SCHEMA)
        got = nearest(df, df.where("vec_id % 20 = 0"), params=ForestParams(trees=80)).groupBy("query_id").count().collect()
        assert len(got) == n // 20 and all(r["count"] == 20 for r in got)


def test_repeats_lengths_and_overflow(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [0.5, 0.5]), (3, [3.0]), (4, [2.0]), (5, [1e200, 1e200]), (6, [1e200, -1e200]), (7, [1e200, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "9 AS query_id", "8 AS score")
    got = {}
    for r in nearest(df, df.union(df.where("vec_id = 1"))).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got[3] == [(4, 6.0)] and got[4] == [(3, 6.0)]
    assert got[2][:3] == [(5, 1e200), (7, 1e200), (1, 1.0)]  # the better of both vectors of 1, listed once
    assert [v for v, _ in got[1]] == [5, 7, 6, 2] and got[1][0][1] == 2e200
    assert got[5][0] == (7, math.inf) and got[5][-1][0] == 6 and math.isnan(got[5][-1][1])
