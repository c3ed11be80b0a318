import math
import os
from collections import defaultdict

import numpy as np
import pytest

from strandwise.llm.whitening import WhiteningParams, deviations, fit, op11_whitening, whitened

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, scale=64, shift=1_000_000, k=16):
    """{vec_id: (deviation, projections)}, eigenvalues, trace and n by a dense eigen-decomposition."""
    ok = [(i, [math.floor(scale * c) + shift for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    listed = sorted({tuple(x) for _, x in ok})
    n, s = len(listed), [sum(col) for col in zip(*listed, strict=True)]
    c = np.array([[(n * a - b) / n for a, b in zip(x, s, strict=True)] for x in listed])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-13 * values.sum()).sum()))
    out = [(i, sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)), np.array([(n * a - b) / n for a, b in zip(x, s, strict=True)]) @ vectors[:, :k] / np.sqrt(values[:k])) for i, x in ok]
    return out, values, n, k


def check(got, rows, near=1e-8):
    want, values, n, k = plain(rows)
    own = defaultdict(list)
    for r in got:
        assert r["n"] == n and abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-9 and 0 <= r["identity_error"] < 1e-9
        own[r["vec_id"], r["deviation"]].append((r["component"], r["whitened"]))
    assert sum(map(len, own.values())) == k * len(want)
    found = np.array([[x for _, x in sorted(own[i, d])[:: len(own[i, d]) // k]] for i, d, _ in want])
    wanted = np.array([w for *_, w in want])
    signs = np.sign((found * wanted).sum(0))
    assert np.abs(found * signs - wanted).max() < near


@pytest.mark.parametrize("d, spectrum", [(64, "flat"), (64, "steep"), (40, "one"), (7, "flat"), (100, "steep")])
def test_against_a_dense_decomposition(spark, d, spectrum):
    rng = np.random.default_rng(d)
    scales = {"flat": np.linspace(1, 2, d), "steep": 2.0 ** -np.arange(d), "one": np.r_[500, np.linspace(1, 3, d - 1)]}[spectrum]
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    v = (rng.standard_normal((900, d)) * scales * 30) @ turn
    rows = [(i, x) for i, x in enumerate(v.tolist())]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # a hot vector counts once
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(whitened(df).collect(), rows, 1e-4 if spectrum == "steep" else 1e-8)  # both lose what the covariance's rounding hides of the least of steep spectra


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, x) for i, x in enumerate(rng.standard_normal((200, 5)).tolist())]
    odd = [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0]), (303, [float("nan")] * 5), (304, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (305, [1.0, 2.0]), (306, [1e30, 0.0, 0.0, 0.0, 0.0])]
    rows += [(None, rows[0][1]), (7, rows[7][1])]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    for c in ("id", "x", "i", "v", "n", "component"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    got = whitened(df).collect()
    assert {r["vec_id"] for r in got} == {r[0] for r in rows}
    check(got, rows)


def test_few_vectors(spark):
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert whitened(df([])).count() == 0 and whitened(df([(1, [2.0, 3.0])] * 3)).count() == 0
    got = whitened(df([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0])])).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"], abs(round(r["whitened"], 12)), round(r["explained"], 12)) for r in got) == [(1, 1, 2, 64**2, 1, 1), (2, 1, 2, 64**2, 1, 1), (3, 1, 2, 64**2, 1, 1)]


def test_large_entries_are_exact(spark):
    rows = [(1, [2.0**50, 1.0]), (2, [-(2.0**50), 2.0]), (3, [5.0, 2.0**40])]
    got = {r["vec_id"]: r["deviation"] for r in whitened(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: None, 2: None, 3: None}  # beyond 64 bits
    off, rest = np.array([[3037000499], [3037000500], [1 << 40], [5]]), np.array([0])
    assert deviations(off, rest, 1) == [3037000499**2, None, None, 25]


def test_the_block_grows_where_the_spectrum_is_flat(spark):
    """With a narrow guard the residuals shrink slowly; more columns make them shrink."""
    rng = np.random.default_rng(5)
    rows = [(i, x) for i, x in enumerate((rng.standard_normal((2000, 48)) * 20).tolist())]
    df = spark.createDataFrame(rows, SCHEMA)
    check(whitened(df, params=WhiteningParams(guard=1, degree=4)).collect(), rows, 1e-7)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    got = op11_whitening(spark, folder)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()])


def test_an_empty_list_has_no_fit(spark):
    assert fit(spark.createDataFrame([], "x array<long>")) is None
