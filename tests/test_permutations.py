import os
import zlib

import numpy as np
import pytest

from strandwise.operators.kernels import permutation_p
from strandwise.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_query_takes_2000_shuffles(spark):
    for r in catalogue.QUERIES["perm_pvalue"](spark, FOLDER).collect():
        assert r["p"] * 2001 == pytest.approx(round(r["p"] * 2001), abs=1e-6) and round(r["p"] * 2001) >= 1


def test_against_plain_shuffles(spark):
    rng = np.random.default_rng(4)
    own = [(rng.normal(size=7), rng.normal(size=7)), (np.ones(5), rng.normal(size=5)), (rng.integers(0, 3, 9).astype(float), rng.normal(size=9))]
    rows = [("p", s, t, float(x), float(y)) for s, (a, b) in enumerate(own) for t, (x, y) in enumerate(zip(a, b, strict=True))]
    got = permutation_p(spark.createDataFrame(rows, "pair string, series int, t int, x double, y double"), "pair", "series", "t", "x", "y", 300).first()
    draw, hits = np.random.default_rng(zlib.crc32(b"p")), 0
    seen = abs(np.mean([np.corrcoef(*own[i])[0, 1] for i in (0, 2)]))
    for _ in range(300):
        mixed = [draw.permutation(a) for a, _ in own]
        hits += abs(np.mean([np.corrcoef(mixed[i], own[i][1])[0, 1] for i in (0, 2)])) >= seen - 1e-12
    assert got["n_series"] == 2 and got["p"] == pytest.approx((1 + hits) / 301)
