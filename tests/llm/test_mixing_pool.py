import pytest
from pyspark.sql import functions as F

from strandwise.llm.mixing import MixParams, mix


def frame(spark, sizes):
    rows = [(1000 * i + j, "word " * 20, f"s{i:03}", "en") for i, n in enumerate(sizes) for j in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def by_source(df, cap, budget):
    out = mix(df, params=MixParams(categories={"source": cap, "lang": 64, "topic": 16}, budget=budget))
    return {r["source"]: (r["p"], r["w"]) for r in out.groupBy("source").agg(F.max("mix_probability").alias("p"), F.max("mix_weight").alias("w")).collect()}


def test_equal_sources_have_equal_shares_beyond_the_cap(spark):
    got = by_source(frame(spark, [2] * 50), 5, 0.5)
    assert [p for p, _ in got.values()] == pytest.approx([0.5] * 50)
    assert [w for _, w in got.values()] == pytest.approx([0.02] * 50)


@pytest.mark.parametrize("budget", [0.2, 0.6, 0.9])  # the larger ones cut small sources at what they hold
def test_the_cap_changes_nothing(spark, budget):
    df = frame(spark, [1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    want = by_source(df, 64, budget)
    for cap in (1, 3, 9):
        got = by_source(df, cap, budget)
        whole = sum(w for _, w in got.values())
        assert whole == pytest.approx(1)
        if budget == 0.2:
            assert {k: p for k, (p, _) in got.items()} == pytest.approx({k: p for k, (p, _) in want.items()}, rel=1e-6)
        assert all(p <= 1 for p, _ in got.values())
