import random

import numpy as np

from strandwise.llm.quality import FEATURES, QualityParams, features, fit, learn, op7_quality, rate
from tests.llm.conftest import text


def junk(i):
    rng = random.Random(i)
    return " | ".join(w for w in text("en", 30, i).split()) if rng.random() < 0.5 else text("en", 40, i).upper().replace(" ", "!! ")


def test_held_out_accuracy(spark, sf):
    rows = [(i, junk(i) if i % 4 == 0 else text("en", 40, i)) for i in range(400)] + [(900, None), (901, ""), (None, "no id"), (902, "x" * 200000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS score", "1 AS _id", "2 AS x")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(5, None, 1), (None, 1, 0), (7, 9, 0), (900, 0, 0), (10, 1, 0)], "doc_id long, quality int, toxic int")
    got = op7_quality(spark, sf(documents=docs, labels=labels)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 != 0) for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(1, 1)], none.schema), spark.createDataFrame([(1, 0)], none.schema)):
        got = rate(docs, learn(docs, labels), ["doc_id"]).collect()
        assert len(got) == 2 and all(0 <= r["score"] <= 1 for r in got)
    assert rate(docs.limit(0), learn(docs.limit(0), none), ["doc_id"]).count() == 0


def test_preferences_are_learnt():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, FEATURES))
    y = (x[:, 2] + 0.5 * x[:, 4] + 0.1 * rng.normal(size=300) > -0.5).astype(int)
    model = fit(x, y, 1 - y.mean(), QualityParams(pairs=4000))
    s = model(x)
    good, bad = s[y == 1], s[y == 0]
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert abs((s < 0.3).mean() - (1 - y.mean())) < 0.02


def plain_features(body):
    """The same by loops over bytes."""
    from strandwise.llm.quality import _CLASS, _PAIR, BUCKETS, CLASSES

    pairs, whole, most = [0] * BUCKETS, [0] * CLASSES, [0] * CLASSES
    for a, b in zip(body, body[1:], strict=False):
        pairs[_PAIR[a * 256 + b]] += 1
    for at in range(0, len(body), 128):
        own = [0] * CLASSES
        for b in body[at : at + 128]:
            own[_CLASS[b]] += 1
        whole = [x + y for x, y in zip(whole, own, strict=True)]
        most = [max(x, y) for x, y in zip(most, own, strict=True)]
    words, lines = body.split(), [x for x in body.split(b"\n") if x.strip()]
    root = lambda v, n: [(x / n) ** 0.5 for x in v]
    tail = [1.0, np.log1p(len(words)) / 10, len(body) / (len(words) or 1) / 20, len(set(words)) / (len(words) or 1), 1 - len(set(lines)) / (len(lines) or 1)]
    return [*root(pairs, max(1, len(body) - 1)), *root(whole, len(body)), *root(most, 128), *tail]


def test_features(monkeypatch):
    from strandwise.llm import quality

    assert not features(b"").any() and features(b"\n \n").shape == (FEATURES,)
    monkeypatch.setattr(quality, "CHUNK", 256)
    for body in (b"a", b"Ab1 \n|%%\x00\xc3\xa9" * 40, bytes(range(256)) * 5, b"one line\none line\n"):
        assert np.allclose(features(body), plain_features(body))


def test_the_whole_query_against_a_plain_one(spark, sf):
    import zlib

    rows = [(i, junk(i) if i % 3 == 0 else text("en", 30, i)) for i in range(120)] + [(7, text("en", 30, 7))] * 3 + [(500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    got = op7_quality(spark, sf(documents=docs, labels=labels)).collect()
    own = sorted((np.array(plain_features(t.encode()), np.float32).tobytes(), int(i % 3 != 0)) for i, t in dict(rows).items() if i < 120 and zlib.crc32(str(i).encode()) % 5)
    x, y = np.array([np.frombuffer(v, np.float32) for v, _ in own], float), np.array([k for _, k in own])
    model = fit(x, y, 1 - y.mean())
    want = {i: model(np.array([plain_features(t.encode()) if t else [0.0] * FEATURES]))[0] for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-6 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_every_labelled_row_is_learnt_from(spark):
    """A sign that one labelled row alone has moves the score, however many rows there are, and blocks rank as one fit does."""
    rows = [(i, junk(i) if i % 4 == 0 else text("en", 30, i)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)], "doc_id long, quality int")
    params = QualityParams(block_docs=50, least_docs=20, pairs=500, steps=100)
    for odd in (21, 140, 399):
        docs = spark.createDataFrame([(i, t + " ~~~~" * 9 if i == odd else t) for i, t in rows], "doc_id long, text string")
        model = learn(docs, labels, params=params)
        sign = model.weights[np.flatnonzero(features(b"~~~~"))[0]]
        assert sign > 0 if odd % 4 else sign < 0
    got = rate(docs, model, ["doc_id"]).collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 != 0) for r in got]) > 0.97


def test_few_labels_of_a_kind_reach_every_block(spark):
    rows = [(i, junk(i) if i < 3 else text("en", 30, i)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = learn(docs, spark.createDataFrame([(i, int(i >= 3)) for i in range(300)], "doc_id long, quality int"), params=QualityParams(block_docs=50, least_docs=3, pairs=500, steps=100))
    bad = [r["doc_id"] for r in rate(docs, model, ["doc_id"]).where("predicted = 0").collect()]
    assert sorted(bad) == [0, 1, 2]


def test_texts_are_not_shuffled(spark, monkeypatch):
    """Labels of any size come to the texts; joined by sorting, beyond the bound, they give the same."""
    from strandwise.llm import quality

    rows = [(i, junk(i) if i % 4 == 0 else text("en", 30, i)) for i in range(200)] + [(3, "another text of 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)] + [(4, 1), (5, 1)], "doc_id long, quality int")
    plans = {}

    def kept(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, label)

    staged = quality.staged
    monkeypatch.setattr(quality, "staged", kept)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = learn(docs, labels)
        assert "SortMergeJoin" not in plans["labelled-features"] and "BroadcastHashJoin" in plans["labelled-features"]
        other = learn(docs, labels, params=QualityParams(broadcast_rows=0))
        assert "SortMergeJoin" in plans["labelled-features"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert np.allclose(model.weights, other.weights) and abs(model.cut - other.cut) < 1e-6
