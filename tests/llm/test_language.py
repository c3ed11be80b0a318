import numpy as np

from strandwise.llm.language import Applied, LanguageParams, identify, learn, op5_language, train, windows_of
from tests.llm.conftest import text

FAST = LanguageParams(sample_docs=200, steps=150)


def test_held_out_accuracy(spark):
    rows = [(text("en" if i % 2 else "de", 30, i), "en" if i % 2 else "de") for i in range(300)]
    net = train([t.encode()[:256] for t, _ in rows[:200]], [x for _, x in rows[:200]], FAST)
    got, scores = Applied(net)([t for t, _ in rows[200:]])
    assert np.mean([g == x for g, (_, x) in zip(got, rows[200:], strict=True)]) > 0.97
    assert all(0 <= s <= 1 for s in scores)


def test_edges(docs, rows):
    net = learn(docs, params=FAST)
    got = identify(docs, net).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
        assert r["keep_id"] == "clash" and 0 <= r["score"] <= 1


def test_empty_and_unlabelled(none, docs):
    net = learn(none, params=FAST)
    assert net.langs == ()
    assert identify(none, net).count() == 0
    assert {r["lang_pred"] for r in identify(docs, net).collect()} == {"und"}


def test_whole_texts_count():
    net = train([text("en", 40, i).encode()[:256] for i in range(60)] + [text("de", 40, i).encode()[:256] for i in range(60)], ["en"] * 60 + ["de"] * 60, FAST)
    mixed = text("en", 20, 1) + " " + " ".join(text("de", 100, k) for k in range(10))
    assert Applied(net)([mixed])[0] == ["de"]


def test_windows():
    x, n = windows_of([b"", b"abc", b"a" * 9], 4)
    assert n.tolist() == [1, 1, 3] and x.shape == (5, 4) and x[1].tolist() == [97, 98, 99, 0] and x[4].tolist() == [97, 0, 0, 0]


def test_lookup_equals_convolution():
    rng = np.random.default_rng(0)
    net = train([b"abc def", b"xyz uvw"], ["a", "b"], LanguageParams(steps=5, window=32))
    x = rng.integers(0, 256, (3, 32)).astype(np.uint8)
    pooled = []
    for k, kernel, shift in zip(net.widths, net.kernels, net.shifts, strict=True):
        r = np.array([[sum(net.embed[x[b, t + j]] @ kernel[j] for j in range(k)) + shift for t in range(32 - k + 1)] for b in range(3)])
        pooled.append(np.maximum(r.max(axis=1), 0))
    z = np.concatenate(pooled, axis=1) @ net.dense + net.base
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(Applied(net).probabilities(x), p, atol=1e-4)


def test_query_learns_from_its_fold_only(spark, sf, docs):
    import zlib

    got = op5_language(spark, sf(documents=docs)).collect()
    for r in got:
        want = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == want


def test_figures_are_no_letters(spark):
    net = train([b"abc def", b"xyz uvw"], ["a", "b"], LanguageParams(steps=5))
    odd = ["½", "²", "Ⅷ", "① 12", "_", "", None, "1 é", "Ω", "ª"]
    assert [x == "und" for x in Applied(net)(odd)[0]] == [True] * 7 + [False] * 3


def test_a_repeated_id_is_learnt_from_once(spark):
    rows = [(1, text("en", 9, i), "en") for i in range(50)] + [(2, text("de", 9, 1), "de")]
    from pyspark.sql import functions as F

    net = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), order=F.col("doc_id"), params=FAST)
    assert net.langs == ("de", "en")


def test_scores_against_a_plain_network(spark):
    """Whole texts by loops: windows, convolutions, largest responses, softmax, mean by bytes."""
    bodies = [text("en", 60, i) for i in range(4)] + [text("de", 200, i) for i in range(4)] + ["ß"]
    net = train([b.encode()[:64] for b in bodies], ["en"] * 4 + ["de"] * 4 + ["de"], LanguageParams(steps=20, window=64))
    df = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in identify(df, net).collect()}
    for i, b in enumerate(bodies):
        data, total = b.encode(), np.zeros(2)
        for at in range(0, len(data), 64):
            part = data[at : at + 64]
            full = part + bytes(64 - len(part))
            pooled = []
            for k, kernel, shift in zip(net.widths, net.kernels, net.shifts, strict=True):
                pooled.append(np.maximum(np.max([sum(net.embed[full[t + j]] @ kernel[j] for j in range(k)) + shift for t in range(64 - k + 1)], axis=0), 0))
            z = np.exp(np.concatenate(pooled) @ net.dense + net.base)
            total += z / z.sum() * len(part)
        assert got[i]["lang_pred"] == net.langs[total.argmax()] and abs(got[i]["score"] - total.max() / len(data)) < 1e-3
