import random
from itertools import combinations

import pytest

from strandwise.llm import similar
from strandwise.llm.similar import SimilarParams, drop_similar, key_of, similar_classes

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def sets(text, k=5):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def survivors(rows):
    """Brute force: the least id of each class that pairs of similarity 0.8 connect."""
    group = {i: i for i, _ in rows}
    own = {i: sets(t) for i, t in rows}
    for a, b in combinations(sorted(own), 2):
        if 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b]):
            x, y = sorted((group[a], group[b]))
            group = {k: x if v == y else v for k, v in group.items()}
    return sorted(set(group.values()))


@pytest.fixture(scope="module")
def texts():
    rng, out = random.Random(3), []
    for base in range(30):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((6, 40, 150, 400)))]
        out.append(words)
        for _ in range(4):  # one word changed each: from above the threshold to below it
            copy = list(words)
            for _ in range(rng.randrange(1, max(2, len(words) // 25))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            out.append(copy)
        out.append("one line that every text of the corpus has in common".split() + words[:8])
    return [(i, " ".join(w)) for i, w in enumerate(out)] + [(900, ""), (901, " "), (902, "two words")]


@pytest.mark.parametrize("params", [None, SimilarParams(radius=1, sample=1, common=3), SimilarParams(slice=200), SimilarParams(radius=1, common=0, slice=50)])
def test_stage_against_brute_force(spark, texts, params):
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    kept = drop_similar(docs, params=params) if params else corpus_pipeline.near(spark, docs, "")
    got = sorted(r["doc_id"] for r in kept.collect())
    assert got == survivors(texts)
    assert 30 < len(got) < len(texts)


def test_nulls_and_empty(spark, none):
    assert similar_classes(none).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (3, "a b c d e f"), (None, "alone")], "doc_id long, text string")
    got = similar_classes(docs).join(docs.withColumn("key", key_of("doc_id", "text")), "key").collect()
    assert len({r["root"] for r in got if r["text"] != "alone"}) == 1
    assert sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near(spark, docs, "").collect()), key=str) == [(3, "a b c d e f"), (None, "alone")]


@pytest.fixture(scope="module")
def crowd():
    """Copies of two texts with one to four words changed: each near its text or not, and most of them far from each other."""
    rng, out = random.Random(5), []
    for _ in range(2):
        words = [f"w{rng.randrange(3000)}" for _ in range(90)]
        out.append(words)
        for i in range(90):
            copy = list(words)
            for at in rng.sample(range(90), 1 + i % 4):
                copy[at] = f"x{rng.randrange(10**9)}"
            out.append(copy)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


def test_pairs_of_a_crowd_grow_with_its_texts(spark, crowd, monkeypatch):
    met = []
    verified = similar._verified
    monkeypatch.setattr(similar, "_verified", lambda pairs, *rest: met.append(pairs.count()) or verified(pairs, *rest))
    kept = drop_similar(spark.createDataFrame(crowd, "doc_id long, text string"), params=SimilarParams(radius=1))
    assert sorted(r["doc_id"] for r in kept.collect()) == survivors(crowd)
    assert sum(met) <= 4 * len(crowd)


@pytest.mark.parametrize("params", [SimilarParams(radius=1, rounds=0), SimilarParams(radius=1, rounds=1, extra=2, slice=300), SimilarParams(radius=1, extra=1000, sample=1)])
def test_rounds_and_longer_prefixes_lose_nothing(spark, crowd, texts, params):
    rows = texts + [(1000 + i, t) for i, t in crowd] + texts[:9]  # some rows repeat
    kept = drop_similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), params=params)
    assert sorted({r["doc_id"] for r in kept.collect()}) == survivors(list(dict(rows).items()))
