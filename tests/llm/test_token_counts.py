import random

import pytest

from strandwise.llm import token_counts
from strandwise.llm.token_counts import Counter, CountParams, TokenCache, count_tokens, folds, normalised, op13_token_counts

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def plain(path):
    if path.endswith(".json"):
        tok = tokenizers.Tokenizer.from_file(path)
        return lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda t: len(model.encode(t))


def result(df):
    return sorted(map(str, df.collect()))


def wanted(rows, path, limit=2048):
    from pyspark.sql import Row

    count = plain(path)
    made = ((r[0], len((r[1] or "").encode()), count(r[1] or "")) for r in rows)
    return sorted(str(Row(doc_id=i, n_bytes=b, n_tokens=n, over_limit=n > limit)) for i, b, n in made)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_against_the_library(spark, docs, rows, name):
    path = public.path(name)
    assert result(count_tokens(docs, TokenCache(spark), params=CountParams(path, limit=60))) == wanted(rows, path, 60)


def test_query(spark, docs, sf, rows):
    got = op13_token_counts(spark, sf(documents=docs))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert result(got) == wanted(rows, PATH)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    import os

    if not os.path.isdir(folder):
        pytest.skip("no test data")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(op13_token_counts(spark, folder)) == wanted(rows, PATH)


def test_empty(spark, none):
    assert count_tokens(none, TokenCache(spark)).count() == 0


def test_normalising_keeps_the_counts(spark):
    rng = random.Random(3)
    odd = ["H̱ ẖ", "<|EndOfText|> <|endoftext|>a", "a<|endoftext|>", "<|start\noftext|>", "ΑΣ ΑΣ.", "İI ı", "́a ́", "a b c\x0bd\x0ce\x85f\x1cg", "DON'T we'LL 'S", "ﬁ ½ x²", "日本 語", "​ zero", "A" * 200 + " " + "x1" * 90, "é.É, naïve’s d'accord' l'été!! ß. ǅ. İ. a<| a.<|endoftext|> <| o'", "ﬀ ª º."]
    letters = "aB é́Éß.,'<|>_ \n\t1²日Σ̱H"
    odd += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    got = [r[0] for r in df.select(normalised(df.t, folds(PATH))).collect()]
    count, counter = plain(PATH), Counter(PATH, CountParams(cache_words=50))
    assert counter.count(got) == [count(t) for t in odd]
    assert len(counter.known) <= 50


def test_only_distinct_misses_are_encoded(spark, tmp_path, monkeypatch):
    cache = TokenCache(spark, f"file://{tmp_path}/cache")
    df = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    seen = []
    real = token_counts.encoded
    monkeypatch.setattr(token_counts, "encoded", lambda texts, *a: (seen.append(sorted(r["body"] for r in texts.collect())), real(texts, *a))[1])
    first = result(count_tokens(df(["One two", "one  TWO ", "three", None, ""]), cache))
    assert seen == [["", "one two", "three"]]
    assert result(count_tokens(df(["One two", "one  TWO ", "three", None, ""]), cache)) == first and len(seen) == 1
    count_tokens(df(["three", "four", "ONE two", "four\n"]), cache)
    assert seen[1:] == [["four"]]
    for rows in (0, 1):  # more misses than may be broadcast
        count_tokens(df([f"five {rows}", f"six {rows}", "four"]), cache, params=CountParams(broadcast_rows=rows))
        assert seen[-1] == [f"five {rows}", f"six {rows}"]
    count_tokens(df(["three"]), cache, params=CountParams(public.path("byte_bpe_50k.json")))
    assert seen[-1] == ["three"]  # another tokenizer's counts are no hits


def test_digests_that_two_jobs_added_count_once(spark, tmp_path):
    cache = TokenCache(spark, f"file://{tmp_path}/cache")
    docs = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id long, text string")
    version = token_counts.version(PATH)
    count_tokens(docs, cache)
    cache.append(version, cache.counts(version))
    assert count_tokens(docs, cache).count() == 2
