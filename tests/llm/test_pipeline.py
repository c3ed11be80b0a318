import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_keep_the_columns_and_take_effect(spark, sf, docs, none):
    folder = sf(documents=docs)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [{r["text"] for r in frame.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, folder)
        assert out.columns == frame.columns, name
        frame = out.cache()
        texts.append({r["text"] for r in frame.collect()})
    langs, exact, near, mixed = texts[1:]
    assert not langs & {None, "", "12345 !!! ...", " \n\t "}
    assert exact == langs and near <= exact and mixed < near
    ids = [r["doc_id"] for r in frame.collect()]
    assert len(ids) == len(set(ids))


def shingles(t):
    w = (t or "").lower().encode().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_each_stage_against_a_plain_version(spark, sf, docs):
    from strandwise.llm import language, mixing

    folder = sf(documents=docs)
    stages = dict(corpus_pipeline.STAGES)
    first = spark.read.parquet(f"{folder}/documents.parquet")
    rows = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)

    kept = stages["language_id"](spark, first, folder).cache()
    net = language.learn(first.where(language.fold("doc_id", 4) != 2), order=first.doc_id)
    applied, want = language.Applied(net), []
    for r in rows(first):
        (lang,), (score,) = applied([r[1]])
        if lang != "und" and score >= corpus_pipeline.LEAST_SCORE:
            want.append(r)
    assert rows(kept) == want

    once = stages["exact_dedup"](spark, kept, folder).cache()
    best = {}
    for i, t in rows(kept):
        best[t or ""] = i if t not in best or best[t] is None else best[t] if i is None else max(i, best[t])
    assert rows(once) == sorted(((i, t) for t, i in best.items()), key=repr)

    near = stages["simhash_dedup"](spark, once, folder).cache()
    own = rows(once)
    sets, root = [shingles(t) for _, t in own], list(range(len(own)))
    for i in range(len(own)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    classes = {}
    for r, row in zip(root, own, strict=True):
        classes.setdefault(r, []).append(row)
    assert rows(near) == sorted((min(c, key=lambda r: (r[0] is None, r[0] or 0)) for c in classes.values()), key=repr)

    mixed = stages["mixing"](spark, near, folder).cache()
    assert rows(mixed) == rows(mixing.mix(near).where("mix_sampled"))  # whose probabilities have a test of their own

    packed = stages["packing"](spark, mixed, folder).collect()
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows(mixed)}
    got, places = {}, {}
    for r in packed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == length
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


def test_run(spark, sf, docs):
    got = corpus_pipeline.run(spark, sf(documents=docs)).collect()
    assert got and {"doc_id", "piece", "sequence_id", "offset"} <= set(got[0].asDict())


def test_no_rows(spark, sf, none):
    assert corpus_pipeline.run(spark, sf(documents=none)).count() == 0
