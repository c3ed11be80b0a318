import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pytest

from strandwise.llm.packing import PackingParams, WordTokenizer, cuts, pack, plan

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


def test_round_trip(docs, rows):
    tok = tokenizers.Tokenizer.from_file(PATH)
    for cap in (64, 2048):
        got = pack(docs, params=PackingParams(capacity=cap, with_ids=True)).collect()
        want = []
        for r in rows:
            ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
            for k, (s, n) in enumerate(cuts(len(ids), cap)):
                part = ids[s : s + n].tobytes()
                want.append((r[0], k, s, n, zlib.crc32(part), part))
        assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got), key=str) == sorted(want, key=str)
        full = defaultdict(list)
        for r in got:
            full[r["sequence_id"]].append((r["offset"], r["length"]))
        for own in full.values():
            at = 0
            for o, n in sorted(own):
                assert o == at
                at += n
            assert at <= cap
        least = -(-sum(r["length"] for r in got) // cap)
        assert len(full) <= 1.1 * least + 1


def test_empty(none):
    assert pack(none).count() == 0


def test_cuts():
    assert cuts(1, 4) == [(0, 1)] and cuts(4, 4) == [(0, 4)] and cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_plan_is_a_partition():
    rng = random.Random(2)
    counts = {rng.randint(1, 100): rng.randint(1, 900) for _ in range(60)}
    runs = plan(counts, 100)
    fill = defaultdict(list)
    seen = defaultdict(int)
    for length, rank, n, first, offset in runs.tolist():
        assert seen[length] == rank
        seen[length] += n
        for i in range(n):
            fill[first + i].append((offset, length))
    assert dict(seen) == counts
    assert all(sum(n for _, n in own) <= 100 and all(o == sum(n for _, n in sorted(own)[:i]) for i, (o, _) in enumerate(sorted(own))) for own in fill.values())
    room: list[int] = []  # best fit, one piece at a time
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect_left(room, length)
            left = room.pop(at) if at < len(room) else 100
            insort(room, left - length)
    assert len(fill) <= 1.001 * len(room) + 1


def test_word_tokenizer_is_the_tokenizer():
    w = WordTokenizer(PATH, 50)
    odd = [" a", "a ", "a\n\nb", "a\n b", "a \nb", "  ", "\n", "a  b", "x<|endoftext|>y z", "don't we'll 12 3a, ,b\tc", "é ñ　x", "Ésa ßü, ñó!! naïve’s ½ x²y ǅ ﬁ. 日本 語。 a_b _c_ 'tis rock'n'roll' x' 're", "nul\0byte \x1c sep", "﻿bom ​ zero"]
    rng = random.Random(4)
    letters = "ab é.,'!-_ \n\t1²日"
    odd += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    for text in odd:
        assert w(text) == w.whole(text), text
