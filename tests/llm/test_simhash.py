import numpy as np
import xxhash

from strandwise.llm.simhash import SimhashParams, fingerprint, forest, masks, simhash_dedup


def plain(text, k=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids, fps, radius):
    up = dict(enumerate(ids))
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return [min((up[j] for j in range(len(ids)) if group[j] == g and up[j] is not None), default=None) for g in group]


def test_against_brute_force(docs, rows):
    for params in (SimhashParams(), SimhashParams(dense=2)):
        got = sorted(map(tuple, simhash_dedup(docs, params=params).collect()), key=str)
        fps = [plain(r[1]) for r in rows]
        want = classes([r[0] for r in rows], fps, 4)
        assert got == sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, want, strict=True)), key=str)


def test_empty(none):
    assert simhash_dedup(none).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    rng = np.random.default_rng(0)
    for radius in (2, 3, 4):
        kept = masks(radius, 7)
        assert len(kept) == 2 ** (radius + 1) - 1
        for _ in range(500):
            d = sum(1 << int(i) for i in rng.choice(64, radius, replace=False))
            assert any(d & m == 0 for m in kept)


def test_midpoints_give_the_same_forest():
    rng = np.random.default_rng(1)
    kept = masks(4, 7)[5]
    free = ~kept & (1 << 64) - 1
    places = [i for i in range(64) if free >> i & 1]
    own = {0x123456789ABCDEF0}
    for _ in range(400):
        x = 0x123456789ABCDEF0
        for i in rng.choice(places, rng.integers(0, 11), replace=False):
            x ^= 1 << int(i)
        own.add(x)
    fps = np.array(sorted(own), np.uint64)
    assert (forest(fps, free, 4, 10**6) == forest(fps, free, 4, 1)).all()


def test_long_and_short():
    assert fingerprint(b"", 4) == 0 and fingerprint(b"A b", 4) == plain("a B")
    long_ = " ".join(f"w{i % 977}" for i in range(70000))
    assert fingerprint(long_.encode(), 4) == plain(long_)
