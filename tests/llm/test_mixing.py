import numpy as np
import pytest

from strandwise.llm.mixing import MixParams, mix, rake


def test_rake_meets_its_marginals():
    rng = np.random.default_rng(0)
    cells = [(a, b, c) for a in "xyz" for b in "pq" for c in "uv"]
    tokens = rng.integers(500, 5000, len(cells)).astype(float)
    goals = [{"x": 0.3, "y": 0.3, "z": 0.4}, {"p": 0.5, "q": 0.5}, {"u": 0.6, "v": 0.4}]
    w = rake(cells, tokens, goals, 0.2, 1000, 1e-12)
    assert w.sum() == pytest.approx(0.2 * tokens.sum())
    for k, goal in enumerate(goals):
        for name, share in goal.items():
            assert w[[c[k] == name for c in cells]].sum() / w.sum() == pytest.approx(share, abs=1e-6)
    assert (w <= tokens + 1e-9).all()


def test_rake_with_what_is_missing():
    w = rake([("x", "p", "u")], np.array([10.0]), [{"x": 1, "gone": 5}, {}, {"u": 1}], 0.5, 50, 1e-9)
    assert w.tolist() == [5.0]
    assert rake([], np.array([]), [{}, {}, {}], 0.5, 5, 1e-9).size == 0
    assert rake([("x", "p", "u")], np.array([0.0]), [{}, {}, {}], 0.5, 5, 1e-9).tolist() == [0.0]


def test_against_a_plain_version(docs, rows):
    got = mix(docs).collect()
    assert len(got) == len(rows)
    tokens = {}
    for r in got:
        assert r["mix_tokens"] == len((r["text"] or "").split()) and r["topic"] == "clash"
        tokens.setdefault((r["source"] or "(none)", r["lang"] or "(none)", r["mix_topic"]), 0)
        tokens[r["source"] or "(none)", r["lang"] or "(none)", r["mix_topic"]] += r["mix_tokens"]
    cells = sorted(tokens)
    t = np.array([tokens[c] for c in cells], float)
    goals = []
    for k, power in enumerate((0.7, 0.7, 1.0)):
        by = {}
        for c, n in zip(cells, t, strict=True):
            by[c[k]] = by.get(c[k], 0) + n
        goals.append({x: n**power for x, n in by.items() if n > 0})
    w = dict(zip(cells, rake(cells, t, goals, 0.5, 1000, 1e-9), strict=True))
    for r in got:
        c = (r["source"] or "(none)", r["lang"] or "(none)", r["mix_topic"])
        want = w[c] / tokens[c] if tokens[c] else 0.5
        assert r["mix_probability"] == pytest.approx(want, abs=1e-9)
    again = {(r["doc_id"], r["text"]): r["mix_sampled"] for r in mix(docs.repartition(2)).collect()}
    assert all(again[r["doc_id"], r["text"]] == r["mix_sampled"] for r in got)


def plain_shares(tokens, budget):
    """Proportional fitting by loops over cells, each axis to its own shares to the power; cells hold what they hold."""
    powers = (0.7, 0.7, 1.0)
    total = budget * sum(tokens.values())
    goals = []
    for k, power in enumerate(powers):
        held = {}
        for c, n in tokens.items():
            held[c[k]] = held.get(c[k], 0) + n
        lifted = {x: n**power for x, n in held.items() if n}
        goals.append({x: total * v / sum(lifted.values()) for x, v in lifted.items()})
    w = {c: n * budget for c, n in tokens.items()}
    for _ in range(3000):
        for k, goal in enumerate(goals):
            have = {}
            for c, v in w.items():
                have[c[k]] = have.get(c[k], 0) + v
            w = {c: min(v * goal.get(c[k], 0) / have[c[k]], tokens[c]) if have[c[k]] else 0.0 for c, v in w.items()}
    return w


def test_whole_operator_against_loops(docs, rows):
    docs = docs.where("doc_id IS NULL OR doc_id <> 904").selectExpr("*", "'own' AS mix_source", "2 AS mix_lang")
    got = mix(docs).collect()
    tokens = {}
    for r in got:
        c = (r["source"] or "(none)", r["lang"] or "(none)", r["mix_topic"])
        tokens[c] = tokens.get(c, 0) + len((r["text"] or "").split())
    w = plain_shares(tokens, 0.5)
    for r in got:
        c = (r["source"] or "(none)", r["lang"] or "(none)", r["mix_topic"])
        assert r["mix_probability"] == pytest.approx(w[c] / tokens[c] if tokens[c] else 0.5, abs=1e-4)
        assert r["mix_source"] == "own" and r["mix_lang"] == 2


def test_a_missed_target_warns():
    with pytest.warns(RuntimeWarning, match="missed"):
        rake([("x", "p", "u"), ("y", "p", "u")], np.array([10.0, 90.0]), [{"x": 1.0, "y": 1.0}, {}, {}], 0.8, 100, 1e-9)


def test_pooled_categories_and_targets(docs):
    docs = docs.where("doc_id IS NULL OR doc_id <> 904")  # one long text would leave no mixture that meets all targets
    p = MixParams(targets={"lang": {"de": 1.0, "en": 1.0}}, categories={"source": 2, "lang": 64, "topic": 16}, budget=0.04)
    got = mix(docs, params=p).collect()
    taken = lambda keep: sum(r["mix_tokens"] * r["mix_probability"] for r in got if keep(r))
    whole = sum(r["mix_tokens"] for r in got)
    assert taken(lambda r: True) == pytest.approx(0.04 * whole, rel=1e-6)
    assert taken(lambda r: r["lang"] == "de") == pytest.approx(0.02 * whole, rel=0.02)
    assert taken(lambda r: r["lang"] is None) == 0  # no target, no weight
    held = {}
    for r in got:
        held[r["source"]] = held.get(r["source"], 0) + r["mix_tokens"]
    rest = sorted(held, key=lambda k: -held[k])[2:]
    assert {r["mix_weight"] for r in got if r["source"] in rest} <= {r["mix_weight"] for r in got}


def test_empty(none):
    assert mix(none).count() == 0
