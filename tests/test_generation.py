"""Beam search against exhaustive search and on a cluster's terms: batches, errors, hung models, odd rows."""

import itertools
import time

import numpy as np
import pytest

from pairloom.operators import generation as G


def table_step(seed, size=4):
    """Scores that depend on the input, the place and the last two tokens."""

    def factory():
        def step(inputs, prefixes, parents):
            out = []
            for x, p in zip(inputs, prefixes.tolist()):
                out.append(np.random.default_rng([seed, *x, len(p), *p[-2:]]).normal(0, 2, size))
            return np.array(out)

        return step

    return factory


def exhaustive(step, x, most, rules, size=4):
    def worth(tokens):
        total = 0.0
        for t, token in enumerate(tokens):
            s = step([x], np.array([tokens[:t]], int).reshape(1, t), None)[0]
            logp = s - s.max() - np.log(np.exp(s - s.max()).sum())
            total += logp[token] * (rules.penalty if token in tokens[:t] else 1)
        return total / len(tokens) ** rules.power

    others = [c for c in range(size) if c != rules.end]
    full = [list(c) for c in itertools.product(others, repeat=most)]
    ended = [[*c, rules.end] for n in range(rules.least, most) for c in itertools.product(others, repeat=n)]
    best = max(full + ended, key=worth)
    return [c for c in best if c != rules.end], worth(best)


@pytest.mark.parametrize("rules", [G.Rules(300, early=False), G.Rules(300, early=False, least=3), G.Rules(300, early=False, penalty=1.7, power=0.5), G.Rules(300, early=False, power=0.0)])
def test_wide_beams_find_what_exhaustive_search_finds(rules):
    for seed in range(8):
        step = table_step(seed)()
        inputs, most = [[5, 6], [7], [8, 9, 1]], [5, 3, 4]
        got = G.beam_search(step, inputs, most, rules, ["a", "b", "c"])
        for (tokens, value), x, n in zip(got, inputs, most):
            want = exhaustive(step, x, n, rules)
            assert tokens == want[0] and value == pytest.approx(want[1])


def test_one_beam_is_greedy_and_parents_lead_to_prefixes():
    seen = {}

    def step(inputs, prefixes, parents):
        if parents is None:
            assert prefixes.shape[1] == 0
        else:
            assert (seen["last"][parents] == prefixes[:, :-1]).all()
        seen["last"] = prefixes.copy()
        return table_step(3)()(inputs, prefixes, parents)

    for beams in (1, 3):
        got = G.beam_search(step, [[1], [2], [3]], [6, 2, 0], G.Rules(beams, early=False), list("abc"))
        assert [len(x) for x, _ in got][1:] <= [2, 0] and got[2] == ([], -np.inf)
    tokens, p = [], []
    for t in range(6):
        s = table_step(3)()([[1]], np.array([tokens], int).reshape(1, t), None)[0]
        s[1] = -np.inf if t == 0 else s[1]
        if s.argmax() == 1:
            break
        tokens.append(int(s.argmax()))
    assert G.beam_search(table_step(3)(), [[1]], [6], G.Rules(), ["a"])[0][0] == tokens


def test_draws_follow_the_rules_and_not_the_batches():
    step = table_step(1)()
    rules = G.Rules(2, seed=7, temperature=1.2, top_k=3, top_p=0.95, penalty=1.2)
    inputs = [[k] for k in range(20)]
    together = G.beam_search(step, inputs, [6] * 20, rules, [str(k) for k in range(20)])
    assert together == [G.beam_search(step, [x], [6], rules, [str(k)])[0] for k, x in enumerate(inputs)]
    assert together != G.beam_search(step, inputs, [6] * 20, G.Rules(2, seed=8, temperature=1.2, top_k=3, top_p=0.95, penalty=1.2), [str(k) for k in range(20)])
    x = np.log(np.array([[0.5, 0.3, 0.15, 0.05]]))
    finite = lambda **kw: np.isfinite(G.narrowed(x, G.Rules(**kw)))[0].tolist()
    assert finite(top_k=2) == [True, True, False, False] and finite(top_p=0.7) == [True, True, False, False] and finite(top_p=0.4) == [True, False, False, False]
    counts = np.zeros(4)
    for k in range(2000):
        counts[G.beam_search(lambda i, p, q: np.tile(x, (len(i), 1)), [[1]], [1], G.Rules(seed=1, end=3, least=0), [str(k)])[0][0] or [3]] += 1
    assert np.abs(counts / 2000 - [0.5, 0.3, 0.15, 0.05]).max() < 0.04
    with pytest.raises(ValueError):
        G.Rules(0)


def test_rows_nulls_errors_and_hung_models(spark):
    def factory():
        def step(inputs, prefixes, parents):
            if any(x[1:2] == [22] for x in inputs):  # C
                raise ValueError("refused")
            if any(x[1:2] == [21] for x in inputs):  # W
                time.sleep(600)
            out = np.zeros((len(inputs), 150))
            t = prefixes.shape[1]
            for row, x in zip(out, inputs):
                row[128 + len(x) if t < min(3, len(x) - 2) else 1] = 9.0
            return out

        return step

    G.register_generator("counts", factory)
    df = spark.createDataFrame([(1, "AAAA", 0), (2, None, 0), (3, "", 0), (4, "CA", 0), (5, "ML", 0), (6, "WA", 0), (7, "A", 1)], "id long, s string, tokens int").repartition(2)
    done = spark.createDataFrame([(7,)], "id long")
    start = time.monotonic()
    got = {r.id: (r.letters, r.error) for r in G.structure_by_generation(df, "id", "s", "counts", done=done, seconds=4.0).collect()}
    assert time.monotonic() - start < 90
    assert got[1] == ("eeed", None)
    assert got[2] == (None, None) and got[3] == ("", None) and got[4] == (None, "refused") and got[5][1] is None and len(got[5][0]) == 2
    assert got[6][0] is None and "seconds" in got[6][1] and 7 not in got
    assert G.structure_by_generation(df.limit(0), "id", "s", "counts").collect() == []
    plain = [{r.id: r.letters for r in G.structure_by_generation(df.where("id in (1, 3, 5)"), "id", "s", "counts", G.Rules(b), batch=n).collect()} for b, n in ((1, 1), (1, 8), (4, 2))]
    assert plain[0] == plain[1] == plain[2]


def test_ids_of_both_directions(spark):
    from pyspark.sql import functions as F

    from pairloom.functions import models

    r = spark.createDataFrame([("AxULj", [149, 128, 2, 147, 1])], "s string, t array<int>").select(models.residue_ids(F.col("s")).alias("r"), *(models.structure_letters_of(F.col("t"), F.lit(n)).alias(f"l{n}") for n in (0, 1, 4))).first()
    assert r.r == [149, 3, 23, 23, 4, 2, 1] and (r.l0, r.l1, r.l4) == ("", "a", "acdd")
