"""The kernel against all subsequences, the chance bound, and texts of any length under a model learnt from few documents."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tessera.llm import toxicity as T


def brute_features(x):
    """Three letters in a row but for gaps, within SPAN characters, weighed by how far they are apart."""
    out = Counter()
    for i, j, k in combinations(range(len(x)), 3):
        codes = [int(T.CODES[ord(c)]) for c in (x[i], x[j], x[k])]
        if k - i < T.SPAN and all(codes):
            out[codes[0] << 12 | codes[1] << 6 | codes[2]] += T.DECAY ** (k - i - 2)
    return out


def test_kernel_against_all_subsequences():
    rng = random.Random(5)
    xs = ["".join(rng.choice("abé01.-ß") for _ in range(rng.randint(0, 12))) for _ in range(40)] + ["insult", "in-s.ult", "inxsult", "1nsult", ""]
    own, key, w = T.features(xs)
    got = [dict(zip(key[own == i].tolist(), w[own == i].tolist(), strict=True)) for i in range(len(xs))]
    want = [brute_features(x) for x in xs]
    assert [g.keys() for g in got] == [v.keys() for v in want] and all(g[k] == pytest.approx(v[k]) for g, v in zip(got, want, strict=True) for k in v)
    norm = [max(T.LEAST_NORM, math.sqrt(sum(x * x for x in v.values()))) for v in want]
    table = T.Landmarks(xs[:30]).kernel(xs)
    direct = [[sum(a[k] * b[k] for k in a.keys() & b.keys()) / norm[i] / norm[j] for j, b in enumerate(want[:30])] for i, a in enumerate(want)]
    assert np.allclose(table, direct)


def test_scores_are_the_worst_strings_of_a_text():
    rng = np.random.default_rng(1)
    m = T.Model(rng.normal(size=1 << 18), -0.5, 1.3, 0.2)
    text = "Some plain words. An in-sult! a b c d"
    each = []
    for s in T.strings(text):
        f = brute_features(s)
        each.append(m.bias + max(0.0, sum(m.weights[k] * w for k, w in f.items())) / max(T.LEAST_NORM, math.sqrt(sum(w * w for w in f.values()))))
    worst = sorted(each, reverse=True)[: T.TOP]
    none = math.prod(1 - 1 / (1 + math.exp(-(m.slope * x + m.offset))) for x in worst)
    assert m.probability(T.Scorer(m).worst([text])[0]) == pytest.approx(1 - none)


def test_chance():
    for k, n, share in [(0, 5, 0.2), (1, 1, 0.3), (3, 3, 0.25), (3, 10, 0.1), (40, 60, 0.5), (7, 5, 0.5), (2, 4, 0.0), (2, 4, 1.0)]:
        exact = sum(math.comb(n, j) * share**j * (1 - share) ** (n - j) for j in range(k, n + 1))
        assert T.by_chance(k, n, share) == pytest.approx(exact, rel=1e-4, abs=1e-12)


@pytest.mark.parametrize("seed", range(12))
def test_rare_words_are_no_insults(seed):
    """Words of toxic documents alone, but few, aren't taken for insults: clean texts of any length stay clean, the insult is found."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    model = T.fit([(prose(30) + (" vlorpane" if d % 4 == 0 else ""), int(d % 4 == 0)) for d in range(80)], (60, 20))
    p = [model.probability(w) for w in T.Scorer(model).worst([prose(n) for n in (10, 1000, 100_000)] + [prose(30) + " vlorpane"])]
    assert max(p[:3]) < T.THRESHOLD <= p[3]
