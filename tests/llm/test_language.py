"""Katz back-off, phrases and clustering against brute force, and on odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chunks, clustering, collocations, katz

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k int, n long, words string, chunk long"


def frame(spark, rows):
    """Further columns have names that the operators use inside."""
    return spark.createDataFrame([(d, t, lang, "s", 1, 2, 3, "x", 4) for d, t, lang in rows], SCHEMA)


def texts(n, seed=3):
    """Zipf-like words in a few languages, with copies, marks, odd white space, blanks, nulls and one very long text."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["É", "the", "The", "THE", "日本", "ß"]
    pick = lambda: words[min(len(words) - 1, int(rng.paretovariate(0.7)) - 1)]
    seps = [" "] * 14 + [", ", ". ", "\t", "\n", "\r\n", "  ", "\x0b", "\x0c", ";", "! ", "? ", ":", "\x1c", " "]
    rows = []
    for d in range(n):
        rows.append((d, "".join(pick() + rng.choice(seps) for _ in range(rng.randint(1, 60))), rng.choice(["en", "en", "en", "de", None])))
    rows += [(n, None, "en"), (n + 1, "", "fr"), (n + 2, " \n\t ", "en"), (n + 3, rows[0][1], rows[0][2]), (n + 3, rows[0][1], rows[0][2]), (None, rows[1][1], "de"), (n + 4, " ".join(pick() for _ in range(5000)), "en"), (n + 5, ".,;", "und")]
    return rows


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# --- phrases ---


def brute_phrases(rows, longest, least, subsumed, top):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", ascii_lower(t)):
            ws = re.findall(r"[^ \t]+", piece)
            n[lang] += len(ws)
            for m in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cands.items():
            cuts = [(1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and subsumed[1] * b >= subsumed[0] * a for q, b in cands.items()):
                continue
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize(("longest", "least", "top", "size"), [(3, 3, 50, 1 << 21), (3, 2, 10_000, 100), (2, 2, 10_000, 1 << 21)])
def test_phrases(spark, monkeypatch, longest, least, top, size):
    monkeypatch.setattr(collocations, "CHUNK_WORDS", size)
    monkeypatch.setattr(collocations, "parts_for", lambda df, each: 7)
    rows = texts(150)
    got = collocations.mine(frame(spark, rows).repartition(3), longest=longest, min_count=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, longest, least, (50, 100), top)


def test_phrases_of_one_hot_word(spark, monkeypatch):
    """A word that begins nearly all phrases is cut into ranges by the second word."""
    monkeypatch.setattr(collocations, "parts_for", lambda df, each: 16)
    rng = random.Random(8)
    rows = [(d, " ".join(f"the w{rng.randrange(40)}" for _ in range(60)), "en") for d in range(80)]
    chunked = collocations._words(collocations._chunks(frame(spark, rows)))
    words = chunked.groupBy("lang", "word").agg(F.sum("n").alias("n")).withColumn("id", F.monotonically_increasing_id() + 1)
    ranges = collocations.Ranges(words.persist(), 16)
    assert ranges.count >= 16 and max(len(c) for c in ranges.cut.values()) >= 6
    ids = np.array(sorted(r.id for r in words.collect()), np.uint64)
    first, second = np.repeat(ids, len(ids)), np.tile(ids, len(ids))
    part = ranges.of(first, second)
    assert part.min() >= 0 and part.max() < ranges.count and (np.diff(part) >= 0).all()
    assert sorted(map(tuple, collocations.mine(frame(spark, rows), min_count=2).collect())) == brute_phrases(rows, 3, 2, (50, 100), 2000)


def test_phrases_of_empty_tables(spark):
    assert collocations.mine(frame(spark, [])).collect() == []
    assert collocations.mine(frame(spark, [(1, None, None), (2, "a b", "en")])).collect() == []
    with pytest.raises(ValueError, match="2 or 3"):
        collocations.mine(frame(spark, []), longest=4)


def test_phrase_scores_past_64_bits(spark):
    """The score's products are decimals: counts of 10^11 would pass 64 bits."""
    r = spark.range(1).select(F.lit(99_999_999_999).alias("a"), F.lit(300_000_000_000).alias("l"), F.lit(700_000_000_001).alias("r"))
    e = "CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0)) * 1000000 DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
    assert r.select(F.expr(e).alias("s")).first().s == 1_000_000 * 99_999_999_999**2 // (300_000_000_000 * 700_000_000_001)


def test_radix_runs():
    rng = np.random.default_rng(2)
    keys = [rng.integers(0, 1 << 63, 4000).astype(np.uint64) >> np.uint64(50), rng.integers(0, 3, 4000).astype(np.uint64) << np.uint64(61)]
    counts = rng.integers(1, 9, 4000)
    got, n = chunks.runs(keys, counts)
    want = Counter()
    for a, b, c in zip(*keys, counts, strict=True):
        want[int(a), int(b)] += int(c)
    assert list(zip(*(k.tolist() for k in got), n.tolist(), strict=True)) == [(*k, want[k]) for k in sorted(want)]


# --- Katz ---


class BruteKatz:
    """The model as the definition says, over tuples of words; a text's first history is ('^',)."""

    def __init__(self, docs, order):
        self.order, self.c = order, {n: Counter() for n in range(1, order + 1)}
        for ws in docs:
            self.c[1].update((w,) for w in ws)
            for n in range(2, order + 1):
                padded = ["^", *ws]
                self.c[n].update(tuple(padded[i : i + n]) for i in range(len(padded) - n + 1))
        self.N, self.V = sum(self.c[1].values()), len(self.c[1])
        self.d = {n: self.ratios(Counter(self.c[n].values())) for n in self.c}
        self.after = {n: defaultdict(dict) for n in range(2, order + 1)}
        for n in range(2, order + 1):
            for g, k in self.c[n].items():
                self.after[n][g[:-1]][g[-1]] = k

    @staticmethod
    def ratios(n):
        for k in range(5, 1, -1):
            if all(n[r] for r in range(1, k + 2)) and (k + 1) * n[k + 1] < n[1]:
                a = (k + 1) * n[k + 1] / n[1]
                d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)}
                if all(0 < x <= 1 for x in d.values()) and d[1] < 1:
                    return d
        d = 2 * n[2] / n[1] if n[1] else 0.5
        return {1: d if 0 < d < 1 else 0.5}

    def counts(self, seen, d):
        """Discounted counts, and what they are divided by."""
        total, stars = sum(seen.values()), {w: d.get(k, 1.0) * k for w, k in seen.items()}
        return stars, total if any(d.get(k, 1.0) < 1 for k in seen.values()) else total + 1

    def p(self, h, w):
        if not h:
            stars, total = self.counts({g[0]: k for g, k in self.c[1].items()}, self.d[1])
            return stars[w] / total if w in stars else 1 - sum(stars.values()) / total if total else 1.0
        seen = self.after[len(h) + 1].get(h)
        if not seen:
            return self.p(h[1:], w)
        stars, total = self.counts(seen, self.d[len(h) + 1])
        if w in seen:
            return stars[w] / total
        return (1 - sum(stars.values()) / total) / (1 - sum(self.p(h[1:], x) for x in seen)) * self.p(h[1:], w)

    def score(self, ws):
        padded = ["^", *ws]
        return sum(math.log10(self.p(tuple(padded[max(0, i - self.order + 1) : i]) if i > 1 or self.order > 1 else (), padded[i])) for i in range(1, len(padded)))


def tokens_of(t):
    return [*re.findall(r"[^ \t-\r]+", ascii_lower(t)), "$"]


@pytest.mark.parametrize(("order", "size", "keep"), [(1, 1 << 21, True), (2, 20, False), (3, 20, False), (3, 20, True), (4, 1 << 21, False)])
def test_katz_against_brute_force(spark, monkeypatch, order, size, keep):
    monkeypatch.setattr(katz, "CHUNK_WORDS", size)
    monkeypatch.setattr(katz, "parts_for", lambda df, each: 5)
    rows = texts(60) + [(500, "zzz unseen q the the", "en"), (501, "the the the", "en")]
    learnt = [d is None or d % 4 != 1 for d, _, _ in rows]
    corpus = katz.Corpus(frame(spark, rows).repartition(9), F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True)))
    model = katz.train(corpus, order=order, keep=keep)
    got = defaultdict(list)
    for r in katz.score(corpus, model).collect():
        got[r.doc_id].append(r)
    brute = BruteKatz([tokens_of(t) for (_, t, _), x in zip(rows, learnt, strict=True) if x], order)
    cache = brute.p
    known = {}
    brute.p = lambda h, w: known[h, w] if (h, w) in known else known.setdefault((h, w), cache(h, w))
    assert sum(map(len, got.values())) == len(rows)
    for (d, t, _), x in zip(rows, learnt, strict=True):
        ws = tokens_of(t)
        for r in got[d]:
            assert (r.learnt, r.n_tokens, r.train_tokens) == (x, len(ws), brute.N)
            assert r.n_known == sum((w,) in brute.c[1] for w in ws)
            assert r.base_score == pytest.approx(sum(math.log10((brute.c[1][w,] + 1) / (brute.N + brute.V + 1)) for w in ws), rel=1e-9)
            assert r.score == pytest.approx(brute.score(ws), rel=1e-7, abs=1e-7), (d, ws[:8])
    # every history's probabilities over all words and one unknown word add up to one
    for h in [("^",), ("the",), ("^", "the")][: min(3, order) if order > 1 else 0]:
        assert sum(brute.p(h, w) for (w,) in brute.c[1]) + brute.p(h, "no such word") == pytest.approx(1)


@pytest.mark.parametrize(("order", "limit"), [(3, 1 << 20), (3, 6), (4, 6), (4, 0)])
def test_katz_histories_with_their_ngrams(spark, monkeypatch, order, limit):
    """From order 3 on weights come with the counts: histories are sent once more only where frequent ones are dealt n-gram by n-gram."""
    monkeypatch.setattr(katz, "CHUNK_WORDS", 20)
    monkeypatch.setattr(katz, "parts_for", lambda df, each: 5)
    monkeypatch.setattr(katz, "TOGETHER", limit, raising=False)
    rows = [*texts(60), *texts(60, seed=8), (500, "zzz unseen q the the", "en"), (501, "the the the", "en"), (502, "the the the", "en")]
    rows = [(i, t, lang) for i, (_, t, lang) in enumerate(rows)]
    corpus = katz.Corpus(frame(spark, rows).repartition(9), F.col("doc_id") % 4 != 1)
    model = katz.train(corpus, order=order, keep=False)
    assert len(corpus.answers) == 2 + (limit < 1 << 20)
    last = {t for (t,) in corpus.answers[1].where("kind = 1").select("tag").distinct().collect()}
    assert (katz.COUNTS + order in last) == (limit < 1 << 20) and (katz.GROUPS + order in last) == (limit > 0)
    # earlier answers lie by chunk already
    plan = corpus.chunks.groupBy("chunk").cogroup(corpus._answered(corpus.answers[:1]).groupBy("chunk")).applyInArrow(lambda a, b: a, corpus.chunks.schema)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    brute = BruteKatz([tokens_of(t) for d, t, _ in rows if d % 4 != 1], order)
    cache, known = brute.p, {}
    brute.p = lambda h, w: known[h, w] if (h, w) in known else known.setdefault((h, w), cache(h, w))
    got = {r.doc_id: r.score for r in katz.score(corpus, model).collect()}
    assert got == {d: pytest.approx(brute.score(tokens_of(t)), rel=1e-7, abs=1e-7) for d, t, _ in rows}


def test_katz_scores_other_documents(spark):
    rows = texts(40)
    model = katz.train(katz.Corpus(frame(spark, rows), F.lit(True)), order=2)
    fresh = katz.Corpus(frame(spark, [(7, "the the new", "en")]))
    r = katz.score(fresh, model).first()
    brute = BruteKatz([tokens_of(t) for _, t, _ in rows], 2)
    assert r.score == pytest.approx(brute.score(tokens_of("the the new"))) and not r.learnt


def test_katz_on_odd_tables(spark):
    corpus = katz.Corpus(frame(spark, []), F.lit(True))
    assert katz.score(corpus, katz.train(corpus)).collect() == []
    corpus = katz.Corpus(frame(spark, [(1, "a b", "en"), (2, None, "en")]))
    got = {r.doc_id: r for r in katz.score(corpus, katz.train(corpus)).collect()}
    assert (got[1].score, got[1].base_score, got[1].n_tokens, got[1].n_known, got[1].train_tokens) == (0, 0, 3, 0, 0) and got[2].n_tokens == 1
    corpus = katz.Corpus(frame(spark, [(1, "", "en")]), F.lit(True))
    assert katz.score(corpus, katz.train(corpus)).first().score <= 0


def test_discounts():
    assert katz.discounts([0] * 6).tolist() == [1, 0.5, 1, 1, 1, 1]
    assert katz.discounts([10, 0, 0, 0, 0, 0])[1] == 0.5
    d = katz.discounts([1000, 400, 220, 140, 100, 70])
    assert all(0 < x <= 1 for x in d) and d[1] < 1
    # Good-Turing: the discounted mass of counts up to the limit is what single counts are
    n = [1000, 400, 220, 140, 100, 70]
    assert sum((1 - d[r]) * r * n[r - 1] for r in range(1, 6)) == pytest.approx(n[0])


# --- clustering ---


def brute_clusters(rows, k, rounds, dim, scale):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    at = [v for _, v in sorted(kept, key=key)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for r in range(rounds + 1):
        of = [min(range(len(at)), key=lambda j: (far(v, at[j]), j)) for _, v in kept]
        if r < rounds:
            for j in range(len(at)):
                mine = [v for (_, v), o in zip(kept, of, strict=True) if o == j]
                if mine:
                    at[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    d = [far(v, at[o]) for (_, v), o in zip(kept, of, strict=True)]
    inertia = Counter()
    for o, x in zip(of, d, strict=True):
        inertia[o] += x
    fit = lambda x: x if x < 1 << 63 else None
    return sorted(((i, o, fit(x), fit(inertia[o]), fit(sum(d)), hashlib.sha256(",".join(map(str, at[o])).encode()).hexdigest()) for (i, _), o, x in zip(kept, of, d, strict=True)), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cluster int, was int, v string")


@pytest.mark.parametrize("spread", [0.3, 0.02, 40_000.0, 1e12])
def test_clusters_against_brute_force(spark, spread):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(9, 8))
    rows = [(i, np.float32(centres[i % 9] * spread * 3 + rng.normal(size=8) * spread).tolist()) for i in range(400)]
    odd = [(900, None), (901, []), (902, [1.0] * 7), (903, [float("nan")] + [0.0] * 7), (904, [float("inf")] * 8), (905, [None] + [0.0] * 7), (None, rows[3][1]), (5, rows[5][1]), (5, rows[6][1]), (906, [0.0] * 8)]
    rows += odd + [(1000 + i, rows[0][1]) for i in range(30)]
    got = clustering.clusters(vectors(spark, rows).repartition(3), k=12, rounds=3, dim=8, scale=64)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, 12, 3, 8, 64)


def test_clusters_of_few_and_equal_vectors(spark):
    for rows in ([(1, [1.0, 2.0])], [(i, [0.5, 0.5]) for i in range(40)], [(i, [float(i % 2), 0.0]) for i in range(40)], []):
        got = clustering.clusters(vectors(spark, rows), k=5, rounds=2, dim=2, scale=64)
        assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, 5, 2, 2, 64)


def test_exponion_measures_few_distances():
    """With known bounds most vectors are left alone, and the others measure a few centroids of many."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (60, 4))
    v = (centres[np.arange(6000) % 60] + rng.integers(-60, 60, (6000, 4))).astype(float)
    at = [list(map(int, c)) for c in centres]
    cluster, upper, lower = np.full(len(v), -1), np.full(len(v), np.inf), np.zeros(len(v))
    clustering.assign(clustering.Space(v, at), clustering.Centroids(at), cluster, upper, lower)
    moved = [[x + 3 for x in c] for c in at]
    moved[0] = [x + 2500 for x in moved[0]]
    measured = clustering.assign(clustering.Space(v, moved), clustering.Centroids(moved, at), cluster, upper, lower)
    far = ((v[:, None] - np.array(moved)[None]) ** 2).sum(2)
    assert (cluster == far.argmin(1)).all() and measured < 0.25 * far.size
    assert (upper * upper >= far.min(1) * (1 - 1e-9)).all() and (lower <= np.sqrt(np.partition(far, 1, axis=1)[:, 1]) * (1 + 1e-9)).all()


def test_order_of_hashes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 70_000):
        for high in (1 << 63, 1 << 20, 5):
            keys = rng.integers(0, high, n).astype(np.uint64) * np.uint64(3)
            assert (chunks.hash_order(keys) == np.argsort(keys, kind="stable")).all()
            got, at = chunks.distinct(keys)
            want, places = np.unique(keys, return_inverse=True)
            assert (got == want).all() and (at == places).all()
