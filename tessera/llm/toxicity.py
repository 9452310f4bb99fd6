"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares strings by their subsequences of three characters within SPAN places, each weighed by DECAY for
every character it skips, so an insult with letters inserted or parted by marks stays near itself. Landmarks map a
string to k(x, landmarks) K^-1/2, and a linear SVM of squared hinge loss is trained there. As map and SVM
are linear in the subsequences, both fold into one weight for each subsequence.

Sentences are labelled by their document, and few words of a toxic one are toxic. A sentence is therefore a bag of strings, its
words and runs of very short words joined, as in letters written apart. Training starts from the strings that explain
most toxic sentences, and alternates between fitting the SVM to those against strings of clean sentences, hard ones
first, and choosing each toxic document's worst strings anew. A text's score is the probability that any of its worst
strings is toxic, fitted to the labels as frequent as they are.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.labelled import held_out, sample, totals
from tessera.llm.runtime import tune

SPAN, DECAY = 6, 0.6
#: The norm of about four different letters.
LEAST_NORM = 1.5
#: For each toxic document, so many that hold nothing but one disguised insult are thought of.
DISGUISED = 0.3
#: The SVM's costs of errors, and the sentences for which a clean string counts at most.
TOXIC_COST, COST, MOST_TIMES = 50.0, 50.0, 20.0
#: Bounds of what is learnt from: documents of either label, landmarks, strings of clean documents.
PER_CLASS, LANDMARKS, NEGATIVES = 1000, 600, 10_000
#: Expected number of strings that are taken for insults by chance.
CHANCE = 0.05
THRESHOLD = 0.7
#: Strings of a text that make its score.
TOP = 3
#: Marks that are dropped at a word's ends; they would be gaps.
_EDGES = ".,!?;:#%&*\"'()[]-…"
LONGEST = 48  # longer strings are taken in overlapping parts
KEPT_STRINGS = 300_000
_PAIRS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_WEIGHT = np.array([DECAY ** (b - 2) for _, b in _PAIRS])


def sentences(text: str | None) -> list[set[str]]:
    """The strings of each different sentence; a run of short words may be parted by full stops, so the text's runs stand alone."""
    if not text:
        return []
    parts = dict.fromkeys(re.split(r"(?<=[.!?])\s+|\n+", text))
    got = [strings(p) for p in parts]
    rest = strings(text).difference(*got)
    return [g for g in (*got, rest) if g]


def strings(text: str | None) -> set[str]:
    """The strings of a text or sentence: its lower-case words and runs of at least three words of up to two characters, joined."""
    ws = [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w] if text else []
    out = set(ws)
    run: list[str] = []
    for w in ws:
        if len(w) <= 2:
            run.append(w)
        elif run:
            if len(run) > 2:
                out.update("".join(run[i : i + 10]) for i in range(max(1, len(run) - 9)))
            run = []
    if len(run) > 2:
        out.update("".join(run[i : i + 10]) for i in range(max(1, len(run) - 9)))
    for w in [w for w in out if len(w) > LONGEST]:
        out.discard(w)
        out.update(w[i : i + LONGEST] for i in range(0, len(w) - LONGEST // 2, LONGEST // 2))
    return out


def _codes() -> np.ndarray:
    """A code of 1 to 63 for every character that isn't a gap; digits stand for the letters they imitate."""
    t = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            t[c] = 1 + c - 97 if 97 <= c < 123 else 27 + c % 37
    for a, b in zip("013457@$", "oieastas", strict=True):
        t[ord(a)] = t[ord(b)]
    return t


CODES = _codes()


def features(xs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string number, subsequence, weight), each subsequence of a string once."""
    gap = "\0" * SPAN
    chars = np.frombuffer(gap.join(xs).encode("utf-16-le", "surrogatepass"), "<u2")
    sizes = np.array([len(x.encode("utf-16-le", "surrogatepass")) // 2 for x in xs])
    owner = np.repeat(np.arange(len(xs)), sizes + SPAN)[: len(chars)] if xs else np.zeros(0, np.int64)
    c = CODES[chars].astype(np.int64)
    own, key, weight = [], [], []
    pad = np.concatenate([c, np.zeros(SPAN, np.int64)])
    for (a, b), w in zip(_PAIRS, _WEIGHT, strict=True):
        x, y = pad[a : a + len(c)], pad[b : b + len(c)]
        at = np.flatnonzero((c > 0) & (x > 0) & (y > 0))
        own.append(owner[at])
        key.append(c[at] << 12 | x[at] << 6 | y[at])
        weight.append(np.full(len(at), w))
    own, key, weight = np.concatenate(own), np.concatenate(key), np.concatenate(weight)
    both = own << 18 | key
    u, inv = np.unique(both, return_inverse=True)
    return u >> 18, u & (1 << 18) - 1, np.bincount(inv, weight, len(u))


def length(own: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The norms of n strings. That of a string of few subsequences counts as LEAST_NORM: part of an insult is no insult."""
    return np.maximum(LEAST_NORM, np.sqrt(np.bincount(own, weight * weight, n)))


class Landmarks:
    """Kernel values of strings with some chosen ones, both of unit length."""

    def __init__(self, xs: list[str]):
        own, key, w = features(xs)
        norm = length(own, w, len(xs))
        self.keys = np.unique(key)
        self.table = np.zeros((len(self.keys), len(xs)))
        self.table[np.searchsorted(self.keys, key), own] = w / norm[own]

    def kernel(self, xs: list[str]) -> np.ndarray:
        out = np.zeros((len(xs), self.table.shape[1]))
        for i in range(0, len(xs), 100):
            part = xs[i : i + 100]
            own, key, w = features(part)
            norm = length(own, w, len(part))
            at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
            hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
            own, at, w = own[hit], at[hit], w[hit] / norm[own[hit]]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            if len(first):
                out[i + own[first]] = np.add.reduceat(self.table[at] * w[:, None], first, axis=0)
        return out


@dataclass
class Model:
    weights: np.ndarray  # of subsequences
    bias: float
    slope: float
    offset: float

    def strings(self, xs: list[str]) -> np.ndarray:
        """bias + the positive part of the kernel expansion, for each string."""
        if len(xs) > 2000:
            return np.concatenate([self.strings(xs[i : i + 2000]) for i in range(0, len(xs), 2000)])
        own, key, w = features(xs)
        num = np.bincount(own, w * self.weights[key], len(xs))
        return self.bias + np.maximum(0, num) / length(own, w, len(xs))

    def worst(self, scores: Iterable[float]) -> list[float]:
        """The TOP largest, the bias where there are fewer."""
        got = heapq.nlargest(TOP, scores)
        return got + [self.bias] * (TOP - len(got))

    def probability(self, worst: list[float]) -> float:
        """That any of the worst strings is toxic, each by itself with a logistic function's probability."""
        none = 1.0
        for x in worst:
            none /= 1 + math.exp(max(-500.0, min(500.0, self.slope * x + self.offset)))
        return 1 - none


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared hinge loss by Newton steps; x has a last column of ones, whose weight is the bias. Rows are taken in parts."""
    w = np.zeros(x.shape[1])
    reg = np.eye(len(w))
    reg[-1, -1] = 1e-3
    for _ in range(30):
        second, first = reg.copy(), np.zeros(len(w))
        for i in range(0, len(x), 2000):
            part, sign = x[i : i + 2000].astype(float), y[i : i + 2000]
            on = sign * (part @ w) < 1
            a = part[on] * cost[i : i + 2000][on, None]
            second += a.T @ part[on]
            first += a.T @ sign[on]
        new = np.linalg.solve(second, first)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def by_chance(k: int, n: int, share: float) -> float:
    """The probability that k or more of n things fall where a share of all does."""
    if share <= 0 or k > n:
        return 0.0
    if share >= 1 or k <= 0:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share))
    total = 0.0
    for j in range(k, n + 1):
        total += term
        if term < 1e-6 * total:
            break
        term *= (n - j) / (j + 1) * share / (1 - share)
    return min(1.0, total)


def witnesses(toxic: list[list[set[str]]], clean: Counter, clean_sentences: int) -> Counter:
    """Strings that explain why documents are toxic, with the number of documents each explains.

    toxic: for each document the strings of its sentences; clean: in how many sentences of clean documents a string occurs.
    The string found in most different sentences of documents that fewer than TOP strings explain is taken first, so what
    merely stands beside insults in copies of a text is not. What clean documents hold too counts less.

    A rare word may stand in toxic sentences alone by chance. So a string must stand there so often that, were all
    strings dealt to sentences without regard to labels, fewer than CHANCE of those looked at would: a test for each, at CHANCE by their number.
    """
    total = sum(len(d) for d in toxic)
    share = total / max(1, total + clean_sentences)
    at: dict[str, list[tuple[int, int]]] = {}
    for k, d in enumerate(toxic):
        for sentence in d:
            mark = hash(frozenset(sentence))
            for w in sentence:
                at.setdefault(w, []).append((k, mark))
    times, out = [0] * len(toxic), Counter()

    def gain(w: str) -> float:
        return len({mark for k, mark in at[w] if times[k] < TOP}) - 20 * clean[w] * total / max(1, clean_sentences)

    looked_at = [w for w in at if len(at[w]) > 2]

    def significant(w: str) -> bool:
        k = len({mark for _, mark in at[w]})
        return by_chance(k, k + clean[w], share) * len(looked_at) < CHANCE

    waiting = [(-gain(w), w) for w in looked_at if significant(w)]
    heapq.heapify(waiting)
    while waiting and -waiting[0][0] > 2:
        _, w = heapq.heappop(waiting)
        got = gain(w)  # it may have fallen since; it never rises
        if waiting and (-got, w) > waiting[0]:
            heapq.heappush(waiting, (-got, w))
        elif got > 2:
            gone = {k for k, _ in at[w] if times[k] < TOP}
            out[w] = len(gone)
            for k in gone:
                times[k] += 1
    return out


def disguised(word: str, rng: np.random.Generator) -> list[str]:
    """A word with a letter inserted, one doubled, and marks between its letters."""
    i, j = int(rng.integers(1, max(2, len(word)))), int(rng.integers(0, len(word)))
    return [word[:i] + chr(97 + int(rng.integers(26))) + word[i:], word[: j + 1] + word[j:], ".".join(word)]


def fit(rows: list[tuple[str, int]], totals: tuple[int, int] | None = None, seed: int = 7) -> Model:
    """rows: (text, label); totals: how many clean and toxic documents they stand for, where fewer of either are given.

    Without both labels the model gives every text the share of toxic rows.
    """
    same: dict[str, str] = {}  # each string is kept once
    bags = lambda t: [{same.setdefault(w, w) for w in x} for x in sentences(t)]
    pos, neg = [bags(t) for t, y in rows if y], [bags(t) for t, y in rows if not y]
    if not pos or not neg:
        share = (len(pos) + 0.5) / (len(rows) + 1)
        return Model(np.zeros(1 << 18), 0.0, 0.0, math.log((1 - share) ** (-1 / TOP) - 1))
    rng = np.random.default_rng(seed)
    clean_count: Counter = Counter()
    for sentence in {frozenset(x) for d in neg for x in d}:
        clean_count.update(sentence)
    clean = sorted(clean_count)
    seen = sorted(clean_count, key=lambda w: (-clean_count[w], w))[: NEGATIVES // 2]
    rare = [clean[i] for i in rng.choice(len(clean), min(len(clean), NEGATIVES // 2), replace=False)]
    toxic = [sorted(set().union(*d)) for d in pos]
    found = witnesses(pos, clean_count, sum(len(d) for d in neg))
    worst = list(found.elements()) or [max(d, key=lambda w: (-clean_count[w], len(w), w)) for d in toxic if d]
    hard: list[str] = []
    for _ in range(3):
        count = Counter(worst)
        marks = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))][: LANDMARKS // 2]
        others = [*hard[: LANDMARKS // 4], *rare[:LANDMARKS]]
        marks = list(dict.fromkeys([*marks, *others]))[:LANDMARKS]
        basis = Landmarks(marks)
        val, vec = np.linalg.eigh(basis.kernel(marks))
        keep = val > 1e-6 * val.max(initial=1e-9)
        root = vec[:, keep] / np.sqrt(np.maximum(val[keep], 1e-12))
        forms = [d for w in sorted(count) for d in disguised(w, rng)]
        strs = [*worst, *forms, *dict.fromkeys([*hard, *seen, *rare])]
        bad = len(worst) + len(forms)
        y = np.array([1.0] * bad + [-1.0] * (len(strs) - bad))
        times = np.array([1.0] * bad + [min(float(clean_count[w]), MOST_TIMES) for w in strs[bad:]])
        x = np.ones((len(strs), root.shape[1] + 1), np.float32)
        for i in range(0, len(strs), 2000):
            x[i : i + 2000, :-1] = basis.kernel(strs[i : i + 2000]) @ root
        w, bias = _svm(x, y, times * np.where(y > 0, TOXIC_COST, COST))
        weights = np.zeros(1 << 18)
        weights[basis.keys] = basis.table @ (root @ w)
        model = Model(weights, bias, 0.0, 0.0)
        score = dict(zip(clean, model.strings(clean).tolist(), strict=True))
        hard = sorted(clean, key=lambda s: (-score[s], s))[:4000]
        others = sorted(set().union(*toxic) - score.keys())
        score.update(zip(others, model.strings(others).tolist(), strict=True))
        most = [w for d in toxic for w in heapq.nlargest(TOP, d, key=lambda s: (score[s], s))]
        worst = [w for w in most if score[w] > 0] or worst
    forms = [d for w in sorted(set(worst)) for d in disguised(w, rng)]
    top = np.array([*(model.worst(score[w] for w in set().union(*d)) for d in (*pos, *neg)), *(model.worst([x]) for x in model.strings(forms))])
    y = np.array([1.0] * len(pos) + [0.0] * len(neg) + [1.0] * len(forms))
    whole = totals or (len(neg), len(pos))
    model.slope, model.offset = _calibrated(top, y, np.repeat([whole[1] / len(pos), whole[0] / len(neg), DISGUISED * whole[1] / max(1, len(forms))], [len(pos), len(neg), len(forms)]))
    return model


def _calibrated(top: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """slope, offset of greatest likelihood, each row weighing as many documents as it stands for; slightly damped.

    Found by gradient steps with running moments (Adam), whose number is fixed.
    """
    weight = weight / weight.sum()
    at, mean, square = np.array([1.0, -1.0]), np.zeros(2), np.zeros(2)
    for step in range(1, 1501):
        z = np.clip(at[0] * top + at[1], -30, 30)
        each = 1 / (1 + np.exp(-z))
        none = np.exp(np.log1p(-each).sum(1))
        pull = weight * np.where(y > 0, -none / np.maximum(1 - none, 1e-12), 1.0)
        g = np.array([(pull[:, None] * each * top).sum() + 1e-4 * at[0], (pull[:, None] * each).sum()])
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        at = at - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return float(max(at[0], 1e-3)), float(at[1])


class Scorer:
    """Scores of texts, remembering those of strings; an older generation is kept while a new one fills."""

    def __init__(self, model: Model):
        self.model, self.new, self.old = model, {}, {}

    def worst(self, texts: list[str | None]) -> list[list[float]]:
        sets = [strings(t) for t in texts]
        if len(self.new) > KEPT_STRINGS:
            self.old, self.new = self.new, {}
        want = set().union(*sets) - self.new.keys()
        self.new.update((w, self.old[w]) for w in want & self.old.keys())
        miss = list(want - self.new.keys())
        if miss:
            self.new.update(zip(miss, self.model.strings(miss).tolist(), strict=True))
        get = self.new.__getitem__
        return [self.model.worst(map(get, s)) for s in sets]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits to up to PER_CLASS documents of either label that may be learnt from."""
    rows = sorted(sample(docs, labels, "toxic", PER_CLASS).collect(), key=lambda r: r.doc_id)
    return fit([(r.text or "", r.label) for r in rows], totals(labels, "toxic"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Null and blank texts have the score of a text without any subsequence; null and repeated doc_ids are scored as
    rows of their own; other columns are ignored; an empty table gives an empty one.
    """
    tune(docs.sparkSession)

    def run(batches):
        s = Scorer(model)
        for b in batches:
            p = [model.probability(x) for x in s.worst(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p, pa.float64()), pa.array([int(x >= THRESHOLD) for x in p], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that score at least threshold; all columns stay.

    Null and blank texts score as a text without any subsequence, repeated rows alike, so each stays or goes with its
    copies; an empty table gives an empty one; further columns may have any name.
    """
    tune(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        s = Scorer(model)
        for b in batches:
            yield b.filter(pa.array([model.probability(x) < threshold for x in s.worst(b.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
