"""Text quality by gradient-boosted trees on histograms of document statistics.

Statistics are cut into at most BINS quantile bins; each tree is grown level by level on sums of gradients and
second derivatives for each bin. The trees are complete binary ones, flattened into arrays of feature, cut and
leaf value, so a batch of documents goes down all trees at once in numpy.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.labelled import held_out, sample, totals
from tessera.llm.runtime import tune

BINS, DEPTH, TREES, RATE, REGULAR = 64, 4, 80, 0.15, 1.0
#: Documents of either label that are learnt from.
PER_CLASS = 8000
_MARKS = "!?.,;:|#%*$&-\"'()"
FEATURES = ["words", "mean_word", "distinct_share", "top_share", "repeated_neighbours", "upper_share", "digit_share", "other_share", "words_per_sentence", "lines", "distinct_lines", "words_per_line", "short_words", "long_words", "distinct_bigrams", "capital_starts", "marked_ends", *(f"mark_{ord(c)}" for c in _MARKS)]


def statistics(text: str | None) -> list[float]:
    """FEATURES of one whole text; shares of nothing are 0."""
    t = text or ""
    ws = t.split()
    n, chars = len(ws), max(1, len(t))
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(ws)
    lines = [x for x in t.split("\n") if x.strip()]
    sizes = np.fromiter(map(len, ws), np.int64, n)
    marks = [t.count(c) for c in _MARKS]
    letters = sum(map(len, t.split()))
    ends = marks[_MARKS.index(".")] + marks[_MARKS.index("!")] + marks[_MARKS.index("?")]
    b = t.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(b, np.uint8)
    kind = np.bincount(raw, minlength=256)
    upper, digits, ascii_letters = int(kind[65:91].sum()), int(kind[48:58].sum()), int(kind[65:91].sum() + kind[97:123].sum())
    same = sum(map(str.__eq__, ws, ws[1:]))
    return [
        float(np.log1p(n)), float(sizes.mean()), len(counts) / n, counts.most_common(1)[0][1] / n, same / n, upper / chars, digits / chars, max(0, letters - ascii_letters - digits) / chars,
        n / (1 + ends), float(np.log1p(len(lines))), len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), float((sizes <= 2).mean()), float((sizes >= 12).mean()), len(set(zip(ws, ws[1:], strict=False))) / n,
        sum(w[0].isupper() for w in ws) / n, sum(not w[-1].isalnum() for w in ws) / n, *(m / n for m in marks),
    ]


@dataclass
class Forest:
    """Nodes of each tree in level order; a document goes right where its statistic is above the cut."""

    base: float
    feature: np.ndarray  # (trees, 2^depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, 2^depth)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        trees, inner = np.arange(len(self.feature))[None, :], self.feature.shape[1]
        for i in range(0, len(x), 2000):
            part = x[i : i + 2000]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.cut[trees, node])
            out[i : i + 2000] += self.leaf[trees, node - inner].sum(1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Forest:
    """Logistic loss, each row weighing as many documents as it stands for. Without both labels every document gets the share of label 1."""
    n, d = x.shape if len(x) else (0, len(FEATURES))
    weight = np.ones(n) if weight is None else weight * (n / weight.sum()) if n else weight
    share = ((weight * y).sum() + 0.5) / (n + 1)
    base, inner = float(np.log(share / (1 - share))), 2**DEPTH - 1
    if n == 0 or y.min() == y.max():
        return Forest(base, np.zeros((1, inner), np.int64), np.zeros((1, inner)), np.zeros((1, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(d)]
    bins = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    margin = np.full(n, base)
    feats, cuts, leaves = [], [], []
    flat = bins + np.arange(d)[None, :] * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            key = ((node - first)[:, None] * d * BINS + flat).ravel()
            sg = np.bincount(key, np.repeat(g, d), count * d * BINS).reshape(count, d, BINS)
            sh = np.bincount(key, np.repeat(h, d), count * d * BINS).reshape(count, d, BINS)
            lg, lh = sg.cumsum(2), sh.cumsum(2)
            tg, th = lg[:, :, -1:], lh[:, :, -1:]
            gain = lg**2 / (lh + REGULAR) + (tg - lg) ** 2 / (th - lh + REGULAR) - tg**2 / (th + REGULAR)
            gain[(lh < 1e-3) | (th - lh < 1e-3)] = -1
            best = gain.reshape(count, -1).argmax(1)
            for k in range(count):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    feature[first + k], cut[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - inner
        leaf = -RATE * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + REGULAR)
        margin += leaf[at]
        feats.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Forest(base, np.array(feats), np.array(cuts), np.array(leaves))


def _table(docs: DataFrame, extra: list[str]) -> DataFrame:
    """extra columns and the statistics, as a packed row x of doubles."""

    def run(batches):
        for b in batches:
            x = [np.array(statistics(t)).tobytes() for t in b.column(len(extra)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(extra))), pa.array(x, pa.binary())], [*extra, "x"])

    d = docs.select(*extra, F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, ", ".join(f"{c} {dict(d.dtypes)[c]}" for c in extra) + ", x binary")


def train(docs: DataFrame, labels: DataFrame) -> Forest:
    """Fits to up to PER_CLASS documents of either label that may be learnt from."""
    tune(docs.sparkSession)
    rows = sorted(_table(sample(docs, labels, "quality", PER_CLASS), ["doc_id", "label"]).collect(), key=lambda r: r.doc_id)
    x = np.array([np.frombuffer(r.x) for r in rows]).reshape(len(rows), len(FEATURES))
    y = np.array([r.label for r in rows], float)
    whole, got = totals(labels, "quality"), (float((y == 0).sum()), float(y.sum()))
    return fit(x, y, np.where(y > 0, whole[1] / max(1.0, got[1]), whole[0] / max(1.0, got[0])))


def score(docs: DataFrame, model: Forest, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Null and blank texts have statistics of 0; null and repeated doc_ids are scored as rows of their own; other
    columns are ignored; an empty table gives an empty one.
    """
    tune(docs.sparkSession)

    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in b.column(2).to_pylist()]).reshape(b.num_rows, len(FEATURES))
            p = model.probability(x)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
