"""Documents that contain benchmark items, exactly or with edits.

Items and item-sized windows of a document, as words, are embedded by CGK random walks. A few edits change few steps of a
walk, so edit distance becomes Hamming distance. For bit sampling some steps of each of several walks are hashed, and
items are found by such a hash in a table for each walk; the number of walks follows from the wanted recall. What is
found is confirmed by the exact edit distance.

Which windows are looked up is decided by a filter that loses nothing and doesn't know items: of an item with at most k
edits, one of k + 1 disjoint blocks is untouched, so a window of its length holds, at its place, a block of some item
of that length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import tune
from tessera.llm.words import grams, hashes, mix

#: Items whose index goes to the workers at once; more are taken in turn.
ITEM_BLOCK = 20_000
#: Words of windows that are embedded together.
WINDOW_WORDS = 100_000
_DROPPED = b".,;:!?\"'()[]{}"
MATCHES = "doc_id long, item_id long, start_word long, n_words long, edits long, similarity double"


def plain_words(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation marks."""
    return text.encode("utf-8", "surrogatepass").lower().translate(None, _DROPPED).split() if text else []


class Walks:
    """CGK walks: at each step a walk shows the symbol under its pointer, and a random bit of (step, symbol) says whether the pointer moves on.

    `samples` steps of each of `repeats` walks make signatures; those of a walk are one hash.
    """

    def __init__(self, rate: float, recall: float, samples: int, seed: int = 1):
        # symbols shown at the same step agree at the largest distance with at least this probability, see the README
        agree = ((1 - rate) ** 2 / 2) ** samples
        self.repeats = max(4, math.ceil(math.log(1 - recall) / math.log(1 - agree)))
        rng = np.random.default_rng(seed)
        self.seeds = rng.integers(0, 1 << 63, self.repeats, np.uint64)
        self.at = rng.random((self.repeats, samples))

    def signatures(self, w: np.ndarray, n: int) -> np.ndarray:
        """w: a row of n symbols and a zero for each sequence; shorter ones end in zeros. (repeats, sequences)."""
        wanted: dict[int, list[int]] = {}
        for r, steps in enumerate((self.at * 2 * n).astype(np.int64)):
            for j in sorted(steps):
                wanted.setdefault(int(j), []).append(r)
        flat, first = w.ravel(), np.arange(len(w)) * (n + 1)
        place = np.zeros((self.repeats, len(w)), np.int64)
        sig = np.zeros((self.repeats, len(w)), np.uint64) + self.seeds[:, None]
        for j in range(max(wanted) + 1):
            sym = flat[first + place]
            for r in wanted.get(j, ()):
                sig[r] = mix(sig[r] + sym[r])
            odd = mix(self.seeds + np.uint64(j)) | np.uint64(1)
            place += ((sym * odd[:, None]) >> np.uint64(63)).view(np.int64)
            np.minimum(place, n, out=place)
        return mix(sig + np.uint64(n))


def fit(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edits from item to any part of text, and that part's start and end."""
    m = len(text)
    cost = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)
    idx = np.arange(m + 1)
    for i, x in enumerate(item, 1):
        step = np.empty(m + 1, np.int64)
        step[0], step[1:] = i, np.minimum(cost[:-1] + (text != x), cost[1:] + 1)
        from_left = np.empty(m + 1, np.int64)
        from_left[0] = start[0]
        diagonal = cost[:-1] + (text != x) <= cost[1:] + 1
        from_left[1:] = np.where(diagonal, start[:-1], start[1:])
        run = np.minimum.accumulate(step - idx)  # insertions: the best to the left, one more for each word
        best = run + idx
        source = np.maximum.accumulate(np.where(step - idx == run, idx, 0))
        start, cost = from_left[source], best
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Lookup:
    """Rows of numbers by key."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        self.columns = [c[order] for c in columns]
        self.first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) != 0)
        self.keys, self.first = keys[self.first], np.append(self.first, len(keys))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(places in wanted, columns of the rows found there)."""
        if not len(self.keys) or not len(wanted):
            return np.zeros(0, np.int64), [c[:0] for c in self.columns]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == wanted)
        at = at[hit]
        size = self.first[at + 1] - self.first[at]
        ends = np.cumsum(size)
        rows = np.repeat(self.first[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return np.repeat(hit, size), [c[rows] for c in self.columns]


class Index:
    """LSH tables of a block of items, and where item-sized windows have to be looked up."""

    def __init__(self, items: list[tuple[int, str]], rate: float, recall: float, samples: int):
        known = [(i, hashes(plain_words(t))) for i, t in items]
        known = [(i, h) for i, h in known if len(h)]
        self.ids, self.words = [i for i, _ in known], [h for _, h in known]
        self.n = np.array([len(h) for h in self.words], np.int64)
        self.edits = np.floor(self.n * rate + 1e-9).astype(np.int64)
        self.longest = int(self.n.max(initial=1))
        self.walks = Walks(rate, recall, samples)
        keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for n in np.unique(self.n):
            of = np.flatnonzero(self.n == n)
            for x in range(0, len(of), step := max(1, WINDOW_WORDS // int(n))):
                part = of[x : x + step]
                w = np.zeros((len(part), n + 1), np.uint64)
                w[:, :n] = [self.words[r] for r in part]
                keys.append(self.walks.signatures(w, int(n)).ravel())
                rows.append(np.tile(part, self.walks.repeats))
        self.tables = Lookup(np.concatenate(keys), np.concatenate(rows))
        by: dict[int, set[tuple[int, int, int]]] = {}
        for h, edits in zip(self.words, self.edits, strict=True):
            size = len(h) // (int(edits) + 1)
            g = min(4, size)
            at = np.arange(int(edits) + 1) * size
            by.setdefault(g, set()).update((int(k), len(h), int(o)) for k, o in zip(grams(h, g)[at], at, strict=True))
        self.blocks = {}
        for g, found in by.items():
            k, n, o = zip(*sorted(found), strict=True)
            self.blocks[g] = Lookup(np.array(k, np.uint64), np.array(n, np.int64), np.array(o, np.int64))

    def windows(self, flat: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Columns (document, start, length) of the windows that hold, at its place, a block of any item of that length."""
        out = [np.zeros((3, 0), np.int64)]
        for g, blocks in self.blocks.items():
            p, (n, offset) = blocks.find(grams(flat, g))
            inside = p + g <= ends[doc[p]] if len(p) else np.zeros(0, bool)
            out.append(np.stack([doc[p], p - offset, n])[:, inside])
        return np.unique(np.concatenate(out, axis=1), axis=1)

    def matches(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(document number, item row, start, end, edits), the best for each document and item."""
        flat = np.concatenate([*docs, np.zeros(0, np.uint64)])
        sizes = np.array([len(h) for h in docs], np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        doc, start, size = self.windows(flat, np.repeat(np.arange(len(docs)), sizes), ends)
        pairs = []
        for n in np.unique(size):
            of = np.flatnonzero(size == n)
            for x in range(0, len(of), step := max(1, WINDOW_WORDS // int(n))):
                part = of[x : x + step]
                first = np.maximum(start[part], begins[doc[part]])
                held = np.minimum(start[part] + n, ends[doc[part]]) - first
                at = first[:, None] + np.arange(n + 1)
                w = np.where(np.arange(n + 1) < held[:, None], flat[np.minimum(at, len(flat) - 1)], np.uint64(0))
                hit, (row,) = self.tables.find(self.walks.signatures(w, int(n)).ravel())
                pairs.append(np.stack([part[hit % len(part)], row]))
        if not pairs:
            return
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for k, r in np.unique(np.concatenate(pairs, axis=1), axis=1).T:
            key, most, begin = (int(doc[k]), int(r)), int(self.edits[r]), int(begins[doc[k]])
            lo, item = max(begin, int(start[k]) - most), self.words[r]
            part = flat[lo : min(int(ends[doc[k]]), int(start[k]) + len(item) + most)]
            if np.isin(item, part).sum() < len(item) - most:  # every item word that isn't there is an edit
                continue
            cost, a, b = fit(item, part)
            if cost <= most and (key not in best or cost < best[key][2]):
                best[key] = (lo - begin + a, lo - begin + b, cost)
        for (d, r), (a, b, cost) in best.items():
            yield d, r, a, b, cost


def _indexes(benchmark: DataFrame, rate: float, recall: float, samples: int) -> Iterator[Index]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    blocks = max(1, math.ceil(items.count() / ITEM_BLOCK))
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Index([tuple(r) for r in part.collect()], rate, recall, samples)


def find(docs: DataFrame, benchmark: DataFrame, *, max_edit_rate: float = 0.3, recall: float = 0.99, samples: int = 2) -> DataFrame:
    """MATCHES: a row for each document and item that it holds with at most max_edit_rate word edits per item word.

    start_word and n_words tell where the best match lies among the document's words (ties: the first). Items go to
    the workers in blocks of ITEM_BLOCK; documents aren't shuffled. Null and blank texts on either side match
    nothing; null ids are returned as null; repeated documents give repeated rows; empty tables an empty result. Other
    columns are ignored. Memory doesn't grow with the longest item but as the words of a block of items.
    """
    tune(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in _indexes(benchmark, max_edit_rate, recall, samples):

        def run(batches, index=index):
            for b in batches:
                ids = b.column(0).to_pylist()
                rows = [(ids[k], index.ids[r], s, e - s, c, 1 - c / int(index.n[r])) for k, r, s, e, c in index.matches([hashes(plain_words(t)) for t in b.column(1).to_pylist()])]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.float64())], [x.split()[0] for x in MATCHES.split(", ")])

        got = d.mapInArrow(run, MATCHES)
        out = got if out is None else out.unionByName(got)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, max_edit_rate: float = 0.3, recall: float = 0.99, samples: int = 2) -> DataFrame:
    """docs without the rows that hold an item, as find() finds them; all columns stay, whatever their names.

    Null and blank texts and null ids stay; repeated rows go or stay alike; an empty table on either side drops nothing.
    """
    tune(docs.sparkSession)
    at = docs.columns.index("text")
    for index in _indexes(benchmark, max_edit_rate, recall, samples):

        def run(batches, index=index):
            for b in batches:
                bad = {k for k, *_ in index.matches([hashes(plain_words(t)) for t in b.column(at).to_pylist()])}
                yield b.filter(pa.array([k not in bad for k in range(b.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
