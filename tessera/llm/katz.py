"""A Katz back-off model: Good-Turing discounted counts, back-off weights that normalise exactly, tables dealt by key.

A text's tokens are its words and one end. P(w | h) = d * c(h w) / c(h) where h w was seen, else bow(h) * P(w | h without its first word),
down to single words, where one unknown word takes what discounts leave. d is 1 for counts over FREQUENT and Katz's
renormalised Good-Turing ratio below. bow(h) is what the seen words of h leave of 1, over what the same words leave of the
shorter history's distribution, both from sums over all words seen after h. A history whose words are all too frequent to
be discounted is counted once more, so it too leaves something.

Texts become chunks of word numbers once, and stay where they are. In each step chunks meet: their sorted keys (64-bit hashes of word
sequences) are added up in parts of a table and answered to every chunk that sent them, counts of one order with the histories of
the order before. From order 3 on all n-grams of a history meet in one part, sent as the history's number and the numbers of their
last words, each with the count that it has without its first word: so the part knows what the history leaves, and counts and weights
come with one answer. Only histories that occur more than TOGETHER times are dealt as those of order 2, n-gram by n-gram.
What no other chunk holds is never sent: an n-gram whose first words occur in one chunk alone is counted there, and so is such a
history; an n-gram after a history that was never learnt has count 0. The tables' own rows are the model.

Words and n-grams are told apart by their keys; n different ones make about n * n / 2^65 pairs of equal keys, 0.003 of a
pair for 3 * 10^8 words. Such a pair shares its count.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import SENT, Meeting, chunk_number, cuts, distinct, framed, from_planes, looked_up, met, packed_keys, planes, received, sent, table, tallied, unframed, unpacked_keys
from tessera.llm.runtime import bucketed, discard, parts_for, release, tune, written
from tessera.llm.words import hashes, joined, mix

#: Counts above are not discounted.
FREQUENT = 5
#: Words of a chunk, give or take a hundred documents; a task holds some 300 bytes for each.
CHUNK_WORDS = 1 << 20
#: Bytes of documents whose n-grams meet in one task.
PART_BYTES = 4 << 20
#: How often a history occurs at most whose n-grams meet in one task.
TOGETHER = 1 << 20
#: Stand for the end and the start of a text; words hold no white space.
END, START = b"\n", b"\t"
_CHUNK = "chunk long, ids binary, known binary, learnt binary, lengths binary, hashes binary, numbers binary"
#: Of a history: how often n-grams of count 1 to FREQUENT that it begins occur, the sum of the shorter history's P over words seen, and whether a chunk needs bow.
_STATS = FREQUENT + 2
#: Tags of what chunks send and are answered, to which the order is added.
COUNTS, WEIGHTS, GROUPS = 0, 100, 200
_GOT = "tag int, chunk long, part int, columns binary"


# --- documents ---


def _chunks(docs: DataFrame, learnt: Column) -> DataFrame:
    def closed(k: int, ids: list, learning: list, texts: list[pa.Array]) -> pa.RecordBatch:
        pieces = pc.ascii_split_whitespace(pc.ascii_lower(pa.chunked_array(texts).combine_chunks()))
        words, ends = pieces.flatten(), np.asarray(pieces.offsets)[1:] - pieces.offsets[0].as_py()
        full = np.asarray(pc.not_equal(words, ""))
        ends = np.append(0, np.cumsum(full))[ends]
        e = words.filter(pa.array(full)).dictionary_encode()
        known = e.dictionary.cast(pa.binary()).to_pylist()
        numbers = np.insert(np.asarray(e.indices).astype(np.uint32), ends, len(known))
        lengths = np.diff(ends, prepend=0) + 1
        row = (
            chunk_number(k), planes(np.array([i or 0 for i in ids], "<i8")), planes(np.array([i is not None for i in ids], bool)), planes(np.array(learning, bool)),
            planes(lengths.astype("<i8")), planes(hashes([*known, END, START])), planes(numbers.astype("<u4")),
        )
        return table([row], _CHUNK)

    def run(batches):
        k, ids, learning, texts, size = 0, [], [], [], 0
        for b in batches:
            # a batch is cut so that a chunk holds about CHUNK_WORDS words, of seven characters or so
            for text in [b.slice(i, 100) for i in range(0, b.num_rows, 100)]:
                ids += text.column(0).to_pylist()
                learning += text.column(1).to_pylist()
                texts.append(text.column(2))
                size += pc.sum(pc.binary_length(text.column(2))).as_py() or 0
                if size >= 7 * CHUNK_WORDS:
                    yield closed(k, ids, learning, texts)
                    k, ids, learning, texts, size = k + 1, [], [], [], 0
        if ids:
            yield closed(k, ids, learning, texts)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), learnt.alias("learnt"), text.alias("text")).mapInArrow(run, _CHUNK)


class Tokens:
    """A chunk: documents, and for each order the distinct keys of its n-grams and which of them ends at every token."""

    def __init__(self, row: dict):
        self.ids, self.known = from_planes(row["ids"], "<i8"), from_planes(row["known"], "?")
        self.learnt, self.lengths = from_planes(row["learnt"], "?"), from_planes(row["lengths"], "<i8")
        numbers, words = from_planes(row["numbers"], "<u4").astype(np.int64), from_planes(row["hashes"], "<u8")
        order = np.argsort(words)
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        self.start = int(rank[-1])
        first = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(numbers)) - np.repeat(first, self.lengths)
        self.learning = np.repeat(self.learnt, self.lengths)
        self.levels = {1: (words[order], rank[numbers])}

    def level(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of n-grams, and for each token the number of its key, or -1: a pair may begin with the start, longer ones need n - 1 words."""
        if n not in self.levels:
            keys, _ = self.level(n - 1)
            before = self.before(n)
            at = np.flatnonzero(before >= 0)
            words, number = self.levels[1]
            found, where = distinct(joined(mix(keys[before[at]] + np.uint64(n)), words[number[at]]))
            out = np.full(len(self.place), -1)
            out[at] = where
            self.levels[n] = (found, out)
        return self.levels[n]

    def before(self, n: int) -> np.ndarray:
        """For each token the number of its history among the keys of order n - 1, or -1."""
        out = np.append(-1, self.level(n - 1)[1])[:-1]
        if n == 2:
            out[self.place == 0] = self.start
        else:
            out[self.place < n - 2] = -1
        return out

    def spread(self, n: int, of_token: np.ndarray) -> np.ndarray:
        """For each key of order n what one of its tokens has."""
        keys, at = self.level(n)
        out = np.zeros(len(keys), of_token.dtype)
        out[at[at >= 0]] = of_token[at >= 0]
        return out

    def occurrences(self, n: int) -> np.ndarray:
        """How often each key of order n occurs in learnt documents of this chunk."""
        keys, at = self.level(n)
        return np.bincount(at[self.learning & (at >= 0)], minlength=len(keys))


# --- the model's numbers ---


def discounts(of: list[float]) -> np.ndarray:
    """d of counts 0 to FREQUENT (d[0] unused), from how many n-grams occur once, twice, ... FREQUENT + 1 times.

    Katz's ratios for the largest limit k at which all are between 0 and 1; where none is (a few texts, or odd ones),
    single counts keep 2 n2 / n1, or a half where that is not between 0 and 1.
    """
    n = [0.0, *of]
    for k in range(FREQUENT, 1, -1):
        if min(n[1 : k + 2]) > 0:
            a = (k + 1) * n[k + 1] / n[1]
            if a < 1:
                d = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
                if 0 < min(d) and max(d) <= 1 and d[0] < 1:
                    return np.array([1.0, *d, *[1.0] * (FREQUENT - k)])
    d = 2 * n[2] / n[1] if n[1] else 0.5
    return np.array([1.0, d if 0 < d < 1 else 0.5, *[1.0] * (FREQUENT - 1)])


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts > FREQUENT, 1.0, d[np.minimum(counts, FREQUENT).astype(np.int64)]) * counts


class Words:
    """P of single words: N tokens, V kinds, what discounts leave to the unknown word."""

    def __init__(self, tokens: int, kinds: int, of: list[float]):
        self.tokens, self.kinds, self.d = tokens, kinds, discounts(of)
        left = sum((1 - self.d[r]) * r * of[r - 1] for r in range(1, FREQUENT + 1))
        self.total = tokens if left else tokens + 1
        self.unknown = (left or 1) / self.total

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) / self.total, self.unknown)


def left_over(stats: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Of histories, from their _STATS: what discounts leave of the counts (0: nothing), and 1 less the shorter history's P over words seen."""
    left = (stats[:, :FREQUENT] * (1 - d[1:])).sum(1)
    return np.column_stack([left, np.maximum(1 - stats[:, FREQUENT], 1e-300)])


class Levels:
    """A chunk's counts and probabilities by order, from the answers it has had."""

    def __init__(self, row: dict, got: pa.Table, model: Known):
        self.t, self.m = Tokens(row), model
        self.got: dict[int, dict[int, bytes]] = {}
        for tag, part, columns in zip(*(got[c].to_pylist() for c in ("tag", "part", "columns")), strict=True):
            self.got.setdefault(tag, {})[part] = columns
        self.counted, self.weighed, self.chances, self.begun = {}, {}, {}, {}
        #: by order the numbers of keys in their parts, n-grams that meet by their histories, and what those leave
        self.numbers, self.grouped, self.left = {}, {}, {}

    def counts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each key of order n how often it was learnt anywhere, and whether other chunks hold it too."""
        if n not in self.counted:
            keys, _ = self.t.level(n)
            count, shared = np.zeros(len(keys)), np.zeros(len(keys), bool)
            asked = self.asked(n)
            alone = self.after_alone(n) if n > 1 else np.zeros(len(keys), bool)
            count[alone] = self.t.occurrences(n)[alone]
            a = received(self.got.get(COUNTS + n, {}), keys[asked], self.m.parts, 3 if self.m.numbered(n) else 2)
            count[asked], shared[asked] = a[:, 0], (a[:, 1] > 0) | self.m.keep
            if self.m.numbered(n):
                self.numbers[n] = self._numbers(keys, asked, a[:, 2])
            if self.m.together(n):
                self._from_groups(n, count, shared)
            self.counted[n] = count, shared
        return self.counted[n]

    def _numbers(self, keys: np.ndarray, asked: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key its number in its part, and that part."""
        number, part = np.zeros(len(steps), np.int64), np.zeros(len(steps), np.int64)
        for p, at in cuts(keys[asked], self.m.parts):
            number[at], part[at] = np.cumsum(steps[at]), p
        out = np.zeros((2, len(keys)), np.int64)
        out[:, asked] = number, part
        return out[0], out[1]

    def _groups(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Histories (keys of order n - 1) whose n-grams meet together, how many of those are here, and their keys of order n, history by history."""
        if n not in self.grouped:
            of = self.t.spread(n, self.t.before(n))
            count, shared = self.counts(n - 1)
            at = np.flatnonzero(((count > 0) & shared & ~self.frequent(n))[of])
            both = np.sort(of[at] << 32 | at)
            of, at = both >> 32, both & 0xFFFFFFFF
            first = np.flatnonzero(np.diff(of, prepend=-1))
            self.grouped[n] = of[first], np.diff(first, append=len(of)), at
        return self.grouped[n]

    def _group_slices(self, n: int, histories: np.ndarray, sizes: np.ndarray):
        """For each part its number, its histories and their n-grams."""
        ends = np.append(0, np.cumsum(sizes))
        for p, h in cuts(self.t.level(n - 1)[0][histories], self.m.parts):
            yield p, h, slice(ends[h.start], ends[h.stop])

    def sent_groups(self, n: int, chunk: int) -> list[tuple]:
        """Rows of SENT: histories, how many n-grams each has here, and of these the last word, the occurrences and the count without the first word."""
        t = self.t
        histories, sizes, at = self._groups(n)
        lower = t.spread(n, self.counts(n - 1)[0][t.level(n - 1)[1]])[at]
        number, part = self.numbers[1]
        word = t.spread(n, (number * self.m.parts + part)[t.level(1)[1]])[at]
        here = t.occurrences(n)[at]
        # n-grams of order 3 were themselves counted by history, so those have no number in the part of their key
        ids = self.numbers[2][0].astype(np.uint64) if n == 3 else t.level(n - 1)[0]
        return [
            (GROUPS + n, p, chunk, packed_keys(ids[histories[h]]), framed(planes(sizes[h].astype("<u4")), planes(word[g].astype("<u4")), planes(here[g].astype("<u4")), planes(lower[g].astype("<u8"))))
            for p, h, g in self._group_slices(n, histories, sizes)
        ]

    def _from_groups(self, n: int, count: np.ndarray, shared: np.ndarray) -> None:
        answers = self.got.get(GROUPS + n, {})
        histories, sizes, at = self._groups(n)
        stats, lower = np.zeros((len(histories), FREQUENT)), np.zeros(len(histories))
        for p, h, g in self._group_slices(n, histories, sizes):
            counts, held, some, own, low = unframed(answers[p])
            counts = from_planes(counts, "<u4")
            count[at[g]], shared[at[g]] = counts, from_planes(held, "?")
            # of a history that needs no bow it is enough to know whether anything is left over
            stats[h] = from_planes(some, "u1")[:, None] >> np.arange(FREQUENT) & 1
            wanting = h.start + _wanting(counts, sizes[h])
            stats[wanting], lower[wanting] = from_planes(own, "<u4").reshape(-1, FREQUENT), from_planes(low, "<f8")
        self.left[n] = histories, stats, lower

    def frequent(self, n: int) -> np.ndarray:
        """Keys of order n - 1 whose n-grams are dealt one by one."""
        count = self.counts(n - 1)[0]
        return count > self.m.limit if self.m.together(n) else np.ones(len(count), bool)

    def _history(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each key of order n its history's count and whether that is shared; the start counts as learnt and shared."""
        count, shared = self.counts(n - 1)
        if n == 2:
            count, shared = count.copy(), shared.copy()
            count[self.t.start], shared[self.t.start] = 1, True
        of = self.t.spread(n, self.t.before(n))
        return count[of], shared[of]

    def after_alone(self, n: int) -> np.ndarray:
        return ~self._history(n)[1]

    def asked(self, n: int) -> np.ndarray:
        """Keys of order n that are sent one by one: those with a learnt history that is shared, and frequent."""
        if n == 1:
            return np.ones(len(self.t.level(1)[0]), bool)
        count, shared = self._history(n)
        return (count > 0) & shared & self.frequent(n)[self.t.spread(n, self.t.before(n))]

    def histories(self, n: int) -> np.ndarray:
        """For each key of order n - 1 its _STATS from this chunk: occurrences here, and P of n-grams by the share of their occurrences that is here."""
        if n not in self.begun:
            t = self.t
            size = len(t.level(n - 1)[0])
            of = t.spread(n, t.before(n))
            count, here = self.counts(n)[0], t.occurrences(n)
            share = here / np.maximum(count, 1)
            out = np.zeros((size, _STATS))
            few = np.flatnonzero((count > 0) & (count <= FREQUENT))
            out[:, :FREQUENT] = np.bincount(of[few] * FREQUENT + count[few].astype(np.int64) - 1, here[few], size * FREQUENT).reshape(size, FREQUENT)
            out[:, FREQUENT] = np.bincount(of, share * t.spread(n, self.p(n - 1)), size)
            out[:, FREQUENT + 1] = np.bincount(of[count == 0], minlength=size) > 0
            self.begun[n] = out
        return self.begun[n]

    def sent_histories(self, n: int) -> np.ndarray:
        """Keys of order n - 1 whose weights others need or know, and that are frequent: shared, learnt, and before something here."""
        t, (count, shared) = self.t, self.counts(n - 1)
        begins = np.zeros(len(count), bool)
        before = t.before(n)
        begins[before[before >= 0]] = True
        chosen = begins & (count > 0) & shared & self.frequent(n)
        if n == 2:
            chosen[t.start] = True
        return chosen

    def weights(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each key of order n - 1 its bow (where a chunk has no unknown n-gram after it, any number) and its denominator."""
        if n not in self.weighed:
            keys, _ = self.t.level(n - 1)
            left = left_over(self.histories(n), self.m.ds[n - 1])
            chosen = self.sent_histories(n)
            if chosen.any():
                left[chosen] = received(self.got[WEIGHTS + n], keys[chosen], self.m.parts, 2)
            if self.m.together(n):
                self.counts(n)
                histories, stats, lower = self.left[n]
                shorter = self.t.spread(n - 1, self.weights(n - 1)[1][self.t.level(n - 2)[1]])
                left[histories] = left_over(np.column_stack([stats, lower / shorter[histories]]), self.m.ds[n - 1])
            count = self.counts(n - 1)[0].copy()
            if n == 2:
                count[self.t.start] = self.m.starts
            total = np.where(left[:, 0] > 0, count, count + 1)
            bow = np.where(left[:, 0] > 0, left[:, 0], 1.0) / total / np.maximum(left[:, 1], 1e-300)
            self.weighed[n] = np.where(count > 0, bow, 1.0), total
        return self.weighed[n]

    def p(self, n: int) -> np.ndarray:
        """P of each token after up to n - 1 others."""
        if n not in self.chances:
            _, at = self.t.level(n)
            count = np.append(self.counts(n)[0], 0)[at]
            if n == 1:
                self.chances[1] = self.m.words.p(count)
            else:
                bow, total = (np.append(x, 1.0)[self.t.before(n)] for x in self.weights(n))
                self.chances[n] = np.where(count > 0, discounted(count, self.m.ds[n - 1]) / total, bow * self.p(n - 1))
        return self.chances[n]


class Known:
    """The few numbers of a model that every chunk needs; with keep nothing is left to a chunk alone."""

    def __init__(self, parts: int, keep: bool):
        self.parts, self.keep, self.words, self.starts, self.limit = parts, keep, Words(0, 0, [0.0] * (FREQUENT + 1)), 0, TOGETHER
        #: discounts by order, less one
        self.ds: list[np.ndarray] = []

    def together(self, n: int) -> bool:
        """Whether n-grams of order n meet by their history. Tables that other documents ask have them one by one."""
        return n > 2 and not self.keep

    def numbered(self, n: int) -> bool:
        """Whether chunks are told the numbers of keys of order n."""
        return n < 3 and not self.keep


class Model:
    """Tables of a fitted model (rows of kind 0), by step and tag: the counts of n-grams (words are order 1) and what histories leave over."""

    def __init__(self, order: int, parts: int, keep: bool):
        self.order, self.known = order, Known(parts, keep)
        self.tables: list[DataFrame] = []

    def discard(self) -> None:
        discard(*self.tables)


class Corpus:
    """Documents as chunks, with the answers they have had from one model's tables."""

    def __init__(self, docs: DataFrame, learnt: Column | None = None):
        """learnt: which documents count; a null is false. Without it none do, as for texts to be scored alone."""
        tune(docs.sparkSession)
        self.parts = parts_for(docs, PART_BYTES)
        learnt = F.lit(False) if learnt is None else F.coalesce(learnt, F.lit(False))
        self.buckets = parts_for(docs, 2 * PART_BYTES)
        self.chunks = bucketed(_chunks(docs, learnt), "lm-chunks", "chunk", self.buckets)
        self.answers: list[DataFrame] = []
        #: the model whose answers these are
        self.answered: Model | None = None

    @staticmethod
    def _answered(tables: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, (t.where("kind = 1").select("tag", "chunk", "part", "columns") for t in tables))

    def each(self, run, schema: str) -> DataFrame:
        """run(row, answers) gives rows for each chunk; answers has a tag, part and columns. The chunks stay where they are, answers come to them."""
        got = self._answered(self.answers) if self.answers else self.chunks.sparkSession.createDataFrame([], _GOT)

        def one(t: pa.Table, a: pa.Table) -> pa.Table:
            return pa.Table.from_batches([table([r for row in t.to_pylist() for r in run(row, a)], schema)])

        return self.chunks.groupBy("chunk").cogroup(got.groupBy("chunk")).applyInArrow(one, schema)

    def discard(self) -> None:
        discard(self.chunks, *self.answers)


def _tally(counts: np.ndarray, limit: int, texts: int = 0) -> np.ndarray:
    """Occurrences, kinds, texts, kinds that occur more than limit times, and how many kinds of count 1 to FREQUENT + 1."""
    return np.array([counts.sum(), (counts > 0).sum(), texts, (counts > limit).sum(), *((counts == r).sum() for r in range(1, FREQUENT + 2))], float)


def _sent(corpus: Corpus, model: Known, *, counts: int = 0, histories: int = 0) -> DataFrame:
    """SENT by every chunk: how often its n-grams of order `counts` occur there, and the _STATS of histories of order `histories`.

    n-grams of documents that don't count are sent too, as they want an answer; of n-grams that are not sent there is a tally.
    """

    def run(row, a):
        at, chunk, out = Levels(row, a, model), row["chunk"], []
        if histories:
            chosen = at.sent_histories(histories)
            out += sent(WEIGHTS + histories, chunk, at.t.level(histories - 1)[0][chosen], at.histories(histories)[chosen], model.parts)
        if counts:
            asked, here = at.asked(counts), at.t.occurrences(counts)
            unsent = ~asked
            if model.together(counts):
                out += at.sent_groups(counts, chunk)
                unsent[at._groups(counts)[2]] = False
            out.append((COUNTS + counts, chunk % model.parts, chunk, None, planes(_tally(here[unsent], model.limit, int(at.t.learnt.sum())))))
            out += sent(COUNTS + counts, chunk, at.t.level(counts)[0][asked], here[asked, None].astype("<f8"), model.parts)
        return out

    return corpus.each(run, SENT)


def _counted(sums: np.ndarray, chunks: np.ndarray, at: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, 1) for the table, (count, whether several chunks hold it) for chunks."""
    return np.column_stack([sums[:, 0], sums[:, 0] > 0]), np.column_stack([sums[:, 0], chunks > 1])[at]


def _numbered(n: int):
    """Words are told apart by their numbers; of pairs only those that chunks share are asked for by number."""
    return lambda sums, chunks: (chunks > 1) & (sums[:, 0] > 0) if n > 1 else chunks > 0


def _weighed(d: np.ndarray):
    def answer(sums: np.ndarray, chunks: np.ndarray, at: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = left_over(sums, d)
        back = own[at]
        # a chunk whose n-grams after a history are all known needs the denominator alone: whether anything is left over
        plain = columns[:, FREQUENT + 1] == 0
        back[plain, 0], back[plain, 1] = back[plain, 0] > 0, 1
        return own, back

    return answer


def _wanting(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which histories have an n-gram of count 0 among theirs, which follow each other: they need bow."""
    return np.unique(np.repeat(np.arange(len(sizes)), sizes)[counts == 0])


def _met_together(n: int, shorter: np.ndarray, limit: int):
    """Counts of n-grams, which meet by their histories, and what these leave; shorter: the discounts of order n - 1."""

    def run(part: int, rows: list[tuple]) -> list[tuple]:
        ids = [unpacked_keys(keys) for _, keys, _ in rows]
        sizes, words, here, lower = (list(x) for x in zip(*((from_planes(a, d).astype(np.int64) for a, d in zip(unframed(data), ("<u4", "<u4", "<u4", "<u8"), strict=True)) for _, _, data in rows), strict=True))
        known, of = distinct(mix(np.concatenate(ids)))
        history = np.repeat(of, np.concatenate(sizes))
        # a bijection of history and word, so n-grams are told apart exactly
        grams, at = distinct(mix((history << 32 | np.concatenate(words)).astype(np.uint64)))
        total = np.bincount(at, np.concatenate(here), len(grams)).astype(np.int64)
        held = np.bincount(at, minlength=len(grams)) > 1
        begun, less = np.empty(len(grams), np.int64), np.empty(len(grams), np.int64)
        begun[at], less[at] = history, np.concatenate(lower)
        few, seen = np.flatnonzero((total > 0) & (total <= FREQUENT)), np.flatnonzero(total)
        stats = np.bincount(begun[few] * FREQUENT + total[few] - 1, total[few], len(known) * FREQUENT).reshape(-1, FREQUENT)
        some = ((stats > 0) << np.arange(FREQUENT)).sum(1).astype(np.uint8)
        chances = np.bincount(begun[seen], discounted(less[seen], shorter), len(known))
        out, h, g = [(2, COUNTS + n, part, None, None, planes(_tally(total, limit)))], 0, 0
        for (chunk, _, _), size, word in zip(rows, sizes, words, strict=True):
            own, mine = of[h : h + len(size)], at[g : g + len(word)]
            wanting = own[_wanting(total[mine], size)]
            answer = framed(planes(total[mine].astype("<u4")), planes(held[mine]), planes(some[own]), planes(stats[wanting].astype("<u4").ravel()), planes(chances[wanting]))
            out.append((1, GROUPS + n, part, chunk, None, answer))
            h, g = h + len(size), g + len(word)
        return out

    return run


def train(corpus: Corpus, *, order: int = 3, keep: bool = True) -> Model:
    """Counts, discounts and weights from the learnt documents of corpus; corpus keeps its answers.

    What a step sends: the histories of one order, whose counts are known by then, and the counts of the next. With keep the tables are whole
    and score other documents too; without, chunks answer themselves what no other chunk holds, n-grams of order 3 on meet by their
    histories but for the frequent ones, and no table stays.
    """
    model = Model(order, corpus.parts, keep)
    known, spark, frequent = model.known, corpus.chunks.sparkSession, {}
    for n in range(1, order + 2):
        step = {"counts": n if n <= order else 0, "histories": n - 1 if n > 2 and (not known.together(n - 1) or frequent[n - 2]) else 0}
        if not any(step.values()):
            break
        meetings = {COUNTS + n: Meeting(1, _counted, lambda sums: _tally(sums[:, 0], known.limit), _numbered(n) if known.numbered(n) else None)}
        if step["counts"] and known.together(n):
            meetings[GROUPS + n] = _met_together(n, known.ds[n - 2], known.limit)
        if step["histories"]:
            meetings[WEIGHTS + n - 1] = Meeting(_STATS, _weighed(known.ds[n - 2]))
        back = met(_sent(corpus, known, **step), meetings, keep)
        # answers that a later step reads lie in one table, where the chunks do; those of the last counts, the most, are dealt to them only when what was sent is gone
        if keep or n >= order:
            out = written(back, f"lm-step{n}", by="kind", clean=True)
            corpus.answers.append(out)
        else:
            out = bucketed(back, "lm-steps", "chunk", corpus.buckets, "kind", *corpus.answers)
            corpus.answers = [out]
        model.tables.append(out)
        release(spark)
        if step["counts"]:
            tokens, kinds, texts, frequent[n], *of = tallied(out, COUNTS + n, FREQUENT + 5)
            known.ds.append(discounts(of))
            if n == 1:
                known.words, known.starts = Words(int(tokens), int(kinds), of), int(texts)
    corpus.answered = model
    return model


def _ask(corpus: Corpus, model: Model) -> None:
    """Lets documents ask the tables of a model that they have not made."""
    if corpus.answered is model:
        return
    if not model.known.keep:
        raise ValueError("a model without its tables scores its own corpus alone")
    for n in range(1, model.order + 2):
        step = {"counts": n if n <= model.order else 0, "histories": n - 1 if n > 2 else 0}
        if any(step.values()):
            asked = _sent(corpus, model.known, **step).where("keys IS NOT NULL")
            corpus.answers.append(written(looked_up(asked, model.tables[n - 1].where("kind = 0"), 2), f"lm-answers{n}", by="kind", clean=True))
    corpus.answered = model


RESULT = "doc_id long, learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(corpus: Corpus, model: Model) -> DataFrame:
    """RESULT: of every document the log10 probability of its tokens, by the model (score) and by single words' counts and one (base_score).

    A null text is empty and so one token, its end; a null doc_id stays. Rows of one doc_id are scored each. n_known are tokens
    that were learnt as words. With nothing learnt every token has probability 1. An empty table gives an empty result; other
    columns are ignored. A text longer than a chunk is a chunk of its own, so memory grows with the longest text.
    """
    _ask(corpus, model)
    known, order = model.known, model.order

    def run(row, a):
        at = Levels(row, a, known)
        first = np.cumsum(at.t.lengths) - at.t.lengths
        c = at.counts(1)[0][at.t.level(1)[1]]
        base = np.add.reduceat(np.log10((c + 1) / (known.words.tokens + known.words.kinds + 1)), first)
        own = np.add.reduceat(np.log10(at.p(order)), first)
        seen = np.add.reduceat((c > 0).astype(np.int64), first)
        ids = [i if k else None for i, k in zip(at.t.ids.tolist(), at.t.known.tolist(), strict=True)]
        return list(zip(ids, at.t.learnt.tolist(), at.t.lengths.tolist(), seen.tolist(), [known.words.tokens] * len(ids), base.tolist(), own.tolist(), strict=True))

    return corpus.each(run, RESULT)
