"""Phrases that occur together more often than their words would, by sorted runs of packed word numbers.

Words that occur min_count times in a language are numbered; all others, and marks, break a piece, since no phrase with them
can be frequent. Phrases of a piece are keys of three 64-bit word numbers (the third 0 in a pair), sorted and counted in each
chunk by radix, then dealt to ranges of keys, where sorted runs of equal keys are added up. The ranges hold about as many
occurrences each: they are ranges of the first word's number, and a first word that alone holds more than a range is cut
further by ranges of the second. An entry is a phrase of a chunk, so a phrase of a third of all rows is one entry of each chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.chunks import CHUNK_WORDS, Numbering, chunk_number, grouped, runs, table, unzipped, zipped
from tessera.llm.runtime import discard, parts_for, release, tune, written

#: Bytes of documents whose phrases meet in one task.
PART_BYTES = 4 << 20
#: Marks that end a piece.
MARKS = b".,;:!?\n\x0b\x0c\r"
#: Stands for the end of a piece; no UTF-8 text holds this byte.
BREAK = b"\xff"
_ENDS = bytes.maketrans(MARKS, b"\n" * len(MARKS))
_CHUNK = "chunk long, lang string, n_words long, words binary, numbers binary"
_ENTRY = "part int, first binary, second binary, third binary, counts binary"


def pieces(text: bytes) -> list[bytes]:
    """Lower-case words in order, with BREAK at the end of every piece."""
    return [*text.lower().translate(_ENDS).replace(b"\n", b" " + BREAK + b" ").split(), BREAK]


def _chunks(docs: DataFrame) -> DataFrame:
    def run(batches):
        held: dict[str, Numbering] = {}
        total = k = 0

        def close():
            nonlocal k, total
            rows = []
            for lang, words in held.items():
                numbers = words.numbers()
                end = words.of.get(BREAK, -1)
                rows.append((chunk_number(k), lang, int((numbers != end).sum()), zipped(b"\n".join(words.of)), zipped(numbers)))
                k += 1
            held.clear()
            total = 0
            return table(rows, _CHUNK)

        for b in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).extend(pieces(text))
            for lang, words in by_lang.items():
                held.setdefault(lang, Numbering()).add(words)
                total += len(words)
            if total >= CHUNK_WORDS:
                yield close()
        yield close()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")).mapInArrow(run, _CHUNK)


def _words(chunks: DataFrame) -> DataFrame:
    """A row for every distinct word of a chunk: its number there and how often it occurs."""

    def run(batches):
        for b in batches:
            for chunk, lang, words, numbers in zip(*(b.column(c).to_pylist() for c in ("chunk", "lang", "words", "numbers")), strict=True):
                ws = unzipped(words, "u1").tobytes().split(b"\n")
                n = np.bincount(unzipped(numbers, "<u4"), minlength=len(ws))
                keep = [i for i, w in enumerate(ws) if w and w != BREAK]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), chunk)), pa.array([lang] * len(keep), pa.string()), pa.array([ws[i] for i in keep], pa.binary()), pa.array(keep, pa.int32()), pa.array(n[keep], pa.int64())], ["chunk", "lang", "word", "local", "n"])

    return chunks.mapInArrow(run, "chunk long, lang string, word binary, local int, n long")


class Ranges:
    """Ranges of keys by first word, and by second within frequent first words."""

    def __init__(self, words: DataFrame, parts: int):
        total, distinct = words.agg(F.sum("n"), F.count("*")).first()
        each = max(1, (total or 0) // parts)
        width = max(1, distinct // (8 * parts))
        # ids are 1 + (part << 33) + row: about 8 buckets for each range, and at most `parts` words that fill one alone
        bucket = F.shiftright(F.col("id") - 1, 33) * (1 << 33) + F.floor((F.col("id") - 1).bitwiseAND((1 << 33) - 1) / width) * width
        steps = sorted((int(b) + 1, int(n)) for b, n in words.groupBy(bucket.cast("long")).agg(F.sum("n")).collect())
        heavy = {r.id: r.n for r in words.where(F.col("n") > each).select("id", "n").collect()}
        starts, before = [0], 0
        for at, n in steps:
            if before >= each:
                starts.append(at)
                before = 0
            before += n
        starts = sorted({*starts, *heavy, *(i + 1 for i in heavy)})
        self.starts = np.array(starts, np.uint64)
        cuts = np.array([heavy.get(s, 0) // each + 1 for s in starts])
        self.base = np.concatenate([[0], np.cumsum(cuts)])
        self.cut = {i: self._shares(steps, int(c)) for i, c in enumerate(cuts) if c > 1}
        self.count = int(self.base[-1])

    @staticmethod
    def _shares(steps: list[tuple[int, int]], n: int) -> np.ndarray:
        """n - 1 numbers that part all occurrences of words into about equal shares."""
        at, upto = np.array([a for a, _ in steps], np.uint64), np.cumsum([n for _, n in steps])
        return at[np.minimum(len(at) - 1, np.searchsorted(upto, upto[-1] * np.arange(1, n) / n))]

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The range of each key; first is ascending."""
        i = np.searchsorted(self.starts, first, side="right") - 1
        out = self.base[i].copy()
        for k in np.unique(i).tolist():
            if k in self.cut:
                a, b = np.searchsorted(i, [k, k + 1])
                out[a:b] += np.searchsorted(self.cut[k], second[a:b], side="right")
        return out


def _phrases(chunks: DataFrame, numbered: DataFrame, ranges: Ranges, longest: int) -> DataFrame:
    """Every chunk's phrases of numbered words, counted, in a row for each range."""

    def run(t: pa.Table, ids: pa.Table) -> pa.Table:
        rows = []
        for numbers in t["numbers"].to_pylist():
            numbers = unzipped(numbers, "<u4").astype(np.int64)
            known = ids["id"].to_numpy().astype(np.uint64)
            order = np.argsort(known)
            known = known[order]
            # a word's rank among the chunk's numbered words is 1 and more; 0 breaks
            rank = np.zeros(int(numbers.max(initial=0)) + 1, np.uint64)
            rank[ids["local"].to_numpy()[order]] = np.arange(1, len(known) + 1)
            known = np.concatenate([[np.uint64(0)], known])
            w = rank[numbers]
            keys = []
            for n in range(2, longest + 1):
                if len(w) >= n:
                    cols = [w[i : len(w) - n + 1 + i] for i in range(n)]
                    whole = np.logical_and.reduce([c > 0 for c in cols])
                    cols = [c[whole] for c in cols]
                    keys.append((cols[0] << np.uint64(32) | cols[1], cols[2] if n == 3 else np.zeros(len(cols[0]), np.uint64)))
            if not keys:
                continue
            (pair, third), counts = runs([np.concatenate(x) for x in zip(*keys, strict=True)])
            first, second, third = known[pair >> np.uint64(32)], known[pair & np.uint64(0xFFFFFFFF)], known[third]
            for p, at in grouped(ranges.of(first, second)):
                rows.append((p, *(zipped(x[at]) for x in (first, second, third)), zipped(counts[at].astype("<i8"))))
        return pa.Table.from_batches([table(rows, _ENTRY)])

    return chunks.select("chunk", "numbers").groupBy("chunk").cogroup(numbered.groupBy("chunk")).applyInArrow(run, _ENTRY)


def _counted(entries: DataFrame, min_count: int) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        keys = [np.concatenate([unzipped(x, "<u8") for x in t[c].to_pylist()]) for c in ("first", "second", "third")]
        keys, n = runs(keys, np.concatenate([unzipped(x, "<i8") for x in t["counts"].to_pylist()]))
        keep = n >= min_count
        return pa.table([*(pa.array(k[keep].astype(np.int64)) for k in keys), pa.array(n[keep])], ["k1", "k2", "k3", "a"])

    return entries.groupBy("part").applyInArrow(run, "k1 long, k2 long, k3 long, a long")


def mine(docs: DataFrame, *, longest: int = 3, min_count: int = 10, subsumed: tuple[int, int] = (50, 100), top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to `longest` (2 or 3) words by score.

    docs has lang and text. Texts are lower-cased in A-Z, split into pieces at MARKS and these into words at spaces and
    tabs. a = f(phrase) counts all occurrences within pieces, overlapping ones too; a phrase is a candidate from min_count on. It is cut
    after its first k words into parts of counts l and r, with score floor(10^6 a a / (l r)), in decimals; the cut of smallest score
    counts, of equal ones the first. A pair inside a longer candidate of at least subsumed[0] / subsumed[1] of its count is
    dropped. n is the language's number of words. Ranks go by score and a descending, then by the phrase's bytes.

    A null lang is 'und', a null text empty; repeated rows count each; doc_id and other columns aren't read. A text longer than
    a chunk is a chunk of its own. Empty tables, and languages without candidates, give no rows.
    """
    if longest not in (2, 3):
        raise ValueError("phrases have up to 2 or 3 words")
    tune(docs.sparkSession)
    chunks = written(_chunks(docs), "phrase-chunks")
    of_chunks = _words(chunks)
    words = of_chunks.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    words = written(words.withColumn("id", F.monotonically_increasing_id() + 1), "phrase-words")
    numbered = of_chunks.join(words.select("lang", "word", "id").hint("merge"), ["lang", "word"]).select("chunk", "local", "id")
    phrases = written(_counted(_phrases(chunks, numbered, Ranges(words, parts_for(docs, PART_BYTES)), longest), min_count), "phrases")
    totals = chunks.groupBy("lang").agg(F.sum("n_words").alias("of"))
    totals = written(totals, "phrase-languages")
    discard(chunks)
    release(docs.sparkSession)

    two, three = phrases.where("k3 = 0").drop("k3"), phrases.where("k3 <> 0")
    head = two.select("k1", "k2", F.col("a").alias("f12"))
    tail = two.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("a").alias("f23"))
    over = three.select("k1", "k2", "a").unionByName(three.select(F.col("k2").alias("k1"), F.col("k3").alias("k2"), "a")).groupBy("k1", "k2").agg(F.max("a").alias("longer"))
    share, of = subsumed
    two = two.join(over, ["k1", "k2"], "left").where(F.col("longer").isNull() | (F.col("longer") * of < F.col("a") * share))
    three = three.join(head, ["k1", "k2"]).join(tail, ["k2", "k3"])
    null = F.lit(None).cast("long")
    c = two.select("k1", "k2", null.alias("k3"), "a", null.alias("f12"), null.alias("f23")).unionByName(three.select("k1", "k2", "k3", "a", "f12", "f23"))
    for k in ("1", "2", "3"):
        own = words.select(F.col("id").alias(f"k{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}"), *(["lang"] if k == "1" else []))
        c = c.join(own, f"k{k}", "left" if k == "3" else "inner")

    def cut(k: int, left: str, right: str):
        """Whole division of decimals: a below 10^16, l and r below 10^19."""
        score = F.expr(f"CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0)) * 1000000 DIV (CAST({left} AS DECIMAL(19, 0)) * CAST({right} AS DECIMAL(19, 0)))")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    best = F.when(F.col("k3").isNull(), cut(1, "n1", "n2")).otherwise(F.least(cut(1, "n1", "f23"), cut(2, "f12", "n3")))
    space = F.lit(b" ")
    phrase = F.when(F.col("k3").isNull(), F.concat("w1", space, "w2")).otherwise(F.concat("w1", space, "w2", space, "w3"))
    c = c.select("lang", phrase.cast("string").alias("phrase"), "a", best.alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    c = c.withColumn("rank", rank).where(F.col("rank") <= top)
    return c.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("of").alias("n"), "score")
