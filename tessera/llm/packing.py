"""Harmonic packing of token sequences.

Lengths are parted into classes: a piece of length n is in class j = capacity // n, and a bin of class j
takes exactly j pieces of that class. Each partition fills its own bins, so nothing is shuffled and
workers don't wait for each other. A document is cut into full sequences and, for a capacity that
is a power of two, its rest into pieces of power-of-two lengths: j pieces of class j then fill a bin to
the last token. What a partition has left in a class, fewer than j pieces, goes to bins of a power-of-two
number of pieces, which need no padding either.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import tune
from tessera.llm.tokens import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut(n: int, capacity: int) -> Iterator[int]:
    """Lengths of the pieces of a document of n tokens."""
    full, rest = divmod(n, capacity)
    yield from [capacity] * full
    if capacity & (capacity - 1):
        if rest:
            yield rest
        return
    for k in range(rest.bit_length() - 1, -1, -1):
        if rest >> k & 1:
            yield 1 << k


class Bins:
    """The open bins of one partition. A piece is (length, anything)."""

    def __init__(self, capacity: int):
        self.capacity, self.open = capacity, defaultdict(list)

    def add(self, length: int, piece) -> list | None:
        """The bin's pieces once it is full, else None."""
        j = self.capacity // length
        held = self.open[j]
        held.append((length, piece))
        if len(held) == j:
            self.open[j] = []
            return held
        return None

    def rest(self) -> Iterator[list]:
        """Bins of what is left; at powers of two, each with a power-of-two number of pieces."""
        for j, held in sorted(self.open.items()):
            if j & (j - 1):
                if held:
                    yield held
                continue
            while held:
                n = 1 << (len(held).bit_length() - 1)
                yield held[:n]
                held = held[n:]


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """Packs every document's tokens; a row for each piece: SCHEMA, and its ids if with_ids.

    A null text is empty, so it has only the end token; null and repeated doc_ids are kept as rows of
    their own; other columns are ignored; an empty table gives an empty one. Sequences have at most
    `capacity` tokens; pieces of a sequence lie at offsets without gaps from 0.
    """
    tune(docs.sparkSession)

    def run(batches):
        enc, bins, count = encoder(tokenizer), Bins(capacity), 0
        base = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        out: list[tuple] = []

        def close(held):
            nonlocal count
            offset = 0
            for length, (doc, start, total, crc, ids) in held:
                out.append((doc, start, length, crc, total, base + count, offset, ids))
                offset += length
            count += 1

        def flush():
            cols = list(zip(*out, strict=True)) if out else [[]] * 8
            out.clear()
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype("i4") for x in cols[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = enc.encode(text) + end
                total, start = len(ids) // 4, 0
                for n in cut(total, capacity):
                    own = ids[4 * start : 4 * (start + n)]
                    if full := bins.add(n, (doc, start, total, zlib.crc32(own), own if with_ids else None)):
                        close(full)
                    start += n
                if len(out) >= 20_000:
                    yield flush()
        for held in bins.rest():
            close(held)
        yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
