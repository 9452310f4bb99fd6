"""Texts as chunks of word numbers, and tables of 64-bit keys that chunks ask.

A chunk holds up to CHUNK_WORDS words of one task's documents: the chunk's own list of distinct words, and every
occurrence as a number into that list. Whatever is counted is counted inside a chunk before it is shuffled, so a frequent
word or phrase is one entry of a chunk. What a chunk needs to know of its keys it asks for with one row for each part of the
table's keys, and gets one row back, so rows don't grow with the number of keys and no part depends on one key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame


#: Words of a chunk, give or take one document: some 20 MB of text. It bounds a task's memory.
CHUNK_WORDS = 1 << 21
#: A sort by 16 bits at a time is a radix sort in numpy.
DIGIT = np.uint64(0xFFFF)


def zipped(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes())


def unzipped(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


class Numbering:
    """Numbers words in order of appearance."""

    def __init__(self):
        self.of: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, words: list[bytes]) -> None:
        if words:
            e = pa.array(words, pa.binary()).dictionary_encode()
            of = self.of
            to = np.array([of.setdefault(w, len(of)) for w in e.dictionary.to_pylist()], np.uint32)
            self.parts.append(to[e.indices.to_numpy()])
            self.n += len(words)

    def numbers(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)


def chunk_number(k: int) -> int:
    return (TaskContext.get().partitionId() << 32) + k


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable ascending order of keys given as unsigned words, the most significant first: a pass for every 16 bits that differ."""
    order = None
    for word in reversed(keys):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)) & DIGIT
            if len(digit) and (digit != digit[0]).any():
                digit = digit.astype(np.uint16)
                order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(keys[0])) if order is None else order


def runs(keys: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order, and the sum of their counts (how often each occurs without)."""
    if not len(keys[0]):
        return keys, np.zeros(0, np.int64)
    order = radix_order(keys)
    keys = [k[order] for k in keys]
    start = np.ones(len(order), bool)
    start[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(start)
    n = np.diff(np.append(first, len(order))) if counts is None else np.add.reduceat(counts[order].astype(np.int64), first)
    return [k[first] for k in keys], n


def grouped(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number that occurs in part, with its places, both ascending."""
    if len(part):
        order = np.argsort(part, kind="stable")
        held, first = np.unique(part[order], return_index=True)
        yield from zip(held.tolist(), np.split(order, first[1:]), strict=True)


def table(rows: Iterable[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split() for f in schema.split(",")]
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
    cols = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(cols, fields, strict=True)], [n for n, _ in fields])


# --- tables of 64-bit keys, which are hashes and so spread evenly: a part is a range of them ---


def planes(a: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: what they have in common takes no room."""
    a = np.ascontiguousarray(a)
    return zipped(np.ascontiguousarray(a.view(np.uint8).reshape(a.size, a.itemsize).T)) if a.size else b""


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(unzipped(data, "u1").reshape(size, -1).T).view(dtype).ravel()


def framed(*parts: bytes) -> bytes:
    """Several packed arrays as one, each after its length."""
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def unframed(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + size])
        at += 8 + size
    return out


def packed_keys(ascending: np.ndarray) -> bytes:
    return planes(np.diff(ascending, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "<u8"), dtype=np.uint64)


def hash_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of keys that are hashes: their first bits are sorted with their places in the last bits, which is far cheaper than sorting places."""
    bits = np.uint64(max(1, len(keys) - 1).bit_length())
    first = (keys >> bits) << bits
    order = (np.sort(first | np.arange(len(keys), dtype=np.uint64)) & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    s = keys[order]
    # keys that agree in their first bits alone stand in order of their places: such runs are few and short
    wrong, done = np.flatnonzero(s[1:] < s[:-1]), -1
    if len(wrong):
        first = s >> bits
        for i in wrong.tolist():
            if i >= done:
                a, b = np.searchsorted(first, first[i], "left"), np.searchsorted(first, first[i], "right")
                order[a:b] = order[a:b][np.argsort(s[a:b], kind="stable")]
                done = b
    return order


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once, and for every place the number of its key."""
    order = hash_order(keys)
    s = keys[order]
    start = np.append(True, s[1:] != s[:-1])[: len(s)]
    at = np.empty(len(s), np.int64)
    at[order] = np.cumsum(start) - 1
    return s[start], at


def cuts(ascending: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """For each part that has keys its number and where they are."""
    bounds = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    at = [0, *np.searchsorted(ascending, bounds).tolist(), len(ascending)]
    return [(p, slice(a, b)) for p, (a, b) in enumerate(zip(at, at[1:], strict=False)) if b > a]


#: Rows that a chunk sends: tag tells what they are about, columns holds a matrix of doubles with a row for each key; without keys, numbers to be added to a tally.
SENT = "tag int, part int, chunk long, keys binary, columns binary"
#: What comes back: kind 0 for a table's own rows, 1 for an answer to a chunk, in the order of the keys it sent, 2 for a tally.
BACK = "kind int, tag int, part int, chunk long, keys binary, columns binary"


def sent(tag: int, chunk: int, keys: np.ndarray, columns: np.ndarray, parts: int) -> list[tuple]:
    """Rows of SENT. keys are ascending."""
    return [(tag, p, chunk, packed_keys(keys[at]), planes(columns[at].ravel())) for p, at in cuts(keys, parts)]


class Meeting:
    """What happens to rows of one tag where those of all chunks meet.

    Equal keys are added up in `width` columns. answer(sums, chunks, at, columns) gives the table's columns, a row for each key, and the
    answers, a row for each that was sent: sums and the number of chunks by key, the number of the key by row sent, and what was
    sent. tally(sums) gives numbers that are added up over all parts. numbered(sums, chunks) tells which keys get numbers, in their order;
    then answers end with the key's number in its part, less that of the key before (other keys have the number of the last that has one).
    """

    def __init__(self, width: int, answer, tally=None, numbered=None):
        self.width, self.answer, self.tally, self.numbered = width, answer, tally, numbered


def met(rows: DataFrame, meetings: dict[int, Meeting], keep: bool = True) -> DataFrame:
    """BACK of the rows of SENT, by their tags. Without keep the tables' own rows are left out.

    Instead of a Meeting a tag may have a function of a part's number and its rows (chunk, keys, columns) that gives rows of BACK.
    """

    def run(t: pa.Table) -> pa.Table:
        tag, part, more = t["tag"][0].as_py(), t["part"][0].as_py(), 0.0
        m, chunks, packed, columns = meetings[tag], [], [], [np.zeros(0)]
        rows = zip(*(t[c].to_pylist() for c in ("chunk", "keys", "columns")), strict=True)
        if not isinstance(m, Meeting):
            return pa.Table.from_batches([table(m(part, list(rows)), BACK)])
        for chunk, keys, values in rows:
            values = from_planes(values, "<f8")
            if keys is None:
                more = more + values
            else:
                chunks.append(chunk)
                packed.append(unpacked_keys(keys))
                columns.append(values)
        columns = np.concatenate(columns).reshape(-1, m.width)
        keys, at = distinct(np.concatenate([np.zeros(0, np.uint64), *packed]))
        sums = np.column_stack([np.bincount(at, columns[:, i], len(keys)) for i in range(m.width)])
        holding = np.bincount(at, minlength=len(keys))
        own, back = m.answer(sums, holding, at, columns)
        number = np.cumsum(m.numbered(sums, holding))[at] if m.numbered else None
        out, place = [], 0
        if keep:
            some = own.any(axis=1)
            out.append((0, tag, part, None, packed_keys(keys[some]), planes(own[some].ravel())))
        for chunk, mine in zip(chunks, packed, strict=True):
            own_back = back[place : place + len(mine)]
            if m.numbered:
                own_back = np.column_stack([own_back, np.diff(number[place : place + len(mine)], prepend=0)])
            out.append((1, tag, part, chunk, None, planes(own_back.ravel())))
            place += len(mine)
        if m.tally:
            out.append((2, tag, part, None, None, planes(m.tally(sums) + more)))
        return pa.Table.from_batches([table(out, BACK)])

    return rows.groupBy("tag", "part").applyInArrow(run, BACK)


def tallied(back: DataFrame, tag: int, width: int) -> list[float]:
    """The sum of all tallies of one tag."""

    def run(batches):
        for b in batches:
            yield table([tuple(from_planes(x, "<f8").tolist()) for x in b.column(0).to_pylist()], schema)

    schema = ", ".join(f"t{i} double" for i in range(width))
    r = back.where(f"kind = 2 AND tag = {tag}").select("columns").mapInArrow(run, schema).groupBy().sum().first()
    return [x or 0.0 for x in r]


def looked_up(asked: DataFrame, kept: DataFrame, width: int, missing: float = 0.0) -> DataFrame:
    """BACK, answers alone: for every row of SENT (columns are ignored) what a table's rows (kind 0 of BACK) have for its keys."""

    def run(q: pa.Table, t: pa.Table) -> pa.Table:
        keys, columns = np.zeros(0, np.uint64), np.zeros((0, width))
        if t.num_rows:
            keys, columns = unpacked_keys(t["keys"][0].as_py()), from_planes(t["columns"][0].as_py(), "<f8").reshape(-1, width)
        rows = []
        for tag, part, chunk, mine in zip(*(q[c].to_pylist() for c in ("tag", "part", "chunk", "keys")), strict=True):
            mine = unpacked_keys(mine)
            out = np.full((len(mine), width), missing)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
                hit = keys[at] == mine
                out[hit] = columns[at[hit]]
            rows.append((1, tag, part, chunk, None, planes(out.ravel())))
        return pa.Table.from_batches([table(rows, BACK)])

    return asked.groupBy("tag", "part").cogroup(kept.groupBy("tag", "part")).applyInArrow(run, BACK)


def received(answers: dict[int, bytes], keys: np.ndarray, parts: int, width: int) -> np.ndarray:
    """A chunk's answers by part as one matrix, with a row for each of the keys it sent."""
    out = np.zeros((len(keys), width))
    for p, at in cuts(keys, parts):
        out[at] = from_planes(answers[p], "<f8").reshape(-1, width)
    return out
