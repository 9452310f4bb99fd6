"""Removal of repeated passages by level-wise doubling.

Windows of `window` words count. A window can only repeat if a shorter one inside it repeats, so short windows
are counted first, and those repeated at one length alone are extended to twice that length, until the
windows themselves are reached or no candidate is left. At each level a window is stood for by one shorter
window inside it, the one of smallest hash; equal windows choose alike, so nothing is lost and only
about 2 in (window - length + 2) positions are counted.

Occurrences are dealt to parts by hash. Equal ones of one batch of documents are joined before that, so a passage that
a third of all documents share sends one entry from each batch. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import parts_for, release, tune, written
from tessera.llm.words import grams, hashes, mix, words

#: Bytes of input for each part that occurrences are dealt to.
PART_BYTES = 8 << 20
NULL_ID = -(1 << 63)
_MARKS = "k long, th long, marks binary"
_PACKED = "home int, keys binary, sizes binary, p binary"


def levels_of(window: int, base: int) -> list[int]:
    """base, doubled until it reaches the window."""
    out = [base]
    while out[-1] < window:
        out.append(min(window, out[-1] * 2))
    return out


def anchors(g: np.ndarray, span: int) -> np.ndarray:
    """For every start s the place of the smallest of g[s : s + span], the first of equal ones."""
    if span == 1:
        return np.arange(len(g))
    view = np.lib.stride_tricks.sliding_window_view(g, span)
    return np.arange(len(view)) + view.argmin(1)


def candidates(h: np.ndarray, window: int, level: int, before: int | None, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of length `level` that stand for windows whose stand-in of length `before` is marked."""
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = grams(h, level)
    at = anchors(g, window - level + 1)
    if before:
        known = np.zeros(len(h), bool)
        known[marked] = True
        at = at[known[anchors(grams(h, before), window - before + 1)]]
    at = np.unique(at)
    return at, g[at]


def _marks_of(places: bytes | None) -> np.ndarray:
    return np.frombuffer(places or b"", "<i4")


def _packed(doc: np.ndarray, pos: np.ndarray, keys: np.ndarray, parts: int) -> pa.Table:
    """Entries in one row for each part that documents are dealt to; keys has a row (k, th) for each doc number."""
    home = (mix(keys[:, 0].view(np.uint64) ^ keys[:, 1].view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((doc, home[doc]))
    doc, pos = doc[order], pos[order].astype("<i4")
    rows = []
    homes, starts = np.unique(home[doc], return_index=True)
    for h, x, y in zip(homes.tolist(), starts, np.append(starts, len(doc))[1:], strict=True):
        used, sizes = np.unique(doc[x:y], return_counts=True)
        rows.append((h, keys[used].astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), pos[x:y].tobytes()))
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["home", "keys", "sizes", "p"])


def _by_doc(t: pa.Table) -> pa.Table:
    """All places of each document, in one row."""
    keys = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in t["keys"].to_pylist()])
    sizes = np.concatenate([np.frombuffer(x, "<u4") for x in t["sizes"].to_pylist()]).astype(np.int64)
    pos = np.concatenate([np.frombuffer(x, "<i4") for x in t["p"].to_pylist()])
    row = np.repeat(np.arange(len(keys)), sizes)
    order = np.lexsort((keys[row, 1], keys[row, 0]))
    k, pos = keys[row[order]], pos[order]
    cuts = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
    first = np.concatenate([[0], cuts])
    return pa.table([pa.array(k[first, 0]), pa.array(k[first, 1]), pa.array([p.tobytes() for p in np.split(pos, cuts)], pa.binary())], ["k", "th", "marks"])


def _occurrences(docs: DataFrame, window: int, level: int, before: int | None, last: bool, parts: int) -> DataFrame:
    """Packed entries by part. kind 0: hashes, doc numbers, places; kind 1: places that this batch alone has settled."""

    def run(batches):
        shift = np.uint64(64 - int(math.log2(parts)))
        for b in batches:
            hs, ds, ps, keys = [], [], [], []
            marks = b.column(3).to_pylist() if before else None
            for i, (k, th, text) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)):
                keys.append((k, th))
                at, g = candidates(hashes(words(text)), window, level, before, _marks_of(marks[i]) if before else None)
                hs.append(g)
                ps.append(at)
                ds.append(np.full(len(at), i, np.int64))
            if not keys:
                continue
            keys = np.array(keys, np.int64)
            h, d, p = np.concatenate(hs), np.concatenate(ds), np.concatenate(ps)
            order = np.lexsort((p, keys[d, 1], keys[d, 0], h))
            h, d, p = h[order], d[order], p[order]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            out = []
            if last:
                # rows that are equal in key are one document: the same place in them is one window
                again = np.zeros(len(h), bool)
                if len(h):
                    start = np.flatnonzero(first)[np.cumsum(first) - 1]
                    again = ~first & ~((keys[d] == keys[d[start]]).all(1) & (p == p[start]))
                settled = again
            else:
                multiple = ~first
                multiple[:-1] |= ~first[1:]
                settled = multiple
            part = (h[first] >> shift).astype(np.int64) if parts > 1 else np.zeros(first.sum(), np.int64)
            fh, fd, fp = h[first], d[first], p[first]
            held, starts = np.unique(part, return_index=True)
            for q, x, y in zip(held.tolist(), starts, np.append(starts, len(part))[1:], strict=True):
                used, short = np.unique(fd[x:y], return_inverse=True)
                out.append((q, 0, keys[used].astype("<i8").tobytes(), fh[x:y].astype("<u8").tobytes(), short.astype("<u4").tobytes(), fp[x:y].astype("<i4").tobytes()))
            if settled.any():
                used, short = np.unique(d[settled], return_inverse=True)
                out.append((int(keys[0, 1]) % parts, 1, keys[used].astype("<i8").tobytes(), b"", short.astype("<u4").tobytes(), p[settled].astype("<i4").tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[2:])], ["part", "kind", "keys", "h", "d", "p"])

    return docs.mapInArrow(run, "part int, kind int, keys binary, h binary, d binary, p binary")


def _settle(entries: DataFrame, last: bool, parts: int) -> DataFrame:
    """Marks by document: at the last level every window but the first of its hash, before that every one that repeats."""

    def run(t: pa.Table) -> pa.Table:
        settled, open_ = ([], [], []), ([], [], [])
        hs, n = [], 0
        for kind, k, h, d, p in zip(*(t[c].to_pylist() for c in ("kind", "keys", "h", "d", "p")), strict=True):
            own = np.frombuffer(k, "<i8").reshape(-1, 2)
            to = settled if kind else open_
            to[0].append(np.frombuffer(d, "<u4").astype(np.int64) + n)
            to[1].append(np.frombuffer(p, "<i4"))
            settled[2].append(own)
            n += len(own)
            if not kind:
                hs.append(np.frombuffer(h, "<u8"))
        keys = np.concatenate(settled[2])
        docs, places = settled[0], settled[1]
        if hs:
            h, d, p = np.concatenate(hs), np.concatenate(open_[0]), np.concatenate(open_[1])
            order = np.lexsort((p, keys[d, 1], keys[d, 0], h)) if last else np.argsort(h, kind="stable")
            h, d, p = h[order], d[order], p[order]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            if last:
                start = np.flatnonzero(first)[np.cumsum(first) - 1]
                hit = ~first & ~((keys[d] == keys[d[start]]).all(1) & (p == p[start]))
            else:
                hit = ~first
                hit[:-1] |= ~first[1:]
            docs, places = [*docs, d[hit]], [*places, p[hit]]
        # a document has a number in each batch's entries; equal keys meet again in _by_doc
        return _packed(np.concatenate(docs), np.concatenate(places), keys, parts)

    return entries.groupBy("part").applyInArrow(run, _PACKED).groupBy("home").applyInArrow(_by_doc, _MARKS)


def covered(n: int, window: int, starts: np.ndarray) -> np.ndarray:
    """Which of n words lie in a window with one of these starts."""
    step = np.zeros(n + 1, np.int64)
    starts = np.unique(starts)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(n, starts + window), -1)
    return np.cumsum(step[:n]) > 0


def remove_repeats(docs: DataFrame, *, window: int = 20, base: int = 10, with_text: bool = True) -> DataFrame:
    """Removes every word covered by a window of `window` words whose sequence also starts earlier.

    Earlier: in a document of smaller doc_id, or before in the same one; all judged on the input. Rows: doc_id,
    n_words, n_removed, kept_sha256 (of the kept words joined by single spaces) and, if with_text, kept_text. A null text
    has no words. A null doc_id is smaller than all; rows equal in doc_id and text are one document, others
    of one doc_id are ordered by a hash of their texts. Other columns are ignored; an empty table gives an empty one.
    """
    spark = tune(docs.sparkSession)
    parts = 1 << math.ceil(math.log2(parts_for(docs, PART_BYTES)))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID).cast("long")).alias("k"), F.xxhash64("text").alias("th"), "text")
    marks, before = None, None
    for level in levels_of(window, base):
        last = level >= window
        src = d.select("k", "th", "text") if before is None else d.join(marks, ["k", "th"]).select("k", "th", "text", "marks")
        found = _settle(_occurrences(src, window, level, before, last, parts), last, parts)
        marks = written(found, f"repeats{level}")
        before = level
        del src, found
        release(spark)

    def run(batches):
        for b in batches:
            out = []
            for doc, text, places in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                ws = words(text)
                gone = covered(len(ws), window, _marks_of(places)) if places else None
                kept = b" ".join([w for w, g in zip(ws, gone.tolist(), strict=True) if not g] if places else ws)
                out.append((doc, len(ws), int(gone.sum()) if places else 0, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_text else None))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            arrays = [*(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3 : 4 + with_text])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: len(arrays)])

    return d.join(marks, ["k", "th"], "left").select("doc_id", "text", "marks").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
