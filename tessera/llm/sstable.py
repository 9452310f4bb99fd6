"""Sorted-string tables of token ids.

A shard file holds documents in key order:

    data blocks | index block | Bloom filter | footer

A data block is compressed; its entries are (shared key bytes, other key bytes, value bytes) as varints, the
other key bytes, the value. Its first key is whole, the next ones leave out what they share with the one
before. The index has the last key, place and size of each block; the footer, of fixed size at the end, has
the places of index and filter, counts and the width of an id. A lookup reads footer, filter and
index, finds the block by binary search and scans it.

Keys: byte 0 for a null doc_id, else byte 1 and the doc_id as 8 big-endian bytes with the sign turned, so byte
order is doc_id order. Equal keys follow each other.
"""

from __future__ import annotations

import bisect
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.runtime import scratch, tune
from tessera.llm.tokens import encoder

MAGIC = b"TSSTBL01"
FOOTER = struct.Struct("<QQQQQQQB7x8s")
BLOCK_BYTES, BLOOM_BITS, BLOOM_HASHES = 64 << 10, 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def doc_of(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        x = b[at]
        at += 1
        n |= (x & 127) << shift
        if x < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return [(a + k * b) % bits for k in range(BLOOM_HASHES)]


class Writer:
    """Writes one shard to a file object; keys must come in order."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.at = self.docs = self.tokens = 0
        self.block, self.last, self.raw = io.BytesIO(), b"", 0
        self.index: list[bytes] = []
        self.keys: list[bytes] = []
        self.codec = pa.Codec("zstd", 1)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        shared = 0
        if self.block.tell():
            if key < self.last:
                raise ValueError("keys out of order")
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        value = ids.astype(f"<u{self.width}").tobytes()
        self.block.write(_varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value)
        if not self.keys or key != self.keys[-1]:
            self.keys.append(key)
        self.last, self.docs, self.tokens = key, self.docs + 1, self.tokens + len(ids)
        if self.block.tell() >= BLOCK_BYTES:
            self._close_block()

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return self.at - len(data)

    def _close_block(self) -> None:
        raw = self.block.getvalue()
        if raw:
            packed = bytes(self.codec.compress(raw))
            at = self._put(packed)
            self.index.append(_varint(len(self.last)) + self.last + _varint(at) + _varint(len(packed)) + _varint(len(raw)) + struct.pack("<I", zlib.crc32(packed)))
            self.block = io.BytesIO()

    def close(self) -> None:
        self._close_block()
        index = self._put(b"".join(self.index))
        bits = max(64, len(self.keys) * BLOOM_BITS)
        bloom = np.zeros(bits, bool)
        for key in self.keys:
            bloom[_probes(key, bits)] = True
        filter_at = self._put(np.packbits(bloom, bitorder="little").tobytes())
        self._put(FOOTER.pack(index, filter_at, bits, len(self.index), len(self.keys), self.docs, self.tokens, self.width, MAGIC))


class Reader:
    """Reads one shard from a file object that can seek."""

    def __init__(self, src):
        self.src = src
        end = src.size()
        self.index_at, self.filter_at, self.bits, self.blocks, self.n_keys, self.docs, self.tokens, self.width, magic = FOOTER.unpack(src.read_at(FOOTER.size, end - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard file")
        self.codec = pa.Codec("zstd")
        raw, at, self.index = src.read_at(self.filter_at - self.index_at, self.index_at), 0, []
        for _ in range(self.blocks):
            n, at = _read_varint(raw, at)
            last, at = raw[at : at + n], at + n
            place, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            full, at = _read_varint(raw, at)
            self.index.append((last, place, size, full, struct.unpack_from("<I", raw, at)[0]))
            at += 4

    def block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, place, size, full, crc = self.index[k]
        packed = self.src.read_at(size, place)
        if zlib.crc32(packed) != crc:
            raise ValueError(f"block {k} is damaged")
        raw, at, key = bytes(self.codec.decompress(packed, full)), 0, b""
        while at < len(raw):
            shared, at = _read_varint(raw, at)
            other, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + other]
            at += other
            yield key, np.frombuffer(raw, f"<u{self.width}", size // self.width, at)
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for k in range(self.blocks):
            yield from self.block(k)

    def may_have(self, key: bytes) -> bool:
        bloom = self.src.read_at((self.bits + 7) // 8, self.filter_at)
        return all(bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, self.bits))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every row with that doc_id, in file order."""
        key, found = key_of(doc_id), []
        if not self.may_have(key):
            return found
        k = bisect.bisect_left(self.index, key, key=lambda x: x[0])
        while k < self.blocks:
            for own, ids in self.block(k):
                if own == key:
                    found.append(ids)
                elif own > key:
                    return found
            k += 1
        return found


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_shards(docs: DataFrame, uri: str, tokenizer: str, *, end_id: int = 0) -> DataFrame:
    """Tokenises every document, ends it with end_id and writes the shards below uri, which all machines reach.

    Rows are range-partitioned by doc_id, so shard k holds smaller ids than shard k + 1. Returns a row for
    each shard in order: shard, path, docs, tokens. A null text is empty; null doc_ids come first; rows
    with one doc_id are kept, ordered by text. A task that runs again writes the same file anew, and each
    file appears by renaming, complete.
    """
    spark = tune(docs.sparkSession)

    def run(batches):
        enc = encoder(tokenizer)
        width = 2 if max(enc.vocabulary, end_id + 1) <= 1 << 16 else 4
        store, root = _store(uri)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        final = f"{root}/shard-{task.partitionId():06d}.sst"
        own = f"{final}.{task.taskAttemptId()}.tmp"
        out = None
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if out is None:
                    out = store.open_output_stream(own)
                    w = Writer(out, width)
                w.add(key_of(doc), np.append(np.frombuffer(enc.encode(text), "<u4"), np.uint32(end_id)))
        if out is None:
            return
        w.close()
        out.close()
        store.move(own, final)
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int64()), pa.array([final]), pa.array([w.docs], pa.int64()), pa.array([w.tokens], pa.int64())], ["shard", "path", "docs", "tokens"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    made = d.mapInArrow(run, "shard long, path string, docs long, tokens long").collect()  # a row for each shard
    return spark.createDataFrame(sorted(made), "shard long, path string, docs long, tokens long")


def read_shards(shards: DataFrame, uri: str, *, with_ids: bool = True) -> DataFrame:
    """Every document of the shards: doc_id, start (ids before it), n_tokens, ids_crc32 and, if with_ids, ids."""
    spark = shards.sparkSession
    rows, before = [], 0
    for r in shards.orderBy("shard").collect():
        rows.append((r.shard, r.path, before))
        before += r.tokens
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches):
        store, _ = _store(uri)
        for b in batches:
            for path, start in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                with store.open_input_file(path) as f:
                    reader = Reader(f)
                    for k in range(reader.blocks):
                        got = [(doc_of(key), ids.astype("<u4")) for key, ids in reader.block(k)]
                        sizes = np.array([len(x) for _, x in got], np.int64)
                        starts = start + np.cumsum(sizes) - sizes
                        start += int(sizes.sum())
                        cols = [pa.array([d for d, _ in got], pa.int64()), pa.array(starts), pa.array(sizes), pa.array([zlib.crc32(x.tobytes()) for _, x in got], pa.int64())]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            cols.append(pa.array([x.astype("i4") for _, x in got], pa.list_(pa.int32())))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(cols, names)

    table = spark.createDataFrame(rows, "shard long, path string, start long")
    return table.repartition(max(1, len(rows))).mapInArrow(run, schema)


def token_table(docs: DataFrame, tokenizer: str, *, end_id: int = 0, uri: str | None = None, with_ids: bool = True) -> DataFrame:
    """Writes the shards and reads them back; see write_shards and read_shards."""
    uri = uri or scratch(docs.sparkSession, "sst")
    return read_shards(write_shards(docs, uri, tokenizer, end_id=end_id), uri, with_ids=with_ids)
