"""Tar shards of samples: a sink that rotates shards, an index of members, and a reader that goes to members by their offsets.

A sample is what members of one key in a row hold. An archive's headers are scanned once, by one task that skips the contents;
what is read afterwards are ranges of bytes, dealt to tasks by their size. So an archive may be larger than
any machine's memory, and one large archive is read by many tasks. What a task holds at a time is one sample.
"""

from __future__ import annotations

import bz2
import gzip
import io
import json
import lzma
import re
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Bytes of members that a task reads, and bytes of samples sent on at once.
SPLIT_BYTES, BATCH_BYTES = 64 << 20, 16 << 20
#: Archives whose headers, or labels, one task reads where there are more than a few for each core.
ARCHIVES = 64
#: Extensions of sound files.
SOUNDS = ("flac", "mp3", "m4a", "ogg", "opus", "wav", "wma")
SINK = "key string, parts map<string,binary>, label string, seconds double"
MANIFEST = "tar string, labels string, items int, seconds double"
INDEX = "tar string, sample long, key string, members array<struct<extension:string,offset:bigint,size:bigint>>, bytes long, error string"
SAMPLES = "tar string, sample long, key string, text string, sound binary, parts map<string,binary>, error string"


def located(path: str):
    """The file system of a path or URI, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def opened(path: str):
    """A file to read from any place; a compressed one is unpacked from its start on."""
    store, at = located(path)
    f = store.open_input_file(at)
    magic = f.read(6)
    f.seek(0)
    for start, unpack in ((b"\x1f\x8b", gzip.open), (b"BZh", bz2.open), (b"\xfd7zXZ\x00", lzma.open)):
        if magic.startswith(start):
            return unpack(io.BufferedReader(_Raw(f)))
    return io.BufferedReader(_Raw(f), 1 << 16)


class _Raw(io.RawIOBase):
    """An Arrow file as one of Python's."""

    def __init__(self, f: pa.NativeFile):
        self.f = f

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, to: int, whence: int = 0) -> int:
        return self.f.seek(to, whence)

    def tell(self) -> int:
        return self.f.tell()

    def readinto(self, into) -> int:
        data = self.f.read(len(into))
        into[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.f.close()
        super().close()


# --- the sink ---


class _Shards(WriterCommitMessage):
    def __init__(self, lines: list[str]):
        self.lines = lines


class TarShards(DataSource):
    """df.write.format("tar_shards").option("per_shard", n).save(folder): columns SINK.

    Each task writes archives of up to per_shard samples, every part as key.extension, a .jsonl of labels beside each
    (label, a JSON object, with the key as its id), and at the end one manifest of those that were committed:
    tar, labels, items, seconds, by white space. A shard that a lost task left behind is in no manifest.
    """

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return SINK

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _TarWriter(self.options["path"].rstrip("/"), int(self.options.get("per_shard", 1000)))


class _TarWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, per_shard: int):
        self.folder, self.per_shard = folder, per_shard

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Shards:
        store, at = located(self.folder)
        store.create_dir(f"{at}/shards", recursive=True)
        part, lines, shard, n, seconds = TaskContext.get().partitionId(), [], None, 0, 0.0

        def close():
            nonlocal shard, n, seconds
            for f in shard[1:]:
                f.close()
            lines.append(f"{self.folder}/shards/{shard[0]}.tar {self.folder}/shards/{shard[0]}.jsonl {n} {seconds!r}")
            shard, n, seconds = None, 0, 0.0

        for b in iterator:
            for row in b.to_pylist():
                if shard is None:
                    name = f"{part:06}-{len(lines):04}-{uuid.uuid4().hex[:8]}"
                    out = store.open_output_stream(f"{at}/shards/{name}.tar")
                    shard = (name, tarfile.open(fileobj=out, mode="w|", format=tarfile.PAX_FORMAT), out, store.open_output_stream(f"{at}/shards/{name}.jsonl"))
                for extension, data in row["parts"]:
                    info = tarfile.TarInfo(f"{row['key']}.{extension}")
                    info.size = len(data)
                    shard[1].addfile(info, io.BytesIO(data))
                label = json.loads(row["label"]) if row["label"] else {}
                shard[3].write((json.dumps({"id": row["key"]} | label, ensure_ascii=False) + "\n").encode())
                n, seconds = n + 1, seconds + (row["seconds"] or 0.0)
                if n == self.per_shard:
                    close()
        if shard:
            close()
        return _Shards(lines)

    def commit(self, messages) -> None:
        store, at = located(self.folder)
        store.create_dir(f"{at}/manifest", recursive=True)
        with store.open_output_stream(f"{at}/manifest/data.lst") as f:
            f.write("".join(line + "\n" for m in messages if m for line in m.lines).encode())

    def abort(self, messages) -> None:
        store, at = located(self.folder)
        store.delete_dir_contents(f"{at}/shards", missing_dir_ok=True)


def write_tar_shards(samples: DataFrame, folder: str, *, per_shard: int = 1000) -> str:
    """Writes samples (SINK) and returns where the manifest is."""
    samples.sparkSession.dataSource.register(TarShards)
    samples.select("key", "parts", "label", "seconds").write.format("tar_shards").option("per_shard", per_shard).mode("append").save(folder)
    return f"{folder.rstrip('/')}/manifest"


# --- the reader ---

#: How a member's name is split: by the first dot of its last part, or by the last dot of all.
FIRST_DOT, LAST_DOT = r"((?:.*/)?[^./][^./]*)\.([^/]*)", r"(.+)\.([^.]*)"


def _dealt(archives: DataFrame) -> DataFrame:
    """Archives dealt to tasks: one to each while they are few, then several, as the driver keeps an account of every task."""
    n = archives.count()
    return archives.repartition(max(1, min(n, max(4 * archives.sparkSession.sparkContext.defaultParallelism, -(-n // ARCHIVES)))))


def tar_index(archives: DataFrame, *, names: str = FIRST_DOT, strict: bool = False) -> DataFrame:
    """INDEX of the samples in archives (a column tar of paths or URIs): where their members are.

    Names that don't match are left out, as are folders and links, and names between double underscores; with strict they
    end the archive, as an unreadable header does: what stood before counts, and a row without a key tells the
    error. A member beyond the end of its file makes its sample one with an error. Compressed archives are read from their start.
    """
    pattern = re.compile(names, re.S)

    def scanned(path: str) -> Iterator[tuple]:
        sample, key, members, error = 0, None, [], None

        def ended():
            return (path, sample, key, members, sum(m["size"] for m in members), error)

        try:
            with opened(path) as f:
                length = f.seek(0, 2) if isinstance(f, io.BufferedReader) else None
                f.seek(0)
                tar = tarfile.open(fileobj=f, mode="r:")
                while (m := tar.next()) is not None:
                    tar.members = []  # else the whole archive's members stay in memory
                    if not m.isfile() or re.fullmatch(r"__.*__", m.name.rpartition("/")[2]):
                        continue
                    found = pattern.fullmatch(m.name)
                    if not found:
                        if strict:
                            raise tarfile.ReadError(f"no extension: {m.name}")
                        continue
                    if key is not None and found[1] != key:
                        yield ended()
                        sample, members, error = sample + 1, [], None
                    key = found[1]
                    members.append({"extension": found[2], "offset": m.offset_data, "size": m.size})
                    if length is not None and m.offset_data + m.size > length:
                        error = f"{m.name} is cut off"
            if key is not None:
                yield ended()
        except (OSError, EOFError, tarfile.TarError, lzma.LZMAError, zlib.error) as e:
            if members and not strict:
                yield ended()
            yield (path, -1, None, [], 0, f"{type(e).__name__}: {e}")

    def run(batches):
        for b in batches:
            rows = []
            for path in b.column(0).to_pylist():
                for row in scanned(path):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _batch(rows, _INDEX_TYPES)
                        rows = []
            yield _batch(rows, _INDEX_TYPES)

    return _dealt(archives.select("tar")).mapInArrow(run, INDEX)


_MEMBERS = pa.list_(pa.struct([("extension", pa.string()), ("offset", pa.int64()), ("size", pa.int64())]))
_INDEX_TYPES = pa.schema([("tar", pa.string()), ("sample", pa.int64()), ("key", pa.string()), ("members", _MEMBERS), ("bytes", pa.int64()), ("error", pa.string())])
_SAMPLE_TYPES = pa.schema([("tar", pa.string()), ("sample", pa.int64()), ("key", pa.string()), ("text", pa.string()), ("sound", pa.binary()), ("parts", pa.map_(pa.string(), pa.binary())), ("error", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def tar_samples(index: DataFrame, *, split: int = SPLIT_BYTES) -> DataFrame:
    """SAMPLES of an INDEX: text (.txt, decoded and stripped), sound (the first sound file), all other parts by extension.

    A sample with a bad member (cut off, no UTF-8, or two members of one extension) comes with its error and without parts; samples_read() and
    sample_errors() tell them apart. A task reads about `split` bytes of one archive, in order.
    """
    total = index.agg(F.sum("bytes")).first()[0] or 0
    block = F.floor(F.coalesce(F.get("members", F.lit(0))["offset"], F.lit(0)) / split)
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // split))
    dealt = index.repartition(int(tasks), "tar", block).sortWithinPartitions("tar", "sample")

    def run(batches):
        rows, held, at, f = [], 0, None, None
        for b in batches:
            for tar, sample, key, members, error in zip(*(b.column(c).to_pylist() for c in ("tar", "sample", "key", "members", "error")), strict=True):
                text, sound, parts = None, None, {}
                if tar != at and members and not error:
                    if f:
                        f.close()
                    f, at = opened(tar), tar
                for m in members if not error else []:
                    try:
                        f.seek(m["offset"])
                        data = f.read(m["size"])
                        if len(data) < m["size"]:
                            raise EOFError(f"{m['extension']} is cut off")
                        held += len(data)
                        kind = m["extension"]
                        if kind == "txt" and text is None:
                            text = data.decode("utf-8").strip()
                        elif kind in SOUNDS and sound is None:
                            sound = data
                        elif kind in parts or kind == "txt" or kind in SOUNDS:
                            raise ValueError(f"{kind} twice")
                        else:
                            parts[kind] = data
                    except (OSError, EOFError, ValueError) as e:
                        error = f"{type(e).__name__}: {e}"
                        break
                rows.append((tar, sample, key, None, None, [], error) if error else (tar, sample, key, text, sound, list(parts.items()), None))
                if held >= BATCH_BYTES or len(rows) == 1000:
                    yield _batch(rows, _SAMPLE_TYPES)
                    rows, held = [], 0
        yield _batch(rows, _SAMPLE_TYPES)

    return dealt.mapInArrow(run, SAMPLES)


def samples_read(samples: DataFrame) -> DataFrame:
    """Samples without an error."""
    return samples.where("error IS NULL").drop("error")


def sample_errors(samples: DataFrame) -> DataFrame:
    """tar, dropped (samples with an error), cut_short (1 where the archive's rest could not be read)."""
    bad = samples.where("error IS NOT NULL")
    return bad.groupBy("tar").agg(F.count_if(F.col("sample") >= 0).alias("dropped"), F.count_if(F.col("sample") < 0).alias("cut_short"))


def labels_of(manifest: DataFrame) -> DataFrame:
    """tar, key, label (the JSON line) of the label files of a manifest; of a key that repeats the last line counts; blank lines and lines without an id are skipped."""

    def run(batches):
        for b in batches:
            rows = []
            for tar, labels in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with opened(labels) as f:
                    for k, line in enumerate(f):
                        if line.strip():
                            item = json.loads(line)
                            if "id" in item:
                                rows.append((tar, str(item["id"]), k, line.decode("utf-8").strip()))
                        if len(rows) == 10_000:
                            yield _batch(rows, types)
                            rows = []
            yield _batch(rows, types)

    types = pa.schema([("tar", pa.string()), ("key", pa.string()), ("k", pa.int64()), ("label", pa.string())])
    lines = _dealt(manifest.select("tar", "labels")).mapInArrow(run, "tar string, key string, k long, label string")
    return lines.groupBy("tar", "key").agg(F.max_by("label", "k").alias("label"))


def labelled(samples: DataFrame, labels: DataFrame) -> DataFrame:
    """Samples with the label of their archive and key; a sample without one is an error.

    There are as many labels as samples, but Spark takes a few times the manifest for their size and would broadcast them: they are merged.
    """
    found = samples.join(labels.hint("merge"), ["tar", "key"], "left")
    missing = F.raise_error(F.concat(F.lit("no label for "), "key", F.lit(" of "), "tar"))
    return found.withColumn("label", F.coalesce("label", missing))


def array_bytes(values: Column, kind: str = "<i8") -> Column:
    """An array of numbers as a .npy file of one dimension."""
    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        def one(x):
            out = io.BytesIO()
            np.save(out, np.asarray(x, kind))
            return out.getvalue()

        return v.map(one, na_action="ignore")

    return packed(values)


def array_values(data: Column) -> Column:
    """The numbers of a .npy file, row after row."""
    @F.pandas_udf("array<double>")
    def read(v: pd.Series) -> pd.Series:
        return v.map(lambda x: np.load(io.BytesIO(x), allow_pickle=False).astype(float).ravel(), na_action="ignore")

    return read(data)
