"""Tar shards: what is written is read, bad members drop their samples, large archives are read in ranges."""

from __future__ import annotations

import gzip
import io
import tarfile

import pytest
from pyspark.sql import functions as F

from tessera.sources import archives as A
from tessera.sources.io import shard_manifest


def tar(path, members, cut=0):
    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w") as t:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    raw = data.getvalue()
    path.write_bytes(raw[: len(raw) - cut] if cut else raw)
    return str(path)


def index(spark, *paths, **options):
    return A.tar_index(spark.createDataFrame([(p,) for p in paths], "tar string"), **options)


def read(spark, *paths, split=A.SPLIT_BYTES, **options):
    return A.tar_samples(index(spark, *paths, **options), split=split)


def test_samples_by_key(spark, tmp_path):
    at = tar(tmp_path / "a.tar", [("x/1.json", b"{}"), ("x/1.tok.npy", b"12"), ("x/1.txt", " é \n".encode()), ("x/2.wav", b"RIFF"), ("__meta__", b""), ("noext", b""), ("x.y/3.txt", b"three")])
    rows = {r.key: r for r in read(spark, at).collect()}
    assert {k: (r.text, r.sound, r.parts) for k, r in rows.items()} == {
        "x/1": ("é", None, {"json": b"{}", "tok.npy": b"12"}), "x/2": (None, b"RIFF", {}), "x.y/3": ("three", None, {}),
    }
    assert [r.sample for r in sorted(rows.values(), key=lambda r: r.sample)] == [0, 1, 2]


def test_last_dot_splits_names_and_ends_an_archive_without_one(spark, tmp_path):
    members = [("a.b.txt", b"one"), ("a.b.wav", b"w"), ("c.txt", b"two"), ("noext", b""), ("d.txt", b"never")]
    rows = read(spark, tar(tmp_path / "a.tar", members), names=A.LAST_DOT, strict=True).collect()
    assert {r.key: r.text for r in rows if r.key} == {"a.b": "one"}
    assert [r.error for r in rows if not r.key] == ["ReadError: no extension: noext"]


@pytest.mark.parametrize(("bad", "why"), [(("2.txt", b"\xff"), "UnicodeDecodeError"), (("2.json", b"again"), "json twice"), (("2.flac", b"x"), "flac twice")])
def test_a_bad_member_drops_its_sample_alone(spark, tmp_path, bad, why):
    at = tar(tmp_path / "a.tar", [("1.txt", b"a"), ("2.json", b"{}"), ("2.wav", b"x"), bad, ("3.txt", b"c")])
    s = read(spark, at)
    assert [r.key for r in A.samples_read(s).orderBy("sample").collect()] == ["1", "3"]
    assert why in s.where("key = '2'").first().error
    assert tuple(A.sample_errors(s).first()) == (at, 1, 0)


def test_archives_that_end_too_early(spark, tmp_path):
    good = tar(tmp_path / "good.tar", [("1.txt", b"a")])
    cut = tar(tmp_path / "cut.tar", [("1.txt", b"a" * 600), ("2.txt", b"b" * 30_000)], cut=25_000)
    (tmp_path / "junk.tar").write_bytes(b"no archive " * 100)
    (tmp_path / "empty.tar").write_bytes(b"")
    s = read(spark, good, cut, str(tmp_path / "junk.tar"), str(tmp_path / "empty.tar"), str(tmp_path / "none.tar"))
    assert sorted((r.tar.rpartition("/")[2], r.key) for r in A.samples_read(s).collect()) == [("cut.tar", "1"), ("good.tar", "1")]
    errors = {r.tar.rpartition("/")[2]: (r.dropped, r.cut_short) for r in A.sample_errors(s).collect()}
    assert errors == {"cut.tar": (1, 1), "junk.tar": (0, 1), "empty.tar": (0, 1), "none.tar": (0, 1)}


def test_one_archive_is_read_by_many_tasks(spark, tmp_path):
    members = [(f"{i}.txt", f"text {i} ".encode() * 50) for i in range(400)]
    at = tar(tmp_path / "a.tar", members)
    s = read(spark, at, split=20_000)
    assert {r.key: r.text for r in s.collect()} == {f"{i}": ("text %d " % i * 50).strip() for i in range(400)}
    used = s.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 5


def test_compressed_archives(spark, tmp_path):
    at = tar(tmp_path / "a.tar", [(f"{i}.txt", b"x" * i) for i in range(50)])
    (tmp_path / "a.tar.gz").write_bytes(gzip.compress((tmp_path / "a.tar").read_bytes()))
    plain, packed = (sorted((r.key, r.text) for r in read(spark, p, split=9000).collect()) for p in (at, str(tmp_path / "a.tar.gz")))
    assert plain == packed and len(plain) == 50


def test_round_trip_with_labels(spark, tmp_path):
    rows = [(f"k{i}", {"txt": f"text {i}".encode(), "bin": bytes([i % 256])}, f'{{"n": {i}}}', i / 4) for i in range(250)] + [("none", {"txt": b""}, None, None)]
    d = spark.createDataFrame(rows, A.SINK).repartition(3)
    manifest = shard_manifest(spark, A.write_tar_shards(d, f"file://{tmp_path}/out", per_shard=40))
    assert manifest.agg(F.sum("items"), F.max("items"), F.sum("seconds")).first() == (251, 40, sum(i / 4 for i in range(250)))
    samples = A.samples_read(A.tar_samples(A.tar_index(manifest)))
    got = {r.key: (r.text, r.parts, r.n) for r in A.labelled(samples, A.labels_of(manifest)).select("*", F.get_json_object("label", "$.n").cast("int").alias("n")).collect()}
    assert got == {f"k{i}": (f"text {i}", {"bin": bytes([i % 256])}, i) for i in range(250)} | {"none": ("", {}, None)}
    some = A.labels_of(manifest).where("key <> 'k7'")
    with pytest.raises(Exception, match="no label for k7"):
        A.labelled(samples, some).collect()


def test_labels_keep_the_last_line_of_a_key(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"id": "a", "v": 1}\n\n{"v": 9}\n{"id": "a", "v": 2}\n{"id": 5}\n')
    m = spark.createDataFrame([("t.tar", str(tmp_path / "l.jsonl"))], "tar string, labels string")
    assert {r.key: r.label for r in A.labels_of(m).collect()} == {"a": '{"id": "a", "v": 2}', "5": '{"id": 5}'}


def test_labels_are_not_sent_through_the_driver(spark, tmp_path):
    """Spark guesses the size of labels from that of the manifest, so no join may be left to its size check."""
    from tessera.plans import QUERIES

    rows = [(i, "x" * (i % 50), "en", f"s{i % 3}", i % 50) for i in range(900)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    d = QUERIES["j16_label_lookup"](spark, str(tmp_path))
    assert sorted(map(tuple, d.select("key", "n", "lang", "source").collect())) == sorted((f"folder/d{i}", len(x), a, b) for i, x, a, b, _ in rows)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_tasks_take_several_of_many_archives(spark, tmp_path):
    tars = [tar(tmp_path / f"{i}.tar", [("a.txt", b"x")]) for i in range(5)]
    (tmp_path / "l.jsonl").write_text('{"id": "a", "v": 1}\n')
    few, many = (spark.createDataFrame([(p, str(tmp_path / "l.jsonl")) for p in tars * n], "tar string, labels string") for n in (1, 300))
    assert A.tar_index(few).rdd.getNumPartitions() == 5
    found, labels = A.tar_index(many), A.labels_of(many)
    assert found.count() == 1500 and labels.count() == 5
    assert found.rdd.getNumPartitions() == 4 * max(spark.sparkContext.defaultParallelism, 6)


def test_no_archives(spark):
    assert read(spark).count() == 0 and A.sample_errors(read(spark)).count() == 0


def test_arrays(spark):
    d = spark.createDataFrame([([1, 2, 300],), ([],), (None,)], "v array<long>")
    got = [r.v for r in d.select(A.array_values(A.array_bytes(F.col("v"))).alias("v")).collect()]
    assert got == [[1.0, 2.0, 300.0], [], None]
