"""Queries that write tar shards, array archives and sound files from the tables and read them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.registry import Tables, query, scratch
from tessera.sources import archives as A
from tessera.sources import io

_STRIPPED = "regexp_replace(text, '^[\\s\\x0b\\x1c-\\x1f\\x85\\xa0]+|[\\s\\x0b\\x1c-\\x1f\\x85\\xa0]+$', '', 'g')"


def _shards(t: Tables, text: Column | None = None, per_shard: int = 300) -> str:
    """documents as tar shards of a text, an array (doc_id, n_chars) and a label; gives the manifest's place."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary") if text is None else text
    parts = F.map_from_arrays(F.array(F.lit("txt"), F.lit("npy")), F.array(body, A.array_bytes(F.array("doc_id", "n_chars"))))
    d = t.documents.select(F.concat(F.lit("folder/d"), "doc_id").alias("key"), parts.alias("parts"), F.to_json(F.struct("lang", "source")).alias("label"), (F.col("n_chars") / 16).alias("seconds"))
    return A.write_tar_shards(d, scratch(t.spark, "tar"), per_shard=per_shard)


@query("s9_tar_samples", f"SELECT 'folder/d' || doc_id AS key, {_STRIPPED} AS text, doc_id::DOUBLE AS id, n_chars::DOUBLE AS n_chars FROM documents")
def _(t: Tables) -> DataFrame:
    """Samples of every shard: the text, and the array's numbers."""
    manifest = io.shard_manifest(t.spark, _shards(t))
    numbers = A.array_values(F.element_at("parts", "npy"))
    s = A.samples_read(A.tar_samples(A.tar_index(manifest))).select("key", "text", numbers.alias("v"))
    return s.select("key", "text", F.get("v", F.lit(0)).alias("id"), F.get("v", F.lit(1)).alias("n_chars"))


@query("s10_tar_groups", f"SELECT 'folder/d' || doc_id AS key, {_STRIPPED} AS text, (SELECT count(*) FROM documents WHERE doc_id % 7 = 3) AS dropped FROM documents WHERE doc_id % 7 <> 3")
def _(t: Tables) -> DataFrame:
    """Texts of every seventh document are no UTF-8: such samples are dropped, and counted by archive."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    bad = F.when(F.col("doc_id") % 7 == 3, F.concat(text, F.lit(b"\xff\xfe"))).otherwise(text)
    samples = A.tar_samples(A.tar_index(io.shard_manifest(t.spark, _shards(t, bad)), names=A.LAST_DOT, strict=True))
    dropped = A.sample_errors(samples).agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("dropped"))
    return A.samples_read(samples).select("key", "text").crossJoin(F.broadcast(dropped))


@query("j16_label_lookup", "SELECT 'folder/d' || doc_id AS key, length(text)::INTEGER AS n, lang, source FROM documents")
def _(t: Tables) -> DataFrame:
    """Every sample with the label of its archive's label file."""
    manifest = io.shard_manifest(t.spark, _shards(t))
    samples = A.samples_read(A.tar_samples(A.tar_index(manifest))).select("tar", "key", F.element_at("parts", "npy").alias("npy"))
    of = lambda name: F.get_json_object("label", f"$.{name}").alias(name)
    return A.labelled(samples, A.labels_of(manifest)).select("key", F.get(A.array_values(F.col("npy")), F.lit(1)).cast("int").alias("n"), of("lang"), of("source"))


@query("s20_s21_shard_manifest_of_tars", "SELECT count(*)::BIGINT AS items, count(DISTINCT doc_id)::BIGINT AS keys, sum(n_chars / 16.0)::DOUBLE AS seconds, true AS within FROM documents")
def _(t: Tables) -> DataFrame:
    """The manifest of the shards against what the archives hold."""
    manifest = io.shard_manifest(t.spark, _shards(t, per_shard=100))
    keys = A.tar_index(manifest).agg(F.count_distinct("key").alias("keys"))
    return manifest.agg(F.sum("items").cast("long").alias("items"), F.sum("seconds").alias("seconds"), (F.max("items") <= 100).alias("within")).crossJoin(F.broadcast(keys))
