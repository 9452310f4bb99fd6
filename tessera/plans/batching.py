"""Batches, shards, splits and streams of samples."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import batching as B
from tessera.operators import relational as R
from tessera.plans.registry import Tables, query, scratch
from tessera.streaming import events as E


def numbered(t: Tables) -> DataFrame:
    return R.numbered(t.documents.select("source", "doc_id", "n_chars"), [F.col("doc_id")], "source")


@query("f6_machine_split", "SELECT doc_id, doc_id % 4 AS machine FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.pmod("doc_id", F.lit(4)).alias("machine"))


@query("f7_repeat", "SELECT item_id, unnest(range(1, 4))::INTEGER AS repeat FROM benchmark")
def _(t: Tables) -> DataFrame:
    return B.repeated(t.benchmark.select("item_id"), 3)


@query("f12_static_batches", "SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8 AS batch FROM documents")
def _(t: Tables) -> DataFrame:
    return numbered(t).select("source", "doc_id", B.fixed(F.col("rn"), 8).alias("batch"))


@query(
    "f13_length_buckets",
    """WITH b AS (SELECT source, doc_id, CASE WHEN n_chars < 500 THEN 0 WHEN n_chars < 2000 THEN 1 WHEN n_chars < 8000 THEN 2 ELSE 3 END AS bucket FROM documents)
    SELECT source, doc_id, bucket, (row_number() OVER (PARTITION BY source, bucket ORDER BY doc_id) - 1) // CASE bucket WHEN 0 THEN 16 WHEN 1 THEN 8 WHEN 2 THEN 4 ELSE 1 END AS batch FROM b""",
)
def _(t: Tables) -> DataFrame:
    return B.bucket_batches(t.documents.select("source", "doc_id", "n_chars"), "source", ["doc_id"], "n_chars", [500, 2000, 8000], [16, 8, 4, 1]).select("source", "doc_id", "bucket", "batch")


@query("f15_padded_batches")
def _(t: Tables) -> DataFrame:
    return B.folded(t.documents, "source", "doc_id", "n_chars", partial(B.padded_fold, budget=20_000))


@query("f16_length_groups")
def _(t: Tables) -> DataFrame:
    return B.folded(t.documents, "source", "doc_id", "n_chars", partial(B.length_group_fold, budget=30_000, low=50, high=20_000, buckets=10, most=16))


@query(
    "f17_token_packing",
    """WITH RECURSIVE d AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
    f AS (
        SELECT source, doc_id, n_chars, rn, CASE WHEN n_chars > 16000 THEN -1 ELSE 0 END AS batch, 0 AS now, CASE WHEN n_chars > 16000 THEN 0 ELSE n_chars END AS used, n_chars <= 16000 AS any_ FROM d WHERE rn = 1
        UNION ALL
        SELECT d.source, d.doc_id, d.n_chars, d.rn,
               CASE WHEN d.n_chars > 16000 THEN -1 WHEN f.any_ AND f.used + d.n_chars > 16000 THEN f.now + 1 ELSE f.now END,
               CASE WHEN d.n_chars <= 16000 AND f.any_ AND f.used + d.n_chars > 16000 THEN f.now + 1 ELSE f.now END,
               CASE WHEN d.n_chars > 16000 THEN f.used WHEN f.any_ AND f.used + d.n_chars > 16000 THEN d.n_chars ELSE f.used + d.n_chars END, f.any_ OR d.n_chars <= 16000
        FROM f JOIN d ON d.source = f.source AND d.rn = f.rn + 1)
    SELECT source, doc_id, n_chars, batch::BIGINT AS batch FROM f""",
)
def _(t: Tables) -> DataFrame:
    return B.folded(t.documents, "source", "doc_id", "n_chars", partial(B.pack_fold, budget=16_000))


@query("f18_collated", "SELECT conv_id, list_resize(list(turn ORDER BY turn), 12, 0)::BIGINT[] AS tokens, list_resize(list((turn - m)::INTEGER ORDER BY turn), 12, -1)::INTEGER[] AS documents FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn), min(turn) OVER (PARTITION BY conv_id) AS m FROM conversations) GROUP BY conv_id")
def _(t: Tables) -> DataFrame:
    return B.collated(t.conversations.select("conv_id", "turn", F.array("turn").alias("toks")), ["conv_id"], "turn", "toks", 12)


@query("f20_split", "WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS total FROM documents) SELECT doc_id, CASE WHEN rn <= total - floor(total * 0.1) - floor(total * 0.05) THEN 'train' WHEN rn <= total - floor(total * 0.1) THEN 'dev' ELSE 'test' END AS split FROM n")
def _(t: Tables) -> DataFrame:
    d = R.numbered(t.documents.select("doc_id"), [F.col("doc_id")])
    return B.split_by_order(d, t.documents.count(), 0.1, 0.05).select("doc_id", "split")


@query("f3_epoch_shuffle")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", B.epoch_order(F.col("doc_id"), 3).alias("place")).orderBy("place", "doc_id")


@query("f10_weighted_interleave")
def _(t: Tables) -> DataFrame:
    w = F.when(F.col("lang") == "en", 1.0).otherwise(3.0)
    return t.documents.select("doc_id", "lang", B.weighted_order(F.col("doc_id"), w, 1).alias("place")).orderBy("place", "doc_id")


@query("f27_all_ready", "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING bool_and(o_orderstatus <> 'P')")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.bool_and(F.col("o_orderstatus") != "P").alias("ready")).where("ready").select("o_custkey")


@query("q26_chunks")
def _(t: Tables) -> DataFrame:
    return B.folded(t.conversations.withColumn("n", F.length("text").cast("long")), "conv_id", "turn", "n", partial(B.chunk_fold, budget=1200), "chunk")


@query("a27_entity_merge")
def _(t: Tables) -> DataFrame:
    names = F.array(F.element_at(F.split("p_name", " "), 1), F.col("p_type"))
    return B.merge_entities(t.part.select("p_brand", "p_partkey", names.alias("names")), "p_brand", "p_partkey", "names")


# --- streams, run to their end ---


def _collected(t: Tables, df: DataFrame, mode: str) -> DataFrame:
    """The stream's result: its micro-batches, written below the shared folder and read again."""
    spark, at = t.spark, scratch(t.spark, "stream")
    E.run_to_end(df, lambda part, n: part.write.mode("overwrite").parquet(f"{at}/out/n={n}"), f"{at}/state", mode)
    return spark.read.schema(df.schema).parquet(f"{at}/out/n=*")


@query("st1_window_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    s = E.window_counts(E.stream(t.spark, t.folder, "events"))
    return _collected(t, s, "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("st2_user_state", "SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    s = E.last_state(E.stream(t.spark, t.folder, "events"))
    out = _collected(t, s, "update")
    return out.groupBy("user_id").agg(F.max("n").alias("n"), F.max("errors").alias("errors"))


@query(
    "st3_sessions",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", user_id, count(*) AS n FROM s GROUP BY user_id, k""",
)
def _(t: Tables) -> DataFrame:
    e = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return E.sessions(e).select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "user_id", "n")
