"""Queries that write files of a kind and read them back, and further functions by themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions import values as V
from tessera.operators import batching as B
from tessera.operators import jobs as J
from tessera.operators import metrics as M
from tessera.operators import quality as Q
from tessera.operators import reader
from tessera.operators import reading as R
from tessera.operators import relational as L
from tessera.operators import stories as S
from tessera.plans.registry import Tables, chapters, jobs, query, scratch
from tessera.sources import io


def _lines(t: Tables, df: DataFrame, what: str) -> str:
    at = scratch(t.spark, what)
    df.write.text(at)
    return at


@query("s4_z16_text_or_file", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND text <> '' THEN 'db' WHEN doc_id % 3 = 1 THEN 'file' ELSE 'none' END AS origin, CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN 'f' || doc_id ELSE '' END AS effective FROM documents")
def _(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 3
    d = t.documents.select("doc_id", F.when(k == 0, F.col("text")).alias("content"), F.concat(F.lit("p"), "doc_id").alias("at"))
    files = t.documents.where(k == 1).select(F.concat(F.lit("p"), "doc_id").alias("path"), F.concat(F.lit("f"), "doc_id").alias("value"))
    return io.text_with_fallback(d, "content", files, "at").select("doc_id", "origin", "effective")


@query("s5_json_lines", "SELECT 'd' || doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN text END AS text FROM documents WHERE doc_id % 5 <> 0")
def _(t: Tables) -> DataFrame:
    good = F.to_json(F.struct(F.concat(F.lit("d"), "doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("text")))
    at = _lines(t, t.documents.select(F.when(F.col("doc_id") % 10 == 0, "").when(F.col("doc_id") % 5 == 0, F.lit("{broken")).otherwise(good).alias("value")), "jsonl")
    return io.json_lines(t.spark, at).select("id", "text")


@query("s6_json_lines_of_a_worker", "SELECT doc_id::VARCHAR AS id FROM documents WHERE doc_id % 4 = 1 AND (doc_id // 4) % 3 = 2")
def _(t: Tables) -> DataFrame:
    at = _lines(t, t.documents.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"))).alias("value")), "jsonl")
    k = F.col("id").cast("long")
    return io.json_lines(t.spark, at).where((k % 4 == 1) & (F.floor(k / 4) % 3 == 2)).select("id")


@query("s8_shard_manifest", "SELECT 'a' || n_nationkey || '.tar' AS tar, 'l' || n_nationkey AS labels, n_regionkey::INTEGER AS items, n_nationkey * 0.5::DOUBLE AS seconds FROM nation")
def _(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    return io.shard_manifest(t.spark, _lines(t, t.nation.select(F.concat(F.lit("a"), k, F.lit(".tar  l"), k, F.lit(" "), "n_regionkey", F.lit(" "), k * 0.5).alias("value")), "manifest"))


@query("s11_lines", "SELECT n_name AS line, 1 AS files FROM nation")
def _(t: Tables) -> DataFrame:
    at = _lines(t, t.nation.coalesce(1).select(F.col("n_name").alias("value")), "lines")
    d = io.lines_with_file(t.spark, at)
    return d.select("line", F.when(F.col("file").endswith(".txt"), 1).otherwise(0).alias("files"))


@query("s15_tsv", "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer")
@query("s25_metrics_tsv", "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer")
def _(t: Tables) -> DataFrame:
    at = scratch(t.spark, "tsv")
    io.write_tsv(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")), at)
    return io.tsv(t.spark, at, "key long, name string, balance double")


@query("s17_symbols", "SELECT n_name AS symbol, n_nationkey::INTEGER AS id FROM nation WHERE NOT contains(n_name, ' ')")
def _(t: Tables) -> DataFrame:
    return io.symbol_table(t.spark, _lines(t, t.nation.where("NOT contains(n_name, ' ')").select(F.concat_ws(" ", "n_name", "n_nationkey").alias("value")), "symbols"))


@query("s19_glossary", "SELECT n_name AS canonical, n_regionkey = 1 AS priority FROM nation")
def _(t: Tables) -> DataFrame:
    terms = t.nation.select(F.struct(F.col("n_name").alias("canonical"), (F.col("n_regionkey") == 1).alias("priority")).alias("x"))
    at = _lines(t, terms.agg(F.to_json(F.collect_list("x")).alias("value")), "glossary")  # a seed glossary is one small JSON array
    return io.glossary(t.spark, at).select("canonical", "priority")


@query("s22_findings", r"SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{6,}')) AS matched FROM documents")
def _(t: Tables) -> DataFrame:
    at = scratch(t.spark, "findings")
    Q.rule_findings(t.documents.select("doc_id", "text"), "text", [("number", "warning", "[0-9]{6,}")]).write.json(at)
    return t.spark.read.schema("doc_id long, matched string").json(at)


@query("s23_survey", "SELECT source, count(*) AS n, avg(n_chars) > 0 AS some FROM documents GROUP BY source")
def _(t: Tables) -> DataFrame:
    at = scratch(t.spark, "survey")
    d = t.documents.groupBy("source").agg(F.count("*").alias("n"), (F.avg("n_chars") > 0).alias("some"))
    d.write.json(f"{at}/json")
    d.write.option("header", True).csv(f"{at}/csv")
    both = t.spark.read.schema("source string, n long, some boolean").json(f"{at}/json").unionByName(t.spark.read.schema("source string, n long, some boolean").option("header", True).csv(f"{at}/csv"))
    return both.groupBy("source", "n", "some").agg(F.count("*").alias("times")).where("times = 2").drop("times")


@query("j15_known_labels", "SELECT quality::INTEGER AS truth, toxic::INTEGER AS predicted, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality >= 0 GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    d = t.documents.join(t.labels, "doc_id").select(F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    return M.confusion(d, "quality", "toxic")


@query("t11_slug", "SELECT n_nationkey, trim(regexp_replace(lower(strip_accents(n_name || ' Ế-é')), '[^a-z0-9]+', '-', 'g'), '-') AS v FROM nation")
def _(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", X.slug(F.concat("n_name", F.lit(" Ế-é"))).alias("v"))


@query("t17_unaccented", "SELECT doc_id, lower(replace(strip_accents(text), 'ß', 'ss')) AS v FROM documents WHERE regexp_full_match(text, '(?s)[\\x00-\\x{17F}]*')")
def _(t: Tables) -> DataFrame:
    return t.documents.where(F.col("text").rlike(r"^[\x00-\u017F]*$")).select("doc_id", X.unaccented(F.col("text")).alias("v"))


@query("t21_bounded", r"SELECT doc_id, regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])license($|[^\p{L}\p{N}_])') AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.bounded(F.col("text"), "License").alias("v"))


@query("t25_title_key", "SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS v FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", reader.title_key(F.concat(F.lit("## "), "p_name", F.lit("!"))).alias("v"))


@query("t29_short_parts")
def _(t: Tables) -> DataFrame:
    return reader.short_parts(t.documents.where("text IS NOT NULL"), "text").select("doc_id", F.posexplode("parts").alias("place", "part"))


@query("t44_cjk_spaces", "SELECT n_nationkey, '漢字' || n_name || ' x' AS v FROM nation")
def _(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", X.without_cjk_spaces(F.concat(F.lit("漢 字 "), "n_name", F.lit("  x "))).alias("v"))


@query("x1_recent", "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 90 MINUTE")
def _(t: Tables) -> DataFrame:
    last = t.events.agg(F.max("ts").alias("last"))
    return t.events.join(F.broadcast(last)).where(F.col("ts") > F.col("last") - F.make_interval(mins=F.lit(90))).select("event_id")  # one row is broadcast


@query("n9_any_all", "SELECT doc_id, len(list_filter(ws, lambda x: x = 'the')) > 0 AS some, len(list_filter(ws, lambda x: length(x) < 20)) = len(ws) AS every FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)")
def _(t: Tables) -> DataFrame:
    ws = F.split("text", " ")
    return t.documents.select("doc_id", F.exists(ws, lambda x: x == "the").alias("some"), F.forall(ws, lambda x: F.length(x) < 20).alias("every"))


@query("n11_precedence", "SELECT p_partkey, p_name AS a, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'seed' END AS b FROM part")
def _(t: Tables) -> DataFrame:
    seed = F.create_map(F.lit("a"), F.col("p_name"), F.lit("b"), F.lit("seed"))
    own = F.when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("b"), F.col("p_type")))
    return t.part.select("p_partkey", V.json_merge(seed, own).alias("m")).select("p_partkey", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"))


@query("q12_register", r"""SELECT doc_id, list_filter(['version', 'the'], lambda k: regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])' || k || '($|[^\p{L}\p{N}_])'))[1:1] AS terms FROM documents""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", Q.surfaces_found(F.col("text"), ["the", "version"], 1).alias("terms"))


@query("q22_save_gate", "SELECT doc_id FROM documents WHERE length(trim(text, ' ')) >= 100 AND NOT contains(text, 'License')")
def _(t: Tables) -> DataFrame:
    codes = F.array_compact(F.array(F.when(Q.too_short(F.col("text")), "output_too_short"), F.when(F.contains("text", F.lit("License")), "forbidden_term:License")))
    return Q.audited(t.documents.select("doc_id", codes.alias("codes"))).where("passed").select("doc_id")


@query("q24_patched", "SELECT doc_id, CASE WHEN contains(text, 'the') THEN left(text, strpos(text, 'the') - 1) || 'THE' || substr(text, strpos(text, 'the') + 3) ELSE text END AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", Q.patch_first(F.col("text"), F.lit("the"), F.lit("THE")).alias("v"))


@query("f4_f11_orders")
def _(t: Tables) -> DataFrame:
    """Shards in an epoch's order, and sources interleaved by their sizes, which are the default weights."""
    size = t.documents.groupBy("source").agg(F.count("*").cast("double").alias("w"))
    d = t.documents.select("doc_id", "source").join(size, "source")
    return d.select("doc_id", B.epoch_order(F.col("source"), 2).alias("shard_place"), B.weighted_order(F.col("doc_id"), F.col("w"), 2).alias("place"))


@query("f9_local_sort", "WITH n AS (SELECT lang, doc_id, n_chars, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 16 AS buffer FROM documents) SELECT lang, doc_id, buffer, row_number() OVER (PARTITION BY lang, buffer ORDER BY n_chars, doc_id) AS place FROM n")
def _(t: Tables) -> DataFrame:
    d = L.local_sort(t.documents.select("lang", "doc_id", "n_chars"), [F.col("doc_id")], [F.col("n_chars"), F.col("doc_id")], 16, "lang")
    place = [c for c in d.columns if c not in ("lang", "doc_id", "n_chars", "rn", "buffer")][0]
    return d.select("lang", "doc_id", "buffer", F.col(place).cast("long").alias("place"))


@query("f14_window_groups", "SELECT lang, doc_id, CASE WHEN n_chars < 1000 THEN 0 ELSE 1 END AS bucket, (row_number() OVER (PARTITION BY lang, n_chars < 1000 ORDER BY doc_id) - 1) // CASE WHEN n_chars < 1000 THEN 8 ELSE 4 END AS batch FROM documents")
def _(t: Tables) -> DataFrame:
    return B.bucket_batches(t.documents.select("lang", "doc_id", "n_chars"), "lang", ["doc_id"], "n_chars", [1000], [8, 4]).select("lang", "doc_id", "bucket", "batch")


@query("f21_chunks", "SELECT lang, doc_id, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 50 AS chunk FROM documents")
def _(t: Tables) -> DataFrame:
    return L.numbered(t.documents.select("lang", "doc_id"), [F.col("doc_id")], "lang").select("lang", "doc_id", B.fixed(F.col("rn"), 50).alias("chunk"))


@query("f22_metadata", "SELECT json_object('n_nationkey', n_nationkey, 'n_name', n_name)::VARCHAR AS value FROM nation")
def _(t: Tables) -> DataFrame:
    return io.as_json_lines(t.nation.select("n_nationkey", "n_name", F.lit(None).cast("string").alias("none")))


@query(
    "m4_upsert_story",
    """WITH n AS (SELECT s_nationkey AS id, min(s_name) AS title, count(*) AS total, bool_or(s_acctbal < 0) AS done FROM supplier GROUP BY 1)
    SELECT coalesce(n_nationkey, id) AS id, CASE WHEN n_nationkey IS NULL THEN title ELSE coalesce(title, n_name) END AS title, CASE WHEN id IS NULL THEN n_regionkey WHEN n_nationkey IS NULL THEN total ELSE greatest(n_regionkey, total) END AS total,
           CASE WHEN id IS NULL THEN n_regionkey = 0 WHEN n_nationkey IS NULL THEN done ELSE coalesce(n_regionkey = 0, false) OR coalesce(done, false) END AS done
    FROM nation FULL JOIN n ON n_nationkey = id""",
)
def _(t: Tables) -> DataFrame:
    old = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"), F.col("n_regionkey").cast("long").alias("total"), (F.col("n_regionkey") == 0).alias("done"))
    new = t.supplier.groupBy(F.col("s_nationkey").alias("id")).agg(F.min("s_name").alias("title"), F.count("*").alias("total"), F.bool_or(F.col("s_acctbal") < 0).alias("done"))
    return J.upsert(old, new, ["id"], {"title": J.keep_unless_new, "total": J.greatest, "done": J.either})


@query("m17_stale_segments", "WITH {JOBS} SELECT job_id, CASE WHEN status = 'running' AND locked_at < TIMESTAMP '1997-01-01' - INTERVAL 30 MINUTE THEN CASE WHEN attempts >= max_attempts THEN 'failed' ELSE 'pending' END ELSE status END AS status FROM jobs")
def _(t: Tables) -> DataFrame:
    return J.reset_stale(jobs(t), F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"), 30).select("job_id", "status")


@query("z9_recording_issues", "SELECT event_id, list_filter([CASE WHEN value > 5 * 0.32 * 2.2 THEN 'too_long' END, CASE WHEN value < 5 * 0.18 THEN 'too_short' END], lambda x: x IS NOT NULL) AS issues FROM events WHERE value IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return t.events.where("value IS NOT NULL").select("event_id", F.array_sort(Q.audio_issues(F.col("value"), F.lit(5), F.lit(0.1), F.lit(0.0), F.lit(0.0))).alias("issues"))


@query("z24_forced_range", "WITH {CH} SELECT id, CASE WHEN story_id % 10 = 3 AND number BETWEEN 2 AND 6 THEN 'pending_audit' ELSE 'passed' END AS quality_status FROM chapters")
def _(t: Tables) -> DataFrame:
    c = chapters(t)
    forced = c.where((F.col("story_id") % 10 == 3) & F.col("number").between(2, 6))
    return S.set_where(c.select("id", F.lit("passed").alias("quality_status")), forced, "id", {"quality_status": F.lit("pending_audit")})


@query("z25_locked_content", "SELECT lang, doc_id, left(text, 20) AS preview FROM documents WHERE contains(lower(text), 'licensed under') QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) = 1")
def _(t: Tables) -> DataFrame:
    d = t.documents.where(X.has_any(F.col("text"), ["licensed under"]))
    return L.first_of_each(d.select("lang", "doc_id", F.left("text", F.lit(20)).alias("preview")), ["lang"], [F.col("doc_id")])
