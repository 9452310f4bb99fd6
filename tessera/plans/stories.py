"""Queries of stories, chapters and their gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import stories as S
from tessera.plans.registry import Tables, chapters, jobs, query


@query("n4_object", "SELECT n_nationkey, json_object('id', n_nationkey, 'name', n_name)::VARCHAR AS v FROM nation")
def _(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("v"))


@query("n7_z20_string_list", "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN ['a'] WHEN 1 THEN ['b', 'c'] ELSE []::VARCHAR[] END AS names FROM conversations")
def _(t: Tables) -> DataFrame:
    k = F.col("turn") % 3
    c = F.when(k == 0, '{"alias": "a"}').when(k == 1, '{"aliases": ["b", "c", "b", " "]}').otherwise('{"other": 1}')
    return t.conversations.select("conv_id", "turn", S.string_list(c, ["alias", "aliases"]).alias("names"))


@query("n8_ordered_distinct", "SELECT doc_id, list_filter(ws, lambda x, i: list_position(ws, x) = i) AS v FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_distinct(F.split("text", " ")).alias("v"))


@query("n10_head", "SELECT doc_id, string_split(text, ' ')[1:8] AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.slice(F.split("text", " "), 1, 8).alias("v"))


@query("n13_suffix_columns", "SELECT column_name AS name FROM (DESCRIBE SELECT * FROM lineitem) WHERE column_name LIKE '%key'")
def _(t: Tables) -> DataFrame:
    names = [c for c in t.lineitem.columns if c.endswith("key")]
    return t.region.limit(1).select(F.explode(F.array(*map(F.lit, names))).alias("name"))


@query("u3_intersection", "SELECT doc_id, list_sort(list_distinct(list_intersect(string_split(text, ' '), ['the', 'of', 'and', 'der', 'la']))) AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_sort(F.array_intersect(F.split("text", " "), F.array(*map(F.lit, ["the", "of", "and", "der", "la"])))).alias("v"))


@query("x2_timestamp", "SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN 'junk' ELSE strftime(o_orderdate, '%Y-%m-%dT12:30:00') END AS TIMESTAMP) AS at FROM orders")
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 3 == 0, "junk").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T12:30:00'"))
    return t.orders.select("o_orderkey", text.try_cast("timestamp_ntz").alias("at"))


@query("x16_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity * 0.125, 2) AS v FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.bround(F.col("l_quantity").cast("double") * 0.125, 2).alias("v"))


@query("f1_f2_map_filter", "SELECT doc_id, length(text) * 2 AS twice FROM documents WHERE n_chars > 200")
def _(t: Tables) -> DataFrame:
    return t.documents.where("n_chars > 200").select("doc_id", (F.length("text") * 2).cast("long").alias("twice"))


@query("f5_rank_worker_split", "SELECT doc_id, doc_id % 4 AS rank, (doc_id // 4) % 3 AS worker FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", (F.col("doc_id") % 4).alias("rank"), (F.floor(F.col("doc_id") / 4) % 3).alias("worker"))


@query("f19_length_stream", "SELECT doc_id FROM documents WHERE n_chars BETWEEN 100 AND 2000 AND len(string_split(text, ' ')) BETWEEN 10 AND 300 AND n_chars / len(string_split(text, ' ')) >= 4")
def _(t: Tables) -> DataFrame:
    n = F.size(F.split("text", " "))
    return t.documents.where(F.col("n_chars").between(100, 2000) & n.between(10, 300) & (F.col("n_chars") / n >= 4)).select("doc_id")


@query("s21_least_shards", "SELECT lang, doc_id, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // greatest(1, least(100, ceil(count(*) OVER (PARTITION BY lang) / 4)::BIGINT)) AS shard FROM documents")
def _(t: Tables) -> DataFrame:
    return S.shards(t.documents.select("lang", "doc_id"), ["doc_id"], "lang", 100, 4).select("lang", "doc_id", "shard")


@query("j12_returned_lookup", "SELECT o_orderkey, (SELECT c_name FROM customer WHERE c_custkey = o_custkey) AS name FROM orders WHERE o_orderstatus = 'P'")
def _(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return t.orders.where("o_orderstatus = 'P'").join(c, "o_custkey", "left").select("o_orderkey", "name")


@query("o2_priority_order_short", "SELECT row_number() OVER (ORDER BY o_orderstatus = 'F' DESC, o_orderpriority, o_orderdate DESC, o_orderkey) AS place, o_orderkey FROM orders ORDER BY o_orderstatus = 'F' DESC, o_orderpriority, o_orderdate DESC, o_orderkey LIMIT 50")
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    keys = [F.desc("polished"), F.asc("o_orderpriority"), F.desc("o_orderdate"), F.asc("o_orderkey")]
    top = t.orders.withColumn("polished", F.col("o_orderstatus") == "F").orderBy(*keys).limit(50)  # a report of the first 50
    return top.select(F.row_number().over(Window.orderBy(*keys)).cast("long").alias("place"), "o_orderkey")


@query("p20_incomplete_stories", "WITH {CH} SELECT c_custkey AS story_id FROM customer LEFT JOIN (SELECT story_id, count(*) FILTER (WHERE NOT polished) AS open FROM chapters GROUP BY 1) ON story_id = c_custkey WHERE coalesce(open, 1) > 0")
def _(t: Tables) -> DataFrame:
    return S.incomplete(t.customer.select(F.col("c_custkey").alias("story_id")), chapters(t), "story_id", F.col("polished"))


@query("a18_severities", r"SELECT coalesce(sum(len(regexp_extract_all(text, '[A-Z]+ License'))), 0)::BIGINT AS blocking, coalesce(sum(len(regexp_extract_all(text, '[0-9]{6,}'))), 0)::BIGINT AS warnings, (coalesce(sum(len(regexp_extract_all(text, '[A-Z]+ License'))), 0) + coalesce(sum(len(regexp_extract_all(text, '[0-9]{6,}'))), 0))::BIGINT AS total FROM documents")
def _(t: Tables) -> DataFrame:
    from tessera.operators.quality import rule_findings

    return S.severities(rule_findings(t.documents.select("doc_id", "text"), "text", [("licence", "blocking", "[A-Z]+ License"), ("number", "warning", "[0-9]{6,}")]))


_FULL_SQL = "f AS (SELECT event_id, CASE WHEN event_type = 'click' THEN ['output_too_short'] ELSE []::VARCHAR[] END AS blocking, list_concat(CASE WHEN event_type = 'view' THEN ['judge:tone', 'memory_drift:x'] ELSE []::VARCHAR[] END, CASE WHEN user_id % 2 = 0 THEN ['drift:name'] ELSE []::VARCHAR[] END) AS warnings FROM events)"


def _full(t: Tables) -> DataFrame:
    e = F.col("event_type")
    codes = F.when(e == "click", F.array(F.lit("output_too_short"))).when(e == "view", F.array(F.lit("judge:tone"), F.lit("memory_drift:x"))).otherwise(F.array().cast("array<string>"))
    drift = F.when(F.col("user_id") % 2 == 0, F.array(F.lit("drift:name"))).otherwise(F.array().cast("array<string>"))
    return t.events.select("event_id", S.full_check(codes, drift, ["output_too_short", "repeated_content"]).alias("x")).select("event_id", "x.*")


@query("q11_full_check", f"WITH {_FULL_SQL} SELECT event_id, blocking, warnings FROM f")
def _(t: Tables) -> DataFrame:
    return _full(t)


@query("z14_range_gate", f"WITH {_FULL_SQL} SELECT count(*) AS chapters, count(*) FILTER (WHERE len(blocking) > 0 OR list_contains(warnings, 'judge:tone')) AS failed, count(*) > 0 AND count(*) FILTER (WHERE len(blocking) > 0 OR list_contains(warnings, 'judge:tone')) = 0 AS passed FROM f WHERE event_id BETWEEN 100 AND 5000")
def _(t: Tables) -> DataFrame:
    return S.range_gate(_full(t), "event_id", 100, 5000)


@query("q32_files_and_chapters", "WITH {CH} SELECT 'out/' || o_orderkey || '.wav' AS path, o_orderkey AS id, c.polished FROM orders LEFT JOIN (SELECT * FROM chapters WHERE number <= 3) c ON c.id = o_orderkey")
def _(t: Tables) -> DataFrame:
    files = t.orders.select(F.concat(F.lit("out/"), F.col("o_orderkey").cast("string"), F.lit(".wav")).alias("path"))
    return S.matched_by_number(files, "path", chapters(t).where("number <= 3").select("id", "polished"), "id").select("path", "id", "polished")


@query("q36_page_matches", """WITH p AS (SELECT doc_id, lower(text) AS low, 'the License ' || lang AS name, source AS author FROM documents), w AS (SELECT *, list_filter(list_distinct(string_split(lower(name), ' ')), lambda x: length(x) > 1) AS ws FROM p), h AS (SELECT *, len(list_filter(ws, lambda x: contains(low, x))) AS hits FROM w)
    SELECT doc_id, contains(low, lower(name)) OR hits >= greatest(2, ceil(len(ws) * 0.6)) OR (contains(low, lower(author)) AND hits > 0) AS matches FROM h""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.page_matches(F.col("text"), F.concat(F.lit("the License "), "lang"), F.col("source")).alias("matches"))


@query("m12_text_outputs", """WITH {CH}, n AS (SELECT l_orderkey AS id, min(l_linestatus) AS body, bool_or(l_returnflag = 'R') AS polished FROM lineitem WHERE l_linenumber < 3 GROUP BY 1)
    SELECT c.id, coalesce(n.body, 'old') AS body, c.polished OR coalesce(n.polished, false) AS polished, CASE WHEN n.body IS NULL THEN 'a.wav' END AS audio FROM chapters c LEFT JOIN n ON n.id = c.id""")
def _(t: Tables) -> DataFrame:
    c = chapters(t).select("id", F.lit("old").alias("body"), "polished", F.lit("a.wav").alias("audio"))
    n = t.lineitem.where("l_linenumber < 3").groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_linestatus").alias("body"), F.bool_or(F.col("l_returnflag") == "R").alias("polished"))
    return S.text_outputs(c, n, "id", ["body"], ["polished"])


@query("m13_m24_set_by_keys", "WITH {JOBS} SELECT job_id, CASE WHEN job_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'pending' ELSE status END AS status, CASE WHEN job_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 0 ELSE attempts END AS attempts FROM jobs")
def _(t: Tables) -> DataFrame:
    keys = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("job_id"))
    return S.set_where(jobs(t).select("job_id", "status", "attempts"), keys, "job_id", {"status": F.lit("pending"), "attempts": F.lit(0).cast("long")})


@query("m15_named", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE c_name END AS author FROM customer")
def _(t: Tables) -> DataFrame:
    meta = F.create_map(F.lit("author"), F.lit("old"), F.lit("lang"), F.lit("vi"))
    new = F.when(F.col("c_custkey") % 2 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_name", F.lit(" ")))
    return t.customer.select("c_custkey", S.named(meta, "author", new)["author"].alias("author"))


@query("m20_audit_saved", """SELECT o_orderkey, CASE WHEN bad IS NULL THEN 'old' WHEN bad THEN 'failed' ELSE 'passed' END AS quality_status, coalesce(n, -1) AS issues, CASE WHEN bad IS NOT NULL THEN DATE '2024-01-01' END AS audited_at
    FROM orders LEFT JOIN (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS bad, count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem WHERE l_linenumber > 2 GROUP BY 1) ON l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    c = t.orders.select("o_orderkey", F.lit("old").alias("quality_status"), F.lit(-1).cast("long").alias("issues"), F.lit(None).cast("date").alias("audited_at"))
    a = t.lineitem.where("l_linenumber > 2").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_if(F.col("l_returnflag") == "R").alias("issues"))
    return S.audit_saved(c, a.withColumn("passed", F.col("issues") == 0), "o_orderkey", F.lit("2024-01-01").cast("date"))


@query("m21_m23_reset_stage", "WITH {JOBS} SELECT job_id, CASE WHEN h THEN 'pending' ELSE status END AS status, CASE WHEN h THEN 0 ELSE attempts END AS attempts, CASE WHEN h THEN 'translate' ELSE 'polish' END AS stage, CASE WHEN NOT h THEN 'x' END AS body FROM (SELECT *, story_id % 2 = 0 AND status <> 'running' AS h FROM jobs)")
def _(t: Tables) -> DataFrame:
    j = jobs(t).withColumns({"stage": F.lit("polish"), "body": F.lit("x")})
    return S.reset_stage(j, F.col("story_id") % 2 == 0, F.lit("translate"), ["body"]).select("job_id", "status", "attempts", "stage", "body")


@query("z10_words_or_estimate", r"SELECT doc_id, coalesce(len(regexp_extract_all(CASE WHEN doc_id % 2 = 0 THEN text END, '[\p{L}\p{M}\p{N}_]+')), n_chars // 5) AS n FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.words_or_estimate(F.when(F.col("doc_id") % 2 == 0, F.col("text")), F.col("n_chars")).alias("n"))


@query("z17_romanised", r"""WITH w AS (SELECT doc_id, text, list_filter(string_split_regex(lower(trim(text)), '\s+'), lambda x: x <> '') AS ws FROM documents)
    SELECT doc_id, regexp_full_match(text, '(?s)[\x00-\x7F]*') AND len(ws) >= 2 AND len(list_filter(ws, lambda x: x IN ('license', 'apache'))) = 0 AND len(list_filter(ws, lambda x: x IN ('the', 'of', 'th', 'an'))) >= len(ws) * 0.1 AS romanised FROM w""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.looks_romanised(F.col("text"), ["the", "of", "th", "an"], ["license", "apache"], 0.1).alias("romanised"))


@query("z19_mapped_number", "WITH {CH} SELECT id, CASE WHEN number >= 3 THEN number + 7 END AS other FROM chapters")
def _(t: Tables) -> DataFrame:
    return chapters(t).select("id", S.mapped_number(F.col("number"), 3, 10).alias("other"))


@query("z21_flagged_or_active", "SELECT o_orderkey, o_custkey % 2 AS case FROM orders WHERE (o_custkey % 2 = 0 AND o_orderpriority = '1-URGENT') OR (o_custkey % 2 = 1 AND o_orderstatus = 'P')")
def _(t: Tables) -> DataFrame:
    none, active = F.lit(False), F.col("o_orderstatus") == "P"
    some = S.flagged_or_active(t.orders.where("o_custkey % 2 = 0"), F.col("o_orderpriority") == "1-URGENT", active)
    return some.unionByName(S.flagged_or_active(t.orders.where("o_custkey % 2 = 1"), none, active)).select("o_orderkey", (F.col("o_custkey") % 2).alias("case"))


@query("z26_one_of_each_key", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey FROM orders WHERE regexp_matches(o_orderpriority, '^[12]-') OR o_orderstatus LIKE 'P%' ORDER BY o_custkey, o_orderdate DESC, o_orderkey")
def _(t: Tables) -> DataFrame:
    ok = F.col("o_orderpriority").rlike("^[12]-") | F.col("o_orderstatus").like("P%")
    return S.one_of_each_key(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")], ok).select("o_custkey", "o_orderkey")


@query("z27_repair_choice", "SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'retranslate' ELSE 'repolish' END AS action FROM events WHERE event_type IN ('click', 'view') AND user_id % 5 <> 0")
def _(t: Tables) -> DataFrame:
    e = F.col("event_type")
    codes = F.when(F.col("user_id") % 5 == 0, F.array().cast("array<string>")).when(F.col("user_id") % 2 == 0, F.array(F.lit("tone"), F.lit("cjk_not_translated:9"))).otherwise(F.array(F.lit("tone")))
    status = F.when(e == "click", "failed").when(e == "view", "failed_manual").otherwise("passed")
    return S.repair_choice(t.events.select("event_id", codes.alias("codes"), status.alias("quality_status"))).select("event_id", "action")


@query("z30_numbers", "SELECT o_orderkey, list_sort(list_distinct(list_concat([o_orderkey % 7, 3], range(o_orderkey % 5, o_orderkey % 5 + 3)))) AS numbers FROM orders")
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    c = F.concat_ws(",", (k % 7).cast("string"), F.lit("x"), F.lit("3"), F.concat((k % 5).cast("string"), F.lit("-"), (k % 5 + 2).cast("string")))
    return t.orders.select("o_orderkey", S.numbers_of(c).alias("numbers"))
