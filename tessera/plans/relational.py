"""Filters, joins, aggregates, windows and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import values as V
from tessera.operators import relational as R
from tessera.plans.registry import Tables, chapters, query

def as_of():
    """The clock of queries, fixed so that they give the same rows when run again."""
    return F.lit("1999-01-01").cast("timestamp_ntz")



@query("s1_scan_by_key", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 77")
def _(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey = 77").select("o_orderkey", "o_custkey", "o_totalprice")


@query("s2_content_read", "SELECT doc_id, text FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")


@query("s3_value_set", "SELECT DISTINCT url FROM pages WHERE url LIKE 'https%'")
def _(t: Tables) -> DataFrame:
    return t.pages.where("url LIKE 'https%'").select("url").distinct()


@query("p1_find", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE (c_name ILIKE '%00007%' OR c_mktsegment ILIKE '%00007%') AND c_nationkey IN (1, 2, 3, 7, 11) ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def _(t: Tables) -> DataFrame:
    cond = R.all_of([R.contains_any_case(["c_name", "c_mktsegment"], "00007"), R.one_of("c_nationkey", [1, 2, 3, 7, 11]), None])
    return R.limited(t.customer.where(cond).orderBy(F.desc("c_acctbal"), "c_custkey"), 20).select("c_custkey", "c_name", "c_acctbal")


@query("p2_optional_list", "SELECT count(*) AS n, count(*) FILTER (WHERE c_nationkey IN (3, 4)) AS n_listed FROM customer")
def _(t: Tables) -> DataFrame:
    c = t.customer
    return c.where(R.all_of([R.one_of("c_nationkey", None)])).agg(F.count("*").alias("n"), F.count_if(R.one_of("c_nationkey", [3, 4])).alias("n_listed"))


@query("p3_bounded_range", "WITH {CH} SELECT id, story_id, number FROM chapters WHERE number >= 3 AND number <= 5 AND polished")
def _(t: Tables) -> DataFrame:
    return chapters(t).where(R.between("number", 3, 5) & F.col("polished")).select("id", "story_id", "number")


@query("p4_any_present", "SELECT count(*) FILTER (WHERE coalesce(nullif(text, ''), nullif(lang, 'en')) IS NOT NULL) AS n FROM documents")
def _(t: Tables) -> DataFrame:
    d = t.documents.select(F.nullif(F.col("text"), F.lit("")).alias("a"), F.nullif(F.col("lang"), F.lit("en")).alias("b"))
    return d.agg(F.count_if(R.any_present("a", "b")).alias("n"))


@query("p5_effective_value", "SELECT doc_id, coalesce(nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, ''), source, '') AS effective FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.withColumn("own", F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))).select("doc_id", R.effective("own", "source").alias("effective"))


@query("p6_not_in_or", "SELECT doc_id FROM documents WHERE lower(lang) NOT IN ('en', 'de') OR source = 'src3'")
def _(t: Tables) -> DataFrame:
    return t.documents.where(~F.lower("lang").isin("en", "de") | (F.col("source") == "src3")).select("doc_id")


@query("p7_title_regex", "SELECT p_partkey FROM part WHERE p_name IS NULL OR p_name = '' OR regexp_matches(p_name, '^(red|blue) ')")
def _(t: Tables) -> DataFrame:
    n = F.col("p_name")
    return t.part.where(n.isNull() | (n == "") | n.rlike("^(red|blue) ")).select("p_partkey")


@query("p8_any_pattern", "SELECT doc_id FROM documents WHERE text ILIKE '%license%' OR text ILIKE '%copyright%' OR text ILIKE '%password%'")
def _(t: Tables) -> DataFrame:
    return t.documents.where(R.like_any("text", ["license", "copyright", "password"])).select("doc_id")


@query("p9_needs_audit", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag IN ('R', 'A') OR l_tax < 0.03)")
def _(t: Tables) -> DataFrame:
    return t.lineitem.where((F.col("l_returnflag").isin("R", "A") | (F.col("l_tax") < 0.03))).select("l_orderkey", "l_linenumber")


@query("p10_lease_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' OR o_orderdate IS NULL OR o_orderdate < TIMESTAMP '1999-01-01' - INTERVAL 90 MINUTE")
def _(t: Tables) -> DataFrame:
    return t.orders.where((F.col("o_orderstatus") != "P") | F.col("o_orderdate").isNull() | (F.col("o_orderdate") < V.minutes_before(as_of(), 90))).select("o_orderkey")


@query("p11_length_over", "SELECT doc_id FROM documents WHERE length(coalesce(text, '')) > 5000")
def _(t: Tables) -> DataFrame:
    return t.documents.where(R.longer_than("text", 5000)).select("doc_id")


@query("p12_json_coalesce", "SELECT event_id, coalesce(props ->> '$.title', props ->> '$.k') AS v FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.coalesce(V.json_text(F.col("props"), "title"), V.json_text(F.col("props"), "k")).alias("v"))


@query("p13_reason", "SELECT doc_id, CASE WHEN length(text) < 200 THEN 'short' WHEN lang <> 'en' THEN 'foreign' ELSE 'other' END AS reason, lang <> 'en' AND length(text) >= 200 AS needed FROM documents")
def _(t: Tables) -> DataFrame:
    r = R.first_reason([(F.length("text") < 200, False, "short"), (F.col("lang") != "en", True, "foreign"), (F.lit(True), False, "other")])
    return t.documents.select("doc_id", r.alias("r")).select("doc_id", "r.reason", "r.needed")


@query(
    "p14_keyword_filter",
    """SELECT doc_id, (CASE WHEN contains(lower(text), 'thst') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'license') THEN 1 ELSE 0 END)::INTEGER AS hits FROM documents
    WHERE (contains(lower(text), 'thst') OR contains(lower(text), 'license')) AND NOT regexp_matches(lower(text), '\\bof\\b')""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.withColumn("hits", F.size(R.keyword_hits(F.col("text"), ["thst", "license"]))).where((F.col("hits") > 0) & ~R.word_excluded(F.col("text"), ["of"])).select("doc_id", "hits")


@query("p15_weighted_score", "SELECT p_partkey, ((CASE WHEN p_name LIKE '%red%' THEN 10 ELSE 0 END) + (CASE WHEN p_size > 20 THEN 15 ELSE 0 END) + (CASE WHEN p_type = 'SMALL' THEN 5 ELSE 0 END))::INTEGER AS score FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", R.weighted_score([(F.col("p_name").like("%red%"), 10), (F.col("p_size") > 20, 15), (F.col("p_type") == "SMALL", 5)]).alias("score"))


@query("p16_half_open_band", "SELECT doc_id FROM documents WHERE n_chars >= 500 AND n_chars < 1500")
def _(t: Tables) -> DataFrame:
    return t.documents.where(R.half_open("n_chars", 500, 1500)).select("doc_id")


@query("p17_closed_band", "SELECT doc_id FROM documents WHERE n_chars BETWEEN 500 AND 1500")
def _(t: Tables) -> DataFrame:
    return t.documents.where(R.closed("n_chars", 500, 1500)).select("doc_id")


@query("p18_sample_filter", "SELECT doc_id FROM documents WHERE n_chars BETWEEN 10 AND 10240 AND len(string_split(text, ' ')) BETWEEN 1 AND 200 AND n_chars <> 0 AND len(string_split(text, ' ')) / n_chars BETWEEN 0.0005 AND 0.2")
def _(t: Tables) -> DataFrame:
    return t.documents.where(R.sample_filter(F.col("n_chars"), F.size(F.split("text", " ")), ratio_in=(0.0005, 0.2))).select("doc_id")


@query("p19_tolerant_map", "SELECT event_id, TRY_CAST(replace(event_type, 'click', '7') AS BIGINT) AS v FROM events WHERE TRY_CAST(replace(event_type, 'click', '7') AS BIGINT) IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.replace("event_type", F.lit("click"), F.lit("7")).try_cast("bigint").alias("v")).where("v IS NOT NULL")


@query("p22_bad_name", "SELECT c_custkey FROM customer WHERE length(trim(coalesce(c_mktsegment, ''))) <= 1 OR lower(trim(c_mktsegment)) IN ('machinery', 'unknown')")
def _(t: Tables) -> DataFrame:
    return t.customer.where(R.bad_name("c_mktsegment", ["machinery", "unknown"])).select("c_custkey")


@query("p23_url_filter", "SELECT page_id FROM pages WHERE regexp_matches(url, '/(en|de)/[0-9]+') AND url LIKE '%.com/%'")
def _(t: Tables) -> DataFrame:
    return t.pages.where(F.col("url").rlike("/(en|de)/[0-9]+") & F.col("url").like("%.com/%")).select("page_id")


# --- joins ---


@query("j1_lookup", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(t: Tables) -> DataFrame:
    return R.lookup(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, "n_nationkey").select("c_custkey", "c_name", "n_name")


@query("j2_chain", "SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    by_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    j = by_customer.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey").join(t.nation, "n_nationkey").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("j3_left_count_zero", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def _(t: Tables) -> DataFrame:
    return R.counted(t.customer.select("c_custkey"), t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "n")


@query("j4_two_left", "SELECT l_orderkey, l_linenumber, o_orderstatus, s_name FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F' LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 45")
def _(t: Tables) -> DataFrame:
    li = t.lineitem.where("l_quantity > 45")
    o = t.orders.where("o_orderstatus = 'F'")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", "l_linenumber", "o_orderstatus", "s_name")


@query("j5_left_on_predicate", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'")
def _(t: Tables) -> DataFrame:
    o = t.orders
    return t.customer.join(o, (F.col("c_custkey") == o.o_custkey) & (o.o_orderpriority == "1-URGENT"), "left").select("c_custkey", "o_orderkey")


@query(
    "j6_counts_without_fan_out",
    """SELECT c_custkey, coalesce(a.n, 0) AS n_orders, coalesce(b.n, 0) AS n_urgent FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b ON b.o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return R.counted(R.counted(t.customer.select("c_custkey"), o, "c_custkey", "n_orders"), o, "c_custkey", "n_urgent", F.col("o_orderpriority") == "1-URGENT")


@query("j7_tail_window", "WITH {CH}, m AS (SELECT story_id, max(number) AS top FROM chapters GROUP BY 1) SELECT c.story_id, c.number, c.id FROM chapters c JOIN m USING (story_id) WHERE c.number >= greatest(m.top - 3, 1)")
def _(t: Tables) -> DataFrame:
    return R.tail(chapters(t), "story_id", "number", 3).select("story_id", "number", "id")


@query(
    "j8_same_number_like_title",
    """SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey AND (a.p_name = b.p_name OR b.p_type ILIKE '%' || a.p_type || '%')""",
)
def _(t: Tables) -> DataFrame:
    a, b = t.part.alias("a"), t.part.alias("b")
    on = (F.col("a.p_size") == F.col("b.p_size")) & (F.col("a.p_brand") == F.col("b.p_brand")) & (F.col("a.p_partkey") != F.col("b.p_partkey"))
    like = (F.col("a.p_name") == F.col("b.p_name")) | F.contains(F.lower(F.col("b.p_type")), F.lower(F.col("a.p_type")))
    return a.join(b, on & like).select(F.col("a.p_partkey").alias("a"), F.col("b.p_partkey").alias("b"))


@query("j9_repeated_keys", "SELECT doc_id FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)")
def _(t: Tables) -> DataFrame:
    return R.repeated_keys(t.documents.select("doc_id", F.sha2("text", 256).alias("h")), ["h"]).select("doc_id")


@query(
    "j10_cte_threshold",
    """WITH {CH}, c AS (SELECT story_id, count(*) FILTER (WHERE polished) AS n FROM chapters GROUP BY 1)
    SELECT c_custkey, n FROM customer JOIN c ON story_id = c_custkey WHERE n >= 5 AND (c_acctbal < 0 OR n - c_nationkey >= 2)""",
)
def _(t: Tables) -> DataFrame:
    c = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("n")).where("n >= 5")
    return t.customer.join(c, "c_custkey").where("c_acctbal < 0 OR n - c_nationkey >= 2").select("c_custkey", "n")


@query("j11_order_by_preaggregate", "SELECT c_custkey, c_name FROM customer ORDER BY (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) DESC, c_custkey LIMIT 25")
def _(t: Tables) -> DataFrame:
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return R.counted(t.customer, o, "c_custkey", "n").orderBy(F.desc("n"), "c_custkey").limit(25).select("c_custkey", "c_name")


@query(
    "j13_match_by_any_key",
    """WITH m AS (SELECT s_suppkey AS lid, c_custkey AS rid, CASE WHEN replace(s_name, 'Supplier', '') = replace(c_name, 'Customer', '') THEN 'name' ELSE 'place' END AS key
    FROM supplier JOIN customer ON replace(s_name, 'Supplier', '') = replace(c_name, 'Customer', '') OR (s_nationkey = c_nationkey AND floor(s_acctbal / 100) = floor(c_acctbal / 100)))
    SELECT lid, rid, key FROM m QUALIFY row_number() OVER (PARTITION BY lid ORDER BY key, rid) = 1""",
)
def _(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("lid"), F.replace("s_name", F.lit("Supplier"), F.lit("")).alias("name"), F.concat_ws(":", "s_nationkey", F.floor(F.col("s_acctbal") / 100)).alias("place"))
    c = t.customer.select(F.col("c_custkey").alias("rid"), F.replace("c_name", F.lit("Customer"), F.lit("")).alias("name"), F.concat_ws(":", "c_nationkey", F.floor(F.col("c_acctbal") / 100)).alias("place"))
    return R.match_by_any_key(s, c, [("name", "name", "name"), ("place", "place", "place")])


@query("j14_lookup_default", "SELECT doc_id, coalesce(quality, -1)::INTEGER AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).cast("int").alias("quality"))


@query("j17_containment", "SELECT doc_id, k AS term FROM documents, (SELECT unnest(['license', 'idiot', 'password']) AS k) WHERE contains(lower(text), k)")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(R.keyword_hits(F.col("text"), ["license", "idiot", "password"])).alias("term"))


@query("j18_unseen", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t: Tables) -> DataFrame:
    return R.unseen(t.documents, t.labels, ["doc_id"]).select("doc_id")


@query("j19_edges_of_active", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (1, 2, 3) OR l_suppkey IN (1, 2, 3)")
def _(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_partkey").isin(1, 2, 3) | F.col("l_suppkey").isin(1, 2, 3)).select("l_partkey", "l_suppkey").distinct()


# --- aggregates ---


@query("a1_bounds", "SELECT coalesce(min(o_orderkey), 0) AS low, coalesce(max(o_orderkey), 0) AS high, count(*) AS n FROM orders WHERE o_totalprice < 0")
def _(t: Tables) -> DataFrame:
    return t.orders.where("o_totalprice < 0").agg(F.coalesce(F.min("o_orderkey"), F.lit(0)).alias("low"), F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("high"), F.count("*").alias("n"))


@query("a2_conditional_progress", "WITH {CH} SELECT story_id, count(*) AS total, count(*) FILTER (WHERE downloaded) AS n_downloaded, count(*) FILTER (WHERE polished) AS n_polished, max(number) FILTER (WHERE polished) AS last_polished FROM chapters GROUP BY story_id")
def _(t: Tables) -> DataFrame:
    return chapters(t).groupBy("story_id").agg(F.count("*").alias("total"), F.count_if("downloaded").alias("n_downloaded"), F.count_if("polished").alias("n_polished"), F.max(F.when(F.col("polished"), F.col("number"))).alias("last_polished"))


@query(
    "a3_grouped_filter_having",
    """SELECT source, count(*) AS n, count(*) FILTER (WHERE lang = 'en') AS n_en, count(*) FILTER (WHERE length(text) > 1000) AS n_long, max(n_chars) AS longest FROM documents
    GROUP BY source HAVING count(*) FILTER (WHERE lang = 'en') >= 2 AND count(*) FILTER (WHERE length(text) > 1000) >= 1 ORDER BY n_long DESC, source LIMIT 10""",
)
def _(t: Tables) -> DataFrame:
    aggs = {"n": F.count("*"), "n_en": F.count_if(F.col("lang") == "en"), "n_long": F.count_if(F.length("text") > 1000), "longest": F.max("n_chars")}
    return R.grouped_filter_having(t.documents, "source", aggs, F.expr("n_en >= 2 AND n_long >= 1"), 10, [F.desc("n_long"), F.col("source")])


@query("a4_group_then_attributes", "SELECT c_custkey, c_name, c_mktsegment, count(o_orderkey) AS n, max(o_totalprice) AS top FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return t.customer.join(o, "c_custkey").select("c_custkey", "c_name", "c_mktsegment", "n", "top")


@query("a5_having_filtered", "SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'P') AS n FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus = 'P') > 5")
def _(t: Tables) -> DataFrame:
    return R.grouped_filter_having(t.orders, "o_custkey", {"n": F.count_if(F.col("o_orderstatus") == "P")}, F.col("n") > 5)


@query("a6_text_bytes", "SELECT sum(octet_length(encode(text)))::BIGINT AS bytes, count(*) AS n FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count("*").alias("n"))


@query("a7_count_by_status", "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


@query("a8_duplicate_keys", "SELECT regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS key, count(*) AS n FROM pages GROUP BY 1 HAVING count(*) > 1")
def _(t: Tables) -> DataFrame:
    from tessera.functions.text import url_key_case

    return t.pages.groupBy(url_key_case(F.regexp_replace("url", "[?#].*$", "")).alias("key")).agg(F.count("*").alias("n")).where("n > 1")


@query("a9_group_lists", "SELECT sha256(text) AS h, doc_id AS id FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)")
def _(t: Tables) -> DataFrame:
    d = R.repeated_keys(t.documents.select("doc_id", F.sha2("text", 256).alias("h")), ["h"])
    return d.select("h", F.col("doc_id").alias("id"))


@query(
    "a10_cross_source_groups",
    """WITH e AS (
        SELECT DISTINCT p_partkey AS id, p_brand AS source, 0 AS weak, p_name || p_size AS key FROM part WHERE length(p_name || p_size) >= 10
        UNION SELECT DISTINCT p_partkey, p_brand, 1, p_type || p_size FROM part WHERE length(p_type || p_size) >= 6),
    g AS (SELECT weak, key, list_sort(list(DISTINCT id)) AS ids, count(DISTINCT source) AS sources FROM e GROUP BY 1, 2 HAVING count(DISTINCT source) > 1 AND count(DISTINCT id) > 1)
    SELECT weak, key, unnest(ids) AS id, sources FROM (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY ids ORDER BY weak, key) = 1)""",
)
def _(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", "p_brand", F.concat("p_name", "p_size").alias("strong"), F.concat("p_type", "p_size").alias("weak_key"))
    return R.duplicate_groups(p, "p_partkey", "p_brand", ["strong"], "weak_key")


@query("a11_winner", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_totalprice DESC, o_orderkey DESC) = 1")
def _(t: Tables) -> DataFrame:
    return R.winner(t.orders, ["o_custkey"], ["o_orderpriority", "o_totalprice", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query("a12_best_by_key", "SELECT p_name, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_retailprice DESC, p_partkey) = 1")
def _(t: Tables) -> DataFrame:
    return R.first_of_each(t.part, ["p_name"], [F.desc("p_retailprice"), F.col("p_partkey")]).select("p_name", "p_partkey", "p_retailprice")


@query("a13_first_wins", "SELECT source, lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1")
def _(t: Tables) -> DataFrame:
    return R.first_of_each(t.documents.select("source", "lang", "doc_id"), ["source", "lang"], [F.col("doc_id")])


@query("a14_cap_per_source", "SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 3")
def _(t: Tables) -> DataFrame:
    return R.capped(t.documents.select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), F.col("doc_id")], 3)


@query(
    "a15_frequent_terms",
    """SELECT lower(w) AS term, count(*) AS n, min(doc_id) AS first_doc FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]+')) AS w FROM documents) GROUP BY 1 HAVING count(*) >= 3 ORDER BY n DESC, first_doc, term LIMIT 50""",
)
def _(t: Tables) -> DataFrame:
    w = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Z][a-z]+ [a-z]+)"), 1)).alias("w"))
    return w.groupBy(F.lower("w").alias("term")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n >= 3").orderBy(F.desc("n"), "first_doc", "term").limit(50)


@query("a16_name_statistics", "SELECT 'the' AS name, sum((length(text) - length(replace(text, 'the', ''))) // 3)::BIGINT AS n, min(doc_id) FILTER (WHERE contains(text, 'the')) AS first, max(doc_id) FILTER (WHERE contains(text, 'the')) AS last FROM documents")
def _(t: Tables) -> DataFrame:
    has = F.contains("text", F.lit("the"))
    return t.documents.agg(F.lit("the").alias("name"), F.sum(F.regexp_count("text", F.lit("the"))).cast("long").alias("n"), F.min(F.when(has, F.col("doc_id"))).alias("first"), F.max(F.when(has, F.col("doc_id"))).alias("last"))


@query("a22_label_distribution", "SELECT toxic, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM labels WHERE toxic >= 0 GROUP BY toxic")
def _(t: Tables) -> DataFrame:
    return R.label_distribution(t.labels, "toxic")


@query("a26_shard_sums", "SELECT doc_id // 100 AS shard, count(*) AS items, sum(n_chars)::BIGINT AS seconds FROM documents GROUP BY 1")
def _(t: Tables) -> DataFrame:
    from tessera.sources.io import shard_summary

    return shard_summary(t.documents.withColumn("shard", F.floor(F.col("doc_id") / 100)), "shard", "n_chars")


@query("a29_newest_entries", "WITH {CH} SELECT story_id, number FROM chapters QUALIFY row_number() OVER (PARTITION BY story_id ORDER BY number DESC) <= 5")
def _(t: Tables) -> DataFrame:
    return R.capped(chapters(t), ["story_id"], [F.desc("number")], 5).select("story_id", "number")


# --- windows ---


@query("w1_w2_numbered_total", "WITH {CH} SELECT story_id, number, count(*) OVER (PARTITION BY story_id) AS total FROM chapters")
def _(t: Tables) -> DataFrame:
    return chapters(t).select("story_id", "number", F.count("*").over(Window.partitionBy("story_id")).alias("total"))


@query(
    "w3_spread_sample",
    """WITH {CH}, n AS (SELECT *, row_number() OVER (PARTITION BY story_id ORDER BY number) AS rn, count(*) OVER (PARTITION BY story_id) AS total FROM chapters),
    b AS (SELECT *, CASE WHEN total > 4 THEN (rn - 1) * 4 // total ELSE rn END AS bucket FROM n)
    SELECT story_id, id, bucket FROM b QUALIFY row_number() OVER (PARTITION BY story_id, bucket ORDER BY rn) = 1""",
)
def _(t: Tables) -> DataFrame:
    return R.spread_sample(chapters(t), "story_id", [F.col("number")], 4).select("story_id", "id", "bucket")


@query("w4_previous_recaps", "SELECT conv_id, turn, list(turn) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before FROM conversations")
def _(t: Tables) -> DataFrame:
    d = R.previous(t.conversations, "conv_id", "turn", "turn", 3, "before")
    return d.select("conv_id", "turn", F.when(F.size("before") > 0, F.col("before")).alias("before"))


@query("w6_carried_tail", "SELECT conv_id, turn, right(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), 600) AS tail FROM conversations")
def _(t: Tables) -> DataFrame:
    return R.carried(t.conversations, "conv_id", "turn", F.right("text", F.lit(600)), "tail").select("conv_id", "turn", "tail")


@query(
    "w7_next_missing",
    """WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM d)
    SELECT l_orderkey, coalesce(max(l_linenumber) FILTER (WHERE l_linenumber = rn), 0)::BIGINT + 1 AS next_missing FROM n GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return R.next_missing(t.lineitem, "l_orderkey", "l_linenumber")


@query("w8_rank_tier", "SELECT c_custkey, CASE WHEN c_nationkey IS NULL OR c_nationkey < 1 THEN 2147483647 ELSE (c_nationkey - 1) // 3 END::INTEGER AS tier FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", R.rank_tier(F.col("c_nationkey")).alias("tier"))


@query("w9_running_line", "SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT - length(text) AS start, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM conversations")
def _(t: Tables) -> DataFrame:
    return R.running(t.conversations.withColumn("n", F.length("text")), "conv_id", ["turn"], "n", "start", "stop").select("conv_id", "turn", "start", "stop")


# --- orders ---


@query("o1_priority_order", "SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END, CASE WHEN c_nationkey < 1 THEN 2147483647 ELSE (c_nationkey - 1) // 3 END, c_nationkey NULLS LAST, c_acctbal DESC NULLS FIRST, c_custkey) AS place FROM customer QUALIFY place <= 100")
def _(t: Tables) -> DataFrame:
    order = [F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0), R.rank_tier(F.col("c_nationkey")), F.col("c_nationkey").asc_nulls_last(), F.col("c_acctbal").desc_nulls_first(), F.col("c_custkey")]
    top = t.customer.orderBy(*order).limit(100)
    return top.select("c_custkey", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


@query("o4_descending_nulls_last", "SELECT event_id, value FROM events ORDER BY (event_type = 'error') DESC NULLS LAST, value DESC NULLS LAST, event_id LIMIT 40")
def _(t: Tables) -> DataFrame:
    return t.events.orderBy((F.col("event_type") == "error").desc_nulls_last(), F.col("value").desc_nulls_last(), "event_id").limit(40).select("event_id", "value")


@query("o5_nulls_first", "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l USING (doc_id) ORDER BY quality ASC NULLS FIRST, d.doc_id LIMIT 30")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").orderBy(F.col("quality").asc_nulls_first(), "doc_id").limit(30).select("doc_id", "quality")


@query("o6_optional_limit", "SELECT n_nationkey, n_name FROM nation")
def _(t: Tables) -> DataFrame:
    return R.limited(t.nation, 0).select("n_nationkey", "n_name")


@query("o7_paging", "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 100")
def _(t: Tables) -> DataFrame:
    return t.orders.orderBy("o_orderdate", "o_orderkey").offset(100).limit(50).select("o_orderkey")


@query("o8_pinned_first", "SELECT c_custkey FROM customer ORDER BY coalesce(list_position([40, 7, 99], c_custkey), 1000), c_acctbal DESC, c_custkey LIMIT 15")
def _(t: Tables) -> DataFrame:
    return R.pinned_first(t.customer, "c_custkey", [40, 7, 99], [F.desc("c_acctbal"), F.col("c_custkey")]).limit(15).select("c_custkey")


@query("o9_missing_first", "SELECT c_custkey FROM customer ORDER BY CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END, c_custkey LIMIT 60")
def _(t: Tables) -> DataFrame:
    return t.customer.orderBy(F.when(F.col("c_acctbal") < 0, 0).otherwise(1), "c_custkey").limit(60).select("c_custkey")


@query("o10_local_sort", "WITH {CH} SELECT story_id, id, (number - 1) // 4 AS buffer, row_number() OVER (PARTITION BY story_id, (number - 1) // 4 ORDER BY size DESC, number)::INTEGER AS place FROM chapters")
def _(t: Tables) -> DataFrame:
    return R.local_sort(chapters(t), [F.col("number")], [F.desc("size")], 4, "story_id").select("story_id", "id", "buffer", "place")


@query("o11_batch_length_sort", "SELECT doc_id // 50 AS batch, doc_id, row_number() OVER (PARTITION BY doc_id // 50 ORDER BY n_chars DESC, doc_id)::INTEGER AS place FROM documents")
def _(t: Tables) -> DataFrame:
    d = t.documents.select(F.floor(F.col("doc_id") / 50).alias("batch"), "doc_id", "n_chars")
    return d.select("batch", "doc_id", F.row_number().over(Window.partitionBy("batch").orderBy(F.desc("n_chars"), "doc_id")).alias("place"))


@query("o12_ratio_ranking", "SELECT source, count(*) FILTER (WHERE lang = 'en') AS n_en, round(count(*) FILTER (WHERE lang = 'en') / count(*), 4) AS ratio FROM documents GROUP BY source ORDER BY n_en DESC, ratio DESC, source LIMIT 12")
def _(t: Tables) -> DataFrame:
    g = t.documents.groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("n_en"), F.count("*").alias("n"))
    return g.select("source", "n_en", F.round(F.col("n_en") / F.col("n"), 4).alias("ratio")).orderBy(F.desc("n_en"), F.desc("ratio"), "source").limit(12)


# --- sets ---


@query("u1_ordered_union", "SELECT text FROM benchmark UNION SELECT reverse(text) FROM benchmark")
def _(t: Tables) -> DataFrame:
    b = t.benchmark
    return b.select("text").unionByName(b.select(F.reverse("text").alias("text"))).distinct()


@query("u2_union_minus", "SELECT p_name FROM part WHERE p_size < 10 UNION ALL SELECT p_name FROM part WHERE p_size >= 40 AND lower(p_name) NOT IN (SELECT lower(p_name) FROM part WHERE p_size < 10)")
def _(t: Tables) -> DataFrame:
    own = t.part.where("p_size < 10")
    seed = t.part.where("p_size >= 40").withColumn("k", F.lower("p_name")).join(own.select(F.lower("p_name").alias("k")), "k", "left_anti")
    return own.select("p_name").unionByName(seed.select("p_name"))


@query("u4_difference", "SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part WHERE p_size > 5")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey").distinct().join(t.part.where("p_size > 5").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti")


@query("u5_jaccard", "SELECT page_id, len(list_intersect(string_split(lower(url), '/'), ['en', 'https:', ''])) / len(list_distinct(list_concat(string_split(lower(url), '/'), ['en', 'https:', '']))) AS jaccard FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", V.jaccard(F.array_distinct(F.split(F.lower("url"), "/")), F.array(F.lit("en"), F.lit("https:"), F.lit(""))).alias("jaccard"))
