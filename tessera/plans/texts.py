"""Text, value, source and HTML functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions import values as V
from tessera.plans.registry import Tables, query
from tessera.sources import io as S

WORD = r"[\p{L}\p{M}\p{N}_]"


@query("t1_slug", "SELECT DISTINCT trim(regexp_replace(lower(p_name || '/' || p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select(X.slug(F.concat("p_name", F.lit("/"), "p_type")).alias("slug")).distinct()


@query("t2_category_name", "SELECT DISTINCT lower(trim(regexp_replace(c_mktsegment || '  x', '\\s+', ' ', 'g'))) AS name FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select(X.category_name(F.concat("c_mktsegment", F.lit("  x"))).alias("name")).distinct()


_T3 = "SELECT doc_id, list_filter(parts, lambda x, i: x <> '' AND list_position(parts, x) = i) AS names FROM (SELECT doc_id, list_transform(regexp_split_to_array(coalesce(text, ''), '[,，/|;；、·]+'), lambda x: trim(x)) AS parts FROM documents)"


@query("t3_category_names", _T3)
@query("t3_category_names_all", _T3)
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.category_names(F.col("text")).alias("names"))


@query("t4_normalize_title", rf"SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.comparable(F.col("text")).alias("title"))


@query("t5_normalize_no_underscore", r"SELECT event_id, trim(regexp_replace(regexp_replace(lower(event_type || '_' || props), '[^\p{L}\p{M}\p{N}\s]', ' ', 'g'), '\s+', ' ', 'g')) AS v FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", X.comparable_no_underscore(F.concat("event_type", F.lit("_"), "props")).alias("v"))


@query("t6_url_key", "SELECT page_id, regexp_replace(lower(trim(url || '/')), '/+$', '') AS key FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.url_key(F.concat("url", F.lit("/"))).alias("key"))


@query("t7_url_key_case", "SELECT page_id, regexp_replace(upper(url) || '//', '/+$', '') AS key FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.url_key_case(F.concat(F.upper("url"), F.lit("//"))).alias("key"))


@query("t8_canonical_url", "SELECT page_id, regexp_replace(regexp_replace(url, '[?#;].*$', ''), '/+$', '') || '/' AS url FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.canonical_url(F.col("url")).alias("url"))


@query("t9_story_key", "SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), ''), nullif(regexp_extract(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*|[?#].*$', '', 'g'), '/+$', ''), '([^/]*)$', 1), ''), url) AS key FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.story_key(F.col("url"), ("page",)).alias("key"))


@query("t10_parent_url", "SELECT page_id, CASE WHEN regexp_matches(url, '^[a-z]+://[^/]+/[^/]+/[^/]+') THEN regexp_replace(url, '/[^/]+/*$', '/') ELSE url END AS parent FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.parent_url(F.col("url")).alias("parent"))


@query("t12_compact", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.compact(F.col("text")).alias("v"))


@query("t13_clean_paragraphs", r"SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.clean_paragraphs(F.col("text")).alias("v"))


@query("t14_chapter_number", r"SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(url, '(?i)(?:page|ref)[^\d]{0,12}0*(\d{1,5})', 1), '') AS INTEGER), page_id::INTEGER) AS n FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.chapter_number(F.lit(""), F.col("url"), F.col("page_id").cast("int"), "page|ref").alias("n"))


@query("t15_digits", "SELECT page_id, coalesce(TRY_CAST(nullif(regexp_replace(url, '[^0-9]', '', 'g'), '') AS BIGINT), 0) AS n FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.digits(F.col("url")).alias("n"))


@query("t16_has_any", "SELECT doc_id, contains(lower(text), 'licensed under') OR contains(lower(text), 'password') AS blocked FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.has_any(F.col("text"), ["licensed under", "password"]).alias("blocked"))


@query("t23_punctuation_spacing")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.punctuation_spacing(F.col("text")).alias("v"))


@query("t24_markdown")
@query("t24_markdown_all")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.without_markdown(F.col("text")).alias("v"))


@query(
    "t26_separator_lines",
    """SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x:
        len(x) >= 3 AND translate(x, '-=_~*', '') = '' OR len(x) BETWEEN 1 AND 12 AND translate(x, '•●◆◇★☆()+ ' || chr(9) || chr(11) || chr(12) || chr(13), '') = ''
        OR translate(lower(regexp_replace(trim(x, '-=_~*'), '[\\s\\v]', '', 'g')), '0', 'o') = 'ooo'))::INTEGER AS n FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.size(F.filter(F.split("text", "\n"), X.is_separator)).alias("n"))


@query("t32_drop_repeated_paragraphs", "SELECT conv_id, turn, text AS v FROM conversations")
def _(t: Tables) -> DataFrame:
    d = t.conversations
    # a paragraph is 120 characters or more, so a text with its copy after a blank line loses the copy
    twice = F.when(F.length(F.trim("text")) >= 120, F.concat("text", F.lit("\n\n"), "text")).otherwise(F.col("text"))
    return d.select("conv_id", "turn", X.drop_repeated_paragraphs(twice).alias("v"))


@query("t33_cjk_parentheses", r"SELECT doc_id, regexp_replace(text, '\s+$', '') AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.without_cjk_parentheses(F.concat(F.col("text"), F.lit(" (漢字)"))).alias("v"))


@query("t36_reduplication", r"SELECT doc_id, regexp_replace(array_to_string(regexp_extract_all(text, '[A-Za-z]+'), '-'), '-', ' ', 'g') AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.joined_reduplication(F.array_join(F.regexp_extract_all(F.col("text"), F.lit("([A-Za-z]+)"), 1), "-")).alias("v"))


@query("t42_full_stop", "SELECT doc_id, CASE WHEN v = '' OR regexp_matches(v, '[.,!?;:。，！？；：…]$') THEN v ELSE v || '.' END AS v FROM (SELECT doc_id, trim(text) AS v FROM documents)")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.with_full_stop(F.col("text")).alias("v"))


@query("t45_without_marks", r"""SELECT doc_id, lower(replace(regexp_replace(text, '[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]', '', 'g'), '  ', ' ')) AS v FROM documents""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.without_marks(F.col("text")).alias("v"))


@query("t47_characters", "SELECT doc_id, list_transform(cs, lambda x: CASE WHEN x = ' ' THEN '▁' ELSE x END) AS tokens FROM (SELECT doc_id, CASE WHEN text = '' THEN [] ELSE string_split(text, '') END AS cs FROM documents)")
def _(t: Tables) -> DataFrame:
    c = F.filter(F.split(F.col("text"), ""), lambda x: x != "")
    return t.documents.select("doc_id", F.transform(c, lambda x: F.when(x == " ", "▁").otherwise(x)).alias("tokens"))


@query("t48_first_rule", "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') THEN 'colour' WHEN contains(lower(p_name), 'ring') THEN 'ring' ELSE 'other' END AS genre FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.first_rule(F.col("p_name"), [(["red", "blue"], "colour"), (["ring"], "ring")], "other").alias("genre"))


@query("t49_language", r"SELECT doc_id, CASE WHEN regexp_matches(text, '[ăâđêôơưĂÂĐÊÔƠƯ]') THEN 'vi' WHEN length(text) > 0 AND length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / length(text) > 0.75 THEN 'en' ELSE 'unknown' END AS guess FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.language_of(F.col("text")).alias("guess"))


@query("t50_word_count", rf"SELECT doc_id, len(regexp_extract_all(text, '{WORD}+'))::INTEGER AS n FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.word_count(F.col("text")).alias("n"))


@query("t52_context", "SELECT doc_id, substr(text, greatest(instr(text, 'license') - 40, 1), instr(text, 'license') - greatest(instr(text, 'license') - 40, 1) + 7 + 40) AS v FROM documents WHERE contains(text, 'license')")
def _(t: Tables) -> DataFrame:
    return t.documents.where(F.contains("text", F.lit("license"))).select("doc_id", X.context_of(F.col("text"), "license").alias("v"))


@query("t18_title_score")
def _(t: Tables) -> DataFrame:
    a = F.lower("p_name")
    return t.part.select("p_partkey", X.title_score(a, F.reverse(a)).alias("score"))


@query("t20_replacements")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.replaced({"the": "ye", "of the": "o'", "and": "und"})(F.col("text")).alias("v"))


@query("t41_sentence_chunks")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(X.sentence_chunks(520)(F.col("text"))).alias("chunk", "v"))


@query("z2_model_output", r"SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.model_output(F.concat(F.lit("<think>a\nb</think>```text\nOutput: "), "text")).alias("v"))


@query("z18_host", "SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.host(F.col("url")).alias("host"))


# --- values ---


@query("x3_backoff", "SELECT c_custkey, least(3600.0::DOUBLE, 30.0 * pow(2.0, greatest(c_nationkey, 1) - 1)) AS seconds FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", V.backoff(F.col("c_nationkey"), 30, 3600).alias("seconds"))


@query("x4_greatest", "SELECT d.doc_id, greatest(quality, toxic) AS top, least(quality, toxic) AS low FROM documents d LEFT JOIN labels USING (doc_id)")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", F.greatest("quality", "toxic").alias("top"), F.least("quality", "toxic").alias("low"))


@query("x5_hash_sample", "SELECT doc_id FROM documents WHERE ('0x' || substr(sha256('s:' || doc_id), 1, 8))::BIGINT % 5 = 0")
def _(t: Tables) -> DataFrame:
    return t.documents.where(V.hash_sampled("s", F.col("doc_id"), 5)).select("doc_id")


@query("x6_text_hash", "SELECT doc_id, substr(sha256(text), 1, 16) AS h FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", V.text_hash(F.col("text")).alias("h"))


@query("x7_hashed_window", "SELECT doc_id, substr(text, (('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT % (greatest(length(text) - 50, 0) + 1) + 1)::INTEGER, 50) AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", V.hashed_window(F.col("text"), F.col("doc_id").cast("string"), 50).alias("v"))


@query("x9_duration_bounds", "SELECT doc_id, n_chars * 0.18::DOUBLE AS low, n_chars * 0.32::DOUBLE * 2.2::DOUBLE AS high FROM documents")
def _(t: Tables) -> DataFrame:
    low, high = V.duration_bounds(F.col("n_chars"))
    return t.documents.select("doc_id", low.alias("low"), high.alias("high"))


@query("x12_cosine", "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def _(t: Tables) -> DataFrame:
    a, b = t.embeddings.select("vec_id", F.col("embedding").alias("x")), t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    return a.join(b, "vec_id").select("vec_id", F.round(V.cosine(F.col("x"), F.col("y")), 9).alias("cosine"))


@query("x13_length_ratio", r"SELECT a.conv_id, a.turn, length(regexp_replace(a.text, '\s+', '', 'g')) / nullif(length(regexp_replace(b.text, '\s+', '', 'g')), 0) AS ratio FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")
def _(t: Tables) -> DataFrame:
    a, b = t.conversations, t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    return a.join(b, ["conv_id", "turn"]).select("conv_id", "turn", V.length_ratio(F.col("text"), F.col("next")).alias("ratio"))


@query("x17_srt_time", "SELECT event_id, lpad((floor(ms / 3600000))::BIGINT::VARCHAR, 2, '0') || ':' || lpad((floor(ms / 60000)::BIGINT % 60)::VARCHAR, 2, '0') || ':' || lpad((floor(ms / 1000)::BIGINT % 60)::VARCHAR, 2, '0') || ',' || lpad((ms % 1000)::VARCHAR, 3, '0') AS v FROM (SELECT event_id, floor(value * 100 * 1000)::BIGINT AS ms FROM events)")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", V.srt_time(F.col("value") * 100).alias("v"))


@query("n1_json_text", "SELECT event_id, props ->> '$.k' AS v FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", V.json_text(F.col("props"), "k").alias("v"))


@query("n2_json_merge", "SELECT event_id, props ->> '$.k' AS k, event_type AS t FROM events")
def _(t: Tables) -> DataFrame:
    old = F.create_map(F.lit("t"), F.lit("old"), F.lit("k"), F.lit("0"))
    new = F.map_concat(F.create_map(F.lit("t"), F.col("event_type")), F.from_json("props", "map<string,string>"))
    return t.events.select("event_id", V.json_merge(old, new).alias("m")).select("event_id", F.col("m")["k"].alias("k"), F.col("m")["t"].alias("t"))


@query("n3_json_delete", "SELECT event_id, NULL::VARCHAR AS k, 1::INTEGER AS left_over FROM events")
def _(t: Tables) -> DataFrame:
    m = V.json_without(F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("x"), F.lit("1"))), ["k", "y"])
    return t.events.select("event_id", m.alias("m")).select("event_id", F.col("m")["k"].alias("k"), F.size("m").alias("left_over"))


@query("n5_issue_codes", "SELECT event_id, [event_type, props ->> '$.k'] AS codes FROM events")
def _(t: Tables) -> DataFrame:
    j = F.concat(F.lit('["'), "event_type", F.lit('", {"code": "'), V.json_text(F.col("props"), "k"), F.lit('"}]'))
    return t.events.select("event_id", V.issue_codes(j).alias("codes"))


@query("n6_json_in_text", "SELECT event_id, props AS v FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", V.json_in_text(F.concat(F.lit("```json\nHere: "), "props", F.lit("\n``` done"))).alias("v"))


@query("n12_label_ids", "SELECT doc_id, CASE WHEN lang IS NOT NULL THEN dense_rank() OVER (ORDER BY lang NULLS LAST)::INTEGER - 1 END AS id FROM documents")
def _(t: Tables) -> DataFrame:
    from tessera.operators.relational import numbered

    ids = numbered(t.documents.select("lang").where("lang IS NOT NULL").distinct(), [F.col("lang")])
    return t.documents.join(ids, "lang", "left").select("doc_id", (F.col("rn") - 1).cast("int").alias("id"))


@query("n14_padded", "SELECT conv_id, list_resize(list(turn ORDER BY turn), 10, -1)::BIGINT[] AS turns FROM conversations GROUP BY conv_id")
def _(t: Tables) -> DataFrame:
    g = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return g.select("conv_id", V.padded(F.col("turns"), 10, -1).alias("turns"))


# --- pages and manifests ---


@query("s7_manifest_repeat", "SELECT lang AS language_id, source AS path, unnest(range(1, 4))::INTEGER AS turn FROM (SELECT DISTINCT lang, source FROM documents)")
def _(t: Tables) -> DataFrame:
    c = t.documents.groupBy(F.col("lang").alias("language_id")).agg(F.collect_set("source").alias("manifest_path")).withColumn("repeat", F.lit(3))
    return S.manifest_entries(c)


@query("s16_json_lines", """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS value FROM nation""")
def _(t: Tables) -> DataFrame:
    return S.as_json_lines(t.nation)


@query("s20_shards", "SELECT ((row_number() OVER (PARTITION BY lang ORDER BY doc_id)) - 1) // 100 AS shard, lang, doc_id FROM documents")
def _(t: Tables) -> DataFrame:
    from tessera.operators.batching import fixed
    from tessera.operators.relational import numbered

    return numbered(t.documents.select("lang", "doc_id"), [F.col("doc_id")], "lang").select(fixed(F.col("rn"), 100).alias("shard"), "lang", "doc_id")


_S24 = "WITH t AS (SELECT *, lpad((turn // 3600)::VARCHAR, 2, '0') || strftime(make_timestamp(((turn % 3600) * 1000000)::BIGINT), ':%M:%S,000') AS a, lpad(((turn + 1) // 3600)::VARCHAR, 2, '0') || strftime(make_timestamp((((turn + 1) % 3600) * 1000000)::BIGINT), ':%M:%S,500') AS b FROM conversations) SELECT conv_id, turn, turn || chr(10) || a || ' --> ' || b || chr(10) || text || chr(10) AS item FROM t"


@query("s24_subtitles", _S24)
@query("s24_subtitles_all", _S24)
def _(t: Tables) -> DataFrame:
    c = F.col("turn")
    return t.conversations.select("conv_id", "turn", S.srt_items(c, c.cast("double"), c + 1.5, F.col("text")).alias("item"))


@query("s26_links", r"""SELECT page_id, list_sort(list_distinct(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["\x27]([^"\x27#]+)["\x27]', 1))) AS links FROM pages""")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.array_sort(S.links(F.col("html"))).alias("links"))


@query("s26_visible_text")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", S.visible_text(F.col("html")).alias("text"), S.page_title(F.col("html")).alias("title"))
