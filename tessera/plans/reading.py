"""Queries of text for readers and for speech, and of checks of translations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import reader
from tessera.operators import reading as R
from tessera.plans.registry import Tables, query


def _below_hundred_sql(n: str) -> str:
    d = "['" + "','".join(R.DIGITS) + "']"
    tens, ones = f"(({n}) // 10)", f"(({n}) % 10)"
    return f"CASE WHEN ({n}) < 10 THEN {d}[({n}) + 1] ELSE CASE WHEN {tens} = 1 THEN 'mười' ELSE {d}[{tens} + 1] || ' mươi' END || CASE WHEN {ones} = 0 THEN '' WHEN {ones} = 1 AND {tens} > 1 THEN ' mốt' WHEN {ones} = 5 THEN ' lăm' ELSE ' ' || {d}[{ones} + 1] END END"


def _below_thousand_sql(n: str) -> str:
    d = "['" + "','".join(R.DIGITS) + "']"
    r = f"(({n}) % 100)"
    return f"CASE WHEN ({n}) < 100 THEN {_below_hundred_sql(n)} ELSE {d}[({n}) // 100 + 1] || ' trăm' || CASE WHEN {r} = 0 THEN '' WHEN {r} < 10 THEN ' lẻ ' || {d}[{r} + 1] ELSE ' ' || ({_below_hundred_sql(r)}) END END"


def number_words_sql(n: str) -> str:
    """Of numbers below a million."""
    d = "['" + "','".join(R.DIGITS) + "']"
    r = f"(({n}) % 1000)"
    return f"CASE WHEN ({n}) < 1000 THEN {_below_thousand_sql(n)} ELSE ({_below_thousand_sql(f'(({n}) // 1000)')}) || ' nghìn' || CASE WHEN {r} = 0 THEN '' WHEN {r} < 10 THEN ' lẻ ' || {d}[{r} + 1] WHEN {r} < 100 THEN ' không trăm ' || ({_below_hundred_sql(r)}) ELSE ' ' || ({_below_thousand_sql(r)}) END END"


@query("t22_truncated", """WITH t AS (SELECT doc_id, trim(regexp_replace(text, chr(10) || '{3,}', chr(10) || chr(10), 'g'), ' ') AS text FROM documents), c AS (SELECT *, rtrim(left(text, 300), ' ') AS cut FROM t),
    e AS (SELECT *, list_max(list_transform([chr(10), '. ', '; '], lambda m: CASE WHEN strpos(reverse(cut), reverse(m)) > 0 THEN length(cut) - strpos(reverse(cut), reverse(m)) - length(m) + 1 ELSE -1 END)) AS stop FROM c)
    SELECT doc_id, CASE WHEN length(text) <= 300 THEN text ELSE CASE WHEN stop > 165 THEN rtrim(left(cut, stop + 1), ' ') ELSE cut END || chr(10) || '[...]' END AS v FROM e""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", R.truncated(F.col("text"), 300).alias("v"))


@query("t27_t28_t30_t31_reader_text")
def _(t: Tables) -> DataFrame:
    return reader.reader_text(t.documents, "doc_id", "text", "source").select("doc_id", F.col("text").alias("v"))


@query("t34_story_markup", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(replace(replace(translate(text, '「」『』％', repeat(chr(34), 4) || '%'), '[', '. '), ']', '. '), '\.{2,}', '...', 'g'), '[\x{200B}-\x{200F}\x{FEFF}]', '', 'g')) AS v FROM (SELECT doc_id, text || ' [x]..「y」' AS text FROM documents)""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", R.story_markup(F.concat("text", F.lit(" [x]..「y」"))).alias("v"))


@query("t35_number_words", f"SELECT o_orderkey, {number_words_sql('(o_orderkey % 1000000)')} AS words FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", R.number_words(F.col("o_orderkey") % 1_000_000).alias("words"))


@query("t35_spoken_numbers", f"SELECT l_orderkey * 8 + l_linenumber AS id, 'HP ' || ({number_words_sql('l_quantity::BIGINT')}) || ', ' || ({number_words_sql('(l_partkey * 1000 + l_suppkey % 1000)')}) || ' x' AS v FROM lineitem WHERE l_partkey < 1000")
def _(t: Tables) -> DataFrame:
    l = t.lineitem.where("l_partkey < 1000")  # noqa: E741 - more would be a million, which has its own name
    text = F.format_string("HP %d, %d.%03d x", F.col("l_quantity").cast("long"), "l_partkey", F.col("l_suppkey") % 1000)
    return R.spoken_numbers(l.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), text.alias("v")), "id", "v")


@query("t37_packed_clauses")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.pandas_udf(lambda s: s.map(R.packed_clauses), "string")(F.coalesce("text", F.lit(""))).alias("v"))


@query("t40_clauses_and_pauses", """WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '(\\.{2,}|…+|[.!?,;:/—–\\-，。？！、；：]|[^.!?,;:/—–\\-，。？！、；：…]+)'), lambda x: trim(regexp_replace(x, '^\\s+|\\s+$', '', 'g'))), lambda x: x <> '') AS parts FROM documents)
    SELECT doc_id, len(parts)::INTEGER AS n, len(list_filter(parts, lambda x: regexp_full_match(x, '\\.{2,}|…+|[.!?,;:/—–\\-，。？！、；：]')))::INTEGER AS pauses,
           coalesce(list_sum(list_transform(parts, lambda x: CASE WHEN x = '.' THEN 500 WHEN x = ',' THEN 250 WHEN regexp_full_match(x, '\\.{2,}|…+|[.!?,;:/—–\\-，。？！、；：]') THEN 200 ELSE 0 END)), 0)::BIGINT AS pause_ms FROM p""")
def _(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", R.clauses(F.col("text"), {".": 500, ",": 250}).alias("s"))
    return d.select("doc_id", F.size("s").alias("n"), F.size(F.filter("s", lambda x: x["kind"] == "pause")).alias("pauses"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["pause_ms"], F.lit(0))).alias("pause_ms"))


@query("q13_priority_hints", r"""SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])license($|[^\p{L}\p{N}_])') THEN '- `license` → phải là `licence`' END, CASE WHEN regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])the($|[^\p{L}\p{N}_])') THEN '- `the` → phải là `that`' END], lambda x: x IS NOT NULL) AS hints FROM documents""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", R.priority_hints(F.col("text"), {"license": "licence", "the": "that", "of": "OF"}).alias("hints"))


_FRAGMENTS_SQL = r"""f AS (SELECT doc_id, list_filter(list_concat(regexp_extract_all(m, '\b[A-Z][a-z]+(?: [A-Z][a-z]+)+\b'), regexp_extract_all(m, '\b[A-Z]{2,}(?: [A-Z]{2,})+\b')), lambda x: len(list_filter(string_split(lower(x), ' '), lambda w: w NOT IN ('the', 'is'))) > 0) AS every FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '\[[^\]]*\]', ' | ', 'g'), '[A-Za-z0-9_À-ɏḀ-ỿ]*[À-ɏḀ-ỿ][A-Za-z0-9_À-ɏḀ-ỿ]*', '#', 'g') AS m FROM documents))"""


@query("q16_foreign_fragments", f"WITH {_FRAGMENTS_SQL} SELECT doc_id, list_sort(list_distinct(every)) AS fragments FROM f")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_sort(R.foreign_fragments(F.col("text"), ["the", "is"])).alias("fragments"))


WRONG = {"license": "licence", "the": "that", "version": "edition"}


@query("q17_wrong_terms", r"""SELECT doc_id, w.surface, w.canonical FROM documents JOIN (VALUES ('license', 'licence'), ('the', 'that'), ('version', 'edition')) w(surface, canonical) ON regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])' || w.surface || '($|[^\p{L}\p{N}_])')""")
def _(t: Tables) -> DataFrame:
    return R.wrong_terms(t.documents, "doc_id", "text", WRONG)


@query("q17_wrong_term_counts", r"""SELECT w.surface, count(*) AS n FROM documents JOIN (VALUES ('license'), ('the'), ('version')) w(surface) ON regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])' || w.surface || '($|[^\p{L}\p{N}_])') GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return R.wrong_terms(t.documents, "doc_id", "text", WRONG).groupBy("surface").agg(F.count("*").alias("n"))


@query("q18_gap_summary", rf"""WITH {_FRAGMENTS_SQL}, g AS (SELECT len(every) AS fragments, regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])license($|[^\p{{L}}\p{{N}}_])')::INTEGER AS priority, regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])the($|[^\p{{L}}\p{{N}}_])')::INTEGER + regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])version($|[^\p{{L}}\p{{N}}_])')::INTEGER AS other FROM f JOIN documents USING (doc_id))
    SELECT count(*) AS scanned, count(*) FILTER (WHERE fragments > 0) AS with_fragments, sum(priority + other)::BIGINT AS term_issues, sum(priority)::BIGINT AS priority_issues, count(*) FILTER (WHERE fragments > 0) > 0 OR sum(priority) > 0 AS should_repolish FROM g""")
def _(t: Tables) -> DataFrame:
    hits = [F.coalesce(R.bounded(F.col("text"), w).cast("long"), F.lit(0)) for w in WRONG]
    return R.gap_summary(t.documents.select(F.size(R.foreign_fragments(F.col("text"), ["the", "is"])).alias("fragments"), sum(hits[1:], hits[0]).alias("terms"), hits[0].alias("priority")))


@query(
    "q23_chunk_violations",
    """WITH p AS (SELECT conv_id, turn, text AS source, CASE turn % 4 WHEN 0 THEN left(text, 10) WHEN 1 THEN text || text || text WHEN 2 THEN '漢' || text ELSE replace(text, 'the', '') END AS output FROM conversations)
    SELECT conv_id, turn, list_filter([CASE WHEN contains(output, '漢') THEN 'cjk_leakage:high' END,
        CASE WHEN source <> '' AND (output = '' OR length(output) / greatest(length(source), 1) < 0.5) THEN 'length_ratio:high' WHEN source <> '' AND length(output) / greatest(length(source), 1) > 2.5 THEN 'length_ratio:medium' END,
        CASE WHEN contains(source, 'the') AND NOT contains(output, 'the') THEN 'glossary_error:the' END], lambda x: x IS NOT NULL) AS codes FROM p WHERE source IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    s, k = F.col("text"), F.col("turn") % 4
    out = F.when(k == 0, F.left(s, F.lit(10))).when(k == 1, F.concat(s, s, s)).when(k == 2, F.concat(F.lit("漢"), s)).otherwise(F.replace(s, F.lit("the"), F.lit("")))
    return t.conversations.where("text IS NOT NULL").select("conv_id", "turn", R.chunk_violations(s, out, {"the": "the"}).alias("codes"))


@query(
    "q29_pronouns",
    r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    m AS (SELECT doc_id, ls, lambda_told FROM (SELECT doc_id, ls, list_transform(ls, lambda x: trim(x, ' ') = '' OR NOT contains(chr(34) || chr(39) || '“‘—[【', left(ltrim(x, ' '), 1))) AS lambda_told FROM l))
    SELECT doc_id, array_to_string(list_transform(ls, lambda x, i: CASE WHEN lambda_told[i] THEN regexp_replace(regexp_replace(x, '\bthe\b', 'that', 'g'), '\bof\b', 'from', 'g') ELSE x END), chr(10)) AS text,
           coalesce(list_sum(list_transform(ls, lambda x, i: CASE WHEN lambda_told[i] THEN len(regexp_extract_all(x, '\bthe\b')) + len(regexp_extract_all(x, '\bof\b')) ELSE 0 END)), 0)::INTEGER AS replaced FROM m WHERE ls IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    d = t.documents.where("text IS NOT NULL").select("doc_id", R.with_pronouns(F.col("text"), {"the": "that", "of": "from"}).alias("x"))
    return d.select("doc_id", "x.text", "x.replaced")


@query("t53_without_affixes", "SELECT c_custkey, regexp_replace(c_name, '^Customer#0*', '') AS v FROM customer")
def _(t: Tables) -> DataFrame:
    name = F.concat(F.lit(" customer#"), F.regexp_replace("c_name", "^Customer#0*", ""), F.lit(" (Author) "))
    return t.customer.select("c_custkey", R.without_affixes(name, ["client#", "customer#"], ["(author)"]).alias("v"))


@query("t51_first_title", r"""SELECT doc_id, (list_filter(list_transform(string_split(coalesce(text, ''), chr(10))[1:15], lambda x: trim(regexp_extract(x, '(Licensed under .*)', 1))), lambda x: x <> ''))[1] AS title FROM documents""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", R.first_title(F.col("text"), ["(Licensed under .*)"]).alias("title"))


@query("t54_aliases", "SELECT p_partkey, p_name AS a, p_type AS b, 3 AS n FROM part")
def _(t: Tables) -> DataFrame:
    text = F.concat(F.lit("# names\n- x, a = "), "p_type", F.lit("\n- a = "), "p_name", F.lit("\n b = "), "p_type")
    return t.part.select("p_partkey", R.alias_map(text).alias("m")).select("p_partkey", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"), F.size("m").alias("n"))


@query("z4_without_promotion", "SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, 'Licensed under|[0-9]{6}')), chr(10)) AS v FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", R.without_promotion(F.col("text"), ["Licensed under", "[0-9]{6}"]).alias("v"))


@query("z8_relevant_seeds", "SELECT doc_id, s.term, s.canonical FROM documents JOIN (VALUES ('Apache', 'A'), ('password', 'P')) s(term, canonical) ON contains(lower(text), lower(s.term))")
def _(t: Tables) -> DataFrame:
    return R.relevant_seeds(t.documents, "doc_id", "text", {"Apache": "A", "password": "P", "The": "T"}, ["the"])


@query("t46_error_tokens", r"""SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '\p{Lo}|<[\x21-\x3D\x3F-\x7E]*>?|[^\s\p{Z}!,?、。！，；？：「」︰『』《》][\x21-\x7E]*'), lambda x: upper(x)) AS tokens FROM documents WHERE NOT contains(text, '<') AND regexp_full_match(text, '(?s)[\x09-\x7F]*')""")
def _(t: Tables) -> DataFrame:
    # tags and letters whose upper case differs between engines are in the tests
    return t.documents.where(~F.contains("text", F.lit("<")) & F.col("text").rlike(r"^[\x09-\x7F]*$")).select("doc_id", R.error_tokens(F.col("text")).alias("tokens"))


@query("t46_all_tokens")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", R.error_tokens(F.col("text")).alias("tokens"))


@query("a24_token_tallies")
def _(t: Tables) -> DataFrame:
    from tessera.operators.metrics import token_tallies
    from tessera.plans.audit import pairs

    d = pairs(t).select(F.slice(R.error_tokens(F.col("source")), 1, 1 << 20).alias("source"), R.error_tokens(F.col("output")).alias("output"))
    return token_tallies(d, "source", "output")


@query("x10_signal_statistics", """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL)
    SELECT vec_id, round(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)), 9) AS rms, list_max(list_transform(x, lambda v: abs(v))) AS peak, len(list_filter(x, lambda v: abs(v) >= 0.2)) / len(x) AS clipped, len(list_filter(x, lambda v: abs(v) < 0.01)) / len(x) AS silent FROM e""")
def _(t: Tables) -> DataFrame:
    from tessera.operators.metrics import signal_statistics

    d = t.embeddings.where("embedding IS NOT NULL").select("vec_id", signal_statistics(F.col("embedding").cast("array<double>"), 0.2, 0.01).alias("s"))
    return d.select("vec_id", F.round("s.rms", 9).alias("rms"), "s.peak", "s.clipped", "s.silent")


@query("a28_glossary_merge", """WITH RECURSIVE d AS (SELECT p_brand, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part),
    f AS (SELECT p_brand, p_partkey, rn, 1 AS kept, [p_name] AS covered FROM d WHERE rn = 1
          UNION ALL SELECT d.p_brand, d.p_partkey, d.rn, (NOT list_contains(f.covered, d.p_name))::INTEGER, CASE WHEN list_contains(f.covered, d.p_name) THEN f.covered ELSE list_append(f.covered, d.p_name) END FROM f JOIN d ON d.p_brand = f.p_brand AND d.rn = f.rn + 1)
    SELECT p_brand, p_partkey, kept::BIGINT AS kept FROM f""")
def _(t: Tables) -> DataFrame:
    from tessera.operators.batching import folded, uncovered_fold

    d = t.part.select("p_brand", "p_partkey", F.array("p_name").alias("terms"))
    return folded(d, "p_brand", "p_partkey", "terms", uncovered_fold, "kept").drop("terms")


@query("z11_pipeline_mode", "SELECT doc_id, CASE WHEN source IN ('books', 'web') THEN source WHEN lower(lang) = 'vi' THEN 'polish_only' ELSE 'translate_polish' END AS mode FROM documents")
def _(t: Tables) -> DataFrame:
    from tessera.operators.stories import pipeline_mode

    return t.documents.select("doc_id", pipeline_mode(F.col("source"), F.col("lang"), ["books", "web"]).alias("mode"))
