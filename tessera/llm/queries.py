"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, chat, clustering, collocations, decontaminate, katz, neardup, packing, quality, secrets, sstable, substring, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe(), capacity=2048, end_id=1, with_ids=False)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return toxicity.score(d, toxicity.train(d, table(spark, sf_dir, "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"), shingle=5, threshold=(75, 100))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return quality.score(d, quality.train(d, table(spark, sf_dir, "labels")))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=20, with_text=False)


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return ann.nearest(e.where(F.col("vec_id") % 20 == 0), e, k=20)


def op9_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_table(table(spark, sf_dir, "documents"), byte_bpe(), end_id=0, with_ids=False)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), longest=3, min_count=10, subsumed=(50, 100), top=2000)


def op12_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    corpus = katz.Corpus(table(spark, sf_dir, "documents"), ~F.coalesce(held_out, F.lit(False)))
    scored = katz.score(corpus, katz.train(corpus, order=3, keep=False))
    return scored.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64, scale=64)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_secrets": op4_secrets,
    "op5_minhash": op5_minhash,
    "op6_quality": op6_quality,
    "op7_ann": op7_ann,
    "op8_substring": op8_substring,
    "op9_sstable": op9_sstable,
    "op10_chat": op10_chat,
    "op11_collocations": op11_collocations,
    "op12_katz": op12_katz,
    "op13_clustering": op13_clustering,
}

def clustering_sql(k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64) -> str:
    """Rounds written out one after the other, every vector against every centroid."""
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS j, v AS c FROM kept ORDER BY sha256('1:' || vec_id), v LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
            SELECT r, vec_id, v, j, d FROM (SELECT r, vec_id, v, j, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{i})
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if i < rounds:
            parts.append(f"""m{i} AS (
            SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
            FROM (SELECT j, i, sum(x) AS s, count(*) AS n FROM (SELECT j, unnest(v) AS x, unnest(range({dim})) AS i FROM a{i}) GROUP BY j, i) GROUP BY j),
        c{i + 1} AS MATERIALIZED (SELECT j, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (j))""")
    return "WITH " + ",\n        ".join(parts) + f"""
        SELECT vec_id, j::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (j)"""


ORACLE_SQL: dict[str, str] = {
    "op11_collocations": r"""
        WITH p AS (
            SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        k AS MATERIALIZED (
            SELECT lang, m, ph, count(*) AS f FROM (
                SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS ph FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS m) WHERE len(ws) >= m))
            GROUP BY lang, m, ph),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM k WHERE m = 1 GROUP BY lang),
        c AS (SELECT lang, m, ph, f AS a, string_split(ph, ' ') AS ws FROM k WHERE m > 1 AND f >= 10),
        cuts AS (
            SELECT c.*, j, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
            FROM (SELECT c.*, unnest(range(1, m)) AS j FROM c) c
            JOIN k x ON x.lang = c.lang AND x.m = j AND x.ph = array_to_string(ws[1 : j], ' ') JOIN k y ON y.lang = c.lang AND y.m = c.m - j AND y.ph = array_to_string(ws[j + 1 : c.m], ' ')),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1),
        over AS (SELECT lang, part, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS part FROM c WHERE m = 3) GROUP BY lang, part)
        SELECT lang, rank, ph AS phrase, a, l, r, n, score::BIGINT AS score FROM (
            SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(ph)) AS rank
            FROM best b LEFT JOIN over o ON o.lang = b.lang AND o.part = b.ph WHERE b.m = 3 OR o.longer IS NULL OR 100 * o.longer < 50 * a)
        JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_clustering": clustering_sql(),
    "op7_ann": """
        WITH good AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op8_substring": """
        WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        p AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS pos, ws FROM w WHERE len(ws) >= 20),
        s AS (SELECT doc_id, pos, array_to_string(ws[pos : pos + 19], ' ') AS seq FROM p),
        r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY seq ORDER BY doc_id, pos) AS n FROM s),
        gone AS (SELECT DISTINCT doc_id, pos + k AS i FROM (SELECT doc_id, pos, unnest(range(0, 20)) AS k FROM r WHERE n > 1)),
        e AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
        kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM e ANTI JOIN gone USING (doc_id, i) GROUP BY e.doc_id),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op10_chat": """
        WITH t AS (
            SELECT DISTINCT conv_id, turn, CASE WHEN role IS NULL OR trim(role) = '' THEN 'unknown' ELSE role END AS role, coalesce(text, '') AS text,
                   floor(turn / 256.0)::BIGINT AS chunk FROM conversations),
        p AS (SELECT DISTINCT conv_id AS of, role AS perspective FROM t WHERE role <> 'system'),
        s AS (
            SELECT t.*, p.perspective, role = perspective AS own,
                   CASE WHEN role = perspective THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10) ELSE '<|user name=' || role || '|>' || chr(10) END || text || '<|end|>' || chr(10) AS seg
            FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.of),
        o AS (SELECT *, sum(length(seg)) OVER (PARTITION BY conv_id, perspective, chunk ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS stop FROM s)
        SELECT conv_id, perspective, chunk, count(*)::INTEGER AS n_turns, string_agg(seg, '' ORDER BY turn, role, text) AS text,
               string_agg(CASE WHEN own THEN '1' ELSE '0' END, '' ORDER BY turn, role, text) AS turn_mask,
               coalesce(string_agg(CASE WHEN own THEN (stop - length(seg) + 14)::BIGINT || ':' || stop::BIGINT END, ',' ORDER BY turn, role, text), '') AS target_spans,
               sum(CASE WHEN own THEN length(seg) - 14 ELSE 0 END)::BIGINT AS n_target_chars
        FROM o GROUP BY conv_id, perspective, chunk""",
}
