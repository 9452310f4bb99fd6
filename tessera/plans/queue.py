"""Upserts, the job queue and other changes of state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import values as V
from tessera.operators import jobs as J
from tessera.operators import relational as R
from tessera.plans.registry import Tables, jobs, query

CLOCK = "TIMESTAMP '1999-01-01'"


def clock():
    return F.lit("1999-01-01").cast("timestamp_ntz")


@query("m1_upsert_source", "SELECT coalesce(n.n_nationkey, s.k) AS code, CASE WHEN s.k IS NULL THEN n_name ELSE s.name END AS name FROM nation n FULL JOIN (SELECT s_nationkey + 10 AS k, min(s_name) AS name FROM supplier GROUP BY 1) s ON n.n_nationkey = s.k")
def _(t: Tables) -> DataFrame:
    old = t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    new = t.supplier.groupBy((F.col("s_nationkey") + 10).alias("code")).agg(F.min("s_name").alias("name"))
    return J.upsert(old, new, ["code"], {"name": J.overwrite})


@query(
    "m2_upsert_merge",
    """WITH n AS (SELECT user_id AS id, max(event_type) AS lang, max(value) AS top FROM events GROUP BY 1)
    SELECT coalesce(c_custkey, id) AS id, CASE WHEN c_custkey IS NULL THEN lang ELSE coalesce(c_mktsegment, lang) END AS lang, CASE WHEN id IS NULL THEN c_acctbal WHEN c_custkey IS NULL THEN top ELSE greatest(c_acctbal, top) END AS top
    FROM customer FULL JOIN n ON c_custkey = id""",
)
def _(t: Tables) -> DataFrame:
    old = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("lang"), F.col("c_acctbal").alias("top"))
    new = t.events.groupBy(F.col("user_id").alias("id")).agg(F.max("event_type").alias("lang"), F.max("value").alias("top"))
    return J.upsert(old, new, ["id"], {"lang": J.keep_old, "top": J.greatest})


@query("m3_category_links", "SELECT DISTINCT source, c AS category FROM (SELECT source, unnest([lang, lang || '-' || (n_chars > 1000)::VARCHAR]) AS c FROM documents)")
def _(t: Tables) -> DataFrame:
    c = F.array_distinct(F.array("lang", F.concat("lang", F.lit("-"), (F.col("n_chars") > 1000).cast("string"))))
    return t.documents.select("source", F.explode(c).alias("category")).distinct()


@query(
    "m5_upsert_chapter",
    """WITH n AS (SELECT l_orderkey AS id, bool_or(l_returnflag = 'R') AS done, max(l_linestatus) AS note FROM lineitem GROUP BY 1)
    SELECT coalesce(o_orderkey, id) AS id, CASE WHEN o_orderkey IS NULL THEN done ELSE coalesce(o_orderstatus = 'F', false) OR coalesce(done, false) END AS done, CASE WHEN o_orderkey IS NULL THEN note ELSE coalesce(note, o_orderpriority) END AS note
    FROM orders FULL JOIN n ON o_orderkey = id""",
)
def _(t: Tables) -> DataFrame:
    old = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").alias("done"), F.col("o_orderpriority").alias("note"))
    new = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("done"), F.max("l_linestatus").alias("note"))
    return J.upsert(old, new, ["id"], {"done": J.either, "note": J.keep_unless_new})


@query(
    "m6_enqueue",
    """WITH {JOBS}, n AS (SELECT c_custkey AS job_id, 2 AS priority FROM customer UNION ALL SELECT NULL, 9)
    SELECT coalesce(j.job_id, n.job_id) AS job_id, CASE WHEN n.priority IS NULL THEN j.priority WHEN j.job_id IS NULL THEN n.priority ELSE least(j.priority, n.priority) END AS priority,
           CASE WHEN n.priority IS NULL OR j.status IN ('done', 'running') THEN j.status ELSE 'pending' END AS status FROM jobs j FULL JOIN n ON j.job_id = n.job_id""",
)
def _(t: Tables) -> DataFrame:
    new = t.customer.select(F.col("c_custkey").alias("job_id"), F.lit(2).alias("priority"), F.lit("pending").alias("status"))
    new = new.unionByName(t.region.limit(1).select(F.lit(None).cast("long").alias("job_id"), F.lit(9).alias("priority"), F.lit("pending").alias("status")))
    state = lambda o, n: F.when(o.isin("done", "running"), o).otherwise("pending")
    return J.upsert(jobs(t).select("job_id", "priority", "status"), new, ["job_id"], {"priority": J.least, "status": state})


def claim_sql(order: str) -> str:
    return f"""WITH {{JOBS}}, mine AS (SELECT job_id FROM jobs WHERE status = 'pending' AND attempts < max_attempts AND run_after <= {CLOCK} ORDER BY {order} LIMIT 20)
    SELECT job_id, CASE WHEN m.job_id IS NULL THEN status ELSE 'running' END AS status, attempts + CASE WHEN m.job_id IS NULL THEN 0 ELSE 1 END AS attempts, CASE WHEN m.job_id IS NULL THEN locked_by ELSE 'me' END AS locked_by FROM jobs LEFT JOIN mine m USING (job_id)"""


CLAIM_ORDERS = {
    "fifo": ("priority, run_after, job_id", ["priority", "run_after", "job_id"]),
    "newest_story": ("run_after DESC, priority, job_id", ["-run_after", "priority", "job_id"]),
    "non_vi_first": ("story_id % 2, priority, run_after, job_id", ["story_id % 2", "priority", "run_after", "job_id"]),
    "rank_tier": ("CASE WHEN priority < 1 THEN 2147483647 ELSE (priority - 1) // 3 END, run_after, job_id", ["tier", "run_after", "job_id"]),
}


def _register(name: str, sql: str, order: list[str]) -> None:
    def run(t: Tables) -> DataFrame:
        cols = [F.desc(c[1:]) if c[0] == "-" else R.rank_tier(F.col("priority")) if c == "tier" else F.expr(c) for c in order]
        return J.claim(jobs(t), "me", 20, cols, clock()).select("job_id", "status", "attempts", "locked_by")

    query(f"o3_m7_claim_{name}", claim_sql(sql))(run)


for _name, (_sql, _order) in CLAIM_ORDERS.items():
    _register(_name, _sql, _order)


@query("m8_complete", "WITH {JOBS} SELECT job_id, CASE WHEN status = 'running' AND story_id % 3 = 0 THEN 'done' ELSE status END AS status FROM jobs")
def _(t: Tables) -> DataFrame:
    j = jobs(t).withColumn("finished_at", F.lit(None).cast("timestamp_ntz"))
    return J.completed(j, F.col("story_id") % 3 == 0, clock()).select("job_id", "status")


@query("m8_fail", "WITH {JOBS} SELECT job_id, CASE WHEN status = 'running' AND attempts >= 3 THEN 'failed' WHEN status = 'running' THEN 'pending' ELSE status END AS status, CASE WHEN status = 'running' AND attempts < 3 THEN " + CLOCK + " + INTERVAL 300 SECOND ELSE run_after END AS run_after, CASE WHEN status = 'running' THEN repeat('x', 4000) END AS last_error FROM jobs")
def _(t: Tables) -> DataFrame:
    j = jobs(t).withColumn("last_error", F.lit(None).cast("string"))
    return J.failed(j, F.col("status") == "running", F.repeat(F.lit("x"), F.lit(5000)), clock(), 300).select("job_id", "status", "run_after", "last_error")


@query("m8_reset_stale", "WITH {JOBS} SELECT job_id, CASE WHEN status = 'running' AND locked_at < " + CLOCK + " - INTERVAL 60 MINUTE THEN CASE WHEN attempts >= 3 THEN 'failed' ELSE 'pending' END ELSE status END AS status FROM jobs")
def _(t: Tables) -> DataFrame:
    return J.reset_stale(jobs(t), clock(), 60).select("job_id", "status")


@query("m9_lease", "SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'me' END AS claimed_by, 'v' AS k FROM customer")
def _(t: Tables) -> DataFrame:
    meta = F.create_map(F.lit("k"), F.lit("v"))
    return t.customer.select("c_custkey", J.leased(meta, "me", clock(), F.col("c_nationkey") < 5).alias("m")).select("c_custkey", F.col("m")["claimed_by"].alias("claimed_by"), F.col("m")["k"].alias("k"))


@query("m10_release", "SELECT c_custkey, CASE WHEN c_nationkey % 2 = 1 THEN 'other' END AS claimed_by FROM customer")
def _(t: Tables) -> DataFrame:
    meta = F.create_map(F.lit("claimed_by"), F.when(F.col("c_nationkey") % 2 == 1, "other").otherwise("me"))
    return t.customer.select("c_custkey", J.released(meta, "me").alias("m")).select("c_custkey", F.col("m")["claimed_by"].alias("claimed_by"))


@query("m11_list_claims", "WITH {JOBS} SELECT job_id, locked_by, locked_at FROM jobs WHERE locked_by IS NOT NULL AND locked_at >= " + CLOCK + " ORDER BY locked_at DESC, job_id LIMIT 30")
def _(t: Tables) -> DataFrame:
    return jobs(t).where(F.col("locked_by").isNotNull() & (F.col("locked_at") >= clock())).orderBy(F.desc("locked_at"), "job_id").limit(30).select("job_id", "locked_by", "locked_at")


@query("m14_bulk_change", "WITH {JOBS} SELECT count(*) FILTER (WHERE status IN ('pending', 'failed') AND priority <> 3) AS n_changed, count(*) FILTER (WHERE status = 'pending') AS n_pending FROM jobs")
def _(t: Tables) -> DataFrame:
    j = jobs(t)
    return j.agg(F.count_if(F.col("status").isin("pending", "failed") & (F.col("priority") != 3)).alias("n_changed"), F.count_if(F.col("status") == "pending").alias("n_pending"))


@query(
    "m16_segment_diff",
    """WITH o AS (SELECT conv_id, turn, sha256(text) AS h, role AS status FROM conversations WHERE turn < 4), n AS (SELECT conv_id, turn, sha256(CASE WHEN turn = 1 THEN text || '!' ELSE text END) AS h FROM conversations WHERE turn >= 1 AND turn < 6)
    SELECT coalesce(o.conv_id, n.conv_id) AS conv_id, coalesce(o.turn, n.turn) AS turn, CASE WHEN o.h IS NULL THEN 'inserted' WHEN n.h IS NULL THEN 'deleted' WHEN o.h = n.h THEN 'unchanged' ELSE 'reset' END AS action
    FROM o FULL JOIN n ON o.conv_id = n.conv_id AND o.turn = n.turn""",
)
def _(t: Tables) -> DataFrame:
    old = t.conversations.where("turn < 4").select("conv_id", "turn", F.sha2("text", 256).alias("text_hash"), F.col("role").alias("status"))
    new = t.conversations.where("turn >= 1 AND turn < 6").select("conv_id", "turn", F.sha2(F.when(F.col("turn") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("text_hash"))
    return J.segment_diff(old, new, ["conv_id", "turn"])


@query("m18_recrawl_range", "WITH {JOBS} SELECT job_id, CASE WHEN job_id BETWEEN 100 AND 200 THEN NULL ELSE run_after END AS run_after FROM jobs")
def _(t: Tables) -> DataFrame:
    return jobs(t).select("job_id", F.when(~R.between("job_id", 100, 200), F.col("run_after")).alias("run_after"))


@query("m19_repair_requests", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 >= 3 THEN 'failed_manual' ELSE 'pending_audit' END AS quality_status, CASE WHEN o_orderkey % 4 < 3 THEN CASE WHEN o_orderstatus = 'P' THEN 'translate_chapter' ELSE 'polish_chapter' END END AS job_type, o_orderkey % 4 + CASE WHEN o_orderkey % 4 >= 3 THEN 0 ELSE 1 END AS repair_attempts FROM orders")
def _(t: Tables) -> DataFrame:
    c = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 4).alias("repair_attempts"), F.when(F.col("o_orderstatus") == "P", "retranslate").otherwise("repolish").alias("action"))
    return J.repair_requests(c, 3).select("id", "quality_status", "job_type", "repair_attempts")


@query("m22_without_losers", "SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def _(t: Tables) -> DataFrame:
    first = t.documents.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"))
    losers = t.documents.select("doc_id").join(first.select("doc_id"), "doc_id", "left_anti")
    return J.without(t.documents.select("doc_id"), losers, ["doc_id"])


@query("z6_learned_terms", "SELECT p_brand, list_sort(list_distinct(list(p_type))) AS wrong FROM part GROUP BY 1")
def _(t: Tables) -> DataFrame:
    old = t.part.where("p_size < 25").groupBy("p_brand").agg(F.collect_set("p_type").alias("a"))
    new = t.part.where("p_size >= 25").groupBy("p_brand").agg(F.collect_set("p_type").alias("b"))
    none = F.array().cast("array<string>")
    return old.join(new, "p_brand", "full").select("p_brand", F.array_sort(F.array_union(F.coalesce("a", none), F.coalesce("b", none))).alias("wrong"))


@query("z7_replacement_table", "SELECT p_type AS wrong, arg_max(p_name, p_partkey) AS canonical FROM part GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_type").alias("wrong")).agg(F.max_by("p_name", "p_partkey").alias("canonical"))


@query("z13_range_progress", "SELECT o_custkey, count(*) FILTER (WHERE o_orderkey BETWEEN 100 AND 5000) AS n, least(max(o_orderkey), 5000) + 1 AS next_from FROM orders GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count_if(R.between("o_orderkey", 100, 5000)).alias("n"), (F.least(F.max("o_orderkey"), F.lit(5000)) + 1).alias("next_from"))


@query("z15_backfill_candidates", "SELECT d.doc_id, coalesce(quality, -1)::INTEGER AS quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE quality IS NULL")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").where("quality IS NULL").select("doc_id", F.coalesce("quality", F.lit(-1)).cast("int").alias("quality"))


@query("z22_additive_score", "SELECT s_suppkey, (CASE WHEN s_acctbal > 0 THEN 2 ELSE 0 END + CASE WHEN s_nationkey < 10 THEN 3 ELSE 0 END)::INTEGER AS score FROM supplier")
def _(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", R.weighted_score([(F.col("s_acctbal") > 0, 2), (F.col("s_nationkey") < 10, 3)]).alias("score"))


@query("z12_nested_patch", "SELECT event_id, event_type AS state, props ->> '$.k' AS k FROM events")
def _(t: Tables) -> DataFrame:
    m = V.json_merge(F.from_json("props", "map<string,string>"), F.create_map(F.lit("state"), F.col("event_type")))
    return t.events.select("event_id", m.alias("m")).select("event_id", F.col("m")["state"].alias("state"), F.col("m")["k"].alias("k"))
