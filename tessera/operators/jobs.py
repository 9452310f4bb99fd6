"""Upserts and the states of a work queue, as pure functions from tables and a clock to new tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.values import json_merge, json_without

# --- rules of an upsert: (old, new) -> value ---


def overwrite(old: Column, new: Column) -> Column:
    return new


def keep_unless_new(old: Column, new: Column) -> Column:
    return F.coalesce(new, old)


def keep_old(old: Column, new: Column) -> Column:
    return F.coalesce(old, new)


def either(old: Column, new: Column) -> Column:
    return F.coalesce(old, F.lit(False)) | F.coalesce(new, F.lit(False))


merge, least, greatest = json_merge, F.least, F.greatest


def upsert(target: DataFrame, source: DataFrame, keys: list[str], rules: dict) -> DataFrame:
    """target with source's rows: a new key is inserted, a known one changed column by column (M1 to M6).

    rules gives for each column but the keys what to do with (old, new). A null key never meets another, as in
    SQL, so such rows are inserted. One full outer join on the keys.
    """
    t = target.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in rules], F.lit(True).alias("_t"))
    s = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in rules], F.lit(True).alias("_s"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    j = t.join(s, on, "full")
    old, new = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    cols = [F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys]
    cols += [F.when(old & new, f(F.col(f"_o_{c}"), F.col(f"_n_{c}"))).when(old, F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}")).alias(c) for c, f in rules.items()]
    return j.select(*cols)


# --- the queue ---


def eligible(as_of: Column) -> Column:
    return (F.col("status") == "pending") & (F.col("attempts") < F.col("max_attempts")) & (F.col("run_after") <= as_of)


def claim(jobs: DataFrame, worker: str, n: int, order: Sequence[Column], as_of: Column, key: str = "job_id") -> DataFrame:
    """jobs with the first n eligible ones running for worker (M7); Spark keeps only n rows of each part for the choice."""
    chosen = jobs.where(eligible(as_of)).orderBy(*order).limit(n).select(key, F.lit(True).alias("_mine"))
    j = jobs.join(chosen, key, "left")
    mine = F.col("_mine").isNotNull()
    return j.withColumns({"status": F.when(mine, "running").otherwise(F.col("status")), "attempts": F.col("attempts") + F.when(mine, 1).otherwise(0), "locked_by": F.when(mine, worker).otherwise(F.col("locked_by")), "locked_at": F.when(mine, as_of).otherwise(F.col("locked_at"))}).drop("_mine")


def completed(jobs: DataFrame, which: Column, as_of: Column) -> DataFrame:
    """M8."""
    done = which & (F.col("status") == "running")
    return jobs.withColumns({"status": F.when(done, "done").otherwise(F.col("status")), "finished_at": F.when(done, as_of).otherwise(F.col("finished_at")), "locked_by": F.when(~done, F.col("locked_by"))})


def failed(jobs: DataFrame, which: Column, error: Column, as_of: Column, delay_seconds: int) -> DataFrame:
    """Pending again after a delay, failed once no attempt is left; the error is cut at 4000 characters (M8)."""
    last = F.col("attempts") >= F.col("max_attempts")
    return jobs.withColumns(
        {
            "status": F.when(which & last, "failed").when(which, "pending").otherwise(F.col("status")),
            "run_after": F.when(which & ~last, as_of + F.make_interval(secs=F.lit(delay_seconds))).otherwise(F.col("run_after")),
            "last_error": F.when(which, F.substring(error, 1, 4000)).otherwise(F.col("last_error")),
            "locked_by": F.when(~which, F.col("locked_by")),
        }
    )


def reset_stale(jobs: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Running jobs locked too long ago are pending again, or failed without attempts left."""
    stale = (F.col("status") == "running") & (F.col("locked_at") < as_of - F.make_interval(mins=F.lit(minutes)))
    last = F.col("attempts") >= F.col("max_attempts")
    return jobs.withColumns({"status": F.when(stale & last, "failed").when(stale, "pending").otherwise(F.col("status")), "locked_by": F.when(~stale, F.col("locked_by")), "locked_at": F.when(~stale, F.col("locked_at"))})


def leased(meta: Column, worker: str, as_of: Column, on: Column) -> Column:
    """The lease keys merged into metadata (M9)."""
    return F.when(on, json_merge(meta, F.create_map(F.lit("claimed_by"), F.lit(worker), F.lit("claimed_at"), as_of.cast("string")))).otherwise(meta)


def released(meta: Column, worker: str | None) -> Column:
    """Without the lease keys, if worker holds it; any lease for None."""
    mine = F.lit(True) if worker is None else F.coalesce(meta["claimed_by"] == worker, F.lit(False))
    return F.when(mine, json_without(meta, ["claimed_by", "claimed_at"])).otherwise(meta)


def segment_diff(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """What to do with each segment: inserted, reset, unchanged, kept or deleted.

    Both have text_hash, target status too. A surplus segment is deleted unless it runs; an equal hash keeps its state, though one
    that is pending or failed counts as reset; another hash resets.
    """
    t = target.select(*keys, F.col("text_hash").alias("_old"), "status", F.lit(True).alias("_t"))
    s = source.select(*keys, F.col("text_hash").alias("_new"), F.lit(True).alias("_s"))
    same = F.col("_old") == F.col("_new")
    action = (
        F.when(F.col("_t").isNull(), "inserted")
        .when(F.col("_s").isNull(), F.when(F.col("status") == "running", "kept").otherwise("deleted"))
        .when(same & ~F.col("status").isin("pending", "failed"), "unchanged")
        .otherwise("reset")
    )
    return t.join(s, keys, "full").select(*keys, action.alias("action"))


def without(target: DataFrame, losers: DataFrame, on: list[str]) -> DataFrame:
    """M22."""
    return target.join(losers.select(*on), on, "left_anti")


def repair_requests(chapters: DataFrame, max_attempts: int) -> DataFrame:
    """Chapters that failed the audit: a job by action, or failed_manual once attempts are used up."""
    used = F.col("repair_attempts") >= max_attempts
    return chapters.withColumns(
        {
            "quality_status": F.when(used, "failed_manual").otherwise("pending_audit"),
            "job_type": F.when(~used, F.when(F.col("action") == "retranslate", "translate_chapter").otherwise("polish_chapter")),
            "clear_text": ~used & (F.col("action") == "retranslate"),
            "repair_attempts": F.col("repair_attempts") + F.when(used, 0).otherwise(1),
        }
    )
