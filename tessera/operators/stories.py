"""Stories, chapters and their gates: state changes as functions of tables, and choices of what to work on next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.values import json_merge

# --- values ---


def string_list(c: Column, names: Sequence[str]) -> Column:
    """The first of the JSON fields that is there, a string or a list of strings, as distinct strings in order."""
    found = F.coalesce(*[F.get_json_object(c, f"$.{n}") for n in names])
    many = F.when(F.startswith(found, F.lit("[")), F.from_json(found, "array<string>")).otherwise(F.array(found))
    return F.array_distinct(F.filter(F.coalesce(many, F.array().cast("array<string>")), lambda x: x.isNotNull() & (F.trim(x) != "")))


def numbers_of(c: Column) -> Column:
    """Distinct numbers, in order, of a list such as 3,5-7."""
    parts = F.filter(F.split(c, r"\s*,\s*"), lambda p: p.rlike(r"^\d+(-\d+)?$"))

    def span(p: Column) -> Column:
        a, b = F.split_part(p, F.lit("-"), F.lit(1)).cast("long"), F.nullif(F.split_part(p, F.lit("-"), F.lit(2)), F.lit("")).cast("long")
        return F.when(b < a, F.array().cast("array<bigint>")).otherwise(F.sequence(a, F.greatest(a, F.coalesce(b, a))))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, span))))


def words_or_estimate(text: Column, chars: Column, per_word: float = 5.0) -> Column:
    """Words of a text, else its characters by the usual length of a word."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\w+")).cast("long"), F.floor(chars / per_word).cast("long"))


def looks_romanised(c: Column, foreign: Sequence[str], signals: Sequence[str], share: float = 0.25) -> Column:
    """ASCII, two words or more, no signal word, and enough of the foreign words."""
    ws = F.filter(F.split(F.lower(F.trim(c)), r"\s+"), lambda w: w != "")
    hits = F.size(F.filter(ws, lambda w: w.isin(*foreign)))
    return c.rlike(r"^[\x00-\x7F]*$") & (F.size(ws) >= 2) & ~F.exists(ws, lambda w: w.isin(*signals)) & (hits >= F.size(ws) * share)


def page_matches(text: Column, name: Column, author: Column) -> Column:
    """The page holds the name, or at least two and 60 % of its words, or the author and any word (Q36)."""
    low = F.lower(text)
    ws = F.filter(F.array_distinct(F.split(F.lower(F.trim(name)), r"\s+")), lambda w: F.length(w) > 1)
    hits = F.size(F.filter(ws, lambda w: F.contains(low, w)))
    whole = F.contains(low, F.lower(name))
    return whole | (hits >= F.greatest(F.lit(2), F.ceil(F.size(ws) * 0.6))) | (F.contains(low, F.lower(author)) & (hits > 0))


# --- choices ---


def incomplete(stories: DataFrame, chapters: DataFrame, key: str, done: Column) -> DataFrame:
    """Stories with a chapter that isn't done, or with none (P20)."""
    c = chapters.groupBy(key).agg(F.count_if(~done).alias("_open"))
    return stories.join(c, key, "left").where(F.coalesce("_open", F.lit(1)) > 0).drop("_open")


def flagged_or_active(df: DataFrame, flagged: Column, active: Column) -> DataFrame:
    """The flagged rows, or all active ones where none is flagged: the one-row count is all that is broadcast."""
    any_flag = df.agg(F.count_if(flagged).alias("_flags"))
    return df.join(F.broadcast(any_flag)).where(F.when(F.col("_flags") > 0, flagged).otherwise(active)).drop("_flags")


def one_of_each_key(df: DataFrame, keys: list[str], order: list[Column], where: Column) -> DataFrame:
    """Of the rows that qualify the first of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.where(where).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def matched_by_number(files: DataFrame, path: str, chapters: DataFrame, number: str) -> DataFrame:
    """Files with the chapter whose number their name ends in; without one they stay (Q32)."""
    n = F.regexp_extract(F.col(path), r"(\d+)\D*$", 1).try_cast("bigint")
    return files.withColumn(number, n).join(chapters, number, "left")


def mapped_number(number: Column, start: int, other_start: int) -> Column:
    """A chapter's number in another source whose first is other_start; null before the start."""
    n = number - start + other_start
    return F.when((number >= start) & (n >= 1), n)


def shards(df: DataFrame, order: list[str], group: str, most: int, least_shards: int) -> DataFrame:
    """df with its shard: most rows each, fewer where there would be less than least_shards."""
    total = df.groupBy(group).agg(F.count("*").alias("_n"))
    size = F.greatest(F.lit(1), F.least(F.lit(most), F.ceil(F.col("_n") / least_shards)))
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    return df.withColumn("_place", place).join(total, group).withColumn("shard", F.floor(F.col("_place") / size)).drop("_place", "_n")


def severities(findings: DataFrame, severity: str = "severity") -> DataFrame:
    """One row: blocking, warnings, total."""
    s = F.col(severity)
    return findings.agg(F.count_if(s == "blocking").alias("blocking"), F.count_if(s == "warning").alias("warnings"), F.count("*").alias("total"))


def full_check(codes: Column, drift: Column, blocking: Sequence[str]) -> Column:
    """Struct (blocking, warnings): codes by their name, drift always among the warnings (Q11)."""
    blocks = lambda c: F.substring_index(c, ":", 1).isin(*blocking)
    return F.struct(F.filter(codes, blocks).alias("blocking"), F.concat(F.filter(codes, lambda c: ~blocks(c)), drift).alias("warnings"))


def range_gate(checks: DataFrame, number: str, low: int, high: int) -> DataFrame:
    """One row for chapters from low to high: how many, how many fail, and whether the range may pass.

    A chapter fails on a blocking code or on a warning of a judge.
    """
    bad = (F.size("blocking") > 0) | F.exists("warnings", lambda w: F.startswith(w, F.lit("judge:")))
    s = checks.where(F.col(number).between(low, high)).agg(F.count("*").alias("chapters"), F.count_if(bad).alias("failed"))
    return s.withColumn("passed", (F.col("chapters") > 0) & (F.col("failed") == 0))


# --- changes ---


def text_outputs(chapters: DataFrame, new: DataFrame, key: str, texts: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """New texts where given, flags kept once set; a chapter that gets a text loses its audio."""
    n = new.select(key, *[F.col(c).alias(f"_{c}") for c in (*texts, *flags)])
    j = chapters.join(n, key, "left")
    got = F.lit(False)
    for c in texts:
        got = got | F.col(f"_{c}").isNotNull()
    cols = {c: F.coalesce(f"_{c}", c) for c in texts} | {c: F.coalesce(c, F.lit(False)) | F.coalesce(f"_{c}", F.lit(False)) for c in flags}
    return j.withColumns(cols | {"audio": F.when(~got, F.col("audio"))}).select(chapters.columns)


def set_where(df: DataFrame, keys: DataFrame, on: str, changes: dict[str, Column]) -> DataFrame:
    """df with changed columns in rows whose key is in keys."""
    hit = keys.select(on).distinct().withColumn("_hit", F.lit(True))
    j = df.join(hit, on, "left")
    return j.withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in changes.items()}).select(df.columns)


def named(meta: Column, field: str, value: Column) -> Column:
    """metadata with a trimmed value; an empty one changes nothing."""
    v = F.trim(value)
    return F.when(F.coalesce(v, F.lit("")) != "", json_merge(meta, F.create_map(F.lit(field), v))).otherwise(meta)


def audit_saved(chapters: DataFrame, audits: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Audit columns of the chapters that were audited; others keep theirs."""
    a = audits.select(key, F.col("issues").alias("_issues"), F.col("passed").alias("_passed"))
    j = chapters.join(a, key, "left")
    was = F.col("_passed").isNotNull()
    status = F.when(was, F.when(F.col("_passed"), "passed").otherwise("failed")).otherwise(F.col("quality_status"))
    return j.withColumns({"quality_status": status, "issues": F.coalesce("_issues", "issues"), "audited_at": F.when(was, as_of).otherwise(F.col("audited_at"))}).select(chapters.columns)


def reset_stage(jobs: DataFrame, which: Column, stage: Column, text_columns: Sequence[str]) -> DataFrame:
    """Chosen jobs pending again at another stage, without these texts; running ones are left alone."""
    hit = which & (F.col("status") != "running")
    cols = {"status": F.when(hit, "pending").otherwise(F.col("status")), "attempts": F.when(hit, 0).otherwise(F.col("attempts")), "stage": F.when(hit, stage).otherwise(F.col("stage"))}
    return jobs.withColumns(cols | {c: F.when(~hit, F.col(c)) for c in text_columns})


def repair_choice(chapters: DataFrame, states: Sequence[str] = ("failed", "failed_manual")) -> DataFrame:
    """Chapters of these states with the repair that their stored issues ask for."""
    codes = F.transform(F.col("codes"), lambda c: F.substring_index(c, ":", 1))
    action = F.when(F.exists(codes, lambda c: c.isin("not_vietnamese", "cjk_not_translated", "output_too_short")), "retranslate").otherwise("repolish")
    return chapters.where(F.col("quality_status").isin(*states) & (F.size("codes") > 0)).withColumn("action", action)


def pipeline_mode(story: Column, language: Column, known: Sequence[str] = ("polish_only", "translate_polish")) -> Column:
    """A known mode of its own, else polishing alone for a Vietnamese source, else both."""
    return F.when(story.isin(*known), story).when(F.lower(language) == "vi", "polish_only").otherwise("translate_polish")
