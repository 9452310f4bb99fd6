"""Finished chapters as paragraphs for readers (T27 to T31), as a plan over lines.

A text becomes rows, one for each line, and what a line is is a column. Titles at the start, remarks at the end and blocks of
lines are found by windows over the lines' numbers; blocks become paragraphs, these become parts that fit, short narration is joined to
what stands before it, and at the end the paragraphs of a text are joined. No step walks a text; only how many pieces fit
together depends on all before it, and that is decided on their lengths.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import by_marks, is_separator, plain_spaces, punctuation_spacing, stripped, without_markdown

LONGEST, SHORT, TITLES, TAIL, LONGEST_HEADING, LEAST_KEY = 520, 180, 4, 12, 140, 3
# Ends of sentences.
ENDS, WIDE_ENDS = ".!?", "。！？…"
# What a chapter's heading and its number look like, and what may stand between number and title.
CHAPTER, BREAK = r"(?:#{1,6}\s*)?(?:chương|chapter)\s*(?:\d+|[ivxlcdm]+)", "[-–—:：.．]"
# How notes that belong to a story begin; how remarks of editors begin; further lines of editors; what stands before a text.
NOTES = "ghi chú|chú thích|note|notes|lưu ý"
REMARKS = [
    "nhận xét|tóm tắt|hậu kiểm|các thay đổi|những thay đổi|đã chỉnh sửa|bản đã chỉnh|bản biên tập|văn bản đã biên tập|phong cách chỉnh sửa",
    r"(?:dưới đây là|sau đây là)\s+(?:bản|văn bản|nội dung)\s+(?:đã\s+)?(?:biên tập|chỉnh sửa|polish)",
]
ACCOUNTS = [
    r"(?:bản biên tập|văn bản đã biên tập|nội dung đã biên tập|bản đã chỉnh sửa)\s*:",
    r"(?:tôi|mình|em)\s+đã\s+(?:biên tập|chỉnh sửa|sửa|giữ|loại|xóa|chuẩn hóa)\b",
    r"(?:đã\s+)?(?:sửa|chỉnh|chuẩn hóa|loại bỏ|xóa|giữ nguyên|thay|đổi)\b.{0,120}\b(?:văn phong|câu|từ|lỗi|dấu câu|tên riêng|thuật ngữ|markdown|title|tiêu đề|line break|xuống dòng)\b",
    r"(?:không\s+)?(?:tóm tắt|rút gọn|thêm tình tiết|bỏ nội dung)\b",
    r"(?:output|kết quả)\s+(?:đã\s+)?(?:được\s+)?(?:biên tập|chỉnh sửa|polish)",
]
VERSIONS = "phiên bản chỉnh sửa|bản chỉnh sửa|bản dịch|bản tiếng việt"
SOUNDS = "keng|đinh|tinh|ting|ầm|rầm|vù|xoẹt|két|bốp|chát"


def _starts(c: Column, *patterns: str) -> Column:
    """Whether a line starts with one of the patterns in any case; words in them end where letters and digits do."""
    p = "|".join(patterns).replace(r")\b", r")(?![\p{L}\p{N}_])").replace(r"\b(", r"(?<![\p{L}\p{N}_])(")
    return F.lower(c).rlike(rf"\A(?:{p})")


def is_note(c: Column) -> Column:
    """A note that belongs to the story."""
    return _starts(c, rf"(?:{NOTES})\b")


def is_remark(c: Column) -> Column:
    """A note or remark, of a story or of an editor."""
    return is_note(c) | _starts(c, rf"(?:{REMARKS[0]})\b", REMARKS[1])


def is_account(c: Column) -> Column:
    """An editor's account of what was changed."""
    return _starts(c, *ACCOUNTS)


def is_heading(c: Column) -> Column:
    """A chapter's heading alone, with its title or a part's number."""
    return (F.length(c) <= LONGEST_HEADING) & F.lower(c).rlike(rf"\A{CHAPTER}(?:\s*{BREAK}.+)?(?:\s*\(\d+\))?\z") & ~c.rlike(rf"[{ENDS}{WIDE_ENDS}]\s+\S")


@F.pandas_udf(T.StringType())
def _normal(v: pd.Series) -> pd.Series:
    return v.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(T.StringType())
def _bare(v: pd.Series) -> pd.Series:
    """Decomposed, without combining marks, folded."""
    return v.map(lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).casefold(), na_action="ignore")


def title_key(c: Column) -> Column:
    """Letters and digits without accents, in one case."""
    return stripped(F.regexp_replace(_bare(without_markdown(F.coalesce(c, F.lit("")))), r"[^\p{L}\p{N}]+", " "))


def without_number(c: Column) -> Column:
    """Without a chapter's number, and its word, at the start."""
    return stripped(F.regexp_replace(without_markdown(stripped(F.coalesce(c, F.lit("")))), rf"(?iu)\A(?:(?:chương|chapter)\s*)?(?:\d+|[ivxlcdm]+)(?:\s*{BREAK}\s*|\s*::\s*)?", ""))


def reader_lines(d: DataFrame) -> DataFrame:
    """Lines (column line) for readers; empty where they are remarks, separators or headings."""
    x, rest = F.col("line"), F.col("rest")
    d = d.withColumn("line", stripped(x)).withColumn("line", without_markdown(x)).withColumn("line", punctuation_spacing(x))
    d = d.withColumn("line", stripped(F.regexp_replace(x, rf"(?iu)\A(?:{VERSIONS})\s*:?\s*", "")))
    d = d.withColumn("line", F.when(((is_remark(x) | is_account(x)) & ~is_note(x)) | is_separator(x) | is_heading(x), "").otherwise(x))
    d = d.withColumn("rest", stripped(F.regexp_replace(x, rf"(?iu)\A{CHAPTER}\s*(?:{BREAK}\s*)?[^{ENDS}{WIDE_ENDS}\n]{{0,90}}[{ENDS}{WIDE_ENDS}]\s*", "")))
    return d.withColumn("line", F.when((rest == "") | (rest == x), x).otherwise(punctuation_spacing(rest))).drop("rest")


@F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def _groups(lengths: pd.Series) -> pd.Series:
    """Of each group of pieces the place of the first (from 1) and how many: a piece joins the group before while all fit with a space between."""

    def one(n) -> list[list[int]]:
        out, have = [], LONGEST
        for i, x in enumerate(n):
            have += 1 + x
            if have > LONGEST:
                out.append([i + 1, 0])
                have = x
            out[-1][1] += 1
        return out

    return lengths.map(one, na_action="ignore")


def fitted(pieces: Column) -> Column:
    """Pieces of an array, best a column of its own, joined with a space while they fit; one that is too long stays whole."""
    return F.transform(_groups(F.transform(pieces, F.length)), lambda g: F.array_join(F.slice(pieces, g[0], g[1]), " "))


def sentences(c: Column) -> Column:
    """Sentences with their ends and closing quotes. (Split, as Spark's extraction of all matches copies the text for each.)"""
    after = "[”\"'’]"

    def split(ends: str) -> Column:
        pieces = F.split(c, "|".join(rf"(?<=[{ends}]{after * n})(?![{ends}”\"'’])" for n in range(4)))
        return F.filter(F.transform(pieces, lambda x: stripped(F.regexp_replace(x, rf"\A[{ends}]+", ""))), lambda x: x != "")

    return by_marks(c, split, WIDE_ENDS, ENDS)


def short_parts(d: DataFrame, text: str) -> DataFrame:
    """Adds parts: sentences of a paragraph joined while they fit; a paragraph that fits stays as it is."""
    p = F.col(text)
    d = d.withColumn("_s", F.when(F.length(p) <= LONGEST, F.array(p)).otherwise(sentences(p)))
    return d.withColumn("parts", F.when(F.size("_s") == 0, F.array(p)).otherwise(fitted(F.col("_s")))).drop("_s")


def _ordered(value: Column, by: Column) -> Column:
    """Values of a group as an array, in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(by.alias("by"), value.alias("v")))), lambda x: x["v"])


def _over(key: str) -> Window:
    return Window.partitionBy(key).orderBy("n")


def without_titles(d: DataFrame, key: str, titles: DataFrame) -> DataFrame:
    """Lines without up to TITLES headings or titles at the start (T28). titles: key, names (an array of title keys)."""
    d = d.join(titles, key, "left")
    full = F.col("line") != ""
    d = d.withColumn("c", F.count_if(full).over(_over(key).rowsBetween(Window.unboundedPreceding, 0)))
    early = F.when(full & (F.col("c") <= TITLES), F.col("line"))
    names = F.filter(F.array(title_key(early), title_key(without_number(early))), lambda x: x != "")
    title = early.isNotNull() & (F.arrays_overlap(names, F.coalesce("names", F.array().cast("array<string>"))) | is_heading(F.col("line")))
    d = d.withColumn("text_begun", F.count_if(full & ~title).over(_over(key).rowsBetween(Window.unboundedPreceding, 0)) > 0)
    return d.where("text_begun OR c > " + str(TITLES)).drop("c", "text_begun", "names")


def without_remarks(d: DataFrame, key: str) -> DataFrame:
    """Lines up to an editor's remark among the last TAIL, without accounts of changes (T28); of blank lines in a row one stays."""
    w = Window.partitionBy(key)
    full = F.col("line") != ""
    d = d.withColumn("at", F.row_number().over(_over(key)))
    d = d.withColumn("last", F.max(F.when(full, F.col("at"))).over(w))
    remark = full & is_remark(F.col("line")) & ~is_note(F.col("line")) & (F.col("at") > F.col("last") - TAIL) & (F.col("at") <= F.col("last"))
    d = d.withColumn("cut", F.max(F.when(remark, F.col("at"))).over(w)).withColumn("before", F.lag("line").over(_over(key)))
    d = d.where((F.col("at") <= F.col("last")) & (F.col("cut").isNull() | (F.col("at") < F.col("cut"))))
    blank = ~full & (F.coalesce("before", F.lit("")) != "") & (F.col("at") < F.coalesce(F.col("cut") - 1, F.col("last")))
    return d.where((full & (is_remark(F.col("line")) | ~is_account(F.col("line")))) | blank).drop("at", "last", "cut", "before")


def _blocks(d: DataFrame, key: str) -> DataFrame:
    """key, n, paragraph: lines between blank ones as one line; a quotation mark on a line of its own goes to the line before."""
    blank = F.col("line") == ""
    d = d.withColumn("block", F.count_if(blank).over(_over(key).rowsBetween(Window.unboundedPreceding, 0))).where(~blank)
    text = F.array_join(_ordered(F.col("line"), F.col("n")), "\n")
    g = d.groupBy(key, F.col("block").alias("n")).agg(text.alias("text"))
    text = F.regexp_replace(F.col("text"), "([^\n])\n([\"'])(?=\n|\\z)", "$1$2")
    g = g.select(key, "n", F.regexp_replace(F.regexp_replace(text, "[ \t]+", " "), r" *\n[ \n]*", " ").alias("paragraph"))
    return g.withColumn("paragraph", punctuation_spacing(F.col("paragraph")))


def _parts(d: DataFrame, key: str) -> DataFrame:
    """key, n (a pair of numbers), p: paragraphs, parted where speech opens after a sentence's end, in parts that fit."""
    c = F.col("paragraph")
    opened = by_marks(c, lambda ends: F.split(c, rf"(?<=[{ends}])\s+(?=[\"'“‘])|(?<=[{ends}][”\"'’])\s+(?=[\"'“‘])"), WIDE_ENDS, ENDS)
    d = d.select(key, "n", F.posexplode(opened).alias("k", "p")).select(key, "n", "k", stripped(F.col("p")).alias("p")).where("p <> ''")
    d = d.withColumn("s", F.when(F.length("p") <= LONGEST, F.array("p")).otherwise(sentences(F.col("p"))))
    d = d.select(key, "n", "k", F.posexplode(fitted(F.col("s"))).alias("j", "p"))
    return d.select(key, F.struct("n", "k", "j").alias("n"), punctuation_spacing(F.col("p")).alias("p")).where("p <> ''")


def _merged(d: DataFrame, key: str) -> DataFrame:
    """key, n, p: a quotation mark alone joined to the paragraph before it, then short narration to the narration before it."""
    quote = F.col("p").isin('"', "'")
    d = d.withColumn("g", F.count_if(~quote).over(_over(key).rowsBetween(Window.unboundedPreceding, 0))).where("g > 0")
    own = _ordered(F.col("p"), F.col("n"))
    d = d.groupBy(key, "g").agg(own.alias("ps")).select(key, F.col("g").alias("n"), F.when(F.size("ps") == 1, F.get("ps", F.lit(0))).otherwise(punctuation_spacing(F.array_join("ps", ""))).alias("p"))
    p = F.col("p")
    alone = (F.length(p) >= LONGEST) | p.rlike("\\A[\"']") | p.rlike("[\"'].*[\"']\\z") | p.rlike(rf"(?iu)\A(?:{SOUNDS})!\z")
    # narration in a row: what stands alone is a run of its own; long narration starts anew
    d = d.withColumn("alone", alone).withColumn("starts", F.col("alone") | F.coalesce(F.lag("alone").over(_over(key)), F.lit(True)) | (F.length("p") >= SHORT))
    d = d.withColumn("run", F.count_if("starts").over(_over(key).rowsBetween(Window.unboundedPreceding, 0)))
    g = d.groupBy(key, F.col("run").alias("n")).agg(own.alias("ps"))
    return g.select(key, "n", F.posexplode(fitted(F.col("ps"))).alias("k", "p")).select(key, F.struct("n", "k").alias("n"), "p")


def reader_text(docs: DataFrame, key: str, content: str, title: str) -> DataFrame:
    """key, text: every chapter in paragraphs for readers (T31). key is unique; a null or blank content gives an empty text."""
    text = F.translate(_normal(F.coalesce("_content", F.lit(""))), "“”‘’\u00a0\u200b\u200c\u200d\ufeff", "\"\"'' ")
    text = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), "([^\n])\n+\\s*([\"'])(?=\n|\\z)", "$1$2")
    named = F.filter(F.array(title_key(F.col(title)), title_key(without_number(F.col(title)))), lambda x: F.length(x) >= LEAST_KEY)
    own = F.col(key).alias("_key")
    # dealt by key as texts, which are fewer than lines: no window or group below deals them again
    d = docs.select(own, F.col(content).alias("_content")).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_key").select("_key", plain_spaces(text).alias("_text"))
    d = d.select("_key", F.posexplode(F.split("_text", "\n")).alias("n", "raw"))
    d = d.select("_key", "n", stripped(F.col("raw")).alias("line")).withColumn("line", without_markdown(F.col("line"))).withColumn("line", punctuation_spacing(F.col("line")))
    d = without_remarks(without_titles(d, "_key", docs.select(own, named.alias("names"))), "_key")
    d = without_remarks(reader_lines(d), "_key")
    d = _merged(_parts(_blocks(d, "_key"), "_key"), "_key")
    d = d.groupBy("_key").agg(F.array_join(_ordered(F.col("p"), F.col("n")), "\n\n").alias("text"))
    return docs.select(own).join(d, "_key", "left").select(F.col("_key").alias(key), F.coalesce("text", F.lit("")).alias("text"))
