"""Text for speech and for checks: excerpts, numbers as words, clauses and pauses, fragments left untranslated, names and titles."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import bounded, stripped

# --- excerpts (T22) ---


def truncated(c: Column, most: int) -> Column:
    """At most `most` characters and a mark, cut after the last line, sentence or clause beyond 55 % of them."""
    text = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\n{3,}", "\n\n"))
    cut = F.rtrim(F.left(text, F.lit(most)))

    def last(mark: str) -> Column:
        at = F.instr(F.reverse(cut), mark[::-1])
        return F.when(at > 0, F.length(cut) - at - len(mark) + 1).otherwise(-1)

    end = F.greatest(*map(last, ("\n", ". ", "; ")))
    part = F.when(end > most * 0.55, F.rtrim(F.left(cut, end + 1))).otherwise(cut)
    return F.when(F.length(text) <= most, text).otherwise(F.concat(part, F.lit("\n[...]")))


# --- speech (T34, T35, T37, T39, T40) ---

# Vietnamese digits and the abbreviations of games.
DIGITS = ("không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín")
ABBREVIATIONS = {"EXP": "EXp", "STR": "sức mạnh", "DEX": "sự khéo léo", "AGI": "tốc độ", "INT": "trí tuệ", "ATK": "tấn công", "DEF": "phòng thủ"}
MOST_SPOKEN = 999_999_999


def _below_hundred(n: Column) -> Column:
    digits = F.array(*map(F.lit, DIGITS))
    tens, ones = F.floor(n / 10).cast("int"), (n % 10).cast("int")
    front = F.when(tens == 1, "mười").otherwise(F.concat(digits[tens], F.lit(" mươi")))
    back = F.when(ones == 0, "").when((ones == 1) & (tens > 1), " mốt").when(ones == 5, " lăm").otherwise(F.concat(F.lit(" "), digits[ones]))
    return F.when(n < 10, digits[n.cast("int")]).otherwise(F.concat(front, back))


def _above(n: Column, unit: int, name: str, front, back) -> Column:
    """front of the units and their name, then back of the rest if there is one."""
    high, rest = F.floor(n / unit).cast("long"), (n % unit).cast("long")
    return F.concat(front(high), F.lit(f" {name}"), F.when(rest == 0, "").otherwise(F.concat(F.lit(" "), back(rest))))


def _below_thousand(n: Column) -> Column:
    digits = F.array(*map(F.lit, DIGITS))
    odd = lambda r: F.when(r < 10, F.concat(F.lit("lẻ "), digits[r.cast("int")])).otherwise(_below_hundred(r))
    return F.when(n < 100, _below_hundred(n)).otherwise(_above(n, 100, "trăm", _below_hundred, odd))


def _below_million(n: Column) -> Column:
    digits = F.array(*map(F.lit, DIGITS))
    rest = lambda r: F.when(r < 10, F.concat(F.lit("lẻ "), digits[r.cast("int")])).when(r < 100, F.concat(F.lit("không trăm "), _below_hundred(r))).otherwise(_below_thousand(r))
    return F.when(n < 1000, _below_thousand(n)).otherwise(_above(n, 1000, "nghìn", _below_thousand, rest))


def number_words(n: Column) -> Column:
    """Vietnamese words of a whole number up to MOST_SPOKEN; its digits beyond."""
    return F.when((n < 0) | (n > MOST_SPOKEN), n.cast("string")).when(n < 1_000_000, _below_million(n)).otherwise(_above(n, 1_000_000, "triệu", _below_thousand, _below_million))


def spoken_numbers(df: DataFrame, key: str, text: str) -> DataFrame:
    """df's key and text with numbers as words: thousands parted by dots first, then abbreviations, then what is left.

    Pieces between numbers and the numbers themselves are parted into an array and joined again, so words are looked up
    by expressions, not by a function of Python.
    """
    pattern = r"(?U)\b\d{1,3}(?:\.\d{3})+\b|\b\d+\b"
    c = reduce(lambda x, a: F.regexp_replace(x, rf"\b{a[0]}\b", a[1]), ABBREVIATIONS.items(), F.col(text))
    numbers = F.regexp_extract_all(c, F.lit(f"({pattern})"), 1)
    between = F.split(c, pattern, -1)
    words = F.transform(numbers, lambda x: F.coalesce(number_words(F.replace(x, F.lit("."), F.lit("")).try_cast("bigint")), x))
    return df.select(key, F.array_join(F.zip_with(between, words, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "").alias(text))


def story_markup(c: Column) -> Column:
    """Brackets as stops, corner quotes as quotes, runs of dots as three, invisible characters dropped (T34 without percents)."""
    x = F.translate(c, "「」『』％", '""""%')
    for a in "【】[]":
        x = F.replace(x, F.lit(a), F.lit(". "))
    x = F.regexp_replace(F.replace(x, F.lit("…"), F.lit("...")), r"\.{2,}", "...")
    return F.trim(F.regexp_replace(x, r"[​-‏⁠-⁯﻿]", ""))


PAUSE_MARKS = r"\.{2,}|…+|[.!?,;:/—–\-，。？！、；：]"


def clauses(c: Column, pauses: dict[str, int], default: int = 200) -> Column:
    """Structs (kind, content, pause_ms): clauses, and each mark between them with its pause; runs of dots are one ellipsis."""
    known = F.create_map(*[F.lit(x) for kv in pauses.items() for x in kv])
    parts = F.filter(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"(?s)({PAUSE_MARKS}|(?:(?!{PAUSE_MARKS}).)+)"), 1), lambda x: F.trim(F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))), lambda x: x != "")

    def one(x: Column) -> Column:
        mark = x.rlike(rf"^(?:{PAUSE_MARKS})$")
        name = F.when(mark & x.rlike(r"^(?:\.{2,}|…+)$"), F.lit("…")).otherwise(x)
        return F.struct(F.when(mark, "pause").otherwise("text").alias("kind"), name.alias("content"), F.when(mark, F.coalesce(known[name], F.lit(default))).cast("int").alias("pause_ms"))

    return F.transform(parts, one)


def packed_clauses(text: str | None, most: int = 160, comma_every: int = 70) -> str:
    """Fewer, longer clauses: commas fall away but for one every so many characters; a sentence's end, or `most`, ends a clause."""
    lines = [x for x in (line.strip().strip('"').strip() for line in (text or "").splitlines()) if x]
    out, now, since = [], "", 0
    for content, mark in re.findall(r"([^.!?。！？;；:：…,，、]+)([.!?。！？;；:：…]*|[,，、]*)", re.sub(r"\s+", " ", ". ".join(lines))):
        unit = content.strip(" -—–")
        if not unit:
            continue
        comma = not mark or mark[0] in ",，、"
        if not mark and not content.strip():
            continue
        ends = not comma
        join = ", " if now and comma and since >= comma_every else " "
        since = 0 if join == ", " else since
        longer = f"{now}{join}{unit}" if now else unit
        if len(longer) <= most:
            now, since = longer, since + len(unit)
        else:
            if now:
                out.append(now)
            words = short_words(unit, most)
            out += words[:-1]
            now, since = words[-1], len(words[-1])
        if ends:
            out.append(now)
            now, since = "", 0
    out += [now] if now else []
    return ". ".join(out) + "." if out else ""


def short_words(unit: str, most: int) -> list[str]:
    """Words joined while they fit."""
    out = [""]
    for w in unit.split():
        if out[-1] and len(out[-1]) + 1 + len(w) > most:
            out.append(w)
        else:
            out[-1] = f"{out[-1]} {w}".strip()
    return out


# --- checks of translations (A18, Q11, Q13, Q16 to Q18, Q23, Q29) ---


def foreign_fragments(c: Column, allowed: Sequence[str], names: Sequence[str] = ()) -> Column:
    """Runs of at least two capitalised or upper-case words outside brackets, each once; runs of allowed words or of names alone aren't any (Q16)."""
    masked = F.regexp_replace(F.coalesce(c, F.lit("")), r"\[[^\]]*\]", " | ")
    found = F.concat(*[F.regexp_extract_all(masked, F.lit(rf"(?<![\p{{L}}\p{{M}}\p{{N}}_])({w}(?: {w})+)(?![\p{{L}}\p{{M}}\p{{N}}_])"), 1) for w in ("[A-Z][a-z]+", "[A-Z]{2,}")])
    few = F.array(*map(F.lit, allowed)) if allowed else F.array().cast("array<string>")
    known = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")

    def foreign(x: Column) -> Column:
        ws = F.split(x, " ")
        return F.exists(ws, lambda w: ~F.array_contains(few, F.lower(w))) & F.exists(ws, lambda w: ~F.array_contains(known, w))

    return F.array_distinct(F.filter(found, foreign))


def wrong_terms(texts: DataFrame, key: str, text: str, wrong: dict[str, str]) -> DataFrame:
    """A row for each text and wrong surface that stands in it as a name of its own: key, surface, canonical (Q17).

    Texts are read once; a text's few surfaces are exploded, so nothing is joined or gathered.
    """
    pairs = F.array(*[F.when(bounded(F.col(text), w), F.struct(F.lit(w).alias("surface"), F.lit(c).alias("canonical"))) for w, c in wrong.items()])
    return texts.select(key, F.explode(F.array_compact(pairs)).alias("x")).select(key, "x.surface", "x.canonical")


def priority_hints(c: Column, wrong: dict[str, str]) -> Column:
    """Lines that say what a surface has to be; surfaces that differ in case alone say nothing (Q13)."""
    tests = [F.when(bounded(c, w), F.lit(f"- `{w}` → phải là `{to}`")) for w, to in wrong.items() if w.casefold() != to.casefold()]
    return F.array_distinct(F.array_compact(F.array(*tests)))


def chunk_violations(source: Column, output: Column, glossary: dict[str, str], least: float = 0.5, most: float = 2.5, cjk: str = "[㐀-鿿぀-ヿ가-힯]") -> Column:
    """Codes of a translated chunk: foreign script left, length out of bounds, glossary words whose translation is missing (Q23)."""
    ratio = F.length(output) / F.greatest(F.length(source), F.lit(1))
    tests = [
        F.when(output.rlike(cjk), F.lit("cjk_leakage:high")),
        F.when((source != "") & ((output == "") | (ratio < least)), F.lit("length_ratio:high")).when((source != "") & (ratio > most), F.lit("length_ratio:medium")),
        *[F.when(F.contains(source, F.lit(s)) & ~F.contains(output, F.lit(t)), F.lit(f"glossary_error:{t}")) for s, t in glossary.items()],
    ]
    return F.array_compact(F.array(*tests))


def with_pronouns(c: Column, fixes: dict[str, str], spoken: str = "\"'“‘—[【") -> Column:
    """Struct (text, replaced): whole words replaced on lines that don't start as speech does (Q29)."""

    def replaced(line: Column) -> Column:
        return reduce(lambda x, kv: F.regexp_replace(x, rf"(?U)\b{kv[0]}\b", kv[1]), fixes.items(), line)

    lines = F.split(c, "\n", -1)
    told = lambda line: ~F.contains(F.lit(spoken), F.left(F.ltrim(line), F.lit(1))) | (F.trim(line) == "")
    n = F.aggregate(F.filter(lines, told), F.lit(0), lambda s, x: s + reduce(lambda a, b: a + b, [F.regexp_count(x, F.lit(rf"(?U)\b{k}\b")) for k in fixes]))
    return F.struct(F.array_join(F.transform(lines, lambda x: F.when(told(x), replaced(x)).otherwise(x)), "\n").alias("text"), n.alias("replaced"))


def gap_summary(found: DataFrame) -> DataFrame:
    """One row of counts, and whether to polish again. found: fragments, wrong terms, priority terms of each text (Q18)."""
    s = found.agg(F.count("*").alias("scanned"), F.count_if(F.col("fragments") > 0).alias("with_fragments"), F.coalesce(F.sum("terms"), F.lit(0)).alias("term_issues"), F.coalesce(F.sum("priority"), F.lit(0)).alias("priority_issues"))
    return s.withColumn("should_repolish", (F.col("with_fragments") > 0) | (F.col("priority_issues") > 0))


# --- names and titles (T51, T53, T54, Z4, Z8) ---


def without_affixes(c: Column, prefixes: Sequence[str], suffixes: Sequence[str] = ()) -> Column:
    """Trimmed, without one of the prefixes and one of the suffixes, in any case."""
    t = F.trim(c)
    for words, cut in ((prefixes, lambda x, w: F.substring(x, len(w) + 1, 1 << 30)), (suffixes, lambda x, w: F.left(x, F.length(x) - len(w)))):
        out, low = t, F.lower(t)
        for w in reversed(words):
            has = F.startswith(low, F.lit(w)) if words is prefixes else F.endswith(low, F.lit(w))
            out = F.when(has, F.trim(cut(t, w))).otherwise(out)
        t = out
    return t


def first_title(c: Column, patterns: Sequence[str], lines: int = 15) -> Column:
    """What the first pattern's group finds in the first lines, trying patterns in order; null for none."""
    head = F.slice(F.split(F.coalesce(c, F.lit("")), "\n"), 1, lines)

    def first(p: str) -> Column:
        return F.get(F.filter(F.transform(head, lambda x: F.trim(F.regexp_extract(x, p, 1))), lambda x: x != ""), F.lit(0))

    return F.coalesce(*map(first, patterns))


def alias_map(c: Column) -> Column:
    """Lines such as - a, b = name as a map from each alias to the name; later lines win."""
    lines = F.filter(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.contains(x, F.lit("=")))

    def entries(x: Column) -> Column:
        name = F.trim(F.substring_index(x, "=", -1))
        own = F.filter(F.transform(F.split(F.regexp_replace(F.substring_index(x, "=", 1), r"^\s*-\s*", ""), ","), lambda a: F.trim(a)), lambda a: a != "")
        return F.transform(own, lambda a: F.struct(a.alias("k"), name.alias("v")))

    every = F.reverse(F.flatten(F.transform(lines, entries)))
    keys = F.transform(every, lambda e: e["k"])
    return F.map_from_entries(F.filter(every, lambda e, i: F.array_position(keys, e["k"]) == i + 1))


def without_promotion(c: Column, patterns: Sequence[str]) -> Column:
    """Lines that any pattern finds are dropped."""
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~x.rlike("|".join(f"(?:{p})" for p in patterns))), "\n")


def relevant_seeds(texts: DataFrame, key: str, text: str, seeds: dict[str, str], own: Sequence[str]) -> DataFrame:
    """key, term, canonical of the seed terms that a text holds, but for those the story's own glossary has."""
    left = {k: v for k, v in seeds.items() if k.lower() not in {o.lower() for o in own}}
    found = F.array(*[F.when(F.contains(F.lower(text), F.lit(k.lower())), F.struct(F.lit(k).alias("term"), F.lit(v).alias("canonical"))) for k, v in left.items()])
    return texts.select(key, F.explode(F.array_compact(found)).alias("x")).select(key, "x.*")


# --- words of the error tool (T46) ---

# Marks that start no token.
SKIPPED = "!,?、。！，；？：「」︰『』《》"


def error_tokens(c: Column, ignored: Sequence[str] = (), case_sensitive: bool = False, keep_tags: bool = False) -> Column:
    """Tokens as errors are counted: each letter without case by itself; else ASCII runs, of a tag up to its end, after any first character."""
    ascii_run = r"[\x21-\x7E]*"
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"(\p{{Lo}}|<[\x21-\x3D\x3F-\x7E]*>?|[^\s\p{{Zs}}\p{{Cn}}{SKIPPED}]{ascii_run})"), 1)
    out = F.transform(found, lambda x: x if case_sensitive else F.upper(x))
    if ignored:
        out = F.filter(out, lambda x: ~x.isin(*ignored))
    if not keep_tags:
        out = F.filter(F.transform(out, lambda x: F.regexp_replace(x, "<[^>]*>?", "")), lambda x: x != "")
    return out


# --- titles that were crawled (P21) ---

# A title that is a number alone, what a model says in place of one, two sentences in a row, and hosts of sites.
BARE_TITLE = r"(?iu)\A(?:chapter|chương)\s+\d+[\s.]*\z"
NO_TITLE = r"(?iu)\A\((?:no text|the text|narration|văn bản)"
SENTENCES_IN_TITLE = r"[!?]\s+\S|\.\s+[A-ZÀ-ỹ]"
HOST_IN_TITLE = r"(?i)\b\w[\w-]+\.(?:com|net|org|vn|one|io|me|xyz)\b"


def suspicious_title(c: Column) -> Column:
    """No title, or none worth keeping: blank, a number alone, or a model's remark."""
    t = stripped(F.coalesce(c, F.lit("")))
    return (t == "") | t.rlike(BARE_TITLE) | t.rlike(NO_TITLE)


def valid_title(c: Column) -> Column:
    """Whether a title may replace another: 2 to 120 characters, not suspicious, no prose and no site's name."""
    t = stripped(F.coalesce(c, F.lit("")))
    return F.length(t).between(2, 120) & ~suspicious_title(c) & ~t.rlike(SENTENCES_IN_TITLE) & ~t.rlike(HOST_IN_TITLE)
