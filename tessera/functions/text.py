"""Text functions as column expressions; those that need Unicode normal forms or folds over lines are Arrow UDFs.

Patterns start with (?U) or (?iu) where word characters or case are to be those of Unicode.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- normal forms and slugs ---


def by_text(one: Callable, kind: str = "string") -> Callable[[Column], Column]:
    """An Arrow UDF of a function of one text; null stays null."""
    return lambda c: F.pandas_udf(lambda s: s.map(lambda x: None if x is None else one(x)), kind)(c)


def nfkd_ascii(c: Column) -> Column:
    """ASCII characters of the compatibility decomposition."""
    return by_text(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())(c)


def unaccented(c: Column) -> Column:
    """Without combining marks, d for đ, case-folded."""

    def one(x: str) -> str:
        x = unicodedata.normalize("NFKD", x.replace("đ", "d").replace("Đ", "D"))
        return "".join(k for k in x if not unicodedata.combining(k)).casefold()

    return by_text(one)(c)


def compact(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def slug(c: Column, fallback: str = "category") -> Column:
    """Lower-case ASCII letters and digits joined by hyphens; else the text with hyphens for spaces; else fallback."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(nfkd_ascii(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    own = F.regexp_replace(F.lower(compact(c)), r"(?U)\s+", "-")
    return F.coalesce(F.nullif(plain, F.lit("")), F.nullif(own, F.lit("")), F.lit(fallback))


def category_name(c: Column) -> Column:
    """Compacted, lower-case ASCII; the compacted text where nothing is left."""
    return F.coalesce(F.nullif(F.trim(nfkd_ascii(F.lower(compact(c)))), F.lit("")), F.lower(compact(c)))


def category_names(c: Column) -> Column:
    """Names parted by commas, slashes, bars and the like, each once."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[,，/|;；、·]+"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def comparable(c: Column) -> Column:
    """Lower case, marks as spaces, underscores kept (T4)."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def comparable_no_underscore(c: Column) -> Column:
    """As comparable, but only letters, marks and digits are kept (T5)."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}\s]", " "), r"\s+", " "))


# --- addresses ---


def url_key(c: Column) -> Column:
    """Lower case without slashes at the end."""
    return F.regexp_replace(F.lower(F.trim(c)), "/+$", "")


def url_key_case(c: Column) -> Column:
    """Without slashes at the end, case kept."""
    return F.regexp_replace(c, "/+$", "")


def canonical_url(c: Column) -> Column:
    """Scheme, host and path with one slash at the end."""
    return F.concat(F.regexp_replace(F.regexp_replace(c, r"[?#;].*$", ""), "/+$", ""), F.lit("/"))


def story_key(c: Column, names: Sequence[str] = ("bookId", "productNo", "novelId")) -> Column:
    """A known query parameter, else the last part of the path, else the address."""
    params = [F.nullif(F.regexp_extract(c, rf"[?&]{n}=([^&#]+)", 1), F.lit("")) for n in names]
    return F.coalesce(*params, F.nullif(F.element_at(F.split(F.regexp_replace(F.regexp_replace(c, r"^[a-z]+://[^/]*|[?#].*$", ""), "/+$", ""), "/"), -1), F.lit("")), c)


def parent_url(c: Column) -> Column:
    """Without the last part of a path of at least two."""
    return F.when(c.rlike(r"^[a-z]+://[^/]+/[^/]+/[^/]+"), F.regexp_replace(c, "/[^/]+/*$", "/")).otherwise(c)


def host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[a-zA-Z]+://([^/:?#]+)", 1))


# --- lines and paragraphs ---


def clean_paragraphs(c: Column) -> Column:
    """Lines compacted, blank ones dropped, joined by blank lines."""
    lines = F.transform(F.split(F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit(" ")), "\r\n|\n|\r"), compact)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n\n")


def paragraphs(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\n\s*\n"), lambda p: F.length(F.trim(p)) > 0)


def chapter_number(title: Column, url: Column, fallback: Column, words: str = "chương|chuong|chapter|chap|ch") -> Column:
    """The number after a chapter word of the title, else of the address, else fallback."""
    found = [F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), rf"(?iu)(?:{words})[^\d]{{0,12}}0*(\d{{1,5}})", 1), F.lit("")).cast("int") for c in (title, url)]
    return F.coalesce(*found, fallback)


def digits(c: Column) -> Column:
    """All digits as one number; 0 for none."""
    return F.coalesce(F.nullif(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", ""), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def has_any(c: Column, patterns: Sequence[str]) -> Column:
    """Any of the literal patterns in the lower-cased text."""
    return F.lower(c).rlike("|".join(re.escape(p.lower()) for p in patterns))


def drop_repeated_paragraphs(c: Column, least: int = 120) -> Column:
    """Repeats of paragraphs of at least `least` characters, compared compacted and in lower case, are dropped."""
    ps = F.split(c, r"\n\s*\n")
    key = F.transform(ps, lambda p: F.lower(compact(p)))
    kept = F.filter(F.zip_with(ps, F.sequence(F.lit(1), F.size(ps)), lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: (F.length(F.trim(x["p"])) < least) | (F.array_position(key, F.element_at(key, x["i"])) == x["i"]))
    return F.array_join(F.transform(kept, lambda x: x["p"]), "\n\n")


def without_cjk_parentheses(c: Column) -> Column:
    """Parentheses that hold Chinese, Japanese or Korean are removed."""
    return F.regexp_replace(c, r"\s*[(（][^()（）]*[㐀-鿿぀-ヿ가-힯][^()（）]*[)）]", "")


OPENING, CLOSING = r"(\[{", r")\]}"
# Marks that stand close to the word before them.
MARKS, WIDE_MARKS = ",.!?;:", "，。！？；："
#: White space of all scripts, and that of Latin texts as a class of characters, which is far faster than a class with characters above U+00FF.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
_BLANK = r"\s\x1C-\x1F\x85\xA0"
BLANK = f"[{_BLANK}]"


def stripped(c: Column) -> Column:
    """Without white space of any kind at the ends; trim() knows the space alone."""
    return F.btrim(c, F.lit(BLANKS))


def plain_spaces(c: Column) -> Column:
    """Spaces beyond Latin texts as plain ones."""
    wide = "".join(x for x in BLANKS if x > "\xff")
    return F.translate(c, wide, " " * len(wide))


def by_marks(c: Column, make: Callable[[str], Column], wide: str = WIDE_MARKS, narrow: str = MARKS) -> Column:
    """make(marks), with wide marks only for texts that hold one."""
    return F.when(c.rlike(f"[{wide}]"), make(narrow + wide)).otherwise(make(narrow))


def punctuation_spacing(c: Column) -> Column:
    """No space before marks, after opening and before closing brackets and inside quotes, one after marks (T23). c is best a column of its own."""

    def spaced(marks: str) -> Column:
        uneven = rf"""{BLANK}[{_BLANK}{marks}{CLOSING}]|[{OPENING}"']{BLANK}|[{marks}][^{_BLANK}]"""
        x = F.regexp_replace(c, rf"{BLANK}+(?=[{marks}{CLOSING}])|(?<=[{OPENING}]){BLANK}+", "")
        x = F.regexp_replace(x, rf"""(?<![^{_BLANK}{OPENING}])(["']){BLANK}+([^"'\n]*?){BLANK}+\1(?![^{_BLANK}{marks}{CLOSING}])""", "$1$2$1")
        x = F.regexp_replace(x, rf"""(?<=[{marks}])(?=[^{_BLANK}{marks}{CLOSING}"'])""", " ")
        return F.when(c.rlike(uneven), F.regexp_replace(stripped(x), f"{BLANK}{{2,}}", " ")).otherwise(stripped(c))

    return by_marks(c, spaced)


def without_markdown(c: Column) -> Column:
    """Heading, quote, list and emphasis marks of one line removed (T24). c is best a column of its own."""
    x = F.regexp_replace(F.regexp_replace(c, rf"\A#{{1,6}}{BLANK}+", ""), rf"\A>{BLANK}+", "")
    x = F.regexp_replace(F.regexp_replace(x, r"\A[-*_]{3,}\z", ""), rf"\A[-*+]{BLANK}+(?=[^{_BLANK}])", "")
    for mark in ("*", "_"):
        x = F.regexp_replace(x, rf"[{mark}]{{2}}([^{mark}]+?){BLANK}*[{mark}]{{2}}", "$1")
    for mark in ("*", "_"):  # what stands alone is emphasis between words alone
        x = F.regexp_replace(x, rf"""(?<![^{_BLANK}("'\[])[{mark}]([^{mark}\n]+)[{mark}](?![^{_BLANK},.!?;:)"'\]])""", "$1")
    return F.when(c.rlike(r"[*_]|\A[#>+-]"), x).otherwise(c)


RULE, ORNAMENTS = "-=_~*", "•●◆◇★☆()+"


def is_separator(c: Column) -> Column:
    """A line of at least three rule marks, of three circles that rules may enclose, or of up to twelve ornaments."""
    blank = " \t\n\r\x0b\x0c"
    circles = F.translate(F.lower(F.translate(F.btrim(c, F.lit(RULE)), blank, "")), "0", "o")
    return ((F.length(c) >= 3) & (F.translate(c, RULE, "") == "")) | (circles == "ooo") | (F.length(c).between(1, 12) & (F.translate(c, ORNAMENTS + blank, "") == ""))


def word_count(c: Column) -> Column:
    """T50."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"(?U)\w+"))


def with_full_stop(c: Column) -> Column:
    """A full stop where the text ends without a mark, an ideographic one after Chinese, Japanese or Korean."""
    t = F.trim(c)
    return F.when((t == "") | t.rlike(r"[.,!?;:。，！？；：…]\z"), t).otherwise(F.concat(t, F.when(t.rlike("[㐀-鿿぀-ヿ가-힯]"), F.lit("。")).otherwise(F.lit("."))))


def language_of(c: Column) -> Column:
    """By script: Hangul, Han, Vietnamese letters, mostly ASCII."""
    n = F.length(c)
    ascii_letters = F.regexp_count(c, F.lit("[\\x00-\\x7F]"))
    return F.when(c.rlike("[가-힯]"), "ko").when(c.rlike("[一-鿿]"), "zh").when(c.rlike("[ăâđêôơưĂÂĐÊÔƠƯạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ]"), "vi").when((n > 0) & (ascii_letters / n > 0.75), "en").otherwise("unknown")


def context_of(c: Column, phrase: str, width: int = 40) -> Column:
    """Text around the first occurrence of the phrase; null without one."""
    at = F.locate(phrase, c)
    start = F.greatest(at - width, F.lit(1))
    return F.when(at > 0, F.substring(c, start, at - start + len(phrase) + width))


def first_rule(c: Column, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """The name of the first rule of which a keyword occurs in the lower-cased text."""
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit(default)
    for words, name in reversed(rules):
        out = F.when(low.rlike("|".join(re.escape(w) for w in words)), F.lit(name)).otherwise(out)
    return out


def without_cjk_spaces(c: Column) -> Column:
    """No space next to Chinese and Japanese characters, others compacted."""
    return compact(F.regexp_replace(F.regexp_replace(c, r"(?<=[一-鿿぀-ヿ])\s+", ""), r"\s+(?=[一-鿿぀-ヿ])", ""))


def without_marks(c: Column, lower: bool = True) -> Column:
    """ASCII punctuation but the apostrophe deleted, a double space once halved."""
    x = F.replace(F.regexp_replace(c, r"[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]", ""), F.lit("  "), F.lit(" "))
    return F.lower(x) if lower else x


def bounded(c: Column, surface: str) -> Column:
    """surface as a name of its own, in any case."""
    return c.rlike(rf"(?iu)(?<![\p{{L}}\p{{N}}_]){re.escape(surface)}(?![\p{{L}}\p{{N}}_])")


def joined_reduplication(c: Column) -> Column:
    """A hyphen between letters as a space."""
    return F.regexp_replace(c, r"(?<=\p{L})-(?=\p{L})", " ")



def model_output(c: Column) -> Column:
    """Without thinking blocks, code fences and a label at the start."""
    x = F.regexp_replace(c, r"(?s)<think>.*?</think>", "")
    x = F.regexp_replace(x, r"(?m)^```[a-zA-Z]*\s*$", "")
    return stripped(F.regexp_replace(stripped(x), r"(?iu)\A(?:translation|output|result)\s*:\s*", ""))


# --- sequential rewriting and packing (Arrow UDFs) ---


def replaced(rules: dict[str, str]):
    """Longest names first, at name boundaries, each rule on what the ones before left; case of the first letter is kept."""
    order = sorted(rules, key=lambda k: (-len(k), k))
    tests = [(re.compile(rf"(?<![A-Za-zÀ-ỹ0-9_]){re.escape(k)}(?![A-Za-zÀ-ỹ0-9_])", re.I), rules[k]) for k in order]

    def one(x: str) -> str:
        for pattern, to in tests:
            x = pattern.sub(lambda m, to=to: to[:1].upper() + to[1:] if m[0][:1].isupper() else to, x)
        return x

    return by_text(one)


def pack_sentences(text: str, most: int) -> list[str]:
    """Sentences joined while they fit; one that is too long stands alone."""
    out: list[str] = []
    for s in re.split(r"(?<=[.!?…。！？])\s+", text.strip()):
        if out and len(out[-1]) + 1 + len(s) <= most:
            out[-1] += " " + s
        elif s:
            out.append(s)
    return out


def sentence_chunks(most: int):
    return by_text(lambda x: pack_sentences(x, most), "array<string>")


def title_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """The larger of the Jaccard index of words and the matching-blocks ratio, at most 1."""

    def one(x, y):
        if not x or not y:
            return 0.0
        s, t = set(x.split()), set(y.split())
        return min(1.0, max(len(s & t) / max(1, len(s | t)), difflib.SequenceMatcher(None, x, y).ratio()))

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])


def title_score(a: Column, b: Column) -> Column:
    return F.pandas_udf(title_similarity, "double")(a, b)
