"""Texts as word errors are counted, by rules of their language."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _points(text: str) -> str:
    """Characters of hexadecimal code points and ranges of them."""
    out = []
    for x in text.split():
        first, _, last = x.partition("-")
        out += map(chr, range(int(first, 16), int(last or first, 16) + 1))
    return "".join(out)


# Marks that separate words. Plain ones, quotes, Armenian, Arabic, Indian, Chinese and Japanese ones, then those of a published list:
# controls, code points of private use, and marks of other scripts.
PLAIN = ".?,:!{}<>;\"¿¡"
QUOTES = _points("201C 201D 00AB 00BB 2039 203A 201E 201A 201F 201B 2019 2018")
BY_SCRIPT = _points("055A-055F 0589 060C 061B 061F 0964 3002 FF0C FF01 FF1F FF1B FF1A FF08 FF09 300C-300F FF41-FF44 3008-300B FE4F 22EF 3001 2027 FF0F FF5E 2500 FF3F")
LISTED = _points("""
    0008 001A 0081 008D 008F 0090 0092 0093 0094 009D
    E003 E013 E01D E040 E041 E043 E06B E06D E070 E203 E231 E232 E233 E234 E236 E290-E296 E2D9 E2DB E2DE E2F9-E2FC E2FE E313 E328-E32E E492 E493 E514 E516 E517 E518 EA01 EA7B
    F171 F172 F173 F218 F21D F50E F50F F511 F513 F518 F519 F521 F522 F523 F529 F52D F62D F7D0 F7E8
    206F 2060 2015 05BE 0029 005D 230B 3015 3011 FD3E 0026 0F0D 1362 1365 0F0C 104B 002F 104A 00B7 2038 002A 06D4 1364 104F 17D4 A4FE 166E A92F 2D70 A4FF 0965 061E 104D 0387 2020
    104C 1363 17D6 A92E 203B 1366 2022 00B6 104E FE56 037E 2026 0025 30FB 0F0E 2021 0023 0040 1361 17DA 17D5 FE50 0F05 0F04 FF0E FE57 FE55 2030 FF65 0028 005B 230A 3014 3010 FD3F
    005F 0024 20AC 00A3 007E 003D 007C 2212 226B 226A 002B FF1C FF1E 00AC 00D7 2192 166D 00B0 109F FFFD 231F 231E 00A9 202F 2006 02DC 005E 00AF 02C7 207F 0640 0E46 17D7 3005 0EC6
    30FC 2071 09F7 2153 00BD 00BC 215F 2044
""")
# Characters that are left out, digits, entities that are left out, letters that stand for others, quotes inside words.
DELETED = _points("200E 200C 0656 0657 200B 064B-0652 202C 200F 202A")
DIGITS = _points("0030-0039 09E6-09EF 17E0-17E9 0966-096F 0B66-0B6F 06F0-06F9 A900-A909 FF10-FF19 0D66-0D6F 1040-1049 2170-2179 206F")
ENTITIES, LETTERS = ("&lt;", "&gt;", "&nbsp"), {"ٱ": "ا"}
INNER = "‛’‘"


@dataclass(frozen=True)
class Rules:
    """What a language has besides the rules of all: further characters left out, further marks, and whether to end in ASCII."""

    deleted: str = ""
    marks: str = ""
    ascii: bool = False


# Languages with rules of their own.
LANGUAGES = {
    "mon": Rules(deleted=_points("00AD")), "khk": Rules(deleted=_points("00AD")), "heb": Rules(deleted=_points("05B0-05CF")),
    "tha": Rules(marks=_points("200D")), "jav": Rules(ascii=True),
}


def _form(form: str, ascii_only: bool = False):
    """A normal form of Unicode, which Spark has no function for."""

    @F.pandas_udf(T.StringType())
    def normal(v: pd.Series) -> pd.Series:
        def one(x: str) -> str:
            y = unicodedata.normalize(form, x)
            return y.encode("ascii", "ignore").decode() if ascii_only else y

        return v.map(one, na_action="ignore")

    return normal


def _among(language: Column, names: list[str]) -> Column:
    return F.coalesce(language.isin(*names), F.lit(False)) if names else F.lit(False)


def word_text(text: Column, language: Column, *, lower: bool = True, without_numbers: bool = True, without_brackets: bool = False, rules: dict[str, Rules] = LANGUAGES) -> Column:
    """The text in compatibility form and lower case, without brackets that hold digits, marks, and words of digits alone; single spaces.

    Marks become spaces, deleted characters nothing. Of quotes inside a word the last becomes an apostrophe. A text that is one number
    stays. Languages without rules of their own, and a null language, have those of all; a null text stays null. Languages that end in
    ASCII lose what has no ASCII in its compatibility decomposition, rather than being spelled out letter by letter.
    """
    x = _form("NFKC")(text)
    x = F.lower(x) if lower else x
    x = F.regexp_replace(x, r"(?U)\([^)]*\d[^)]*\)", " ")
    x = F.regexp_replace(x, r"\([^)]*\)", " ") if without_brackets else x
    x = F.regexp_replace(x, "|".join(ENTITIES), "")
    x = F.regexp_replace(x, rf"(?U)(?<=\S)[{INNER}](?=\S)(?!\S*[{INNER}]\S)", "'")
    x = F.translate(x, "".join(LETTERS), "".join(LETTERS.values()))
    marks = PLAIN + QUOTES + BY_SCRIPT + LISTED
    x = F.translate(x, marks + DELETED, " " * len(marks))
    for names, at, to in ((lambda r: r.marks, "marks", " "), (lambda r: r.deleted, "deleted", "")):
        for chars in dict.fromkeys(filter(None, map(names, rules.values()))):
            x = F.when(_among(language, [k for k, r in rules.items() if getattr(r, at) == chars]), F.translate(x, chars, to * len(chars))).otherwise(x)
    if without_numbers:
        x = F.regexp_replace(x, rf"(?U)(?<=\s)[{DIGITS}]+(?=\s|\z)|\A[{DIGITS}]+(?=\s)", " ")
    plain = [k for k, r in rules.items() if r.ascii]
    if plain:
        x = F.when(_among(language, plain), _form("NFKD", True)(x)).otherwise(x)
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))
