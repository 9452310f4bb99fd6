"""Texts by rules of their language, and how long they take to say, against walks over their characters."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import normal, scripts

ODD = "aZé .,!?:;'\"’‘‛“”()[]{}<>-–…0123٣५٠ⅷ²½ \t\n ​‍­ְًٱا漢字かカ한ไทยДжΩאﬁ％（）、。ʼ%&/_|＄€"


def walk(text, language):
    """The rules one after the other, by characters and words."""
    rules = normal.LANGUAGES.get(language, normal.Rules())
    x = re.sub(r"\([^)]*\d[^)]*\)", " ", unicodedata.normalize("NFKC", text).lower())
    for e in normal.ENTITIES:
        x = x.replace(e, "")
    words = []
    for w in re.split(r"(\s+)", x):
        at = [i for i, c in enumerate(w) if c in normal.INNER and 0 < i < len(w) - 1]
        words.append(w[: at[-1]] + "'" + w[at[-1] + 1 :] if at else w)
    out = []
    for c in "".join(words):
        c = normal.LETTERS.get(c, c)
        if c in normal.PLAIN + normal.QUOTES + normal.BY_SCRIPT + normal.LISTED + rules.marks:
            out.append(" ")
        elif c not in normal.DELETED + rules.deleted:
            out.append(c)
    x = "".join(out)
    alone = x and all(c in normal.DIGITS for c in x)
    ws = [w for w in re.split(r"\s+", x) if w and (alone or not all(c in normal.DIGITS for c in w))]
    return " ".join(ws)


def test_word_text(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    texts += ["(Sam 23:17) It’s a&nbsp;test, No. 5!", "12", "12 ", " 12 a", "a’b’c ‘d’", "don’t (ok) &lt;b&gt;", "", "a (b) 7 8"]
    languages = ["eng", "mon", "heb", "tha", "ara", None]
    rows = [(i, t, languages[i % 6]) for i, t in enumerate(texts)] + [(10_000, None, "eng")]
    got = {r.i: r.v for r in spark.createDataFrame(rows, "i int, t string, l string").select("i", normal.word_text(F.col("t"), F.col("l")).alias("v")).collect()}
    assert got.pop(10_000) is None
    for i, t, language in rows[:-1]:
        assert got[i] == walk(t, language), (t, language)


def test_word_text_choices(spark):
    d = spark.createDataFrame([("Ä (b) 5 x", "jav"), ("Ä (b) 5 x", "eng")], "t string, l string")
    at = lambda **o: [r.v for r in d.select(normal.word_text(F.col("t"), F.col("l"), **o).alias("v")).collect()]
    assert at() == ["a b x", "ä b x"] and at(lower=False, without_numbers=False, without_brackets=True) == ["A 5 x", "Ä 5 x"]


def weigh(text):
    total = 0.0
    for c in text:
        kind = unicodedata.category(c)
        if c == "ـ" or kind[0] == "M":
            w = scripts.MARK
        elif kind[0] in "PS":
            w = scripts.PUNCTUATION
        elif kind[0] == "Z":
            w = scripts.SPACE
        elif kind[0] == "N":
            w = scripts.DIGIT
        else:
            w = next(scripts.WEIGHTS[s] for a, b, s in scripts.ranges() if a <= ord(c) <= b)
        total += w
    return total


def test_weights(spark):
    rng = random.Random(2)
    # what Unicode 3.2 knew already, as Java's tables are older than Python's
    points = [c for c in map(chr, range(0x20, 0x2FA20)) if unicodedata.category(c) not in ("Cn", "Cs", "Co") and unicodedata.category(c) == unicodedata.ucd_3_2_0.category(c)]
    texts = ["".join(rng.choice(points) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["Hello, world.", "", "ـ́"]
    got = [r.w for r in spark.createDataFrame([(t,) for t in texts], "t string").select(scripts.weight(F.col("t")).alias("w")).collect()]
    assert got == pytest.approx([weigh(t) for t in texts])


def test_duration(spark):
    rows = [("a" * 10, "b" * 5, 2.0), ("a" * 1000, "b" * 5, 2.0), ("x", "", 1.0), ("x", None, 1.0), ("x", "y", 0.0), ("x", "y", None), ("", "y", 1.0), (None, "y", 1.0), ("x", "́", 1.0)]
    d = spark.createDataFrame(rows, "t string, r string, s double")
    want = [50 * (4 / 50) ** (1 / 3), 400, 0, 0, 0, 0, 0, 0, 0]
    assert [r.v for r in d.select(scripts.duration(F.col("t"), F.col("r"), F.col("s")).alias("v")).collect()] == pytest.approx(want)
    assert d.select(scripts.duration(F.col("t"), F.col("r"), F.col("s"), low=None).alias("v")).first().v == pytest.approx(4)
