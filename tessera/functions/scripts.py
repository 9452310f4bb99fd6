"""How long a text takes to say, from the scripts of its characters (X8). All of it is counting characters in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a character of a script weighs, a Latin letter being 1; the last code point of each run of a script, in order.
WEIGHTS = {
    "cjk": 3.0, "ethiopic": 3.0, "yi": 3.0, "hangul": 2.5, "kana": 2.2, "indic": 1.8, "khmer_myanmar": 1.8, "thai_lao": 1.5, "arabic": 1.5, "hebrew": 1.5,
    "latin": 1.0, "greek": 1.0, "cyrillic": 1.0, "armenian": 1.0, "georgian": 1.0, "default": 1.0,
}
RUNS = """
    latin 02AF, greek 03FF, cyrillic 052F, armenian 058F, hebrew 05FF, arabic 08FF, indic 0DFF, thai_lao 0EFF, indic 0FFF, khmer_myanmar 109F, georgian 10FF, hangul 11FF, ethiopic 139F,
    default 177F, khmer_myanmar 17FF, default 18FF, indic 19DF, khmer_myanmar 19FF, indic 1C7F, cyrillic 1C8F, georgian 1CBF, indic 1CFF, latin 1DBF, default 1DFF, latin 1EFF, kana 30FF,
    cjk 312F, hangul 318F, cjk 9FFF, yi A4CF, default A63F, cyrillic A69F, default A6FF, latin A7FF, indic A82F, default A87F, indic A95F, hangul A97F, indic A9DF, khmer_myanmar A9FF,
    indic AA5F, khmer_myanmar AA7F, indic AAFF, ethiopic AB2F, latin AB6F, default ABBF, indic ABFF, hangul D7AF, cjk FAFF, arabic FDFF, default FE6F, arabic FEFF, latin FFEF,
    default 20000, cjk 10FFFF
"""
# What characters of other kinds weigh, whatever their script.
SPACE, MARK, PUNCTUATION, DIGIT = 0.2, 0.0, 0.5, 3.5
#: Regular expressions of those kinds; the Arabic stretching line is silent as marks are.
KINDS = {r"[\p{Z}]": SPACE, r"[\p{M}\x{0640}]": MARK, r"[\p{P}\p{S}]": PUNCTUATION, r"[\p{N}]": DIGIT}
LOW, BOOST = 50.0, 3.0


def ranges() -> list[tuple[int, int, str]]:
    """(first, last, script) of every run."""
    out, first = [], 0
    for name, last in (x.split() for x in RUNS.split(",")):
        out.append((first, int(last, 16), name))
        first = out[-1][1] + 1
    return out


def classes() -> dict[float, str]:
    """For each weight but 1 the characters that weigh it, as a regular expression."""
    out: dict[float, str] = dict.fromkeys({w for w in WEIGHTS.values() if w != 1.0}, "")
    for first, last, name in ranges():
        if (w := WEIGHTS[name]) in out:
            out[w] += rf"\x{{{first:X}}}-\x{{{last:X}}}"
    return {w: rf"[{x}&&[^\p{{Z}}\p{{M}}\p{{P}}\p{{S}}\p{{N}}\x{{0640}}]]" for w, x in out.items()}


def weight(text: Column) -> Column:
    """The sum over all characters of what they weigh; those of no class weigh 1. A null weighs nothing."""
    of = {**{x: w for w, x in classes().items()}, **KINDS}
    parts = [(F.regexp_count(text, F.lit(x)), w) for x, w in sorted(of.items())]
    return F.coalesce(reduce(lambda a, b: a + b, [n * (w - 1.0) for n, w in parts], F.length(text).cast("double")), F.lit(0.0))


def duration(text: Column, spoken: Column, seconds: Column, *, low: float | None = LOW, boost: float = BOOST) -> Column:
    """How long text takes if `spoken` took `seconds`; 0 where that tells nothing. Below `low` it is low * (d / low) ** (1 / boost); low may be None."""
    d = weight(text) * seconds / weight(spoken)
    if low is not None:
        d = F.when(d < low, low * F.pow(d / low, F.lit(1.0 / boost))).otherwise(d)
    return F.when((F.coalesce(seconds, F.lit(0.0)) <= 0) | (weight(spoken) == 0), 0.0).otherwise(d)
