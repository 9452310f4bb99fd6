"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests finds random.

A candidate is a run of at least SHORTEST characters of an encoding's alphabet. Its encoding is the smallest of hex, capitals,
base32, small letters, letters and digits, base64, URL-safe base64 and the two together that holds it. Three tests ask whether it
could be uniform noise: chi-squared of its characters over the alphabet, runs of characters of one class, and serial
correlation of neighbours. Fisher's sum joins their p-values; small sums look random.

How small a sum a token of language reaches by chance depends on its alphabet and length. So a fixed model of language
tokens, words of several languages joined with capitals, digits and marks, gives the distribution of the sum for each
alphabet and length class, and hence each candidate's p-value, whatever the size of the corpus. Its lower tail is carried on as
log-normal. For each alphabet, Benjamini and Hochberg's rule over all candidates of the corpus then bounds the share of false
discoveries, as far as the corpus's language looks no more random than the model's. Digits alone are numbers, which are
as random as keys, and aren't tested. Counts are in a fixed number of cells, gathered over all documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import tune

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")
SHORTEST = 16
#: A whole run of the alphabets, with '=' as padding at its end only, so a value may directly follow 'NAME='.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
#: Cells of the sum of Fisher, and the share of false discoveries.
CELLS, CELL_WIDTH, RATE = 64, 1.0, 0.01
_HEX_CHARS = str.maketrans({c: "x" for c in "0123456789abcdef"})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


ALPHABETS = {
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "alnum_lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64_url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "base64_any": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
_SETS = {k: frozenset(v) for k, v in ALPHABETS.items()}
_NUMBER = {k: i for i, k in enumerate(ALPHABETS)}
_PLACE = {k: {c: i for i, c in enumerate(v)} for k, v in ALPHABETS.items()}


def encoding(token: str) -> str | None:
    """The first alphabet that holds the token; None for digits alone, which are numbers."""
    if token.isdigit():
        return None
    have = set(token.rstrip("="))
    return next((k for k, v in _SETS.items() if have <= v), None)


def _chi2_tail(x: float, dof: int) -> float:
    """Wilson and Hilferty's approximation of the upper tail."""
    if x <= 0:
        return 1.0
    z = ((x / dof) ** (1 / 3) - (1 - 2 / (9 * dof))) / math.sqrt(2 / (9 * dof))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _classes(kind: str) -> np.ndarray:
    """For each character of an alphabet its class: digit, mark, letter, small letter beside capitals; where there are but letters, vowel or consonant."""
    letters = ALPHABETS[kind]
    alone = letters.isalpha()
    of = [0 if c.isdigit() else 1 if not c.isalpha() else 2 + (c.lower() in VOWELS) if alone else 4 + c.islower() for c in letters]
    return np.unique(of, return_inverse=True)[1]


def _values(kind: str) -> np.ndarray:
    """For each character what serial correlation is taken of: vowel or not, NaN for a digit, where letters of one case stand beside digits; else its place."""
    letters = ALPHABETS[kind]
    if kind in ("base32", "alnum_lower"):
        return np.array([np.nan if c.isdigit() else float(c.lower() in VOWELS) for c in letters])
    return np.arange(len(letters), dtype=float)


VOWELS = "aeiouy"
_CLASS, _VALUE = {k: _classes(k) for k in ALPHABETS}, {k: _values(k) for k in ALPHABETS}


def battery(v: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """p-values of uniformity, runs and serial correlation, of uniform noise over the alphabet. v: a token's places in it a row, all of one length.

    Runs are of characters of one class, tested to one side: words that are joined change far more seldom between digits,
    marks and cases than noise does, and more often between vowels and consonants.
    """
    m, n = v.shape
    size = len(ALPHABETS[kind])
    erfc = np.vectorize(math.erfc, otypes=[float])
    counts = np.bincount((np.arange(m)[:, None] * size + v).ravel(), minlength=m * size).reshape(m, size)
    uniform = np.array([_chi2_tail(float(x), size - 1) for x in ((counts - n / size) ** 2).sum(1) * size / n])
    of = _CLASS[kind]
    share = np.bincount(of) / size
    change, twice = float(1 - (share**2).sum()), float((share * (1 - share) ** 2).sum())
    c = of[v]
    changes = (c[:, 1:] != c[:, :-1]).sum(1)
    var = (n - 1) * change * (1 - change) + 2 * (n - 2) * (twice - change * change)
    side = 1.0 if ALPHABETS[kind].isalpha() and len(share) == 2 else -1.0
    run_p = 0.5 * erfc(side * (changes - (n - 1) * change) / math.sqrt(2 * max(var, 1e-9)))
    x = _VALUE[kind][v]
    used = ~np.isnan(x)
    many = np.maximum(used.sum(1), 1)
    d = np.where(used, np.nan_to_num(x) - (np.nan_to_num(x).sum(1) / many)[:, None], 0.0)
    spread = (d * d).sum(1)
    serial = np.where(spread > 0, (d[:, 1:] * d[:, :-1]).sum(1) / np.where(spread > 0, spread, 1), 1.0)
    return uniform, run_p, erfc(np.abs(serial + 1 / many) * np.sqrt(many / 2))


def fishers(v: np.ndarray, kind: str) -> np.ndarray:
    """Sums of Fisher, small where a token looks random."""
    return -2 * sum(np.log(np.maximum(p, 1e-12)) for p in battery(v, kind))


def fisher(token: str, kind: str) -> float:
    place = _PLACE[kind]
    return float(fishers(np.array([[place[c] for c in token.rstrip("=")]]), kind)[0])


#: Words that the fixed language model joins: frequent ones of several languages and some of programs.
_WORDS = """the of and to in that for with are this from have not which their there were would about other into time only could these
people first after should through where before between because different number system world house program function value index error
message request response user account service file path name data table column list string object class type test build version config
server client public private default update delete create select image page article section category product order customer report
der die und den von das mit sich des auf für ist nicht auch eine werden aus haben sind nach oder zeit über wenn noch schaft heit keit arbeit
les des une est que dans pour qui sur pas plus avec sont par mais comme tout nous leur bien entre aussi sans temps ment tion
los las por con para una del como pero sus este entre cuando muy sin sobre tambien hasta donde todo desde ción mente dad"""
LANGUAGE = tuple(w for w in _WORDS.split() if w.isascii())
_HEX_WORDS = ("face", "dead", "beef", "cafe", "bad", "feed", "added", "decade", "fade", "ace", "deed", "bead", "a", "b", "c", "d", "e", "f")
STREAM, DRAWS, LONGEST = 400_000, 4000, 200


@lru_cache(maxsize=None)
def language(kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A fixed stream of language as tokens of this alphabet hold it, as places; where its pieces start; and, for each smaller alphabet, whether it holds the character."""
    rng, out, starts, at = Random(kind), [], [], 0
    letters = ALPHABETS[kind]
    digits = [c for c in letters if c.isdigit()]
    marks = [c for c in letters if not c.isalnum()]
    while at < STREAM:
        if digits and rng.random() < (0.5 if kind.startswith("hex") else 0.25):
            w = "".join(rng.choice(digits) for _ in range(rng.randint(1, 8)))
        else:
            w = rng.choice(_HEX_WORDS if kind.startswith("hex") else LANGUAGE)
            if "a" not in letters or kind in ("alnum", "base64", "base64_url", "base64_any") and rng.random() < 0.1:
                w = w.upper()
            elif "A" in letters and rng.random() < 0.7:
                w = w.capitalize()
        if marks and rng.random() < 0.8:
            w += rng.choice(marks)
        out.append(w)
        starts.append(at)
        at += len(w)
    text = "".join(out)
    smaller = list(ALPHABETS)[: list(ALPHABETS).index(kind)]
    within = np.array([[c in _SETS[k] for c in text] for k in smaller], bool).reshape(len(smaller), len(text))
    return np.array([_PLACE[kind][c] for c in text]), np.array(starts), within


@lru_cache(maxsize=None)
def language_sums(kind: str, n: int) -> np.ndarray:
    """Sorted sums of Fisher of the fixed model's tokens of n characters that need this alphabet."""
    places, starts, within = language(kind)
    starts = starts[starts <= len(places) - n]
    for row in within:
        held = np.concatenate([[0], np.cumsum(row)])
        starts = starts[held[starts + n] - held[starts] < n]
    starts = starts[:: max(1, len(starts) // DRAWS)]
    return np.sort(fishers(places[starts[:, None] + np.arange(n)], kind))


def length_class(n: int) -> int:
    """Single lengths to 40, then steps of a quarter more."""
    return n if n <= 40 else 40 + int(math.log(n / 40) / math.log(1.25)) + 1


def shortest_of(length: int) -> int:
    """The least number of characters of a length class, LONGEST at most: longer language looks less random, so p is too large at most."""
    return length if length <= 40 else next(n for n in range(40, LONGEST + 1) if length_class(n) == length or n == LONGEST)


@lru_cache(maxsize=None)
def language_tail(kind: str, length: int) -> tuple[float, ...]:
    """p-values of the cells of the sum: the model's share of sums below a cell's end, or the tail of a log-normal, whichever is larger."""
    x = language_sums(kind, shortest_of(length))
    if not len(x):
        return (1.0,) * CELLS
    middle = math.log(max(x[len(x) // 2], 1e-9))
    # as wide as the widest of three quantiles asks, so that the tail isn't too light
    width = max(1e-6, *((middle - math.log(max(x[int(len(x) * q)], 1e-9))) / z for q, z in ((0.1, 1.2816), (0.01, 2.3263), (0.002, 2.8782))))
    ends = [CELL_WIDTH * (c + 1) for c in range(CELLS - 1)]
    return (*(max(float(np.searchsorted(x, e)) / len(x), 0.5 * math.erfc((middle - math.log(e)) / width / math.sqrt(2))) for e in ends), 1.0)


@lru_cache(maxsize=50_000)
def judged(token: str) -> tuple[int, int, int] | None:
    """(number of the alphabet, length class, cell of the sum), or None for what is no candidate."""
    kind = encoding(token)
    if kind is None:
        return None
    return _NUMBER[kind], length_class(len(token.rstrip("="))), min(CELLS - 1, int(fisher(token, kind) / CELL_WIDTH))


def within(start: int, end: int, base: list[tuple[int, int, int]]) -> bool:
    """In a span of a fixed pattern as a whole; such tokens aren't tested."""
    return any(x <= start and end <= y for x, _, y in base)


def candidates(text: str) -> list[tuple[int, int, tuple[int, int, int]]]:
    return [(m.start(), m.end(), j) for m in CANDIDATE.finditer(text) if (j := judged(m[0]))]


def cells(docs: DataFrame) -> DataFrame:
    """Counts over all documents: alphabet, length, cell, n."""

    def run(batches):
        for b in batches:
            count: dict[tuple, int] = {}
            for text in b.column(0).to_pylist():
                if text:
                    base = base_spans(text)
                    for s, e, j in candidates(text):
                        if not within(s, e, base):
                            count[j] = count.get(j, 0) + 1
            rows = [(*j, n) for j, n in count.items()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:3]), pa.array(cols[3], pa.int64())], ["alphabet", "length", "cell", "n"])

    got = docs.select(F.col("text").cast("string")).mapInArrow(run, "alphabet int, length int, cell int, n long")
    return got.groupBy("alphabet", "length", "cell").agg(F.sum("n").alias("n"))


def accepted(counts: list[tuple[int, int, int, int]], rate: float = RATE) -> frozenset[tuple[int, int, int]]:
    """The (alphabet, length class, cell) of candidates that the rule finds random, for each alphabet by itself. counts: rows of cells()."""
    names, out = list(ALPHABETS), set()
    for k in {c[0] for c in counts}:
        tests = sorted((language_tail(names[k], length)[cell], length, cell, n) for a, length, cell, n in counts if a == k)
        total, seen, last = sum(t[3] for t in tests), 0, -1
        for i, t in enumerate(tests):
            seen += t[3]
            if t[0] <= rate * seen / total:
                last = i
        out.update((k, length, cell) for _, length, cell, _ in tests[: last + 1])
    return frozenset(out)


def calibrated(docs: DataFrame, rate: float = RATE) -> frozenset[tuple[int, int, int]]:
    tune(docs.sparkSession)
    return accepted([tuple(r) for r in cells(docs).collect()], rate)  # a bounded number of cells


def spans(text: str, random: frozenset[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the fixed patterns, and of all kinds; a found token that goes beyond a fixed one adds its whole span."""
    base = base_spans(text)
    if not random:
        return base, base
    more = [(s, 3, e) for s, e, j in candidates(text) if j in random and not within(s, e, base)]
    return base, sorted(base + more)


def shown(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def scan(docs: DataFrame, *, rate: float = RATE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans for every document.

    Spans are in code points, the end exclusive. A null text is empty; null and repeated doc_ids are scanned as rows of
    their own; other columns are ignored; an empty table gives an empty one.
    """
    random = calibrated(docs, rate)

    def run(batches):
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                base, found = spans(text or "", random)
                out.append((doc, *(sum(k == x for _, k, _ in found) for x in range(4)), hashlib.sha256(shown(base).encode()).hexdigest(), shown(found)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in cols[5:])], ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def redacted(text: str, found: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """text with every span, overlapping ones as one, replaced by mark."""
    out, at = [], 0
    for s, _, e in found:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, *, rate: float = RATE) -> DataFrame:
    """docs with secrets in text replaced; n_chars, where there is one, follows; all else stays.

    Null and empty texts stay as they are, repeated rows are treated alike, null ids don't matter; an empty table gives an
    empty one; further columns may have any name.
    """
    random = calibrated(docs, rate)
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            new = [redacted(t, spans(t, random)[1]) if t else t for t in texts]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if chars is not None:
                old = b.column(chars).to_pylist()
                cols[chars] = pa.array([o if n == t else len(n) for n, t, o in zip(new, texts, old, strict=True)], b.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return docs.mapInArrow(run, docs.schema)
