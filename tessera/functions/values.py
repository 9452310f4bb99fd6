"""Numbers, hashes, JSON, arrays and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_before(as_of: Column, minutes: Column | int) -> Column:
    """The clock is a parameter, so a query gives the same rows when run again."""
    return as_of - F.make_interval(mins=F.lit(minutes) if isinstance(minutes, int) else minutes)


def backoff(failures: Column, base: float, cap: float) -> Column:
    """base doubled for each failure after the first, at most cap."""
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), F.greatest(failures, F.lit(1)) - 1))


def hash_sampled(seed: str, key: Column, k: int) -> Column:
    """One in k, by a hash of seed and key: none for k <= 0, all for 1."""
    if k <= 1:
        return F.lit(k == 1)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("long") % k == 0


def text_hash(c: Column, digits: int = 16) -> Column:
    """X6."""
    return F.substring(F.sha2(c, 256), 1, digits)


def hashed_window(text: Column, seed: Column, width: int) -> Column:
    """A window of the text at a place that a hash of the seed gives."""
    span = F.greatest(F.length(text) - width, F.lit(0))
    at = F.conv(F.substring(F.sha2(seed, 256), 1, 8), 16, 10).cast("long") % (span + 1)
    return F.substring(text, at.cast("int") + 1, F.lit(width))


def duration_bounds(words: Column) -> tuple[Column, Column]:
    """Least and most seconds of a reading."""
    return words * 0.18, words * 0.32 * 2.2


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm, cut off."""
    ms = F.floor(seconds * 1000).cast("long")
    part = lambda by, mod, n: F.lpad((F.floor(ms / by) % mod).cast("string"), n, "0")
    return F.concat(part(3_600_000, 1_000_000, 2), F.lit(":"), part(60_000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit(","), part(1, 1000, 3))


def cosine(a: Column, b: Column) -> Column:
    """X12; in double precision."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    return dot / (norm(a) * norm(b))


def length_ratio(a: Column, b: Column) -> Column:
    """Of lengths without white space."""
    size = lambda c: F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", ""))
    return size(a) / F.nullif(size(b), F.lit(0))


def rounded(c: Column, digits: int) -> Column:
    """A number of at least 0, halves upwards, as DuckDB's round() does: by the product, so 0.575 gives 0.57, as 0.575 * 100 is below 57.5."""
    x = c * 10.0**digits
    return (F.floor(x) + F.when(x - F.floor(x) >= 0.5, 1).otherwise(0)) / 10.0**digits


# --- JSON and maps ---


def json_text(c: Column, key: str) -> Column:
    """N1."""
    return F.get_json_object(c, f"$.{key}")


def json_merge(old: Column, new: Column) -> Column:
    """Shallow; the right side wins."""
    empty = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(old, empty), F.coalesce(new, empty)
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)


def json_without(c: Column, keys: Sequence[str]) -> Column:
    """N3."""
    return F.map_filter(c, lambda k, v: ~k.isin(*keys))


def issue_codes(c: Column) -> Column:
    """A JSON list of strings or of objects with code, as strings."""
    plain = F.from_json(c, "array<string>")
    return F.filter(F.transform(plain, lambda x: F.coalesce(F.get_json_object(x, "$.code"), x)), lambda x: x.isNotNull() & (x != ""))


def json_in_text(c: Column) -> Column:
    """From the first opening to the last closing brace."""
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))


def padded(c: Column, size: Column | int, value) -> Column:
    """N14."""
    n = F.lit(size) if isinstance(size, int) else size
    return F.slice(F.concat(c, F.array_repeat(F.lit(value), F.greatest(n - F.size(c), F.lit(0)))), F.lit(1), n)


def jaccard(a: Column, b: Column) -> Column:
    """U5; 0 for two empty sets."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))
