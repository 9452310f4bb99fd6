"""Filters, joins, aggregates, windows and orders as functions from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- filters ---


def all_of(conditions: Iterable[Column | None]) -> Column:
    """The conjunction of those that are given; true for none."""
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def contains_any_case(columns: Sequence[str], part: str | None) -> Column | None:
    """part within any of the columns, in any case; None without a part."""
    return any_of([F.col(c).ilike(f"%{part}%") for c in columns]) if part else None


def one_of(column: str, values: Sequence | None) -> Column | None:
    """column among values; no filter where values is None or empty."""
    return F.col(column).isin(*values) if values else None


def between(column: str, low=None, high=None, equal=None) -> Column:
    """Optional bounds, both included, and an optional exact value."""
    c = F.col(column)
    return all_of([c == equal if equal is not None else None, c >= low if low is not None else None, c <= high if high is not None else None])


def half_open(column: str, low, high) -> Column:
    """low <= column < high."""
    return (F.col(column) >= low) & (F.col(column) < high)


def closed(column: str, low, high) -> Column:
    """low <= column <= high."""
    return F.col(column).between(low, high)


def any_present(*columns: str) -> Column:
    """At least one of the columns isn't null."""
    return F.coalesce(*columns).isNotNull()


def effective(first: str, second: str) -> Column:
    """first unless null or empty, else second, else empty (P5)."""
    return F.coalesce(F.nullif(F.col(first), F.lit("")), F.col(second), F.lit(""))


def like_any(column: str, parts: Sequence[str]) -> Column:
    """Any of the parts within column, in any case: one pass with an alternation."""
    import re

    return F.col(column).rlike("(?iu)" + "|".join(re.escape(p) for p in parts))


def longer_than(column: str, n: int) -> Column:
    """Null counts as empty."""
    return F.length(F.coalesce(column, F.lit(""))) > n


def first_reason(rules: Sequence[tuple[Column, bool, str]]) -> Column:
    """(condition, keep, reason) in order: the first that holds decides."""
    out = F.lit(None)
    for cond, keep, why in reversed(rules):
        out = F.when(cond, F.struct(F.lit(keep).alias("needed"), F.lit(why).alias("reason"))).otherwise(out)
    return out


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """The words that occur in the lower-cased text, in given order."""
    low = F.lower(text)
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))


def word_excluded(text: Column, words: Sequence[str]) -> Column:
    """Short ASCII words must stand alone, others may be part of a word."""
    import re

    tests = [F.lower(text).rlike(rf"\b{re.escape(w)}\b") if len(w) <= 3 and w.isascii() else F.contains(F.lower(text), F.lit(w)) for w in words]
    return any_of(tests)


def weighted_score(rules: Sequence[tuple[Column, int]]) -> Column:
    """Sum of the weights of conditions that hold."""
    return reduce(lambda a, b: a + b, [F.when(c, w).otherwise(0) for c, w in rules], F.lit(0))


def sample_filter(frames: Column, tokens: Column, *, frames_in=(10, 10240), tokens_in=(1, 200), ratio_in=(0.0005, 1.0)) -> Column:
    """Lengths within bands, and tokens for each frame too."""
    ratio = tokens / frames
    return frames.between(*frames_in) & tokens.between(*tokens_in) & (frames != 0) & (ratio >= ratio_in[0]) & (ratio <= ratio_in[1])


def bad_name(column: str, denied: Sequence[str]) -> Column:
    """Null, blank, denied, a single character or marks alone."""
    v = F.trim(F.coalesce(column, F.lit("")))
    return (F.length(v) <= 1) | F.lower(v).isin(*denied) | v.rlike(r"(?U)^[^\w]+$")


# --- joins ---


def lookup(df: DataFrame, dimension: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A foreign-key join; Spark broadcasts the dimension only while its size is under the session's bound."""
    return df.join(dimension, on, how)


def counted(left: DataFrame, right: DataFrame, on: str, name: str, where: Column | None = None) -> DataFrame:
    """left with the number of its right rows, 0 for none; counted before joining, so nothing fans out."""
    r = right if where is None else right.where(where)
    return left.join(r.groupBy(on).agg(F.count("*").alias(name)), on, "left").fillna(0, [name])


def tail(df: DataFrame, group: str, number: str, last: int) -> DataFrame:
    """Rows of each group from max - last, 1 at least."""
    top = F.max(number).over(Window.partitionBy(group))
    return df.withColumn("_top", top).where(F.col(number) >= F.greatest(F.col("_top") - last, F.lit(1))).drop("_top")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once; keys are grouped first and joined back, so a hot key is split."""
    many = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return df.join(many, keys, "left_semi")


def unseen(df: DataFrame, seen: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key isn't in seen."""
    return df.join(seen.select(*on), on, "left_anti")


def match_by_any_key(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str, str]], least: int = 1) -> DataFrame:
    """For each left row the right row that it matches by the first of several keys, the smallest of those.

    keys: (left column, right column, name). Keys shorter than `least` don't count. left has `lid`, right `rid`. Right keys
    are brought to their smallest row before the equi-joins, so a hot key adds one row for each left row, not a product.
    """
    out = None
    for rank, (a, b, name) in enumerate(keys):
        x = left.select("lid", F.col(a).alias("k")).where(F.length("k") >= least)
        y = right.select("rid", F.col(b).alias("k")).where(F.length("k") >= least).groupBy("k").agg(F.min("rid").alias("rid"))
        part = x.join(y, "k").select("lid", "rid", F.lit(rank).alias("rank"), F.lit(name).alias("key"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("lid").agg(F.min(F.struct("rank", "rid", "key")).alias("best")).select("lid", "best.rid", "best.key")


# --- aggregates ---


def grouped_filter_having(df: DataFrame, by: str, aggregates: dict[str, Column], having: Column, limit: int = 0, order: Sequence[Column] = ()) -> DataFrame:
    """Conditional aggregates for each group, kept by a condition on them, the first `limit` in order (A3, A5)."""
    out = df.groupBy(by).agg(*[c.alias(n) for n, c in aggregates.items()]).where(having)
    return limited(out.orderBy(*order) if order else out, limit)


def limited(df: DataFrame, n: int) -> DataFrame:
    """The first n rows; all for 0."""
    return df.limit(n) if n > 0 else df


def winner(df: DataFrame, by: list[str], rank: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The row of each group with the largest tuple of rank columns."""
    return df.groupBy(*by).agg(F.max_by(F.struct(*columns), F.struct(*rank)).alias("w")).select(*by, "w.*")


def first_of_each(df: DataFrame, keys: list[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the first in order."""
    return capped(df, keys, order, 1)


def capped(df: DataFrame, keys: list[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each key (A14, A29); Spark limits groups before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def duplicate_groups(df: DataFrame, ids: str, source: str, strong: Sequence[str], weak: str, strong_length: int = 10, weak_length: int = 6) -> DataFrame:
    """Ids that share a key across at least two sources, a row for each: weak, key, id, sources (A10).

    Groups of the same ids count once, by a strong key before a weak one; sets are compared by size and sums of hashes, so no
    list of a key's ids is made. Not transitive: a group is the ids of one key.
    """
    keys = [F.struct(F.lit(0).alias("weak"), F.when(F.length(c) >= strong_length, F.col(c)).alias("key")) for c in strong]
    keys.append(F.struct(F.lit(1).alias("weak"), F.when(F.length(weak) >= weak_length, F.col(weak)).alias("key")))
    e = df.select(F.col(ids).alias("id"), F.col(source).alias("source"), F.explode(F.array(*keys)).alias("k")).select("id", "source", "k.weak", "k.key").where("key IS NOT NULL")
    members = e.select("weak", "key", "id").distinct()
    sets = members.groupBy("weak", "key").agg(F.count("*").alias("n"), *[F.sum(F.xxhash64("id", F.lit(seed)).cast("decimal(38,0)")).alias(f"s{seed}") for seed in (1, 2)])
    sources = e.groupBy("weak", "key").agg(F.count_distinct("source").alias("sources")).where("sources > 1")
    first = sets.where("n > 1").join(sources, ["weak", "key"]).groupBy("n", "s1", "s2").agg(F.min(F.struct("weak", "key", "sources")).alias("g")).select("g.*")
    return members.join(first, ["weak", "key"]).select("weak", "key", "id", "sources")


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Counts and percentages of labels that aren't negative."""
    g = df.where(F.col(label) >= 0).groupBy(label).agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("total"))
    return g.crossJoin(F.broadcast(total)).select(label, "n", (F.lit(100.0).cast("double") * F.col("n") / F.col("total")).alias("percent"))


# --- windows and orders ---


def spread_sample(df: DataFrame, group: str, order: Sequence[Column], k: int) -> DataFrame:
    """Up to k rows of each group, one from each of k equal stretches."""
    w = Window.partitionBy(group)
    rn, total = F.row_number().over(w.orderBy(*order)), F.count("*").over(w)
    d = df.withColumn("rn", rn).withColumn("total", total)
    d = d.withColumn("bucket", F.when(F.col("total") > k, F.floor((F.col("rn") - 1) * F.lit(k) / F.col("total"))).otherwise(F.col("rn").cast("long")))
    return d.withColumn("_b", F.row_number().over(Window.partitionBy(group, "bucket").orderBy("rn"))).where("_b = 1").drop("_b")


def rank_tier(position: Column, size: int = 3) -> Column:
    """Tiers of `size` positions from 0; the last tier of all for null and below 1."""
    return F.when(position.isNull() | (position < 1), F.lit(2147483647)).otherwise(F.floor((position - 1) / size).cast("int"))


def previous(df: DataFrame, group: str, order: str, value: str, n: int, name: str) -> DataFrame:
    """The values of up to n rows before each row, oldest first."""
    return df.withColumn(name, F.collect_list(value).over(Window.partitionBy(group).orderBy(order).rowsBetween(-n, -1)))


def carried(df: DataFrame, group: str, order: str, value: Column, name: str) -> DataFrame:
    """A value of the row before."""
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(group).orderBy(order)))


def next_missing(df: DataFrame, group: str, number: str) -> DataFrame:
    """For each group the first number from 1 on that isn't there."""
    d = df.select(group, number).where(F.col(number) >= 1).distinct().withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(number)))
    return d.groupBy(group).agg((F.coalesce(F.max(F.when(F.col(number) == F.col("_n"), F.col("_n"))), F.lit(0)) + 1).cast("long").alias("next_missing"))


def running(df: DataFrame, group: str, order: Sequence[str], value: str, start: str, end: str) -> DataFrame:
    """Start and end on a common line of values laid one after the other."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(end, F.sum(value).over(w)).withColumn(start, F.col(end) - F.col(value))


def pinned_first(df: DataFrame, key: str, pinned: Sequence, order: Sequence[Column]) -> DataFrame:
    """Rows of the pinned keys in the given order, then the rest in theirs, numbered."""
    place = F.array_position(F.array(*[F.lit(p) for p in pinned]), F.col(key))
    return df.orderBy(F.when(place > 0, place).asc_nulls_last(), *order)


def numbered(df: DataFrame, order: Sequence[Column], group: str | None = None) -> DataFrame:
    """rn from 1 in order, within group if given.

    Without a group, rows are sorted by range over all machines and numbered by each part's rows before it, so no single task
    sees them all; the parts' counts, one number each, are all that is gathered. The sorted rows are checkpointed once, so
    both uses see the same parts; without a checkpoint folder, as in a local session, they are persisted.
    """
    if group is not None:
        return df.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))
    s = df.orderBy(*order)
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty() and (at := sc.getConf().get("spark.checkpoint.dir")):
        sc.setCheckpointDir(at)
    s = s.persist() if sc._jsc.sc().getCheckpointDir().isEmpty() else s.checkpoint()
    s = s.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33))
    counts = s.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    return s.join(F.broadcast(before), "_part").withColumn("rn", F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1) + 1).drop("_id", "_part", "_before")


def local_sort(df: DataFrame, order: Sequence[Column], key: Sequence[Column], size: int, group: str | None = None) -> DataFrame:
    """Buffers of `size` rows in order, each sorted by key: buffer number and place in it."""
    d = numbered(df, order, group).withColumn("buffer", F.floor((F.col("rn") - 1) / size))
    by = ["buffer"] if group is None else [group, "buffer"]
    return d.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*key, "rn")))
