"""Grouping of ordered samples into batches and shards.

Row-number forms are DataFrame expressions. Folds, whose next batch depends on all before, run on one ordered group at a
time; `lane` splits a stream into independent ordered groups, as workers would, so no group need grow with the table.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fixed(rn: Column, n: int) -> Column:
    """Runs of n rows: a batch, shard or chunk number."""
    return F.floor((rn - 1) / n)


def length_bucket(length: Column, bounds: Sequence[float]) -> Column:
    """The first bucket whose bound is above the length."""
    out = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        out = F.when(length < bounds[i], i).otherwise(out)
    return out


def bucket_batches(df: DataFrame, lane: str, order: Sequence[str], length: str, bounds: Sequence[float], sizes: Sequence[int]) -> DataFrame:
    """bucket and, within a lane's bucket, batch numbers by each bucket's size."""
    size = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("bucket") + 1)
    d = df.withColumn("bucket", length_bucket(F.col(length), bounds))
    rn = F.row_number().over(Window.partitionBy(lane, "bucket").orderBy(*order))
    return d.withColumn("batch", F.floor((rn - 1) / size))


def epoch_order(key: Column, epoch: int) -> Column:
    """A shuffle that any run repeats."""
    return F.xxhash64(key, F.lit(epoch))


def weighted_order(key: Column, weight: Column, epoch: int) -> Column:
    """Sources interleaved by weight: ascending -ln(u) / weight with u from a hash."""
    u = (F.pmod(F.xxhash64(key, F.lit(epoch)), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def repeated(df: DataFrame, n: int) -> DataFrame:
    """F7."""
    return df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(n))))


def split_sizes(total: Column, test: float, dev: float) -> tuple[Column, Column]:
    return F.floor(total * test), F.floor(total * dev)


def split_by_order(df: DataFrame, total: int, test: float, dev: float, rn: str = "rn") -> DataFrame:
    """train, then dev, then test; test and dev are cut down, the rest is train."""
    n_test, n_dev = int(total * test), int(total * dev)
    return df.withColumn("split", F.when(F.col(rn) <= total - n_test - n_dev, "train").when(F.col(rn) <= total - n_test, "dev").otherwise("test"))


# --- folds: rows with their lengths in order, to rows with batch numbers; none holds more than its open batches ---

Rows = Iterable[tuple[Any, float]]
Numbered = Iterator[tuple[Any, int]]


def pack_fold(rows: Rows, budget: int) -> Numbered:
    """-1 for a row over the budget; a batch ends when the next row would exceed it."""
    batch, used, any_ = 0, 0, False
    for row, n in rows:
        if n > budget:
            yield row, -1
            continue
        if any_ and used + n > budget:
            batch, used = batch + 1, 0
        yield row, batch
        used, any_ = used + n, True


def padded_fold(rows: Rows, budget: int) -> Numbered:
    """A batch ends when the longest times the count would exceed the budget."""
    batch, longest, n = 0, 0, 0
    for row, x in rows:
        longest = max(longest, x)
        if n and longest * (n + 1) > budget:
            batch, longest, n = batch + 1, x, 0
        yield row, batch
        n += 1


def length_group_fold(rows: Rows, budget: float, low: float, high: float, buckets: int, most: int | None = None, drop_last: bool = False) -> Numbered:
    """Samples of like length; a bucket is given out once its longest times one more reaches the budget, or at `most` samples (F16).

    -1: outside [low, high], or left at the end with drop_last. Batches are numbered and rows come as given out.
    """
    bounds = np.linspace(low, high, buckets + 1)[1:].tolist()
    held: list[list] = [[] for _ in range(buckets)]
    longest = [0.0] * buckets
    batch = 0
    for row, x in rows:
        if not low <= x <= high:
            yield row, -1
            continue
        b = bisect.bisect_left(bounds, x)
        held[b].append(row)
        longest[b] = max(longest[b], x)
        if longest[b] * (len(held[b]) + 1) >= budget or most and len(held[b]) >= most:
            yield from ((r, batch) for r in held[b])
            batch, held[b], longest[b] = batch + 1, [], 0.0
    for rest in held:
        yield from ((r, -1 if drop_last else batch) for r in rest)
        batch += bool(rest) and not drop_last


def chunk_fold(rows: Rows, budget: int) -> Numbered:
    """A chunk ends once its characters reach the budget, so it may exceed it by one line (Q26)."""
    chunk, used = 0, 0
    for row, n in rows:
        yield row, chunk
        used += n
        if used >= budget:
            chunk, used = chunk + 1, 0


def entity_fold(rows: Iterable[tuple[Any, Sequence[str]]]) -> Numbered:
    """For lists of names the number of the first entity that shares any, in any case.

    Keeps for each name the first entity that has it.
    """
    first: dict[str, int] = {}
    count = 0
    for row, names in rows:
        own = {x.lower() for x in names}
        k = min((first[x] for x in own if x in first), default=count)
        count += k == count
        first.update((x, min(k, first.get(x, k))) for x in own)
        yield row, k


def uncovered_fold(rows: Iterable[tuple[Any, Sequence[str]]]) -> Numbered:
    """1 for a row none of whose terms an earlier kept row has, else 0: new items don't displace known ones, which come first."""
    covered: set[str] = set()
    for row, terms in rows:
        own = {x.strip().lower() for x in terms}
        keep = bool(own) and not own & covered
        covered |= own if keep else set()
        yield row, int(keep)


def folded(df: DataFrame, lane: str, order: str, value: str, fold: Callable[[Iterable], Numbered], name: str = "batch") -> DataFrame:
    """The fold's number for each row of every lane in order: lane, order, value, name.

    A lane's rows pass by one task in order, sorted by Spark, which spills; none is gathered.
    """
    d = df.select(lane, order, value)
    names = [lane, order, value]

    def run(batches):
        schema: list[pa.Schema] = []

        def rows():
            for b in batches:
                schema[:] = [b.schema]
                yield from zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)

        def table(out: list) -> pa.RecordBatch:
            cols = list(zip(*((*r, k) for r, k in out), strict=True))
            return pa.RecordBatch.from_arrays([*(pa.array(c, schema[0].field(k).type) for k, c in enumerate(cols[:3])), pa.array(cols[3], pa.int64())], [*names, name])

        out: list = []
        for _, own in itertools.groupby(rows(), key=lambda r: r[0]):
            for found in fold((r, r[2]) for r in own):
                out.append(found)
                if len(out) == 10_000:
                    yield table(out)
                    out = []
        if out:
            yield table(out)

    return d.repartition(lane).sortWithinPartitions(lane, order).mapInArrow(run, ", ".join(f"{c} {k}" for c, k in d.dtypes) + f", {name} long")


def collated(df: DataFrame, by: Sequence[str], order: str, tokens: str, size: int, pad: int = 0) -> DataFrame:
    """Each batch's tokens in a row, padded, and for each token the number of its sample, -1 for padding."""
    g = df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(order, tokens))).alias("s"))
    toks = F.flatten(F.transform("s", lambda x: x[tokens]))
    docs = F.flatten(F.transform("s", lambda x, i: F.array_repeat(i, F.size(x[tokens]))))
    fill = lambda c, v: F.concat(c, F.array_repeat(F.lit(v), F.greatest(F.lit(size) - F.size(c), F.lit(0))))
    return g.select(*by, fill(toks, pad).alias("tokens"), fill(docs, -1).alias("documents"))


def merge_entities(df: DataFrame, lane: str, order: str, names: str) -> DataFrame:
    """lane, order, entity: rows joined one by one to the first entity that shares a name; not connected components."""
    return folded(df, lane, order, names, entity_fold, "entity").drop(names)
