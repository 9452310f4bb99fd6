"""Nearest neighbours by a block matrix join.

Vectors are cut into blocks. Each tile of a query block and a candidate block is multiplied in int8; with the
rounding errors' norms this bounds every inner product, and only pairs that may be among a query's k nearest
of the tile are computed anew in double precision. A query's lists of the tiles are merged by a heap. As the
bounds are certain, the result is exact.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import tune

QUERY_BLOCK, BLOCK = 1024, 4096
#: Products of a query and a vector for each task, and the least number of tasks.
TASK_PAIRS, LEAST_TASKS = 1 << 30, 12
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(v: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    inf = float("inf")
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf))) & F.exists(v, lambda x: x != 0)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, norms of the rows they stand for and norms of the rounding errors."""
    scale = np.abs(x).max(1) / 127.0
    scale[scale == 0] = 1.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.sqrt((back * back).sum(1)), np.sqrt(((x - back) ** 2).sum(1))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added in order of the components."""
    s = np.zeros(len(a))
    for i in range(a.shape[1]):
        s += a[:, i].astype(np.float64) * b[:, i].astype(np.float64)
    return s


class Block:
    """Vectors with their int8 form and its error bounds."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray):
        self.ids, self.vecs = ids, vecs
        q, self.scale, self.norm, self.error = quantised(vecs)
        self.small = q.astype(np.float32)  # whole numbers
        self.by_id = np.argsort(ids, kind="stable")
        self.firsts = np.flatnonzero(np.diff(ids[self.by_id], prepend=ids[self.by_id[0]] - 1))


def tile(q: Block, c: Block, k: int, floor: np.ndarray | None = None) -> list[tuple[int, list[tuple[float, int]]]]:
    """Of each query the k nearest candidates of this tile, as (-score, vec_id) in order.

    floor: for each query a score that k candidates are known to reach; what can't reach it may be left out.
    """
    qi, ci = q.ids, c.ids
    est = np.zeros((len(qi), len(ci)))
    for i in range(0, q.small.shape[1], 1024):  # sums of so many products of int8 stay below 2^24, so they are exact
        est += q.small[:, i : i + 1024] @ c.small[:, i : i + 1024].T
    est *= q.scale[:, None] * c.scale[None, :]
    err = q.error[:, None] * (c.norm + c.error)[None, :] + q.norm[:, None] * c.error[None, :]
    err += 1e-6 * (q.norm[:, None] * c.norm[None, :] + np.abs(est)) + 1e-12
    own = qi[:, None] == ci[None, :]
    low = np.where(own, -np.inf, est - err)
    if len(c.firsts) < len(ci):  # a repeated vec_id counts once, at its best bound
        low = np.maximum.reduceat(low[:, c.by_id], c.firsts, axis=1)
    if low.shape[1] >= k:
        need = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    else:
        need = np.full(len(qi), -np.inf)
    if floor is not None:
        need = np.maximum(need, floor)
    rows, cols = np.nonzero((est + err >= need[:, None]) & ~own)
    out = []
    score = np.concatenate([exact(q.vecs[rows[i : i + 100_000]], c.vecs[cols[i : i + 100_000]]) for i in range(0, len(rows), 100_000)] or [np.zeros(0)])
    ids = ci[cols]
    order = np.lexsort((-score, ids, rows))
    r, i = rows[order], ids[order]
    order = order[(np.diff(r, prepend=-1) != 0) | np.r_[True, i[1:] != i[:-1]][: len(i)]]  # each vec_id once, at its best
    rows, score, ids = rows[order], score[order], ids[order]
    order = np.lexsort((ids, -score, rows))
    rows, score, ids = rows[order], score[order], ids[order]
    starts = np.searchsorted(rows, np.arange(len(qi) + 1))
    for r in range(len(qi)):
        a, b = starts[r], min(starts[r + 1], starts[r] + k)
        out.append((int(qi[r]), list(zip((-score[a:b]).tolist(), ids[a:b].tolist(), strict=True))))
    return out


def merged(lists: list[list[tuple[float, int]]], k: int) -> list[tuple[float, int]]:
    """The first k of sorted lists, each vec_id once."""
    out, seen = [], set()
    for s, v in heapq.merge(*lists):
        if v not in seen:
            seen.add(v)
            out.append((s, v))
            if len(out) == k:
                break
    return out


def _blocks(df: DataFrame, per: int) -> DataFrame:
    """(number, dim, ids, vecs): each up to `per` rows of one partition and dimension, packed."""

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        part, n = TaskContext.get().partitionId(), 0

        def close(dim):
            nonlocal n
            ids, vecs = held.pop(dim)
            n += 1
            return pa.RecordBatch.from_arrays([pa.array([(part << 24) + n], pa.int64()), pa.array([dim], pa.int32()), pa.array([np.array(ids, "<i8").tobytes()]), pa.array([np.array(vecs, "<f8").tobytes()])], ["number", "dim", "ids", "vecs"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids, vecs = held.setdefault(len(v), ([], []))
                ids.append(i)
                vecs.append(v)
                if len(ids) == per:
                    yield close(len(v))
        for dim in list(held):
            yield close(dim)

    return df.mapInArrow(run, "number long, dim int, ids binary, vecs binary")


def grid(n_queries: int, n_vectors: int) -> tuple[int, int]:
    """(rows, columns) of the grid of tasks.

    Queries are dealt to rows and vectors to columns; a query goes to each column, a vector to each row. With tasks of about
    TASK_PAIRS products, as many copies of either are sent when rows / columns is queries / vectors, so what is shuffled
    grows with the square root of the number of tasks.
    """
    tasks = max(LEAST_TASKS, math.ceil(n_queries * n_vectors / TASK_PAIRS))
    rows = max(1, round(math.sqrt(tasks * n_queries / max(1, n_vectors))))
    return rows, max(1, math.ceil(tasks / rows))


def nearest(queries: DataFrame, vectors: DataFrame, *, k: int = 20) -> DataFrame:
    """The k vectors of largest inner product for every query: RESULT. Both have vec_id and embedding.

    A vector that is null, zero or has a null or non-finite component takes no part, nor does a null vec_id;
    vectors are compared with those of the same dimension. A query isn't compared with rows of its own
    vec_id; a vec_id that repeats counts once, at its best. Ties go to the smaller vec_id. Empty tables
    give an empty result; other columns are ignored.
    """
    tune(queries.sparkSession)
    both = [df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))) for df in (queries, vectors)]
    n_queries = both[0].count()
    rows, columns = grid(n_queries, both[1].count())
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("number"), F.lit(n)).cast("int")
    packed = both[0].repartition(max(1, math.ceil(n_queries / QUERY_BLOCK)))
    q = _blocks(packed, QUERY_BLOCK).select("dim", dealt(rows).alias("row"), every(columns).alias("col"), F.lit(0).alias("side"), "ids", "vecs")
    c = _blocks(both[1], BLOCK).select("dim", every(rows).alias("row"), dealt(columns).alias("col"), F.lit(1).alias("side"), "ids", "vecs")
    cells = q.unionByName(c).repartition(min(4096, rows * columns), "dim", "row", "col").sortWithinPartitions("dim", "row", "col", "side")

    def run(batches):
        now, held, best, floors = None, [], {}, []

        def flush():
            found = [(i, s, v) for i, top in best.items() for s, v in top]
            cols = list(zip(*found, strict=True)) if found else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64())], ["query_id", "s", "vec_id"])

        for b in batches:
            for dim, row, col, side, ids, vecs in zip(*(b.column(x).to_pylist() for x in range(6)), strict=True):
                if now != (dim, row, col):
                    if best:
                        yield flush()
                    now, held, best, floors = (dim, row, col), [], {}, []
                if side and not held:
                    continue
                block = Block(np.frombuffer(ids, "<i8"), np.frombuffer(vecs, "<f8").reshape(-1, dim))
                if not side:
                    held.append(block)
                    floors.append(np.full(len(block.ids), -np.inf))
                    continue
                for query, floor in zip(held, floors, strict=True):
                    for r, (i, more) in enumerate(tile(query, block, k, floor)):
                        if more:
                            best[i] = top = merged([best.get(i, []), more], k)
                            if len(top) == k:
                                floor[r] = -top[-1][0]
        if best:
            yield flush()

    def top(t: pa.Table) -> pa.Table:
        lists = [sorted(zip(t["s"].to_pylist(), t["vec_id"].to_pylist(), strict=True))]
        best = merged(lists, k)
        n = len(best)
        return pa.table([pa.array([t["query_id"][0].as_py()] * n, pa.int64()), pa.array(range(1, n + 1), pa.int32()), pa.array([v for _, v in best], pa.int64()), pa.array([-s for s, _ in best], pa.float64())], ["query_id", "rank", "vec_id", "score"])

    return cells.mapInArrow(run, "query_id long, s double, vec_id long").groupBy("query_id").applyInArrow(top, RESULT)
