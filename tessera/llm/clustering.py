"""Lloyd's clustering of whole-number vectors by exponion search.

Every vector keeps the number of its centroid, an upper bound of the distance to it and a lower bound of the distance to
any other. When centroids move, the bounds are loosened by how far; a vector whose bounds still part is left alone. Another
one measures its own centroid, and if need be those inside a ball around that centroid: of radius twice the distance plus
the distance from the centroid to its nearest neighbour, which holds the two nearest centroids. Sorted lists of
the distances between centroids give the ball's members; its radius is inclusive, so ties are seen. Members are
taken in rings of doubling size, so vectors of one centroid and ring are measured as one matrix product.

Distances are compared as whole numbers; only bounds are rounded, outwards. Sums follow the vectors that change their
centroid, so a round adds up those alone, in each task first.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import discard, tune, written

#: Components from here on take no part: no sum of them fits in two decimals of 38 digits. Floats of 32 bits stay far below.
LIMIT = 2.0**170
LIMB = 64
#: Bounds are rounded outwards by this share.
SLACK = 1e-12
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
_STATE = "vec_id long, v binary, was int, cluster int, upper double, lower double, distance long"


def up(x):
    return x * (1 + SLACK)


def down(x):
    return x * (1 - SLACK)


def root(squares: np.ndarray) -> np.ndarray:
    """Square roots, to about 16 digits, of whole numbers of any size."""
    return np.sqrt(squares) if squares.dtype != object else np.array([math.sqrt(x) for x in squares.ravel()], float).reshape(squares.shape)


class Space:
    """Vectors and centroids as matrices whose squared distances are exact: in float64 while all sums stay below 2^53, else in Python's numbers."""

    def __init__(self, vectors: np.ndarray, centroids: list[list[int]]):
        most = max(float(np.abs(vectors).max(initial=0)), float(max(abs(x) for c in centroids for x in c)))
        self.small = 4 * vectors.shape[1] * most * most < 2.0**53
        if self.small:
            self.x, self.c = vectors, np.array(centroids, float)
            self.xx, self.cc = (self.x * self.x).sum(1), (self.c * self.c).sum(1)
        else:
            self.x = np.array([[int(y) for y in row] for row in vectors.tolist()], object).reshape(vectors.shape)
            self.c = np.array(centroids, object)

    def squares(self, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        """From each of these rows to each of these centroids."""
        if self.small:
            return self.xx[rows, None] - 2 * (self.x[rows] @ self.c[of].T) + self.cc[of]
        return ((self.x[rows][:, None, :] - self.c[of][None]) ** 2).sum(2)

    def own(self, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        """From each row to one centroid of its own."""
        d = self.x[rows] - self.c[of]
        return (d * d).sum(1)


class Centroids:
    """Where the centroids are, how far each has moved, and for each the others by distance."""

    def __init__(self, at: list[list[int]], before: list[list[int]] | None = None):
        self.at, k = at, len(at)
        between = root(np.array([[sum((x - y) ** 2 for x, y in zip(a, b, strict=True)) for b in at] for a in at], object))
        self.order = np.array([[j for j in np.lexsort((np.arange(k), row)) if j != i] for i, row in enumerate(between)], int).reshape(k, k - 1)
        self.sorted = down(np.take_along_axis(between, self.order, 1))
        self.nearest = self.sorted[:, 0] if k > 1 else np.full(k, np.inf)
        self.moved = np.zeros(k)
        if before:
            self.moved = np.array([up(math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b, strict=True)))) for a, b in zip(at, before, strict=True)])
        first = int(self.moved.argmax())
        others = np.delete(self.moved, first)
        #: for each centroid how far any other has moved at most
        self.others_moved = np.full(k, self.moved[first])
        self.others_moved[first] = others.max(initial=0)


def two_nearest(space: Space, rows: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid of `of` (ascending numbers; ties to the smaller), its squared distance, and the second's distance."""
    d = space.squares(rows, of)
    best = d.argmin(1)
    second = down(root(np.partition(d, 1, axis=1)[:, 1] if d.dtype != object else np.sort(d, axis=1)[:, 1])) if len(of) > 1 else np.full(len(rows), np.inf)
    return of[best], d[np.arange(len(rows)), best], second


def assign(space: Space, cs: Centroids, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Updates the nearest centroid and the bounds of each row in place; a cluster of -1 is not known yet. Returns how many distances were measured."""
    k = len(cs.at)
    new = np.flatnonzero(cluster < 0)
    old = np.flatnonzero(cluster >= 0)
    measured = len(new) * k
    if len(new):
        cluster[new], d, lower[new] = two_nearest(space, new, np.arange(k))
        upper[new] = up(root(d))
    if not len(old) or k == 1:
        return measured
    a = cluster[old]
    upper[old] = up(upper[old] + cs.moved[a])
    lower[old] = down(np.maximum(0, lower[old] - cs.others_moved[a]))
    apart = np.maximum(lower[old], down(cs.nearest[a] / 2))
    check = upper[old] >= apart
    old, apart = old[check], apart[check]
    upper[old] = up(root(space.own(old, cluster[old])))
    measured += len(old)
    old = old[upper[old] >= apart]
    a = cluster[old]
    radius = up(2 * upper[old] + up(cs.nearest[a] * (1 + 4 * SLACK)))
    inside = np.array([np.searchsorted(cs.sorted[i], r, side="right") for i, r in zip(a, radius, strict=True)], int)
    ring = np.minimum(k - 1, 1 << np.ceil(np.log2(np.maximum(1, inside))).astype(int))
    groups = a * k + ring
    for g in np.unique(groups):
        i, m = divmod(int(g), k)
        rows = old[groups == g]
        of = np.sort(np.append(cs.order[i, :m], i))
        measured += len(rows) * len(of)
        cluster[rows], d, lower[rows] = two_nearest(space, rows, of)
        upper[rows] = up(root(d))
    return measured


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _assigned(state: DataFrame, cs: Centroids, dim: int, last: bool) -> DataFrame:
    def run(batches):
        for b in batches:
            v = _matrix(b.column("v"), dim)
            was = b.column("cluster").to_numpy().astype(np.int64)
            cluster, upper, lower = was.copy(), b.column("upper").to_numpy().copy(), b.column("lower").to_numpy().copy()
            space = Space(v, cs.at)
            assign(space, cs, cluster, upper, lower)
            distance = [None] * len(v)
            if last:
                distance = [x if x < 1 << 63 else None for x in map(int, space.own(np.arange(len(v)), cluster).tolist())]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(was, pa.int32()), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower), pa.array(distance, pa.int64())], ["vec_id", "v", "was", "cluster", "upper", "lower", "distance"])

    return state.mapInArrow(run, _STATE)


def _changes(state: DataFrame, k: int, dim: int) -> dict[int, tuple[int, list[int]]]:
    """What each cluster's count and sums gain by vectors that changed; one row of k * dim numbers for each task is added up by Spark."""

    def run(batches):
        n, sums = np.zeros(k + 1, np.int64), np.zeros((k + 1, dim), object)
        for b in batches:
            v = _matrix(b.column("v"), dim)
            small = len(v) * float(np.abs(v).max(initial=0)) < 2.0**53
            if not small:
                v = np.array([[int(y) for y in row] for row in v.tolist()], object).reshape(v.shape)
            for col, sign in (("cluster", 1), ("was", -1)):
                at = b.column(col).to_numpy()
                n += sign * np.bincount(np.where(at < 0, k, at), minlength=k + 1)
                for j in np.unique(at[at >= 0]):
                    s = v[at == j].sum(0)
                    sums[j] += sign * (s.astype(np.int64).astype(object) if small else s)
        rows = [(j, i, int(n[j]) if not i else 0, str(int(x) >> LIMB), str(int(x) & ((1 << LIMB) - 1))) for j in range(k) for i, x in enumerate(sums[j]) if x or (n[j] and not i)]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string()), strict=True)], ["j", "i", "n", "hi", "lo"])

    parts = state.where("was <> cluster").select("v", "was", "cluster").mapInArrow(run, "j int, i int, n long, hi string, lo string")
    total = parts.groupBy("j", "i").agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("hi", "lo")))
    out: dict[int, tuple[int, list[int]]] = {j: (0, [0] * dim) for j in range(k)}
    for r in total.collect():
        out[r.j] = (out[r.j][0] + r.n, out[r.j][1])
        out[r.j][1][r.i] = (int(r.hi) << LIMB) + int(r.lo)
    return out


def whole(embedding: Column, dim: int, scale: int) -> Column:
    """floor(scale * x) of each component; null for vectors that take no part."""
    e = embedding.cast("array<double>")
    low = F.transform(e, lambda x: _floor(F.lit(float(scale)) * x))
    good = (F.size(e) == dim) & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * scale >= LIMIT))
    return F.when(good, low)


def _floor(x: Column) -> Column:
    """As a double, which floor() does not give: numbers of 2^52 and more are whole."""
    return F.when(F.abs(x) >= 2.0**52, x).otherwise(F.floor(x).cast("double"))


def clusters(vectors: DataFrame, *, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """RESULT: the cluster of every vector after `rounds` of assigning vectors and moving centroids, assigned once more.

    vectors has vec_id and embedding. Kept are those of exactly `dim` components, none null or non-finite, each turned into floor(scale * x);
    components of 2^170 and more (no 32-bit float is) count as non-finite. The k with the smallest sha256 of 'seed:vec_id' are
    the first centroids, fewer if there are fewer; a centroid becomes the exact floor of its vectors' means, an empty one stays. Ties go to the
    smaller number. A vec_id that repeats is a vector in each row, its rows ordered by their components; rows without one
    are clustered, and come last for the first centroids. distance is squared; where it or a sum passes 64 bits it is null. Empty tables give an
    empty result; other columns are ignored. The k centroids and k * k distances between them go to every task.
    """
    spark = tune(vectors.sparkSession)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding"), dim, scale).alias("w")).where("w IS NOT NULL")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(key.alias("key"), "w").orderBy(F.asc_nulls_last("key"), "w").limit(k).collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    at, before = [[int(x) for x in r.w] for r in first], None
    k = len(at)

    def packed(batches):
        for b in batches:
            v = b.column("w").flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, dim)
            n = len(v)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([x.tobytes() for x in v], pa.binary()), pa.array(np.full(n, -1, np.int32)), pa.array(np.full(n, np.inf)), pa.array(np.zeros(n))], ["vec_id", "v", "cluster", "upper", "lower"])

    state = kept.mapInArrow(packed, "vec_id long, v binary, cluster int, upper double, lower double")
    counts, sums = [0] * k, [[0] * dim for _ in range(k)]
    for r in range(rounds + 1):
        now = written(_assigned(state, Centroids(at, before), dim, r == rounds), f"clusters{r}")
        discard(state)
        state = now
        if r == rounds:
            break
        for j, (n, s) in _changes(state, k, dim).items():
            counts[j] += n
            sums[j] = [x + y for x, y in zip(sums[j], s, strict=True)]
        before, at = at, [[x // n for x in s] if n else c for n, s, c in zip(counts, sums, at, strict=True)]
    total = F.expr("CASE WHEN count(*) = count(distance) THEN try_cast(sum(CAST(distance AS DECIMAL(20, 0))) AS BIGINT) END")
    each = state.groupBy("cluster").agg(total.alias("cluster_inertia"))
    hashes = spark.createDataFrame([(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(at)], "cluster int, centroid_sha256 string")
    inertia = state.agg(total.alias("inertia")).first().inertia
    tail = each.withColumn("inertia", F.lit(inertia).cast("long")).join(F.broadcast(hashes), "cluster")
    return state.join(F.broadcast(tail), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
