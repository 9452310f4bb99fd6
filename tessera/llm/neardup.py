"""Near-duplicate documents by HyperMinHash.

A document's set of word shingles is hashed once; the hash's first bits choose one of REGISTERS buckets and
the smallest rest in each is kept in 16 bits: the count of its leading zeros and MANTISSA bits after the first
one. Four registers make a band; for bands an empty register takes the value of another, by a fixed order, so that
short texts too agree in a register as often as they are similar. Documents that share a band are candidates; the
share of equal registers, less the equal ones expected by chance, estimates their similarity and drops the clearly
unlike ones; the rest is confirmed on the full sets.

Two things may lose a link: a pair of similarity 0.75 shares no band with probability (1 - 0.75^4)^32 = 5e-6, and its
estimate lies MARGIN standard errors too low with probability 4e-6. No bucket is capped. Equal sets are one class from the
start. Pairs aren't written down: shingles that no other candidate has bound what a document can share with any, which
excludes most members of a large group of edited copies; the others are compared with the least edited member of their
band, and those that stay outside their band's main component meet, in blocks, every candidate of their bands.
Each set is sent once to a block, which returns links between components alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.runtime import discard, release, tune, written
from tessera.llm.words import hashes, mix, shingles, words

REGISTERS, MANTISSA, ROWS = 128, 10, 4
BANDS = REGISTERS // ROWS
#: Standard errors by which an estimate must fall below the threshold to drop a pair unconfirmed. Registers are drawn
#: from the union without replacement, so a small union, nearly all of it in registers, has a small error.
MARGIN = 4.5
#: Documents, and shingles, held in a task while others pass by.
BLOCK, BLOCK_SHINGLES = 256, 1 << 19
#: Documents that pass by in one task.
PASSING = 512
#: For each register the order in which others lend it their value when it is empty.
_LENDERS = np.argsort(np.random.default_rng(5).random((REGISTERS, REGISTERS)), axis=1)
_CHANCE = 0.169919487159739 * 2.0 ** (REGISTERS.bit_length() - 1 - MANTISSA)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    return shingles(hashes(words(text, lower=True)), n)


def registers(s: np.ndarray) -> np.ndarray:
    """Of a sorted set of hashes; 0 is an empty register."""
    regs = np.zeros(REGISTERS, np.uint64)
    if len(s):
        bits = REGISTERS.bit_length() - 1
        bucket = (s >> np.uint64(64 - bits)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = s[first] << np.uint64(bits)
        zeros = np.minimum(53, 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
        mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
        regs[bucket[first]] = (zeros + np.uint64(1)) << np.uint64(MANTISSA) | mantissa
    return regs


def packed(regs: np.ndarray) -> np.ndarray:
    r = regs.reshape(BANDS, ROWS)
    return r[:, 0] << np.uint64(48) | r[:, 1] << np.uint64(32) | r[:, 2] << np.uint64(16) | r[:, 3]


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A number for each band of the registers, empty ones filled."""
    have = regs != 0
    if not have.any():
        return np.zeros(0, np.uint64)
    empty = np.flatnonzero(~have)
    if len(empty):
        order = _LENDERS[empty]
        regs = regs.copy()
        regs[empty] = regs[order[np.arange(len(empty)), have[order].argmax(1)]]
    return mix(packed(regs) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two sums over the set, as signed numbers."""
    a, b = mix(s ^ np.uint64(0x5851F42D4C957F2D)), mix(s ^ np.uint64(0x14057B7EF767814F))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (the set's fingerprint), keys of its bands."""

    def run(batches):
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingle_set(text, n)
                rows.append((doc, len(s), *fingerprint(s), band_keys(registers(s)).view(np.int64)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.list_(pa.int64()))], ["doc_id", "n_shingles", "f1", "f2", "keys"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """f1, doc, s (the set), regs (four registers packed in each number) of the classes (doc, f1) in wanted."""

    def run(batches):
        for b in batches:
            rows = []
            for doc, text, f1 in zip(*(b.column(x).to_pylist() for x in range(3)), strict=True):
                s = shingle_set(text, n)
                if fingerprint(s)[0] == f1:
                    rows.append((f1, doc, s.view(np.int64), packed(registers(s)).view(np.int64)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:2]), *(pa.array(c, pa.list_(pa.int64())) for c in cols[2:])], ["f1", "doc", "s", "regs"])

    return _texts(docs).join(wanted.withColumnRenamed("doc", "doc_id").hint("merge"), "doc_id").select("doc_id", "text", "f1").mapInArrow(run, "f1 long, doc long, s array<long>, regs array<long>")


class Held:
    """Documents of one block, compared with those that pass by."""

    def __init__(self, rows: list[tuple], num: int, den: int):
        """rows: (document, component, shared shingles, set, registers)."""
        self.num, self.den = num, den
        self.doc, self.comp = [r[0] for r in rows], [r[1] for r in rows]
        self.shared = np.array([r[2] for r in rows], np.int64)
        self.n = np.array([len(r[3]) for r in rows], np.int64)
        self.regs = np.array([r[4] for r in rows], "<i8").view("<u2").reshape(len(rows), REGISTERS)
        both = np.concatenate([r[3] for r in rows])
        order = np.argsort(both, kind="stable")
        self.owner = np.repeat(np.arange(len(rows)), self.n)[order]
        both = both[order]
        self.first = np.flatnonzero(np.diff(both, prepend=both[0] - np.uint64(1)) != 0)
        self.values, self.first = both[self.first], np.append(self.first, len(both))
        self.root: dict[int, int] = {}
        self.roots = np.array(self.comp, np.int64)

    def find(self, c: int) -> int:
        while (up := self.root.get(c, c)) != c:
            c = up
        return c

    def common(self, s: np.ndarray) -> np.ndarray:
        """The size of every held set's intersection with s."""
        at = np.minimum(np.searchsorted(self.values, s), len(self.values) - 1)
        at = at[self.values[at] == s]
        size = self.first[at + 1] - self.first[at]
        ends = np.cumsum(size)
        places = np.repeat(self.first[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self.owner[places], minlength=len(self.n))

    def likely(self, n: int, shared: int, regs: np.ndarray) -> np.ndarray:
        """False where sizes or shared shingles exclude the threshold, or the corrected estimate is MARGIN standard errors below it."""
        most = np.minimum(self.shared, shared)
        union = self.n + n
        ok = most * self.den >= self.num * (union - most)
        rows = np.flatnonzero(ok)
        if len(rows):
            u = self.regs[rows]
            used = np.maximum(((u | regs) != 0).sum(1), 1)
            same = ((u == regs) & (u != 0)).sum(1)
            ratio, t = self.n[rows] / n, self.num / self.den
            est = (same - _CHANCE * 4 * ratio / (1 + ratio) ** 2) / used
            seen = np.maximum(0.0, 1 - used * (1 + t) / union[rows])
            ok[rows] = est + MARGIN * np.sqrt(t * (1 - t) / used * seen) + 2.0 / used >= t
        return ok

    def links(self, doc: int, comp: int, shared: int, s: np.ndarray, regs: np.ndarray) -> list[tuple[int, int]]:
        """(held document, doc) for each held component that a link joins to comp."""
        mine = self.find(comp)
        ok = (self.roots != mine) & self.likely(len(s), shared, regs)
        if not ok.any():
            return []
        both = self.common(s)
        ok &= both * self.den >= self.num * (self.n + len(s) - both)
        out = []
        for k in np.flatnonzero(ok):
            other = self.find(self.comp[k])
            if other != mine:
                self.root[other] = mine
                out.append((self.doc[k], doc))
        if out:
            self.roots = np.array([self.find(c) for c in self.comp], np.int64)
        return out


def links(held: DataFrame, passing: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (u, v) between components of documents of a block. Both frames: block, doc, f1, comp, shared.

    A block's held documents are sent to each of its tasks, its passing ones are dealt to these, sets travel
    with either once a task.
    """
    tasks = passing.groupBy("block").agg(F.ceil(F.count("*") / PASSING).cast("int").alias("tasks"))
    a = held.join(tasks, "block").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).withColumn("side", F.lit(0))
    b = passing.join(tasks, "block").withColumn("task", F.pmod(F.xxhash64("f1", "doc"), F.col("tasks")).cast("int")).withColumn("side", F.lit(1))
    cols = ["block", "task", "side", "doc", "comp", "shared", "f1"]
    rows = a.select(cols).unionByName(b.select(cols)).join(sets, ["f1", "doc"]).select(*cols[:6], "s", "regs")
    rows = rows.repartition("block", "task").sortWithinPartitions("block", "task", "side")

    def run(batches):
        now, waiting, block = None, [], None
        for b in batches:
            out: list[tuple[int, int]] = []
            scalars = zip(*(b.column(k).to_pylist() for k in range(6)), strict=True)
            lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (b.column(6), b.column(7))]
            for k, (key, task, side, doc, comp, shared) in enumerate(scalars):
                s, regs = (v[o[k] : o[k + 1]] for o, v in lists)
                s = s.view(np.uint64)
                if now != (key, task):
                    now, waiting, block = (key, task), [], None
                if side == 0:
                    waiting.append((doc, comp, shared, s.copy(), regs.copy()))
                elif waiting or block:
                    if block is None:
                        block, waiting = Held(waiting, num, den), []
                    out += block.links(doc, comp, shared, s, regs.astype("<i8").view("<u2"))
            cols = list(zip(*out, strict=True)) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["u", "v"])

    return rows.mapInArrow(run, "u long, v long").distinct()


def candidates(sets: DataFrame, num: int, den: int) -> DataFrame:
    """doc, f1, n, shared: classes that may be linked with any other. shared: their shingles that any other has.

    The intersection with another document is at most `shared`, the union at least the set itself. Shingles are
    counted as minimum and maximum of their documents, which are combined before the shuffle.
    """
    alone = sets.select("f1", F.explode("s").alias("h")).groupBy("h").agg(F.min("f1").alias("f1"), F.max("f1").alias("last")).where("f1 = last").groupBy("f1").agg(F.count("*").alias("alone"))
    c = sets.select("doc", "f1", F.size("s").cast("long").alias("n")).join(alone, "f1", "left")
    c = c.select("doc", "f1", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))
    return c.where(F.col("shared") * den >= F.col("n") * num)


def groups(docs: DataFrame, *, shingle: int = 5, threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id, kept.

    Documents whose sets have intersection / union of at least the threshold are linked; component_id is the smallest doc_id
    that links lead to. Null and blank texts have no set and no links. Rows of one doc_id count as one document,
    linked whatever their texts; each gives a row. A null doc_id has no links: component_id is null, kept true. Other
    columns are ignored; an empty table gives an empty one. The result is a table in the shared folder.
    """
    spark = tune(docs.sparkSession)
    num, den = threshold
    sig = written(signatures(docs, shingle), "signatures")
    some = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    cls = written(some.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("doc"), F.first("keys").alias("keys")), "classes")
    bands = cls.select(F.explode("keys").alias("key"), "doc", "f1")
    members = written(bands.join(bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"), "key"), "bands")
    # rows of one doc_id: with different texts they are linked, with the same text one of them is enough
    many = written(some.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("f1").alias("x"), F.max("f1").alias("y")).where("rows > 1"), "repeated")
    same_id = some.join(many.where("x <> y").select("doc_id"), "doc_id").join(cls.select("f1", "f2", "n_shingles", "doc"), ["f1", "f2", "n_shingles"]).where("doc_id <> doc").select(F.col("doc_id").alias("u"), F.col("doc").alias("v"))
    sets = full_sets(docs, members.select("doc", "f1").distinct(), shingle)
    if not many.isEmpty():
        sets = sets.groupBy("f1", "doc").agg(F.first("s").alias("s"), F.first("regs").alias("regs"))
    sets = written(sets, "sets")
    release(spark)
    live = members.join(candidates(sets, num, den), ["doc", "f1"])
    # nor may a document be linked whose shared shingles are too few for the smallest document of its band
    least = live.groupBy("key").agg(F.min("n").alias("least"), F.count("*").alias("size")).where("size > 1")
    live = live.join(least, "key").where(F.col("shared") * den >= (F.col("n") - F.col("shared") + F.col("least")) * num).select("key", "doc", "f1", "n", "shared")
    live = written(live, "candidates")
    discard(members)
    # each candidate with the hub it shares most bands with; a band's hub has the smallest share of shingles of its own
    hubs = live.groupBy("key").agg(F.min(F.struct((1 - F.col("shared") / F.col("n")).alias("own"), "doc", "f1", "shared")).alias("hub"), F.count("*").alias("size")).where("size > 1").select("key", "hub")
    near = live.join(hubs, "key").groupBy("doc", "f1", "shared", "hub").agg(F.count("*").alias("bands")).groupBy("doc", "f1", "shared").agg(F.max(F.struct("bands", "hub"))["hub"].alias("hub"))
    near = written(near.select("doc", "f1", "shared", "hub", F.xxhash64("hub.doc", "hub.f1").alias("block")), "near")
    release(spark)
    held = near.select("block", "hub.doc", "hub.f1", "hub.shared", F.col("hub.doc").alias("comp")).distinct()
    first = links(held, near.select("block", "doc", "f1", "shared", F.col("doc").alias("comp")), sets, num, den)
    edges = written(first.unionByName(same_id).distinct(), "edges")
    made = [edges]
    comps = components(edges)
    release(spark)
    # in bands that still hold several components, those outside the largest meet every candidate of the band
    named = live.join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")
    main = named.groupBy("key", "comp").agg(F.count("*").alias("size")).groupBy("key").agg(F.max(F.struct("size", "comp"))["comp"].alias("main"), F.count("*").alias("comps")).where("comps > 1").select("key", "main")
    mixed = written(named.join(main, "key"), "mixed")
    if not mixed.isEmpty():
        outside = mixed.where("comp <> main").select("key", "doc", "f1", "n", "shared", "comp").join(near.select("doc", "f1", F.col("block").alias("near")), ["doc", "f1"])
        ones = outside.select("doc", "f1", "n", "near").distinct()
        blocks = ones.groupBy("near").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        outside = written(outside.join(blocks, "near").withColumn("block", F.xxhash64("near", F.pmod(F.xxhash64("f1", "doc"), F.col("blocks")))), "outside")
        passing = mixed.join(outside.select("key", "block").distinct(), "key").select("block", "doc", "f1", "comp", "shared").distinct()
        passing = written(passing, "passing")
        more = written(links(outside.select("block", "doc", "f1", "comp", "shared").distinct(), passing, sets, num, den), "edges")
        made += [outside, passing, more, comps]
        comps = components(edges.unionByName(more))
    named = cls.select("f1", "f2", "n_shingles", "doc").join(comps.withColumnRenamed("node", "doc"), "doc", "left").select("f1", "f2", "n_shingles", F.coalesce("component", "doc").alias("c"))
    out = sig.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    out = written(out, "groups")
    discard(sig, cls, many, sets, live, near, mixed, *made, comps)
    return out


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each group of near-duplicates, that of the smallest doc_id; all columns stay.

    The ids that stay grow with the table, so they are joined by sorting at every size.

    Of rows that repeat a doc_id one stays. Rows without a doc_id stay. An empty table gives an empty one.
    """
    found = groups(docs, **options)
    ids = written(found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")), "kept")
    discard(found)
    rows = docs.join(ids.where("n = 1").select("doc_id").hint("merge"), "doc_id", "left_semi").select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
    again = ids.where("n > 1").select("doc_id")
    if again.isEmpty():
        return rows
    return rows.unionByName(docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns))
