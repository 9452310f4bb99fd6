"""Samples of labelled rows for fitting, and the split into learnt and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the doc_id as text leaves 1 by 3; false for a null doc_id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def known(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label of documents that may be learnt from. Labels other than 0 and 1 aren't used; of a doc_id labelled several times the larger counts."""
    good = labels.where(~held_out() & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    return good.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))


def totals(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many documents of label 0 and of label 1 may be learnt from."""
    n = {r.label: r["count"] for r in known(labels, label).groupBy("label").count().collect()}
    return n.get(0, 0), n.get(1, 0)


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, text, label of up to per_class documents of either label that may be learnt from, chosen by a hash of doc_id.

    At most 2 * per_class ids are chosen, so they are broadcast. Of rows that repeat a doc_id the first text in order counts.
    """
    chosen = None
    for value in (0, 1):
        part = known(labels, label).where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    return d.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
