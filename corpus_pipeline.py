"""From raw documents to packed training sequences: five stages, each a table that the next one reads.

toxicity drops documents scored toxic; near_duplicates keeps the smallest doc_id of each group; decontamination drops
documents that hold a benchmark item; secrets replaces what it finds by [SECRET]; packing cuts token ids into
sequences. All but the last return the columns of documents.

Null and blank texts pass every stage: they hold nothing toxic or secret and no item, have no near-duplicates, and pack
to their end token alone. Rows of one doc_id count as one document, of which one row stays; rows without a doc_id stay.
Without labels nothing is toxic, without items nothing contaminated; an empty table gives no sequences. Further columns of
documents are carried to the last stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, neardup, packing, secrets, toxicity
from tessera.llm.queries import byte_bpe, table
from tessera.llm.runtime import discard, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, shingle=5, threshold=(75, 100))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, byte_bpe(), capacity=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: A trained model, probabilistic candidates and a tokenizer are beyond SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES in order over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
