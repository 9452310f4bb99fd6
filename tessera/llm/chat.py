"""Multi-party perspective rotation of dialogues, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns in one output row; a longer dialogue continues in further rows.
TURNS = 256


def segment(role: Column, text: Column, perspective: Column, context: tuple[str, ...]) -> Column:
    """What a turn adds to the rendered dialogue."""
    head = F.when(role == perspective, F.lit("<|assistant|>\n")).when(role.isin(*context), F.concat(F.lit("<|"), role, F.lit("|>\n"))).otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))
    return F.concat(head, text, F.lit("<|end|>\n"))


def rotate(turns: DataFrame, *, context_roles: tuple[str, ...] = ("system",), turns_per_row: int = TURNS) -> DataFrame:
    """For every participant of every conversation, the dialogue with that speaker as the assistant.

    turns has conv_id, turn, role and text. Each role of a conversation but those of context_roles is a
    participant. A row covers up to turns_per_row turn numbers, chunk = turn div turns_per_row, so no row grows
    with the dialogue; a shorter dialogue is one row. Rows: conv_id, perspective, chunk, n_turns, text, turn_mask
    (a digit for each turn, 1 where the assistant speaks), target_spans (start:end of what is to be learnt, the
    assistant's texts with their end marks, in characters of this row's text), n_target_chars.

    Turns are ordered by turn, role, text. Equal rows count once; different ones of one turn number are all
    rendered. A null or empty role is 'unknown', a null text empty, null turns form a chunk of their own that is
    null, null conv_ids one conversation. A conversation with context roles alone gives no row. An empty table gives
    none either, other columns are ignored, and texts are rendered whole however long; a row grows with its turns' texts. Marks that
    a text holds itself are not escaped.
    """
    role = F.when(F.trim("role") == "", None).otherwise(F.col("role"))
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(role, F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    t = t.withColumn("chunk", F.floor(F.col("turn") / F.lit(turns_per_row)).cast("long"))
    chunks = t.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    speakers = t.where(~F.col("role").isin(*context_roles)).select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    r = chunks.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    p = F.col("perspective")
    r = r.withColumn("segments", F.transform("turns", lambda x: segment(x["role"], x["text"], p, context_roles)))
    r = r.withColumn("own", F.transform("turns", lambda x: x["role"] == p))
    r = r.withColumn("ends", F.aggregate("segments", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x)))))
    skip = len("<|assistant|>\n")
    spans = F.filter(F.transform("own", lambda o, i: F.when(o, F.concat((F.get("ends", i) + skip).cast("string"), F.lit(":"), F.get("ends", i + 1).cast("string")))), lambda x: x.isNotNull())
    lengths = F.transform("own", lambda o, i: F.when(o, F.get("ends", i + 1) - F.get("ends", i) - skip).otherwise(0))
    return r.select(
        "conv_id", "perspective", "chunk", F.size("turns").alias("n_turns"), F.array_join("segments", "").alias("text"),
        F.array_join(F.transform("own", lambda o: F.when(o, "1").otherwise("0")), "").alias("turn_mask"), F.array_join(spans, ",").alias("target_spans"),
        F.aggregate(lengths, F.lit(0), lambda a, x: a + x).cast("long").alias("n_target_chars"),
    )
