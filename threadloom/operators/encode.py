"""Encoding: pairs -> training lines, chat turns -> prompts, replies.

Line format (fixed by the reference, no escaping of ``|``):
``|0|<len0>|<text0>|1|<len1>|<text1>``; prompt pieces are
``|<speaker>|<len>|<text>`` followed by ``|1|<wanted length>|``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import length_code, token_count
from threadloom.operators.ranking import scan_rank, with_bucket

# ---------------------------------------------------------------------------
# Speaker codes of chat turns (user 0, bot 1; system dropped)
# ---------------------------------------------------------------------------
SPEAKER_CODES = (("user", 0), ("assistant", 1))


def encode_pairs(pairs: DataFrame, bounds=(15, 50, 256)) -> DataFrame:
    """F1 + F2 + F3: add ``len0``, ``len1`` and the encoded ``line``."""
    l0 = length_code(token_count(F.col("speaker0_text")), bounds)
    l1 = length_code(token_count(F.col("speaker1_text")), bounds)
    out = pairs.withColumn("len0", l0).withColumn("len1", l1)
    return out.withColumn("line", F.concat(F.lit("|0|"), F.col("len0"), F.lit("|"), F.col("speaker0_text"),
                                           F.lit("|1|"), F.col("len1"), F.lit("|"), F.col("speaker1_text")))


def chat_turns(conversations: DataFrame, keep_system: bool = False) -> DataFrame:
    """Conversation turns with a speaker code; system turns are dropped, or kept with a null code."""
    spk = F.lit(None).cast("int")
    for role, code in reversed(SPEAKER_CODES):
        spk = F.when(F.col("role") == role, F.lit(code)).otherwise(spk)
    turns = conversations.select("conv_id", "turn", spk.alias("speaker"), "text")
    return turns if keep_system else turns.filter(F.col("speaker").isNotNull())


def _piece(use_length: bool) -> F.Column:
    ln = length_code(token_count(F.coalesce(F.col("text"), F.lit("")))) if use_length else F.lit("-")
    return F.concat(F.lit("|"), F.col("speaker").cast("string"), F.lit("|"), ln, F.lit("|"),
                    F.coalesce(F.col("text"), F.lit("")))


def prompts(turns: DataFrame, history: int | None = 5, wanted_length: str = "-",
            use_length: bool = True, bucket_size: int = 1 << 16, full_bucket: int = 512) -> DataFrame:
    """Prompt for every user turn from the last ``history`` turns.

    F5 (bounded history): each turn's rank in its conversation comes from a
    bucketed scan; rows are then grouped in rank buckets of ``bucket_size``
    and the last ``history - 1`` rows of every bucket are copied into the
    next one (a halo), so the sliding window never spans more than one
    (conversation, bucket) partition and a long conversation spreads over
    tasks. ``history=None`` uses the whole conversation so far (F6): what
    earlier buckets of ``full_bucket`` turns said is one text per bucket, put in
    front of the bucket's own turns; the output grows with the square of
    a conversation's length by definition, but not in one task.
    """
    ending = F.lit("|1|" + wanted_length + "|")
    t = with_bucket(turns.withColumn("piece", _piece(use_length)), "turn", 1 << 20)
    t = scan_rank(t, ["conv_id"], ["turn"], "_r").drop("_bk")
    said = lambda c: F.array_join(F.transform(c, lambda x: x["piece"]), "")
    if history is None:
        t = t.withColumn("_b", F.floor(F.col("_r") / full_bucket).cast("bigint"))
        whole = t.groupBy("conv_id", "_b").agg(said(F.array_sort(F.collect_list(F.struct("_r", "piece")))).alias("_text"))
        earlier = Window.partitionBy("conv_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        whole = whole.select("conv_id", "_b", F.array_join(F.collect_list("_text").over(earlier), "").alias("_before"))
        w = Window.partitionBy("conv_id", "_b").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
        t = t.withColumn("_own", F.array_join(F.collect_list("piece").over(w), "")).filter(F.col("speaker") == 0)
        return t.join(whole, ["conv_id", "_b"]).select("conv_id", "turn", F.concat("_before", "_own", ending).alias("prompt"))
    assert bucket_size >= history
    t = t.withColumn("_b", F.floor(F.col("_r") / bucket_size).cast("bigint"))
    halo = (F.col("_r") % bucket_size) >= (bucket_size - (history - 1))
    t = t.withColumn("_copies", F.when(halo, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    t = t.select("*", F.explode("_copies").alias("_halo"))
    t = t.withColumn("_b", F.col("_b") + F.col("_halo").cast("bigint"))
    w = Window.partitionBy("conv_id", "_b").orderBy("_r").rowsBetween(-(history - 1), 0)
    t = t.withColumn("prompt", F.concat(said(F.array_sort(F.collect_list(F.struct(F.col("_r"), F.col("piece"))).over(w))), ending))
    return t.filter(~F.col("_halo") & (F.col("speaker") == 0)).select("conv_id", "turn", "prompt")


def parse_reply(col) -> F.Column:
    """the text after the last ``|``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.element_at(F.split(c, r"\|"), -1)


def pick_reply(outputs) -> tuple[F.Column, F.Column]:
    """F8: first output is the reply kept as history, the rest alternatives."""
    c = F.col(outputs) if isinstance(outputs, str) else outputs
    return F.get(c, 0), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
