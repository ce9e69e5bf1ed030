"""Exact deduplication by progressive refinement: length, prefix hash, full hash.

Texts are equal when identical after white space ``[\\x20\\x09-\\x0D]`` is
deleted. The first scan keeps only a length and a prefix hash per row and
narrows them in two steps: lengths that occur twice, then (length, prefix
hash) pairs that occur twice. The second scan hashes the full content only
of rows whose pair survived, told apart by a bitmap of fixed size; rows the
bitmap lets through by chance end as groups of one. All of it is DataFrame
functions; no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, bit_place, bit_words, skew_join, stage

PREFIX_CHARS = 64
#: 64-bit words of the survivor bitmap (8M bits, about 2 MB as rows): a
#: constant, so the broadcast is bounded. A fuller bitmap only means that more
#: rows are hashed in full; the groups stay exact.
BITMAP_WORDS = 1 << 17


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, the ``carry`` columns, keep_id, group_size, kept.

    Of equal texts the row with the most code points in the original text
    stays, then the smallest id; a null id comes last, and of fully repeated
    rows exactly one stays. A null text counts as empty. ``carry`` maps names
    to narrow expressions over the input columns (evaluated in the second
    scan); other input columns are not touched, so clashing names are safe.
    """
    raw = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), raw.alias("_raw"), F.translate(raw, WS, "").alias("_norm"),
                       *[e.alias(f"_c_{k}") for k, e in (carry or {}).items()])
    keyed = base.withColumn("_len", F.length("_norm")).withColumn(
        "_ph", F.xxhash64(F.substring("_norm", 1, PREFIX_CHARS)))

    # step 1: lengths seen twice; step 2: (length, prefix hash) seen twice
    pairs = stage(keyed.groupBy("_len", "_ph").agg(F.count(F.lit(1)).alias("_n")), "exact-pairs")
    lengths = pairs.groupBy("_len").agg(F.sum("_n").alias("_m")).where("_m >= 2").select("_len")
    survivors = pairs.join(lengths, "_len", "left_semi").where("_n >= 2").select(F.xxhash64("_len", "_ph").alias("_h"))
    words = bit_words(survivors, "_h", BITMAP_WORDS)

    # step 3: full hash of the survivors only
    word, bit = bit_place(F.xxhash64("_len", "_ph"), BITMAP_WORDS)
    rows = (keyed.withColumn("_word", word).withColumn("_bit", bit)
            .join(F.broadcast(words), "_word", "left")
            .select("_id", *[f"_c_{k}" for k in (carry or {})], F.length("_raw").alias("_cp"),
                    F.when(F.expr("getbit(_bits, _bit) = 1"), F.sha2("_norm", 256)).alias("_sha"),
                    F.monotonically_increasing_id().alias("_row")))
    rows = stage(rows, "exact-rows")
    order = F.struct((-F.col("_cp")).alias("a"), F.col("_id").isNull().alias("b"), F.col("_id").alias("c"), F.col("_row").alias("d"))
    hashed = rows.where("_sha is not null")
    groups = stage(hashed.groupBy("_sha").agg(F.count(F.lit(1)).alias("_size"), F.min(order).alias("_best")), "exact-groups")
    grouped = skew_join(hashed, groups, ["_sha"], "_size").select(
        *[c for c in rows.columns if c != "_sha"], F.col("_best.c").alias("keep_id"),
        F.col("_size").alias("group_size"), (F.col("_row") == F.col("_best.d")).alias("kept"))
    single = rows.where("_sha is null").select(
        *[c for c in rows.columns if c != "_sha"], F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return grouped.unionByName(single).select(
        F.col("_id").alias(id_col), "keep_id", "group_size", "kept", *[F.col(f"_c_{k}").alias(k) for k in (carry or {})])
