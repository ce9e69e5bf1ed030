"""Shuffle, cap and exact train / test split.

Rows are ordered by ``md5(seed:key)``; the order is cut into 16^d buckets by
the first ``d`` hex digits (uniform, so buckets are balanced whatever the
data). Per-bucket counts form a table of at most 16^d rows, a proven
bound, whose running sum gives every bucket's base rank; a window inside
each bucket gives the rest. One shuffle, exact sizes, no single-partition
window. The exact draw of a seeded numpy shuffle cannot be reproduced;
sizes, disjointness and completeness are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 1234  # fixed value: the reference's seed
TRAIN_FRACTION = 0.8


def sample_hash(key_cols: Sequence[str], seed: int = SEED) -> F.Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed: int = SEED, digits: int = 4) -> DataFrame:
    """Add ``shuffle_rank`` (0-based rank in hash order) and ``n_total``.

    The bucket table is a partial aggregate of at most 16^digits rows; the rows
    are shuffled once, to their bucket. More ``digits`` make smaller buckets
    and do not change the result.
    """
    h = sample_hash(key_cols, seed)
    d = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, digits))
    w = Window.partitionBy("_b").orderBy("_h", *key_cols)
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_cnt"))  # partial counts; lines stay out of it
    d = d.withColumn("_rn", F.row_number().over(w))
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # <= 16^digits rows
    wall = Window.partitionBy(F.lit(1))
    base = counts.select("_b", F.coalesce(F.sum("_cnt").over(wb), F.lit(0)).alias("_base"),
                         F.sum("_cnt").over(wall).alias("n_total"))
    j = d.join(F.broadcast(base), "_b")
    return (j.withColumn("shuffle_rank", (F.col("_base") + F.col("_rn") - 1).cast("bigint"))
             .drop("_h", "_b", "_base", "_rn"))


def n_keep(n_total: F.Column, frac: float) -> F.Column:
    """round(frac * n) as pandas ``sample(frac=...)`` takes it."""
    return F.floor(n_total * F.lit(frac) + F.lit(0.5)).cast("bigint")


def shuffle(df: DataFrame, key_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """Every row with its position in the shuffled order."""
    return hash_rank(df, key_cols, seed).drop("n_total")


def cap_sample(df: DataFrame, key_cols: Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """The first ``n`` rows of the shuffled order (``n`` is the feature, so the caller names it)."""
    return hash_rank(df, key_cols, seed).filter(F.col("shuffle_rank") < n).drop("n_total")


def split(df: DataFrame, key_cols: Sequence[str], frac: float = TRAIN_FRACTION,
          seed: int = SEED) -> DataFrame:
    """G1 + G2: ``split`` = train / test over all shuffled rows.

    train = the first round(frac * n) rows of the shuffle, test = the rest.
    To split a sample, apply ``cap_sample`` first.
    """
    r = hash_rank(df, key_cols, seed)
    return r.withColumn("split", F.when(F.col("shuffle_rank") < n_keep(F.col("n_total"), frac), "train").otherwise("test")).drop(
        "n_total")


def split_threshold(df: DataFrame, key_cols: Sequence[str], frac: float = TRAIN_FRACTION, seed: int = SEED, digits: int = 4) -> DataFrame:
    """G1, cheap mode: a split without ranks, in which no row moves.

    The quantile sketch is the histogram of the hashes' first ``digits`` hex digits (at
    most 16^digits counts, partial sums of which are all that is shuffled). train =
    every row whose hash lies in the bins up to the first one that brings the train rows
    to round(frac * n); so train exceeds that by less than one bin, about n / 16^digits
    rows (all rows of equal keys share a bin). The split of a row depends on its key and the threshold alone, so later rows
    can be split by the same threshold.
    """
    h = F.substring(sample_hash(key_cols, seed), 1, digits)
    bins = df.groupBy(h.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)  # <= 16^digits rows
    sums = bins.select("_b", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    wanted = n_keep(F.col("_total"), frac)
    row = sums.agg(F.min(F.when(F.col("_upto") >= wanted, F.col("_b"))).alias("b"), F.max(wanted).alias("n")).first()
    last = row.b if row.n else ""  # nothing sorts below it
    return df.withColumn("split", F.when(h <= F.lit(last), "train").otherwise("test"))
