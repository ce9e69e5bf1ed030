"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import materialize
from threadloom.sources.tables import read_table

# The white space every operator's contract names, [\x20\x09-\x0D].
WS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A key is hot when it has at least 1/HOT_KEYS of all rows, so there are at
#: most HOT_KEYS hot keys: that is the proven bound of every hot-key broadcast.
HOT_KEYS = 1024


def workers_can_import(spark: SparkSession) -> None:
    """Put this package's folder on the Python workers' path, wherever the driver was started.

    Clusters without that folder get the package like any other library (--py-files).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back."""
    return materialize(df, f"llm-{name}")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of stages that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def skew_join(rows: DataFrame, per_key: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``per_key`` (one row per key) when one key may own a third of the rows.

    ``weight`` counts a key's rows. Keys with at least 1/HOT_KEYS of the
    summed weight (at most HOT_KEYS of them) are broadcast, so their rows
    stay where they are; the others go through an ordinary shuffle join.
    Both inputs are read twice: pass stage tables. Keys must not be null.
    """
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight).cast("double") * HOT_KEYS >= F.lit(float(total))
    hot = F.broadcast(per_key.where(is_hot))
    a = rows.join(hot, keys, "inner")
    b = rows.join(hot.select(*keys), keys, "left_anti").join(per_key.where(~is_hot), keys, how)
    return a.unionByName(b)


def skew_join_once(rows: DataFrame, per_key: DataFrame, key: str, weight: str, value: str, salt: str) -> DataFrame:
    """Inner join that adds ``value`` (not null) like ``skew_join``, reading ``rows`` once.

    Rows of hot keys get ``value`` from the broadcast and cross the shuffle
    under a salt of the ``salt`` column, spread out. ``per_key`` is read twice.
    """
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight).cast("double") * HOT_KEYS >= F.lit(float(total))
    hot = F.broadcast(per_key.where(is_hot).select(key, F.col(value).alias("_hot")))
    cold = per_key.where(~is_hot).select(key, F.lit(0).cast("long").alias("_salt"), F.col(value).alias("_cold"))
    spread = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(salt), F.lit(1 << 20)))
    joined = rows.join(hot, key, "left").withColumn("_salt", spread.cast("long")).join(cold, [key, "_salt"], "left")
    return joined.withColumn(value, F.coalesce("_hot", "_cold")).where(F.col(value).isNotNull()).drop("_hot", "_cold", "_salt")


def bit_words(keys: DataFrame, hash_col: str, n_words: int) -> DataFrame:
    """A bitmap of 64 * ``n_words`` bits, one row per 64-bit word that has a bit set.

    It answers "certainly not among these keys" for any number of keys in
    bounded space; whoever uses it checks the rest exactly.
    """
    word, bit = bit_place(F.col(hash_col), n_words)
    return (keys.select(word.alias("_word"), F.expr("1L").alias("_one"), bit.alias("_bit"))
            .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(_one, _bit)")).alias("_bits")))


def bit_place(h, n_words: int):
    """(word, bit) of a 64-bit hash in a bitmap of ``n_words`` words."""
    return F.pmod(h, F.lit(n_words)), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int")


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges`` ``(u, v)`` of longs; root = smallest node.

    Alternating large-star and small-star steps: every round is a partial
    aggregate and a join, written to a stage table. It ends when a round
    changes nothing; not ending within ``max_rounds`` (a graph would need a
    diameter in the billions) raises instead of returning a partial answer.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            sym = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            sym = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        m = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        j = sym.join(m, "u")
        if large:
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def sign(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    cur = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    last = sign(cur)
    for _ in range(max_rounds):
        if not last[0]:
            break
        cur = stage(star(star(cur, True), False), name)
        now = sign(cur)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"connected components: still changing after {max_rounds} rounds")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
