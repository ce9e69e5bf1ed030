"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without leading and trailing ``[\\x20\\x09-\\x0D]``,
A-Z lower-cased, hashed with md5. Documents come in batches. Each batch counts
its line hashes, merge-anti-joins the runs of settled hashes (already known to
be in ``min_docs`` documents: nothing about them needs storing again) and adds
what is left as its own sorted run at level 0. ``fanout`` runs of a level are
compacted into one run of the next level; hashes that reach ``min_docs`` there
become settled. All DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WS, skew_join, stage

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 2


class LineRuns:
    """Sorted runs ``(h, n)`` by level, with n < min_docs, and settled runs with n >= min_docs."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.settled: list[DataFrame] = []

    def add(self, counts: DataFrame) -> None:
        """Merge-anti-join a batch's ``(h, n)`` with the settled runs and add the rest as a run."""
        for run in self.settled:
            counts = counts.join(run.select("h").hint("merge"), "h", "left_anti")
        self._write(counts, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _write(self, run: DataFrame, level: int) -> None:
        run = stage(run.sortWithinPartitions("h"), f"lines-L{level}")
        self.settled.append(run.where(F.col("n") >= self.min_docs))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run.where(F.col("n") < self.min_docs))

    def _compact(self, level: int) -> None:
        runs, self.levels[level] = self.levels[level], []
        merged = reduce(DataFrame.unionByName, runs).groupBy("h").agg(F.sum("n").alias("n"))
        self._write(merged, level + 1)

    def frequent(self) -> DataFrame:
        """``(h, n)`` of every hash in at least ``min_docs`` documents; n counts up to where it settled."""
        rest = [r for level in self.levels for r in level]
        if rest:
            total = reduce(DataFrame.unionByName, rest).groupBy("h").agg(F.sum("n").alias("n"))
            self.settled.append(total.where(F.col("n") >= self.min_docs))
        self.levels = [[]]
        return reduce(DataFrame.unionByName, self.settled).groupBy("h").agg(F.max("n").alias("n"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
               min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with n_lines, n_dropped, kept_text: lines in ``min_docs`` documents or more lose all copies.

    Every input row is a document, repeated rows too. A null or empty text is
    one empty line; empty keys (fewer than ``min_chars`` code points) always
    stay. When every line goes, kept_text is empty. Input columns
    pass through; one named like an output is replaced.
    """
    spark = docs.sparkSession
    # the input row travels as one struct, so no input name can clash with a working column
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"),
                      # a row is found again by (id, text hash): rows that share both have the same lines to drop
                      F.coalesce(F.col(id_col), F.lit(0)).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    lines = F.split("_text", "\n", -1)

    def key_hash(line):
        key = F.translate(F.btrim(line, F.lit(WS)), UPPER, LOWER)
        return F.when(F.length(key) >= min_chars, F.md5(key)).otherwise(F.lit(""))

    hashed = stage(src.select("_id", "_th", F.transform(lines, key_hash).alias("hs"))
                   .withColumn("batch", F.pmod(F.xxhash64("_id", "_th"), F.lit(batches))), "line-hashes")

    runs = LineRuns(spark, min_docs, fanout)
    for b in range(batches):
        mine = hashed.where(F.col("batch") == b).select(F.explode(F.array_distinct("hs")).alias("h")).where("h <> ''")
        runs.add(mine.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    frequent = stage(runs.frequent(), "lines-frequent")

    # positions of frequent lines per document; a very common line is a hot key
    at = hashed.select("_id", "_th", F.posexplode("hs").alias("pos", "h")).where("h <> ''")
    hits = (skew_join(at, frequent, ["h"], "n").groupBy("_id", "_th")
            .agg(F.sort_array(F.collect_set("pos")).alias("_pos")))
    out = src.join(hits, ["_id", "_th"], "left").withColumn("_lines", lines)
    # kept lines = the gaps between dropped positions, so long documents stay linear
    cuts = F.concat(F.array(F.lit(-1)), F.col("_pos"), F.array(F.size("_lines")))
    out = out.withColumn("_cuts", F.when(F.col("_pos").isNotNull(), cuts))
    gaps = F.transform(F.sequence(F.lit(1), F.size("_cuts") - 1),
                       lambda i: F.slice(F.col("_lines"), F.get("_cuts", i - 1) + 2, F.get("_cuts", i) - F.get("_cuts", i - 1) - 1))
    kept = F.when(F.col("_pos").isNull(), F.col("_text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    made = {"n_lines": F.size("_lines").cast("long"), "n_dropped": F.coalesce(F.size("_pos"), F.lit(0)).cast("long"), "kept_text": kept}
    return out.select(*[F.col(f"_in.`{c}`").alias(c) for c in docs.columns if c not in made], *[e.alias(k) for k, e in made.items()])
