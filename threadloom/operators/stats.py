"""Corpus statistics (H1-H9) as aggregates; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.ranking import global_offsets


def topic_count(posts: DataFrame, salt_buckets: int = 64) -> DataFrame:
    """H1: distinct topics per source (exact).

    Distinct (source, topic) pairs are counted per (source, hash bucket) and
    then summed, so one source with most topics still spreads over tasks.
    """
    pairs = posts.select("source", "topic_id").distinct()
    salted = pairs.groupBy("source", F.pmod(F.xxhash64("topic_id"), F.lit(salt_buckets)).alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"))
    return salted.groupBy("source").agg(F.sum("_n").cast("bigint").alias("n_topics"))


def topic_yield(posts: DataFrame, pairs: DataFrame) -> DataFrame:
    """H2: posts and emitted pairs per topic; topics with no pair keep 0."""
    p = posts.groupBy("source", "topic_id").agg(F.count(F.lit(1)).alias("n_posts"))
    q = pairs.groupBy("source", "topic_id").agg(F.count(F.lit(1)).alias("n_pairs"))
    return (p.join(q, ["source", "topic_id"], "left")
             .select("source", "topic_id", "n_posts", F.coalesce("n_pairs", F.lit(0)).cast("bigint").alias("n_pairs")))


def topic_progress(posts: DataFrame) -> DataFrame:
    """H3: share of topics of a source processed before each topic, in topic order.

    Global rank by (source, topic_id) via R1; the per-source start rank comes
    from a per-source min (one row per source).
    """
    t = posts.select("source", "topic_id").distinct()
    ranked = global_offsets(t, ["source", "topic_id"], out_col="grank")
    per_src = ranked.groupBy("source").agg(F.min("grank").alias("start"), F.count(F.lit(1)).alias("n"))
    r = ranked.join(per_src, "source")
    idx = (F.col("grank") - F.col("start")).cast("bigint")
    return r.select("source", "topic_id", idx.alias("topic_index"), F.col("n").alias("n_topics"),
                    (idx / F.col("n")).alias("progress"))


def running_size(pairs: DataFrame) -> DataFrame:
    """H4: dataset size after each source (sources in name order).

    The window runs over the per-source counts, one row per source.
    """
    c = pairs.groupBy("source").agg(F.count(F.lit(1)).alias("n_lines"))
    w = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, 0)
    return c.withColumn("running_lines", F.sum("n_lines").over(w))


def profile(df: DataFrame) -> DataFrame:
    """H5: row count and non-null count of every column, one row."""
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count(F.col(c)).alias(f"nonnull_{c}") for c in df.columns]
    return df.agg(*aggs)


def split_sizes(split_df: DataFrame) -> DataFrame:
    """H6: rows per split."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def loss_table(events: DataFrame) -> DataFrame:
    """Stand-in loss log from ``events``: step = event_id + 1, loss = value / 100."""
    return events.select((F.col("event_id") + 1).alias("step"), (F.col("value") / 100.0).alias("loss"))


def perplexity(losses: DataFrame) -> DataFrame:
    """H7: exp of the plain mean of per-batch losses."""
    return losses.agg(F.round(F.exp(F.avg("loss")), 6).alias("perplexity"),
                      F.count(F.lit(1)).alias("n_batches"))


def loss_windows(losses: DataFrame, size: int = 500, full_only: bool = True) -> DataFrame:
    """H8: mean loss per window of ``size`` steps; the last, shorter window only without ``full_only``."""
    g = losses.groupBy(F.floor((F.col("step") - 1) / size).cast("bigint").alias("window"))
    out = g.agg(F.round(F.avg("loss"), 6).alias("mean_loss"), F.count(F.lit(1)).alias("n_steps"))
    return out.filter(F.col("n_steps") == size) if full_only else out


def harvest_rate(log: DataFrame, source_col: str = "source", ts_col: str = "ts", page_col: str = "page") -> DataFrame:
    """H9: items, distinct pages, seconds, items per second and pages per minute per source of a fetch log.

    Items are summed per (source, page) first, so a source with most items spreads over its pages.
    """
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    p = log.groupBy(F.col(source_col).alias("source"), F.col(page_col).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(us).alias("_a"), F.max(us).alias("_b"))
    g = p.groupBy("source").agg(F.sum("_n").alias("n_items"), F.count("_p").alias("n_pages"),
                                ((F.max("_b") - F.min("_a")) / 1e6).alias("seconds"))
    rate = lambda n: F.round(F.when(F.col("seconds") > 0, n / F.col("seconds")), 6)
    return g.withColumn("items_per_sec", rate(F.col("n_items"))).withColumn("pages_per_min", rate(F.col("n_pages") * 60))


def tail(df: DataFrame, order_cols, n: int = 5) -> DataFrame:
    """H5: the last ``n`` rows in ``order_cols`` order (a top-k: each task keeps
    its own last n, one task merges them)."""
    return df.orderBy(*[F.col(c).desc() for c in order_cols]).limit(n)


HLL_LG_K = 14  # 2^14 registers: a relative standard error of 0.8 %, at most some 16 kB a sketch


def topic_sketches(posts: DataFrame, lg_k: int = HLL_LG_K) -> DataFrame:
    """H1, approximate: one mergeable sketch of its topics per source (``source, sketch``), to be stored.

    Topics are sketched where they lie; what is shuffled is one sketch per task and source.
    """
    topic = F.coalesce(F.col("topic_id").cast("string"), F.lit(""))
    return posts.groupBy("source").agg(F.hll_sketch_agg(topic, F.lit(lg_k)).alias("sketch"))


def merge_sketches(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The sketches of old and new posts together, from the stored ones and those of the new file: no old post is read."""
    both = stored.unionByName(new)
    return both.groupBy("source").agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch"))


def sketched_topic_count(sketches: DataFrame) -> DataFrame:
    """``source, n_topics`` as the sketches estimate it."""
    return sketches.select("source", F.hll_sketch_estimate("sketch").alias("n_topics"))


def yield_rollup(lines: DataFrame, by=("source", "len1", "kind")) -> DataFrame:
    """H2 rolled up: lines per ``by`` columns and per prefix of them, with ``level`` (Spark's grouping_id) telling them apart.

    A null in a column of ``level`` 0 is the data's; in a rolled-up column it
    stands for all. The finest counts are made first, so the rollup expands counts, not lines.
    """
    fine = lines.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.length("line")).alias("_c"))
    return fine.rollup(*by).agg(F.grouping_id().cast("long").alias("level"), F.sum("_n").alias("n_lines"), F.sum("_c").alias("n_chars"))
