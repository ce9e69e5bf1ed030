"""Use of dates: gap sessions of a topic, and the latest question before an answer.

A topic may hold a third of all posts, so neither is a window over a topic's
posts: sessions are made of cells (the posts of a topic in one stretch of time
no longer than the gap are one session anyway), and the as-of match runs per
bucket of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.ranking import scan_last


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def topic_sessions(posts: DataFrame, topic: list[str], ts_col: str = "ts", gap_seconds: int = 1800) -> DataFrame:
    """Sessions of a topic: a post within ``gap_seconds`` of the one before it belongs to the same session.

    ``topic..., session`` (from 0), ``started, ended`` (first and last post),
    ``n_posts``. Posts without a time are in no session. Posts fold into cells of
    the gap's length first, so what is windowed per topic grows with the time a
    topic spans, not with its posts.
    """
    gap = gap_seconds * 1_000_000
    if gap <= 0:
        raise ValueError("the gap is a time longer than none")
    p = posts.select(*topic, micros(ts_col).alias("_t")).where("_t IS NOT NULL")
    cells = p.groupBy(*topic, F.floor(F.col("_t") / gap).alias("_cell")).agg(F.min("_t").alias("_a"), F.max("_t").alias("_b"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*topic).orderBy("_cell")
    begins = F.coalesce(F.col("_a") - F.lag("_b").over(w) > gap, F.lit(True))
    c = cells.withColumn("_new", begins.cast("long"))
    c = c.withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    s = c.groupBy(*topic, "session").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"), F.sum("_n").alias("n_posts"))
    return s.select(*topic, "session", F.timestamp_micros("_a").alias("started"), F.timestamp_micros("_b").alias("ended"), "n_posts")


def answers_as_of(posts: DataFrame, topic: list[str], is_question: Column, ts_col: str = "ts", id_col: str = "post_id",
                  within_seconds: int | None = None, bucket_seconds: int = 86_400) -> DataFrame:
    """Every answer with the latest question of its topic before it: ``topic..., id_col, question_id, waited`` (seconds).

    Order is time, then id; a question of the same time counts if its id is
    smaller. Without a question, or with one longer ago than ``within_seconds``, both
    are null. Posts without a time are left out; where ``is_question`` is null a post is an answer.
    """
    asks = F.coalesce(is_question, F.lit(False))
    p = posts.select(*topic, F.col(id_col).alias("_id"), micros(ts_col).alias("_t"), asks.alias("_asks")).where("_t IS NOT NULL")
    p = p.withColumn("_bk", F.floor(F.col("_t") / (bucket_seconds * 1_000_000)))
    p = p.withColumn("_q", F.when(F.col("_asks"), F.struct(F.col("_t").alias("at"), F.col("_id").alias("id"))))
    p = scan_last(p, topic, ["_t", "_id"], "_q", "_last").where("NOT _asks")
    waited = (F.col("_t") - F.col("_last.at")) / 1e6
    near = F.col("_last").isNotNull() if within_seconds is None else waited <= within_seconds
    return p.select(*topic, F.col("_id").alias(id_col), F.when(near, F.col("_last.id")).alias("question_id"), F.when(near, waited).alias("waited"))
