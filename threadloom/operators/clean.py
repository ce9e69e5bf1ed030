"""Post cleaning: header rows, duplicate posts, blank posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import strip_ws


def drop_header_rows(posts: DataFrame) -> DataFrame:
    """Drop rows a resumed CSV export repeated as headers."""
    return posts.filter(F.coalesce(F.col("topic_id") != "topic_id", F.lit(True)))


def dedup_posts(posts: DataFrame, topic=("source", "topic_id")) -> DataFrame:
    """Keep the first post of every (topic, text); off in the default chain.

    Exact text equality. The first copy is found by a partial aggregate
    (``min(pos)`` per topic and text) and kept with a semi join on the post
    key, so a text copied a third of the time is still combined map-side.
    """
    firsts = posts.groupBy(*topic, "text").agg(F.min("pos").alias("pos")).select(*topic, "pos")
    return posts.join(firsts, [*topic, "pos"], "left_semi")


def drop_blank(posts: DataFrame) -> DataFrame:
    """Keep posts whose text is not blank."""
    return posts.filter(F.col("text").isNotNull() & (strip_ws(F.col("text")) != ""))
