"""Data contracts on posts (K1-K3): counts, not assertions on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Required fields and the rows-per-page lower bounds per site.
# ---------------------------------------------------------------------------
REQUIRED_FIELDS = ("author_id", "author_name", "text", "topic_id", "url", "html")
EXPECTED_ROWS = (("psy_su", 20), ("b17_ru", 50), ("psycheforum_ru", 30), ("psyhelp24_org", 1))
# Block page: HTTP status, host and marker text of the ban page.
BLOCK_STATUS = 503
BLOCK_HOST = "b17.ru"
BLOCK_MARKER = "Доступ к сайту b17.ru для вашего IP адреса временно заблокирован"


def contract_fields(posts: DataFrame, fields=REQUIRED_FIELDS) -> DataFrame:
    """K1: per source, posts and the number missing each required field."""
    aggs = [F.count(F.lit(1)).alias("n_posts")]
    aggs += [F.count_if(F.col(f).isNull()).alias(f"missing_{f}") for f in fields]
    return posts.groupBy("source").agg(*aggs)


def contract_rows(posts: DataFrame, expected=EXPECTED_ROWS) -> DataFrame:
    """K2: rows per page url against the site's lower bound (small broadcast table)."""
    spark = posts.sparkSession
    exp = spark.createDataFrame(list(expected), "source string, expected bigint")
    per_page = posts.groupBy("source", "url").agg(F.count(F.lit(1)).alias("n_rows"))
    j = per_page.join(F.broadcast(exp), "source", "left")
    return j.select("source", "url", "n_rows", "expected",
                    F.coalesce(F.col("n_rows") >= F.col("expected"), F.lit(True)).alias("ok"))


def contract_follow_ups(next_links: DataFrame, expected: int = 1) -> DataFrame:
    """K2: pages (``url, next_href``) and their number of follow-up links against the lower bound."""
    n = F.col("next_href").isNotNull().cast("bigint")
    return next_links.select("url", n.alias("n_follow_ups"), (n >= expected).alias("ok"))


def blocked_pages(log: DataFrame) -> DataFrame:
    """K3: fetches that hit the ban page (status, host and marker must all match)."""
    hit = ((F.col("status") == BLOCK_STATUS) & (F.instr(F.col("url"), BLOCK_HOST) > 0)
           & (F.instr(F.col("body"), BLOCK_MARKER) > 0))
    return log.filter(hit)
