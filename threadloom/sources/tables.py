"""Driver tables and the post tables built from them.

The engine works on a *posts* table (one row per forum post):

    source string, topic_id string, url string, author_id string,
    author_name string, text string, html string, pos bigint

``posts_from_conversations`` and ``posts_from_documents`` only reshape the
driver's test tables into that schema; they do none of the dialogue work.
The site of a conversation and whether a turn quotes the turn before it are
picked by the first hex digit of an md5, a rule the DuckDB oracle repeats
literally (see ``threadloom.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import hash_bucket_hex
from threadloom.operators.ranking import scan_lag, with_bucket

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

POST_COLUMNS = ["source", "topic_id", "url", "author_id", "author_name", "text", "html", "pos"]

# ---------------------------------------------------------------------------
# The four forum layouts and the quote-header marker ("wrote")
# that the site-B quote rule looks for.
# ---------------------------------------------------------------------------
SITE_SOURCES = ("psy_su", "b17_ru", "psycheforum_ru", "psyhelp24_org")
WROTE_MARKER = "писал(а)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def html_escape(col) -> F.Column:
    """Escape the three characters that would break markup, and write quotes
    and sharp s as character references."""
    for char, written in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("\u00df", "&#xDF;")):
        col = F.replace(col, F.lit(char), F.lit(written))
    return col


def _site_of(key_col) -> F.Column:
    h = hash_bucket_hex(key_col)
    return (F.when(h.isin("0", "1", "2", "3"), F.lit(SITE_SOURCES[0]))
            .when(h.isin("4", "5", "6", "7"), F.lit(SITE_SOURCES[1]))
            .when(h.isin("8", "9", "a", "b"), F.lit(SITE_SOURCES[2]))
            .otherwise(F.lit(SITE_SOURCES[3])))


def _topic_url(source, topic_id) -> F.Column:
    return (F.when(source == SITE_SOURCES[0],
                   F.concat(F.lit("https://psy.su/club/forum/topic/"), topic_id, F.lit("/")))
            .when(source == SITE_SOURCES[1],
                  F.concat(F.lit("https://www.b17.ru/forum/topic.php?id="), topic_id))
            .when(source == SITE_SOURCES[2],
                  F.concat(F.lit("https://psycheforum.ru/topic/"), topic_id, F.lit("-t/")))
            .otherwise(F.concat(F.lit("https://psyhelp24.org/psihologicheskaya-konsultatsiya-"),
                                topic_id, F.lit("/"))))


def _post_html(source, is_quote, left_open, quoted, quoted_author, reply) -> F.Column:
    """Post-body markup in the layout of each site, with or without a quote;
    ``left_open`` posts do not close a tag inside it."""
    q = html_escape(F.coalesce(quoted, F.lit("")))
    r = html_escape(F.coalesce(reply, F.lit("")))
    qa = F.coalesce(quoted_author, F.lit(""))
    b_tag = F.when(left_open, "<b>").otherwise("")
    a_q = F.concat(F.lit('<div class="text"><div class="forum_quote"><div class="quote">'), b_tag, q,
                   F.lit("</div></div>"), r, F.lit("</div>"))
    a_p = F.concat(F.lit('<div class="text">'), r, F.lit("</div>"))
    b_q = F.concat(F.lit('<td class="mes qq"><div class="quote"><b>'), qa,
                   F.lit(" " + WROTE_MARKER + ":</b>"), b_tag, q, F.lit("</div>"), r, F.lit("</td>"))
    b_p = F.concat(F.lit('<td class="mes qq">'), r, F.lit("</td>"))
    c_q = F.concat(F.lit('<div data-role="commentContent"><blockquote><p>'), q,
                   F.when(left_open, "").otherwise("</p>"), F.lit("</blockquote><p>"), r, F.lit("</p></div>"))
    c_p = F.concat(F.lit('<div data-role="commentContent"><p>'), r, F.lit("</p></div>"))
    d_p = F.concat(F.lit("<p>"), r, F.lit("</p>"))
    return (F.when(source == SITE_SOURCES[0], F.when(is_quote, a_q).otherwise(a_p))
            .when(source == SITE_SOURCES[1], F.when(is_quote, b_q).otherwise(b_p))
            .when(source == SITE_SOURCES[2], F.when(is_quote, c_q).otherwise(c_p))
            .otherwise(d_p))


def posts_from_conversations(conversations: DataFrame) -> DataFrame:
    """Posts with few authors: topic = conversation, author = role, pos = turn.

    A later turn quotes the turn right before it when the md5 digit of
    ``conv_id:turn`` is 0-4; its html then carries that quote in the site's
    layout, with a tag left open when the second digit is 0-3. Quote posts keep
    their own text in ``text``. The turn before is a bucketed scan, so a long
    conversation spreads over tasks.
    """
    c = with_bucket(conversations.select("conv_id", "turn", "role", "text"), "turn")
    c = scan_lag(c, ["conv_id"], "turn", {"text": "prev_text", "role": "prev_role"}).drop("_bk")
    topic = F.col("conv_id").cast("string")
    source = _site_of(topic)
    digits = F.md5(F.concat(topic, F.lit(":"), F.col("turn").cast("string")))
    is_quote = ((F.col("turn") > 0) & F.col("prev_text").isNotNull()
                & F.substring(digits, 1, 1).isin("0", "1", "2", "3", "4"))
    left_open = F.substring(digits, 2, 1).isin("0", "1", "2", "3")
    return c.select(
        source.alias("source"),
        topic.alias("topic_id"),
        _topic_url(source, topic).alias("url"),
        F.col("role").alias("author_id"),
        F.col("role").alias("author_name"),
        F.col("text"),
        _post_html(source, is_quote, left_open, F.col("prev_text"), F.col("prev_role"), F.col("text")).alias("html"),
        F.col("turn").cast("bigint").alias("pos"),
    )


def posts_from_documents(documents: DataFrame, topic_size: int = 25) -> DataFrame:
    """Posts with many authors: topic = doc_id // topic_size, author = source.

    These posts carry no quote markup (plain psyhelp24-style bodies), so
    they exercise the chain with up to 20 answerers per topic.
    """
    topic = F.floor(F.col("doc_id") / F.lit(topic_size)).cast("bigint").cast("string")
    return documents.select(
        F.lit("documents").alias("source"),
        topic.alias("topic_id"),
        F.concat(F.lit("https://docs.example/topic/"), topic).alias("url"),
        F.col("source").alias("author_id"),
        F.col("source").alias("author_name"),
        F.col("text"),
        F.concat(F.lit("<p>"), html_escape(F.coalesce(F.col("text"), F.lit(""))),
                 F.lit("</p>")).alias("html"),
        F.col("doc_id").cast("bigint").alias("pos"),
    )
