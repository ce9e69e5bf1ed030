"""Longer chains started by quotes: whom a quote cites, and the chains of replies.

A quote cites the latest earlier post of its topic whose text holds the quote's
words one after the other. Quotes and texts are folded per topic first. A quote of
more than ``FRAGMENT`` words is looked up by the rarest of its fragments of that many
words (a shorter one by all its words), where a text gives the smallest hash of every
``WINDOW`` fragments in a row (fewer in topics with shorter quotes), and what that finds
is checked for the whole quote. Among the posts whose text passed, a running last value over (topic, quote)
picks the latest one before the quoting post; it runs per bucket of positions.

Every post has one parent, the post that its first resolved quote cites, and a
parent is an earlier post. Pointer jumping doubles what each post knows of its way
up in every round, so a chain of n replies takes log2(n) rounds, each a join and a
stage table; posts that have arrived take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import clean_text
from threadloom.operators.chains import TOPIC
from threadloom.operators.ranking import DEFAULT_BUCKET, hot_key_join, scan_last, with_bucket
from threadloom.session import materialize

FRAGMENT = 4
#: Fragments in a row of which a text gives one.
WINDOW = 8
#: What separates words here: the white space that Spark, Java and SQL engines agree on, and U+00A0.
SPACE = "[ \\t\\n\\x0B\\f\\r\\x{A0}]+"


def word_text(text: Column) -> Column:
    """The words of ``text``, joined by one space ('' for null)."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))


def _fragments(text: Column, size: Column, window: Column, topic) -> Column:
    """Distinct hashes, with the topic's, of the stretches of ``size`` words of a ``word_text``: of every ``window`` in a row the smallest.

    A text that holds a quote holds all the quote's windows, so it has the hashes
    that the quote has with the same or a wider window.
    """
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    stretches = lambda w: F.transform(upto(F.size(w) - size + 1), lambda i: F.xxhash64(*topic, F.slice(w, i, size)))
    smallest = lambda h: F.transform(upto(F.size(h) - window + 1), lambda i: F.array_min(F.slice(h, i, window)))
    # arrays of one element: a lambda's variable is computed once, a column inside a lambda for every element
    hashes = F.transform(F.array(F.split(text, " ")), stretches)
    return F.array_distinct(F.transform(hashes, lambda h: F.when(window > 1, smallest(h)).otherwise(h))[0])


def cited_texts(quotes: DataFrame, texts: DataFrame, topic=TOPIC, fragment: int = FRAGMENT) -> DataFrame:
    """The rows of ``texts`` ``(topic..., text, ...)`` with each of the distinct ``quotes`` ``(topic..., quote)`` that they hold, without ``text``.

    Both are ``word_text`` values and stage tables; a text may come in many rows. What is
    looked up are pairs of hashes, a row of two longs for a fragment; quotes and texts
    themselves meet only for what the rarest fragment finds, and decide there.
    """
    t = list(topic)
    words = F.size(F.split("quote", " "))
    size = F.least(words, F.lit(fragment))
    window = F.greatest(F.lit(1), F.least(words - size + 1, F.lit(WINDOW)))
    asked = quotes.where("quote <> ''").withColumn("_n", size).withColumn("_w", window)
    levels = asked.groupBy(*t, "_n").agg(F.min("_w").alias("_w"), F.count(F.lit(1)).alias("_asked"))
    levels = levels.groupBy(*t).agg(F.sum("_asked").alias("_weight"), F.sort_array(F.collect_list(F.struct("_n", "_w"))).alias("_levels"))  # at most ``fragment`` values
    asked = materialize(asked.select(F.xxhash64(*t, "quote").alias("_q"), F.explode(_fragments(F.col("quote"), F.col("_n"), F.col("_w"), t)).alias("_h")), "quote_fragments")
    mine = hot_key_join(texts.select(*t, "text").where("text <> ''").distinct(), materialize(levels, "fragment_levels"), t, "_weight")
    mine = mine.select(*t, F.xxhash64(*t, "text").alias("_t"), "text", F.explode("_levels").alias("_l"))
    mine = mine.select("_t", F.explode(_fragments(F.col("text"), F.col("_l._n"), F.col("_l._w"), t)).alias("_h"))
    found = materialize(mine.join(asked.select("_h").distinct(), "_h", "left_semi"), "found_fragments")
    spread = found.groupBy("_h").agg(F.count(F.lit(1)).alias("_df"))
    # the rarest fragment; a quote with a fragment that no text has cites none
    anchors = asked.join(spread, "_h", "left").groupBy("_q").agg(
        F.min(F.struct("_df", "_h"))["_h"].alias("_h"), F.count_if(F.col("_df").isNull()).alias("_missing"))
    pairs = materialize(anchors.where("_missing = 0").select("_q", "_h").join(found, "_h").select("_q", "_t").distinct(), "quotes_to_try")
    tried = pairs.join(quotes.select(*[F.col(c).alias(f"_q_{c}") for c in t], "quote", F.xxhash64(*t, "quote").alias("_q")), "_q").drop("_q")
    tried = tried.join(texts.withColumn("_t", F.xxhash64(*t, "text")), "_t")
    holds = F.contains(F.concat(F.lit(" "), "text", F.lit(" ")), F.concat(F.lit(" "), "quote", F.lit(" ")))
    for c in t:
        holds = holds & (F.col(c) == F.col(f"_q_{c}"))
    return tried.where(holds).select("quote", *[c for c in texts.columns if c != "text"])


def reply_links(posts: DataFrame, pairs: DataFrame, topic=TOPIC, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """Which post every quote cites: ``topic..., pos, k, cited_pos, reply``; quotes that cite no earlier post are absent.

    ``posts`` have ``topic..., pos, text``, ``pairs`` (``quotes.quote_pairs``)
    ``topic..., pos, k, speaker0_text, speaker1_text``; a pair's first text is the quote.
    """
    t = list(topic)
    said = materialize(pairs.select(*t, "pos", "k", word_text(F.col("speaker0_text")).alias("quote"), F.col("speaker1_text").alias("reply"))
                       .where("quote <> ''"), "quotes_said")
    texts = posts.join(said.select(*t).distinct(), t, "left_semi").select(*t, "pos", word_text(F.col("text")).alias("text"))
    texts = materialize(texts.where("text <> ''"), "texts_of_quoting_topics")
    places = cited_texts(materialize(said.select(*t, "quote").distinct(), "distinct_quotes"), texts, topic)
    # the latest post with such a text before the quoting post; a quote is known by its digest
    places = places.select(*t, F.md5("quote").alias("_q"), "pos", F.lit(1).alias("_o"), F.col("pos").alias("_at"), F.lit(None).cast("long").alias("k"),
                           F.lit(None).cast("string").alias("reply"))
    asks = said.select(*t, F.md5("quote").alias("_q"), "pos", F.lit(0).alias("_o"), F.lit(None).cast("long").alias("_at"), "k", "reply")
    events = materialize(with_bucket(places.unionByName(asks), "pos", bucket_size), "quote_events")
    cited = scan_last(events, [*t, "_q"], ["pos", "_o"], "_at", "cited_pos")
    return cited.where("_o = 0 AND cited_pos IS NOT NULL").select(*t, "pos", "k", "cited_pos", "reply")


def chain_roots(links: DataFrame, topic=TOPIC, max_rounds: int = 60) -> DataFrame:
    """``links`` ``(topic..., pos, parent)`` with ``root_pos`` and ``depth`` (replies from the root), by pointer jumping.

    One parent per post, earlier than the post. Not ending within ``max_rounds``
    (no chain is that long) raises instead of returning part of the chains.
    """
    t = list(topic)
    links = materialize(links.select(*t, "pos", "parent"), "reply_parents")
    cited = materialize(links.groupBy(*t, F.col("parent").alias("pos")).agg(F.count(F.lit(1)).alias("_w")), "cited_posts")
    own = links.select(*t, "pos", F.lit(True).alias("_linked"))
    tops = materialize(cited.join(own, [*t, "pos"], "left").select(*t, F.col("pos").alias("parent"), "_w", F.coalesce("_linked", F.lit(False)).alias("_more")), "cited_tops")
    state = hot_key_join(links, tops, [*t, "parent"], "_w").select(*t, "pos", "parent", F.col("parent").alias("root_pos"), F.lit(1).cast("long").alias("depth"), "_more")
    state = materialize(state, "chain_round")
    for _ in range(max_rounds):
        going = state.where("_more")
        if not going.limit(1).count():
            return state.select(*t, "pos", "parent", "root_pos", "depth")
        # what a post knows so far is one row; how many stand below it is the join's weight
        below = going.groupBy(*t, F.col("root_pos")).agg(F.count(F.lit(1)).alias("_w"))
        up = state.select(*t, F.col("pos").alias("root_pos"), F.col("root_pos").alias("_r"), F.col("depth").alias("_d"), F.col("_more").alias("_m"))
        up = materialize(below.join(up, [*t, "root_pos"]), "chain_ups")
        moved = hot_key_join(going.drop("_more"), up, [*t, "root_pos"], "_w").select(
            *t, "pos", "parent", F.col("_r").alias("root_pos"), (F.col("depth") + F.col("_d")).alias("depth"), F.col("_m").alias("_more"))
        state = materialize(state.where("NOT _more").unionByName(moved), "chain_round")
    raise RuntimeError(f"reply chains: still going up after {max_rounds} rounds")


def quote_chains(posts: DataFrame, pairs: DataFrame, topic=TOPIC, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """The chains of replies that quotes start, a row per post in them.

    ``topic..., root_pos, depth, pos, cited_pos, author_id, text``: depth 0 is the
    post that starts a chain, with its text (``clean_text``) and no ``cited_pos``; every
    other post has the reply to its first quote that cites a post. A chain from the root
    to any post is the way over ``cited_pos``. Posts that neither cite nor are cited are absent.
    """
    t = list(topic)
    links = materialize(reply_links(posts, pairs, topic, bucket_size), "reply_links")
    first = links.groupBy(*t, "pos").agg(F.min(F.struct("k", "cited_pos", "reply")).alias("_f"))
    first = materialize(first.select(*t, "pos", F.col("_f.cited_pos").alias("parent"), F.col("_f.reply").alias("reply")), "first_citations")
    walked = materialize(chain_roots(first, topic), "chains_walked")
    replies = walked.join(first.select(*t, "pos", "reply"), [*t, "pos"]).select(
        *t, "root_pos", "depth", "pos", F.col("parent").alias("cited_pos"), F.col("reply").alias("text"))
    authors = posts.select(*t, "pos", "author_id")
    replies = replies.join(authors, [*t, "pos"], "left")
    roots = walked.select(*t, F.col("root_pos").alias("pos")).distinct().join(posts.select(*t, "pos", "author_id", "text"), [*t, "pos"])
    roots = roots.select(*t, F.col("pos").alias("root_pos"), F.lit(0).cast("long").alias("depth"), "pos", F.lit(None).cast("long").alias("cited_pos"),
                         clean_text(F.col("text")).alias("text"), "author_id")
    cols = [*t, "root_pos", "depth", "pos", "cited_pos", "author_id", "text"]
    return replies.select(*cols).unionByName(roots.select(*cols))
