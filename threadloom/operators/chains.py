"""Dialogue building: posts of a topic -> (question, answer) pairs.

Two variants over posts ordered by ``pos`` inside a topic
``(source, topic_id)``. A topic may hold a third of all posts, so nothing is
a window over a whole topic: ordered scans (first post, previous post,
running counters) run per ``(topic, pos bucket)`` with small per-bucket
summaries (``ranking``); segments and runs are aggregates on
``(topic, seg)`` / ``(topic, run)``; neighbours are found by joins on those
keys; the top-k answers filter gets a map-side partial limit. The segmented
posts and the runs are stage tables, read by several branches.

Variant 2, starter chain (the active one)
  * the topic starter is the author of the first post (D5);
  * quote posts leave the chain (D6); other posts with null / empty text
    are skipped; the rest are whitespace-mapped and stripped (D7);
  * a starter post opens a new segment iff the chain post before it was
    not by the starter (D8);
  * the question is the segment's starter texts, joined with no separator;
    the topic's first text is only stripped (D9);
  * one answer per other author: the first non-empty text, authors in
    order of first appearance, at most ``max_answers`` of them (D10, D11);
  * a segment is emitted when the starter posts again, so the last open
    segment is dropped unless ``flush_tail`` (D12);
  * ``emit_pos`` / ``emit_k`` record where the reference would emit (D13).

Variant 1, two speakers (D1-D4): first two distinct authors, merged runs
of each, run 2k paired with run 2k+1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import clean_text, normalize_ws, strip_ws
from threadloom.session import materialize
from threadloom.operators.ranking import DEFAULT_BUCKET, scan_first, scan_rank, scan_transitions, with_bucket

TOPIC = ("source", "topic_id")
# emit_pos of what is emitted when a topic ends: behind every post
END_OF_TOPIC = (1 << 63) - 1

def topic_starter(posts: DataFrame, topic=TOPIC, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """Add ``is_first`` and ``starter`` (author of the topic's first post)."""
    p = with_bucket(posts, "pos", bucket_size)
    p = scan_first(p, list(topic), "pos", "author_id", "starter")
    return p.withColumn("is_first", F.col("pos") == F.col("starter_pos")).drop("starter_pos")


def flag_posts(posts: DataFrame, quote_arrays: DataFrame | None = None, topic=TOPIC,
               bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """D5 + D6: posts (without html) with ``is_first``, ``starter`` and ``qpairs``.

    ``quote_arrays`` is ``quotes.quote_pair_arrays`` output (one row per post
    with a quote rule). Both the chain and the quote dialogue read this one
    DataFrame.
    """
    p = posts.select(*topic, "pos", "author_id", "text")
    if quote_arrays is not None:
        # stage table: posts with their quote pairs (read by both branches)
        p = materialize(p.join(quote_arrays.select(*topic, "pos", "qpairs"), [*topic, "pos"], "left"),
                        "posts_with_quotes")
    else:
        p = p.withColumn("qpairs", F.lit(None).cast(
            "array<struct<speaker0_text:string,speaker1_text:string>>"))
    return topic_starter(p, topic, bucket_size)


def chain_segments(flagged: DataFrame, topic=TOPIC) -> DataFrame:
    """D7 + D8: chain posts with ``iss`` (starter post), ``seg`` and ``ctext``.

    Posts with at least one quote pair leave the chain, except the first
    post, which is never checked for quotes. ``lag`` and the running segment
    count are bucketed scans, so a hot topic spreads over many tasks.
    """
    is_quote = F.coalesce(F.size("qpairs") > 0, F.lit(False))
    plain = ~is_quote & F.col("text").isNotNull() & (F.col("text") != "")
    c = flagged.filter(F.col("is_first") | plain)
    c = c.withColumn("iss", F.col("is_first") | F.coalesce(F.col("author_id") == F.col("starter"), F.lit(False)))
    # a break: a starter post right after a non-starter chain post (the
    # topic's first post is the first chain row, never a break)
    c = scan_transitions(c, list(topic), "pos", "iss", lambda prev, cur: cur & ~prev, "seg")
    ctext = F.when(F.col("is_first"), strip_ws(F.coalesce(F.col("text"), F.lit("")))).otherwise(clean_text(F.col("text")))
    return c.withColumn("ctext", ctext)


def segment_questions(segs: DataFrame, topic=TOPIC) -> DataFrame:
    """Question text per segment (starter texts, no separator) + its start.

    Two levels: texts are joined per (segment, pos bucket) first, then the
    bucket pieces per segment, so no step collects more than one bucket's
    posts or one piece per bucket.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col("pos"), F.col("ctext"))))
    part = (segs.filter("iss").groupBy(*topic, "seg", "_bk")
                .agg(F.min("pos").alias("p0"), F.array_join(F.transform(ordered, lambda x: x["ctext"]), "").alias("t")))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("p0"), F.col("t"))))
    return (part.groupBy(*topic, "seg")
                .agg(F.min("p0").alias("seg_start"),
                     F.array_join(F.transform(pieces, lambda x: x["t"]), "").alias("question")))


def first_answers(segs: DataFrame, max_answers: int | None = 5, topic=TOPIC, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """D10 + D11: first non-empty text per answering author, first ``max_answers``."""
    first_nonempty = F.min(F.when(F.col("ctext") != "", F.struct(F.col("pos"), F.col("ctext"))))
    a = (segs.filter(~F.col("iss")).groupBy(*topic, "seg", "author_id")
             .agg(F.min("pos").alias("first_pos"), first_nonempty.alias("fa")))
    a = a.select(*topic, "seg", "author_id", "first_pos",
                 F.coalesce(F.col("fa")["ctext"], F.lit("")).alias("answer"))
    if max_answers is None:
        # all authors of a segment, which may be most of a hot topic's: ranked per bucket of positions
        return scan_rank(with_bucket(a, "first_pos", bucket_size), [*topic, "seg"], ["first_pos"], "answer_k").drop("_bk")
    # a plain rank filter lets Spark add a partial (map-side) top-k
    w = Window.partitionBy(*topic, "seg").orderBy("first_pos")
    a = a.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_answers)
    return a.withColumn("answer_k", F.col("_rn") - 1).drop("_rn")


def dialog_starter_chain(posts: DataFrame, quote_arrays: DataFrame | None = None,
                         max_answers: int | None = 5, flush_tail: bool = False,
                         topic=TOPIC, flagged: DataFrame | None = None,
                         bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """Chain pairs ``source, topic_id, emit_pos, emit_k, kind, speaker0_text, speaker1_text``."""
    if flagged is None:
        flagged = flag_posts(posts, quote_arrays, topic, bucket_size)
    # stage table: segmented chain posts feed questions, answers and the
    # next-segment join
    segs = materialize(chain_segments(flagged, topic), "chain_segments")
    q = segment_questions(segs, topic)
    # the segment is emitted where the next one starts (a join on (topic, seg),
    # not a window over the whole topic)
    nxt = q.select(*topic, (F.col("seg") - 1).alias("seg"), F.col("seg_start").alias("emit_pos"))
    q = q.join(nxt, [*topic, "seg"], "inner" if not flush_tail else "left")
    a = first_answers(segs, max_answers, topic, bucket_size)
    pairs = q.join(a, [*topic, "seg"])
    return pairs.select(*topic, F.coalesce(F.col("emit_pos"), F.lit(END_OF_TOPIC)).cast("bigint").alias("emit_pos"),
                        F.col("answer_k").cast("bigint").alias("emit_k"), F.lit("chain").alias("kind"),
                        F.col("question").alias("speaker0_text"), F.col("answer").alias("speaker1_text"))


def quote_dialog(flagged: DataFrame, topic=TOPIC) -> DataFrame:
    """Quote pairs as dialogue rows, emitted at the quoting post (the first
    post of a topic is never checked for quotes)."""
    q = flagged.filter(~F.col("is_first") & (F.size(F.coalesce("qpairs", F.array())) > 0))
    q = q.select(*topic, "pos", F.posexplode("qpairs").alias("k", "pair"))
    return q.select(*topic, F.col("pos").cast("bigint").alias("emit_pos"), F.col("k").cast("bigint").alias("emit_k"),
                    F.lit("quote").alias("kind"), F.col("pair")["speaker0_text"].alias("speaker0_text"),
                    F.col("pair")["speaker1_text"].alias("speaker1_text"))


def dialog_pairs(posts: DataFrame, quote_arrays: DataFrame | None = None, max_answers: int | None = 5,
                 flush_tail: bool = False, topic=TOPIC, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """Variant 2 in full: chain pairs plus quote pairs."""
    flagged = flag_posts(posts, quote_arrays, topic, bucket_size)
    chain = dialog_starter_chain(posts, max_answers=max_answers, flush_tail=flush_tail, topic=topic,
                                 flagged=flagged)
    return chain.unionByName(quote_dialog(flagged, topic))


# ---------------------------------------------------------------------------
# Variant 1: two speakers
# ---------------------------------------------------------------------------

def first_two_speakers(posts: DataFrame, topic=TOPIC) -> DataFrame:
    """``speaker0`` (first author) and ``speaker1`` (next distinct, or null)."""
    firsts = posts.groupBy(*topic, "author_id").agg(F.min("pos").alias("first_pos"))
    w = Window.partitionBy(*topic).orderBy("first_pos")
    r = firsts.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= 2)
    return (r.groupBy(*topic)
             .agg(F.max(F.when(F.col("rk") == 1, F.struct(F.col("author_id")))).alias("s0"),
                  F.max(F.when(F.col("rk") == 2, F.struct(F.col("author_id")))).alias("s1"))
             .select(*topic, F.col("s0")["author_id"].alias("speaker0"),
                     F.col("s1")["author_id"].alias("speaker1")))


def speaker_runs(posts: DataFrame, topic=TOPIC, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """Merged runs of consecutive posts by one of the two speakers.

    Texts get the whitespace map but no strip; a run joins its texts with one
    space, except that no space is added while the run text is still empty.
    Null-text posts are dropped first; topics with one speaker yield nothing.
    The run number is a bucketed scan (``lag`` + running sum).
    """
    p = posts.filter(F.col("text").isNotNull()).select(*topic, "pos", "author_id", "text")
    sp = first_two_speakers(p, topic).filter(F.col("speaker1").isNotNull())
    # the speakers meet the posts per bucket of positions, so a hot topic's posts stay spread
    p = with_bucket(p, "pos", bucket_size)
    p = p.join(p.select(*topic, "_bk").distinct().join(sp, list(topic)), [*topic, "_bk"])
    # the first speaker may be null (a null author never equals anything)
    p = p.filter(F.col("author_id").eqNullSafe(F.col("speaker0")) | (F.col("author_id") == F.col("speaker1")))
    p = p.withColumn("spk", F.when(F.col("author_id").eqNullSafe(F.col("speaker0")), 0).otherwise(1))
    p = scan_transitions(p, list(topic), "pos", "spk", lambda prev, cur: cur != prev, "run")
    # two levels: per (run, pos bucket) the fold result and the plain join;
    # per run, a fold over the bucket pieces (one element per bucket)
    texts = F.transform(F.array_sort(F.collect_list(F.struct(F.col("pos"), normalize_ws(F.col("text")).alias("t")))),
                        lambda x: x["t"])
    fold = F.aggregate(texts, F.lit(""), lambda acc, x: F.when(acc == "", x).otherwise(F.concat(acc, F.lit(" "), x)))
    part = p.groupBy(*topic, "run", "_bk").agg(F.first("spk").alias("spk"), F.min("pos").alias("p0"),
                                              fold.alias("f"), F.array_join(texts, " ").alias("j"))
    pieces = F.array_sort(F.collect_list(F.struct(F.col("p0"), F.col("f"), F.col("j"))))
    merged = F.aggregate(pieces, F.lit(""), lambda acc, x: F.when(acc == "", x["f"]).otherwise(
        F.concat(acc, F.lit(" "), x["j"])))
    return (part.groupBy(*topic, "run").agg(F.first("spk").alias("spk"), F.min("p0").alias("run_pos"),
                                            merged.alias("run_text")))


def dialog_two_speaker(posts: DataFrame, topic=TOPIC, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """D3 + D4: pair run 2k (speaker 0) with run 2k+1 (speaker 1).

    A trailing speaker-0 run is dropped; the trailing speaker-1 run closes a
    pair only if its merged text is non-empty. The neighbouring runs come from
    joins on (topic, run), not from a window over the whole topic.
    """
    runs = materialize(speaker_runs(posts, topic, bucket_size), "speaker_runs")
    even = runs.filter(F.col("run") % 2 == 0)
    nxt = runs.select(*topic, (F.col("run") - 1).alias("run"), F.col("run_text").alias("next_text"))
    after = runs.select(*topic, (F.col("run") - 2).alias("run"), F.col("run_pos").alias("after_next"))
    r = even.join(nxt, [*topic, "run"]).join(after, [*topic, "run"], "left")
    ok = F.col("after_next").isNotNull() | (F.col("next_text") != "")
    return r.filter(ok).select(
        *topic, F.coalesce(F.col("after_next"), F.lit(END_OF_TOPIC)).cast("bigint").alias("emit_pos"),
        (F.col("run") / 2).cast("bigint").alias("emit_k"), F.lit("two_speaker").alias("kind"),
        F.col("run_text").alias("speaker0_text"), F.col("next_text").alias("speaker1_text"))
