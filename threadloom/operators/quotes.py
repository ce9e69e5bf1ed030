"""Quote -> reply pairs inside a post body (three site rules).

The rule is picked by a substring of the post url, in this order: ``psy.su``
(site A), ``b17.ru`` (site B), ``psycheforum.ru`` (site C); other posts have
no quotes. Every pair text gets the whitespace map and the Unicode strip.

All three rules read one token table (one shuffle by post key); per-post
arrays are built by aggregates on that same partitioning and matched with
array functions (``array_position``, ``slice``, ``arrays_zip``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import clean_text, strip_ws
from threadloom.operators.html_tokens import html_tokens, inside, is_el
from threadloom.sources.tables import WROTE_MARKER

POST_KEY = ("source", "topic_id", "pos")

# ---------------------------------------------------------------------------
# Url markers that choose the rule, in dispatch order.
# ---------------------------------------------------------------------------
RULE_MARKERS = (("a", "psy.su"), ("b", "b17.ru"), ("c", "psycheforum.ru"))

_A_QUOTE, _A_BOX, _A_BODY = is_el("div", cls="quote"), is_el("div", cls="forum_quote"), is_el("div", cls="text")
_B_BODY, _B_QUOTE = is_el("td", cls="mes qq"), is_el("div", cls="quote")
_C_BODY, _C_QUOTE, _C_P = is_el("div", role="commentContent"), is_el("blockquote"), is_el("p")


def quote_rule(url_col="url") -> F.Column:
    """Rule letter chosen by url substring; null when no rule applies."""
    u = F.col(url_col)
    out = F.lit(None).cast("string")
    for letter, marker in reversed(RULE_MARKERS):
        out = F.when(F.instr(u, marker) > 0, F.lit(letter)).otherwise(out)
    return out


def quote_tokens(posts: DataFrame, key_cols: Sequence[str] = POST_KEY) -> DataFrame:
    """Token table of the posts that have a quote rule, with rule flags."""
    key = list(key_cols)
    # every rule needs a quote class or a blockquote tag; other posts are not tokenised
    p = posts.filter(F.instr(F.lower("html"), "quote") > 0)
    p = p.select(*key, quote_rule().alias("rule"), "html").filter(F.col("rule").isNotNull())
    t = html_tokens(p, key, keep_cols=["rule"], ancestors=2)
    is_text = F.col("kind") == "text"
    a = F.col("anc0"), F.col("anc1"), F.col("anc2")
    t = t.select(
        *key, "rule", "tpos", "kind", "text",
        # site A: direct text of quote box / of the body box
        (is_text & _A_QUOTE(a[0]) & _A_BOX(a[1]) & _A_BODY(a[2])).alias("a_quote"),
        (is_text & _A_BODY(a[0])).alias("a_reply"),
        "is_elem", "anc0", "anc1", "delta",
    )
    # site B / C: top-level quote boxes (direct children of the body box)
    t = t.withColumn("b_top_open", F.col("is_elem") & _B_QUOTE(F.col("anc0")) & _B_BODY(F.col("anc1")))
    t = t.withColumn("c_top_open", F.col("is_elem") & _C_QUOTE(F.col("anc0")) & _C_BODY(F.col("anc1")))
    w = Window.partitionBy(*key).orderBy("tpos").rowsBetween(Window.unboundedPreceding, 0)
    # open tag of a top-level quote -> its tpos; the close of that same
    # element (matched through anc0.tpos) -> -1; the last event wins.
    flags = {"b": "b_top_open", "c": "c_top_open"}
    t = t.withColumns({
        **{f"{site}_top_pos": F.last(F.when(F.col(flag), F.col("tpos")), ignorenulls=True).over(w) for site, flag in flags.items()},
        "in_b_body": inside(key, _B_BODY), "in_c_body": inside(key, _C_BODY), "in_p": inside(key, _C_P)})
    t = t.withColumns({
        f"{site}_qid": F.last(F.when(F.col(flag), F.col("tpos"))
                               .when((F.col("kind") == "close") & (F.col("delta") == -1)
                                     & (F.col("anc0")["tpos"] == F.col(f"{site}_top_pos")), F.lit(-1)),
                              ignorenulls=True).over(w) for site, flag in flags.items()})
    t = t.withColumn("stext", strip_ws(F.col("text")))
    return t


def _texts_of(arr_col: F.Column) -> F.Column:
    """Sort an array of (tpos, v) structs by tpos and keep v."""
    return F.transform(F.array_sort(arr_col), lambda x: x["v"])


def _coll(cond, value: str) -> F.Column:
    return F.collect_list(F.when(cond, F.struct(F.col("tpos"), F.col(value).alias("v"))))


def post_quote_arrays(t: DataFrame, key) -> DataFrame:
    """Per post: the text arrays every rule needs, from two aggregations.

    Level 1 groups tokens by (post, top-level quote); level 2 by post. Both
    reuse the token table's hash partitioning on the post key.
    """
    is_text = F.col("kind") == "text"
    qid = (F.when(F.col("rule") == "b", F.col("b_qid")).when(F.col("rule") == "c", F.col("c_qid")))
    t = t.withColumn("qid", F.coalesce(qid, F.lit(-1)))
    frag_b = is_text & (F.col("stext") != "") & (F.instr(F.col("stext"), WROTE_MARKER) == 0)
    frag_c = is_text & (F.col("in_p") > 0) & (F.col("stext") != "")
    body_b = is_text & (F.col("in_b_body") > 0) & (F.col("stext") != "")
    body_c = is_text & (F.col("in_c_body") > 0) & (F.col("in_p") > 0) & (F.col("stext") != "")
    rb, rc = F.col("rule") == "b", F.col("rule") == "c"
    l1 = (t.groupBy(*key, "rule", "qid")
           .agg(_coll((F.col("qid") >= 0) & ((rb & frag_b) | (rc & frag_c)), "stext").alias("frags"),
                _coll((rb & body_b) | (rc & body_c), "stext").alias("body"),
                _coll(F.col("a_quote"), "text").alias("aq"),
                _coll(F.col("a_reply"), "text").alias("ar"),
                F.max((rb & F.col("b_top_open")) | (rc & F.col("c_top_open"))).alias("is_top")))
    quote = F.struct(F.col("qid"), _texts_of(F.col("frags")).alias("frags"))
    return (l1.groupBy(*key, "rule")
              .agg(_texts_of(F.flatten(F.collect_list("body"))).alias("text_all"),
                   F.array_sort(F.collect_list(F.when(F.col("is_top") & (F.col("qid") >= 0), quote))).alias("quotes"),
                   _texts_of(F.flatten(F.collect_list("aq"))).alias("q"),
                   _texts_of(F.flatten(F.collect_list("ar"))).alias("r")))


def _pair(q: F.Column, r: F.Column) -> F.Column:
    return F.struct(clean_text(q).alias("speaker0_text"), clean_text(r).alias("speaker1_text"))


def _pairs_a() -> F.Column:
    """Q1: zip quote nodes with body nodes (a blank first body node is dropped
    when there are more body nodes than quotes); shorter list wins."""
    q, r = F.col("q"), F.col("r")
    nq, nr = F.size(q), F.size(r)
    r2 = F.when((nr > nq) & (strip_ws(F.try_element_at(r, F.lit(1))) == ""), F.slice(r, 2, nr)).otherwise(r)
    n = F.least(nq, F.size(r2))
    zipped = F.arrays_zip(F.slice(q, 1, n).alias("q"), F.slice(r2, 1, n).alias("r"))
    out = F.transform(zipped, lambda x: _pair(x["q"], x["r"]))
    return F.when((nq > 0) & (nr > 0), out).otherwise(F.array())


def _pairs_b() -> F.Column:
    """Q2: reply starts after the first body text equal to the quote's last
    fragment and ends before the next body text holding the marker."""
    text_all = F.col("text_all")
    quotes = F.filter(F.col("quotes"), lambda x: F.size(x["frags"]) > 0)

    def one(x):
        s = F.array_position(text_all, F.try_element_at(x["frags"], F.lit(-1)))
        tail = F.slice(text_all, s + 1, F.greatest(F.size(text_all) - s, F.lit(0)))
        m = F.array_position(F.transform(tail, lambda y: F.instr(y, WROTE_MARKER) > 0), True)
        reply = F.when(m == 0, tail).otherwise(F.slice(tail, 1, m - 1))
        return _pair(F.array_join(x["frags"], "\n"), F.array_join(reply, "\n"))
    return F.transform(quotes, one)


def _pairs_c() -> F.Column:
    """Q3: reply starts after the first body text containing the quote's last
    fragment (skipped if none or nothing follows) and ends before the first
    later text equal to the next quote's first fragment."""
    text_all = F.col("text_all")
    n_all = F.size(text_all)
    quotes = F.col("quotes")

    def annotate(x, i):
        nxt = F.try_element_at(F.try_element_at(quotes, i + 2)["frags"], F.lit(1))
        last = F.try_element_at(x["frags"], F.lit(-1))
        p = F.array_position(F.transform(text_all, lambda y: F.instr(y, last) > 0), True)
        return F.struct(x["frags"].alias("frags"), nxt.alias("nxt"), p.alias("p"))

    def one(x):
        tail = F.slice(text_all, x["p"] + 1, F.greatest(n_all - x["p"], F.lit(0)))
        e = F.coalesce(F.array_position(tail, x["nxt"]), F.lit(0))
        reply = F.when(e == 0, tail).otherwise(F.slice(tail, 1, e - 1))
        return _pair(F.array_join(x["frags"], "\n"), F.array_join(reply, "\n"))
    ann = F.transform(F.when(F.size(quotes) > 0, quotes).otherwise(F.array()), annotate)
    ok = F.filter(ann, lambda x: (F.size(x["frags"]) > 0) & (x["p"] > 0) & (x["p"] < n_all))
    return F.transform(ok, one)


def quote_pair_arrays(posts: DataFrame, key_cols: Sequence[str] = POST_KEY) -> DataFrame:
    """Per post with a quote rule: ``key..., rule, qpairs`` (array of pairs)."""
    key = list(key_cols)
    per_post = post_quote_arrays(quote_tokens(posts, key), key)
    pairs = (F.when(F.col("rule") == "a", _pairs_a()).when(F.col("rule") == "b", _pairs_b())
              .otherwise(_pairs_c()))
    return per_post.select(*key, "rule", pairs.alias("qpairs"))


def explode_pairs(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    out = df.select(*key_cols, F.posexplode("qpairs").alias("k", "pair"))
    return out.select(*key_cols, F.col("k").cast("bigint").alias("k"),
                      F.col("pair")["speaker0_text"].alias("speaker0_text"),
                      F.col("pair")["speaker1_text"].alias("speaker1_text"))


def quote_pairs(posts: DataFrame, key_cols: Sequence[str] = POST_KEY) -> DataFrame:
    """Q4: pairs of all three site rules -> ``key..., rule, k, speaker0_text, speaker1_text``.

    ``k`` numbers the pairs of one post in emission order.
    """
    key = list(key_cols)
    out = quote_pair_arrays(posts, key).select(*key, "rule", F.posexplode("qpairs").alias("k", "pair"))
    return out.select(*key, "rule", F.col("k").cast("bigint").alias("k"),
                      F.col("pair")["speaker0_text"].alias("speaker0_text"),
                      F.col("pair")["speaker1_text"].alias("speaker1_text"))


def quotes_site(posts: DataFrame, rule: str, key_cols: Sequence[str] = POST_KEY) -> DataFrame:
    """One site rule alone (Q1, Q2 or Q3)."""
    return quote_pairs(posts, key_cols).filter(F.col("rule") == rule).drop("rule")
