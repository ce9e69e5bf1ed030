"""HTML as a token table, with structure answered by window functions.

``html_tokens`` turns every document (page or post body) into rows
``(key..., tpos, tok, kind, tag, cls, eid, role, href, text, d_before, lvl)``
plus ``anc0 .. ancR``: the open-tag descriptors of the token's enclosing
elements (anc0 = parent for text / close tokens, the element itself for an
open token; anc1 = one level up, ...).

How structure is computed, with one shuffle of whole documents by key
(before tokenising, so the shuffle moves markup, not token rows):

* every close tag is matched with the last unmatched open tag of its own name
  (running sums per document and tag); a close without a partner is ignored.
  With ``repair`` (all tags counted) an open tag without a partner ends where
  its container does - ``p`` also at the next block, ``li`` at the next ``li`` -
  by a close row put in front of that token; an inline tag without a partner,
  or one whose pair crosses a container, has no effect;
* depth is a running sum of +1 / -1 over the matched open / close tags (T2);
* the ancestor at level k of a token is the last open tag at level k before
  it (exact for well-formed regions). A window partitioned by
  ``(key, level)`` yields it; level-shifted copies of the open rows
  (``explode(0..R)``) bring ancestors 1..R levels up into the same window
  partition, so all of them come out of one sort (T3-T9 build on this);
* every later window / aggregate partitions by the document key plus
  something else, so Spark reuses the same hash partitioning; with ``repair`` one
  more shuffle, of tokens, parts the matching from what follows (two stages).

Only tags in ``count_tags`` move the depth (all non-void tags by default);
page-level extraction passes the set of reliably closed containers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.references import decode_references

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr")
# Containers that are always closed in the pages we read (p, b, li are not).
PAGE_CONTAINERS = ("html", "body", "div", "td", "tr", "table", "tbody", "thead", "blockquote",
                   "article", "nav", "ul", "ol", "h1", "h2", "h3", "strong", "span", "a", "em",
                   "header", "footer", "section", "main", "title", "head")
# Inline tags: left open they change nothing. ``p`` and ``li`` may be left open.
INLINE_TAGS = ("a", "abbr", "b", "big", "cite", "code", "em", "font", "i", "mark", "s", "small", "span",
               "strike", "strong", "sub", "sup", "tt", "u")
SOFT_TAGS = (*INLINE_TAGS, "p", "li")
# A tag starts with '<' and a letter, '/', '!' or '?'; quoted attribute values
# may hold '>'. Any other '<' is text on its own. The possessive runs keep the scan of a
# long or unclosed tag off the stack.
TAG_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
TOKEN_PATTERN = r"<[A-Za-z/!?]" + TAG_REST + r"|[^<]++|<"
TEXT_PATTERN = r"[^<]++|<"
TAG_START = r"^<[A-Za-z/!?]"
DROP_PATTERN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def attr_pattern(name: str) -> str:
    """Attribute ``name`` with a double-quoted, single-quoted or bare value."""
    return r"""(?i)\s""" + name + r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))"""


def attr(tok: Column, name: str) -> Column:
    """T5: value of attribute ``name`` in an open-tag token ('' if absent)."""
    pat = attr_pattern(name)
    return F.concat(F.regexp_extract(tok, pat, 1), F.regexp_extract(tok, pat, 2), F.regexp_extract(tok, pat, 3))


def decode_entities(text: Column) -> Column:
    """Decode the character references of a text."""
    return decode_references(text)


def tag_part(html: Column) -> tuple[Column, Column]:
    """``html`` up to its last '>' and from there on: no tag ends in the second part, so nothing in it needs a scan for one."""
    n = F.instr(F.reverse(html), ">")
    head = F.when(n == 0, F.lit("")).otherwise(F.substr(html, F.lit(1), F.length(html) - n + 1))
    return head, F.when(n == 0, html).otherwise(F.substr(html, F.length(html) - n + 2))


def split_tokens(head: Column, tail: Column) -> Column:
    """Tags and texts of a document's ``tag_part`` in order."""
    return F.concat(F.regexp_extract_all(head, F.lit(TOKEN_PATTERN), F.lit(0)), F.regexp_extract_all(tail, F.lit(TEXT_PATTERN), F.lit(0)))


def _desc(prefix: str = "") -> Column:
    return F.struct(F.col("tpos"), F.col("tag"), F.col("cls"), F.col("eid"), F.col("role"))


def html_tokens(df: DataFrame, key_cols: Sequence[str], html_col: str = "html",
                count_tags: Sequence[str] | None = None, ancestors: int = 3,
                keep_cols: Sequence[str] = ()) -> DataFrame:
    """T1 + T2 + ancestor descriptors (see module doc)."""
    key_cols = list(key_cols)
    cleaned = F.regexp_replace(F.col(html_col), DROP_PATTERN, "")
    # shuffle whole documents by key, then explode: every token window below
    # partitions by the key (plus more), so it needs no exchange, and the
    # shuffle moves the raw markup instead of ~100 token rows per document
    # (a fixed number: token work is far heavier than the markup's bytes, by
    # which adaptive execution would merge the partitions)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # columns of their own: a generator would compute them anew wherever it names them
    df = df.select(*key_cols, *keep_cols, cleaned.alias("_markup")).repartition(parts, *key_cols)
    head, tail = tag_part(F.col("_markup"))
    df = df.select(*key_cols, *keep_cols, head.alias("_head"), tail.alias("_tail"))
    base = df.select(*key_cols, *keep_cols,
                     F.posexplode(split_tokens(F.col("_head"), F.col("_tail"))).alias("tpos", "tok"))
    is_tag = F.col("tok").rlike(TAG_START)
    tag = F.lower(F.regexp_extract("tok", r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
    t = base.select(
        *key_cols, *keep_cols, "tpos", "tok",
        F.when(~is_tag, F.lit("text"))
         .when(F.col("tok").startswith("</"), F.lit("close"))
         .when(F.col("tok").rlike(r"^<[A-Za-z]"), F.lit("open"))
         .otherwise(F.lit("other")).alias("kind"),
        F.when(is_tag, tag).otherwise(F.lit("")).alias("tag"),
    )
    counted = F.col("tag").isin(*count_tags) if count_tags else ~F.col("tag").isin(*VOID_TAGS)
    counted = counted & (F.col("tag") != "")
    sign = (F.when((F.col("kind") == "open") & counted, 1)
             .when((F.col("kind") == "close") & counted, -1).otherwise(0))
    t = matched_tags(t.withColumn("sign", sign), key_cols, repair=count_tags is None)
    if count_tags is None:
        # a stage of its own: with the repair's windows and what follows in one, every task
        # compiles its classes anew, as there are more than Spark keeps (Spark leaves out a
        # shuffle into the partitions it has, so there is one more)
        t = t.repartition(parts + 1, *key_cols)
    t = t.select("*",
                 F.when(F.col("kind") == "open", attr(F.col("tok"), "class")).otherwise("").alias("cls"),
                 F.when(F.col("kind") == "open", attr(F.col("tok"), "id")).otherwise("").alias("eid"),
                 F.when(F.col("kind") == "open", attr(F.col("tok"), "data-role")).otherwise("").alias("role"),
                 F.when(F.col("kind") == "text", decode_entities(F.col("tok"))).alias("text"))
    w_doc = Window.partitionBy(*key_cols).orderBy("tpos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("d_after", F.sum("delta").over(w_doc))
    t = t.withColumn("d_before", F.col("d_after") - F.col("delta"))
    is_open = (F.col("kind") == "open") & (F.col("delta") == 1)
    # level an element's open/close and its direct text share
    t = t.withColumn("lvl", F.when(is_open, F.col("d_after")).otherwise(F.col("d_before")))
    t = t.withColumn("is_elem", is_open)
    shifts = F.when(F.col("is_elem"), F.sequence(F.lit(0), F.lit(ancestors))).otherwise(F.array(F.lit(0)))
    s = t.select("*", F.explode(shifts).alias("sh"))
    s = s.withColumn("akey", F.col("lvl") + F.col("sh"))
    # the copies only bring their descriptor; their markup need not be sorted along
    s = s.withColumns({c: F.when(F.col("sh") == 0, F.col(c)) for c in ("tok", "text")})
    w_lvl = (Window.partitionBy(*key_cols, "akey").orderBy("tpos", F.col("sh").desc())
             .rowsBetween(Window.unboundedPreceding, 0))
    anc = [F.last(F.when(F.col("is_elem") & (F.col("sh") == r), _desc()), ignorenulls=True)
           .over(w_lvl).alias(f"anc{r}") for r in range(ancestors + 1)]
    # a close token's anc0 is the element it closes (its parent is anc1)
    return s.select("*", *anc).filter(F.col("sh") == 0).drop("sh", "akey")


# Token positions leave room for the close rows that ``repair`` puts in front of a token.
POS_STEP = 1 << 20


def matched_tags(t: DataFrame, key_cols: Sequence[str], repair: bool) -> DataFrame:
    """Replace ``sign`` by ``delta`` (+1 / -1 for matched tags, else 0) and ``tpos`` by ``tpos * POS_STEP``.

    With ``repair`` unmatched block, ``p`` and ``li`` tags become elements too
    and get a close row (empty ``tok``). All windows partition by the document
    key plus more.
    """
    key = list(key_cols)
    w_name = Window.partitionBy(*key, "tag").orderBy("tpos")
    w_doc = Window.partitionBy(*key).orderBy("tpos")
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    # what follows a row is read backwards: a frame that ends at the partition's end would be computed anew for every row
    after = lambda *by: Window.partitionBy(*key, *by).orderBy(F.desc("tpos")).rowsBetween(Window.unboundedPreceding, -1)
    following = lambda c, *by: F.last(c, ignorenulls=True).over(after(*by))
    is_open, is_close = F.col("sign") == 1, F.col("sign") == -1
    inline, soft = F.col("tag").isin(*INLINE_TAGS), F.col("tag").isin(*SOFT_TAGS)
    # brackets of one name: closes below zero have no partner, opens that are never undercut have none
    t = t.withColumn("_s", F.sum("sign").over(so_far(w_name)))
    t = t.withColumn("_m", F.least(F.lit(0), F.min("_s").over(so_far(w_name))))
    t = t.withColumn("_d", F.col("_s") - F.col("_m"))
    stray = is_close & (F.col("_m") < F.lag("_m", 1, 0).over(w_name))
    loose = is_open & (F.coalesce(F.min("_d").over(after("tag")), F.col("_d")) >= F.col("_d"))
    if repair:  # p does not nest
        p = F.col("tag") == "p"
        stray = F.when(p, is_close & (F.coalesce(F.lag("sign").over(w_name), F.lit(-1)) == -1)).otherwise(stray)
        loose = F.when(p, is_open & (F.coalesce(F.lead("sign").over(w_name), F.lit(1)) == 1)).otherwise(loose)
    t = t.withColumn("_firm", (F.col("sign") != 0) & ~stray & ~loose)
    if repair:
        # a soft pair must open and close at the same depth of firm containers
        t = t.withColumn("_cd", F.sum(F.when(F.col("_firm") & ~soft, F.col("sign")).otherwise(0)).over(so_far(w_doc)))
        w_pair = Window.partitionBy(*key, "tag", "_firm", "_lv").orderBy("tpos")
        t = t.withColumn("_lv", F.when(p, F.lit(0)).when(is_open, F.col("_d")).otherwise(F.col("_d") + 1))
        partner = F.when(is_open, F.lead("_cd").over(w_pair)).otherwise(F.lag("_cd").over(w_pair))
        crosses = F.col("_firm") & soft & (partner != F.col("_cd"))
        t = t.withColumn("_firm", F.col("_firm") & ~F.coalesce(crosses, F.lit(False)))
    t = t.withColumn("delta", F.when(F.col("_firm"), F.col("sign")).otherwise(0))
    if repair:
        t = t.withColumn("_open", is_open & ~F.col("_firm") & ~inline)  # elements without an end of their own
        t = t.withColumn("_df", F.sum("delta").over(so_far(w_doc)))
        t = t.withColumn("_at", F.when(F.col("delta") == -1, F.col("_df") + 1).otherwise(F.col("_df")))
        ends = F.least(following(F.when(F.col("delta") == -1, F.col("tpos")), "_at"),
                       F.when(p, following(F.when(is_open & ~inline, F.col("tpos"))))
                        .when(F.col("tag") == "li", following(F.when(is_open, F.col("tpos")), "_at", "tag")))
        t = t.withColumn("_end", F.when(F.col("_open"), F.coalesce(ends, F.lit(1 << 30))))
        t = t.withColumn("_nth", F.row_number().over(Window.partitionBy(*key, "_end").orderBy("tpos")))
        t = t.withColumn("_copy", F.explode(F.when(F.col("_open"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        made = F.col("_copy") == 1
        t = (t.withColumn("delta", F.when(made, -1).when(F.col("_open"), 1).otherwise(F.col("delta")))
              .withColumn("kind", F.when(made, F.lit("close")).otherwise(F.col("kind")))
              .withColumn("tok", F.when(made, F.lit("")).otherwise(F.col("tok")))
              .withColumn("tpos", F.when(made, F.col("_end").cast("long") * POS_STEP - F.col("_nth"))
                          .otherwise(F.col("tpos").cast("long") * POS_STEP)))
    else:
        t = t.withColumn("tpos", F.col("tpos").cast("long") * POS_STEP)
    return t.drop("sign", "_s", "_m", "_d", "_firm", "_cd", "_lv", "_open", "_df", "_at", "_end", "_nth", "_copy")


def token_no(tpos: Column) -> Column:
    """The number of a token in its document."""
    return F.floor(tpos / POS_STEP).cast("bigint")


def inside(key_cols: Sequence[str], pred) -> Column:
    """Number of open elements matching ``pred(desc)`` that enclose a token.

    ``pred`` is a function of an element descriptor column (a struct with
    tag, cls, eid, role). Positive means "descendant of such an element".
    """
    w = Window.partitionBy(*key_cols).orderBy("tpos").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.col("is_elem") & pred(F.col("anc0"))
    closed = (F.col("kind") == "close") & (F.col("delta") == -1) & pred(F.col("anc0"))
    step = F.when(opened, 1).when(closed, -1).otherwise(0)
    # an element's own open tag is not inside it
    return F.sum(step).over(w) - F.when(opened, 1).otherwise(0)


def current_element(key_cols: Sequence[str], pred) -> Column:
    """tpos of the innermost-opened, still-open element matching ``pred``.

    Valid for elements that do not nest inside each other (e.g. top-level
    quote boxes); -1 / null when the token is outside all of them.
    """
    w = Window.partitionBy(*key_cols).orderBy("tpos").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.col("is_elem") & pred(F.col("anc0"))
    closed = (F.col("kind") == "close") & (F.col("delta") == -1) & pred(F.col("anc0"))
    ev = F.when(opened, F.col("tpos")).when(closed, F.lit(-1))
    cur = F.last(ev, ignorenulls=True).over(w)
    return F.when(opened, F.lit(-1)).otherwise(cur)


def has_class(cls: Column, wanted: str) -> Column:
    """``wanted`` is one of the space-separated classes, in any place."""
    return F.array_contains(F.split(cls, r"\s+"), wanted)


def is_el(tag: str, cls: str | None = None, role: str | None = None, eid: str | None = None, part: str | None = None):
    """Element predicate for a descriptor struct (T7): class tokens (all of
    them), a part of the class attribute, data-role, id."""
    def pred(d: Column) -> Column:
        c = d["tag"] == tag
        for one in (cls or "").split():
            c = c & has_class(d["cls"], one)
        if part is not None:
            c = c & (F.instr(d["cls"], part) > 0)
        if role is not None:
            c = c & (d["role"] == role)
        if eid is not None:
            c = c & (d["eid"] == eid)
        return F.coalesce(c, F.lit(False))
    return pred


def region_id(key_cols: Sequence[str], flag: Column) -> Column:
    """tpos of the flagged element a token lies in (its open and close tags
    included), -1 outside. Flagged elements must not nest in each other.
    """
    w = Window.partitionBy(*key_cols).orderBy("tpos").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.last(F.when(flag, F.col("tpos")), ignorenulls=True).over(w)
    is_own_close = (F.col("kind") == "close") & (F.col("delta") == -1) & (F.col("anc0")["tpos"] == opened)
    ev = F.when(flag, F.col("tpos")).when(is_own_close, F.lit(-1))
    cur = F.coalesce(F.last(ev, ignorenulls=True).over(w), F.lit(-1))
    return F.when(is_own_close, F.col("anc0")["tpos"]).otherwise(cur)


def region_ids(t: DataFrame, key_cols: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """``t`` with ``region_id`` of every flag under its name; all flags share two windows."""
    w = Window.partitionBy(*key_cols).orderBy("tpos").rowsBetween(Window.unboundedPreceding, 0)
    closes = (F.col("kind") == "close") & (F.col("delta") == -1)
    own_close = lambda n: closes & (F.col("anc0")["tpos"] == F.col(f"_o_{n}"))
    event = lambda n: F.when(F.col(f"_f_{n}"), F.col("tpos")).when(own_close(n), F.lit(-1))
    t = t.withColumns({f"_f_{n}": flag for n, flag in flags.items()})
    t = t.withColumns({f"_o_{n}": F.last(F.when(F.col(f"_f_{n}"), F.col("tpos")), ignorenulls=True).over(w) for n in flags})
    t = t.withColumns({f"_c_{n}": F.coalesce(F.last(event(n), ignorenulls=True).over(w), F.lit(-1)) for n in flags})
    t = t.withColumns({n: F.when(own_close(n), F.col("anc0")["tpos"]).otherwise(F.col(f"_c_{n}")) for n in flags})
    return t.drop(*[f"{c}{n}" for n in flags for c in ("_f_", "_o_", "_c_")])


def sibling_indexes(t: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """``parent_tpos``, ``child_index`` (nth-child among element siblings,
    void tags included) and ``tag_index`` (position among same-tag siblings)
    for open tags; null for other tokens."""
    is_open = F.col("kind") == "open"
    t = t.withColumn("parent_tpos", F.when(is_open, F.when(F.col("is_elem"), F.col("anc1")["tpos"])
                                                    .otherwise(F.col("anc0")["tpos"])))
    t = t.withColumn("_o", F.when(is_open, F.lit(0)).otherwise(F.lit(1)))
    w1 = Window.partitionBy(*key_cols, "_o", "parent_tpos").orderBy("tpos")
    w2 = Window.partitionBy(*key_cols, "_o", "parent_tpos", "tag").orderBy("tpos")
    t = t.withColumn("child_index", F.when(is_open, F.row_number().over(w1)))
    t = t.withColumn("tag_index", F.when(is_open, F.row_number().over(w2)))
    return t.drop("_o")
