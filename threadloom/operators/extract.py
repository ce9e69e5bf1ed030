"""Page -> post extraction for the four forum layouts.

One token table for all pages (one shuffle by page key). Each site names
its *record* element, one post:

* psy_su: every ``tr`` inside ``table.forum`` (the first is a header, E1);
* b17_ru: the first ``tr`` of a ``table`` in a ``div`` under
  ``div#topic_post_list``, or under ``div#table-forum-post`` on the
  topic's first page only (E3, E4);
* psycheforum_ru: every ``article`` (E5);
* psyhelp24_org: every ``p`` / ``blockquote`` child of ``div.post-content``
  (E7).

``region_id`` assigns tokens to records (and to the sub-elements fields
come from); one ``groupBy(page, record)`` gathers each record's tokens,
bounded by one post; array functions then read the fields the way each
site's selectors do. The name carry-forward (E9) is a window over the
records of one page; guest ids (E6) are ranked with R1; the sequence number
inside a topic (E15) is a bucketed rank, so a long topic spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import strip_ws
from threadloom.operators.html_tokens import attr, html_tokens, inside, is_el, region_ids, sibling_indexes, token_no  # noqa: F401
from threadloom.operators.ranking import global_offsets, scan_rank, with_bucket
from threadloom.session import materialize
from threadloom.sources.tables import SITE_SOURCES

PAGE_KEY = ["source", "topic_id", "page_no"]
A, B, C, D = SITE_SOURCES

# ---------------------------------------------------------------------------
# Url / link patterns of the sites
# ---------------------------------------------------------------------------
TOPIC_ID_PATTERNS = ((A, r"(?:^|/)topic/([^/?#]*)"), (B, r"\/topic\.php\?id=(\d+)"),
                     (C, r"/topic/(\d+)-"), (D, r"psihologicheskaya-konsultatsiya-(\d+)"))
AUTHOR_ID_PATTERNS = ((A, r"(?:^|/)profile/([^/?#]*)"), (B, r"\/(.+)\/"), (C, r"/profile/(\d+)-"))
GUEST_PREFIX = "gst_"
MIN_TEXT_CHARS = 2  # psyhelp24 skips empty and one-character texts
PAGES_PER_BUCKET = 1024
GUEST_SALTS = 16


def topic_id_from_url(source: Column, url: Column) -> Column:
    """Topic id by the site's url rule; psyhelp24 falls back to '0'."""
    out = F.lit(None).cast("string")
    for site, pat in reversed(TOPIC_ID_PATTERNS):
        v = F.regexp_extract(url, pat, 1)
        v = F.when(v != "", v).otherwise(F.lit("0")) if site == D else F.when(v != "", v)
        out = F.when(source == site, v).otherwise(out)
    return out


def author_id_from_link(source: Column, href: Column) -> Column:
    """Author id from the profile link (A: segment after 'profile';
    B: text between the first and the last slash; C: profile number)."""
    out = F.lit(None).cast("string")
    for site, pat in reversed(AUTHOR_ID_PATTERNS):
        v = F.regexp_extract(strip_ws(href) if site == B else href, pat, 1)
        out = F.when(source == site, F.when(v != "", v)).otherwise(out)
    return out


def forum_tokens(pages: DataFrame) -> DataFrame:
    """Token table of forum pages with record and field regions."""
    key = PAGE_KEY
    t = html_tokens(pages.select(*key, "html"), key, ancestors=3)
    t = sibling_indexes(t, key)
    src = F.col("source")
    a0, a1, a2, a3 = (F.col(f"anc{i}") for i in range(4))
    opened = F.col("is_elem")
    t = t.withColumns({"in_forum": inside(key, is_el("table", cls="forum")), "in_fio": inside(key, is_el("p", cls="fio")),
                       "in_author": inside(key, is_el("td", cls="author")), "in_h1": inside(key, is_el("h1"))})
    rec_a = opened & (F.col("tag") == "tr") & (F.col("in_forum") > 0)
    list_parent = is_el("div", eid="topic_post_list")(a3) | (
        (F.col("page_no") == 1) & is_el("div", eid="table-forum-post")(a3))
    rec_b = (opened & (F.col("tag") == "tr") & (F.col("tag_index") == 1) & is_el("table")(a1)
             & is_el("div")(a2) & list_parent)
    rec_c = opened & (F.col("tag") == "article")
    rec_d = opened & F.col("tag").isin("p", "blockquote") & is_el("div", cls="post-content")(a1)
    rec = (F.when(src == A, rec_a).when(src == B, rec_b).when(src == C, rec_c).otherwise(rec_d))
    t = t.withColumn("rec_open", F.coalesce(rec, F.lit(False)))
    # records and the field regions inside them
    t = region_ids(t, key, {"rec": F.col("rec_open"), "dt": opened & is_el("div", cls="text")(a0),
                            "cc": opened & is_el("div", role="commentContent")(a0)})
    return region_ids(t, key, {"td": opened & (F.col("tag") == "td") & (a1["tpos"] == F.col("rec"))})


def _tok_struct() -> Column:
    return F.struct(
        F.col("tpos"), F.col("kind"), F.col("tok"), F.col("text"), F.col("tag"),
        F.col("anc0")["tpos"].alias("p0"), F.col("anc0")["tag"].alias("t0"),
        F.col("anc1")["tpos"].alias("p1"), F.col("anc1")["tag"].alias("t1"), F.col("anc2")["tag"].alias("t2"),
        F.col("child_index"), F.col("dt"), F.col("cc"), F.col("td"), F.col("in_fio"), F.col("in_author"),
        F.col("rec_open"))


def _texts(arr: Column, cond) -> Column:
    return F.transform(F.filter(arr, cond), lambda x: x["text"])


def _toks(arr: Column, cond) -> Column:
    return F.array_join(F.transform(F.filter(arr, cond), lambda x: x["tok"]), "")


def _first(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(1))


def _is_text(x) -> Column:
    return x["kind"] == "text"


def records(pages: DataFrame) -> DataFrame:
    """One row per record: page key, record position, its ordered tokens and the texts of the page's h1."""
    t = forum_tokens(pages)
    t = t.withColumn("_title", (F.col("kind") == "text") & (F.col("in_h1") > 0)).filter((F.col("rec") >= 0) | F.col("_title"))
    g = t.groupBy(*PAGE_KEY, "rec").agg(F.array_sort(F.collect_list(F.when(F.col("rec") >= 0, _tok_struct()))).alias("toks"),
                                        F.collect_list(F.when(F.col("_title"), F.struct("tpos", "text"))).alias("_h1"))
    page = Window.partitionBy(*PAGE_KEY)
    g = g.withColumn("h1", F.transform(F.array_sort(F.flatten(F.collect_list("_h1").over(page))), lambda x: x["text"]))
    w = page.orderBy("rec")
    return g.filter(F.col("rec") >= 0).drop("_h1").withColumn("rec_no", (F.row_number().over(w) - 1).cast("bigint"))


def _fields_a(toks: Column) -> tuple[Column, ...]:
    link = _first(F.filter(toks, lambda x: (x["kind"] == "open") & (x["tag"] == "a") & (x["child_index"] == 3)
                           & (x["t1"] == "td") & (x["in_author"] > 0)))
    href = attr(link["tok"], "href")
    name = _first(_texts(toks, lambda x: _is_text(x) & (x["p0"] == link["tpos"])))
    parts = _texts(toks, lambda x: _is_text(x) & (x["dt"] >= 0))
    text = strip_ws(F.array_join(parts, "\n"))
    first_dt = F.array_min(F.transform(F.filter(toks, lambda x: x["dt"] >= 0), lambda x: x["dt"]))
    html = _toks(toks, lambda x: x["dt"] == first_dt)
    return F.when(link.isNotNull(), href), name, text, html, F.size(parts) > 0


def _fields_b(toks: Column) -> tuple[Column, ...]:
    tds = F.array_sort(F.array_distinct(F.transform(F.filter(toks, lambda x: x["td"] >= 0), lambda x: x["td"])))
    td1, td2 = F.try_element_at(tds, F.lit(1)), F.try_element_at(tds, F.lit(2))
    href = _first(F.transform(F.filter(toks, lambda x: (x["kind"] == "open") & (x["td"] == td1) & (x["in_fio"] > 0)
                                       & (attr(x["tok"], "href") != "")), lambda x: attr(x["tok"], "href")))
    name = strip_ws(_first(_texts(toks, lambda x: _is_text(x) & (x["td"] == td1) & (x["in_fio"] > 0))))
    parts = F.transform(_texts(toks, lambda x: _is_text(x) & (x["td"] == td2)), lambda v: strip_ws(v))
    text = F.array_join(parts, "\n")
    html = strip_ws(_toks(toks, lambda x: x["td"] == td2))
    return href, name, text, html, F.lit(True)


def _fields_c(toks: Column) -> tuple[Column, ...]:
    link = _first(F.filter(toks, lambda x: (x["kind"] == "open") & (x["tag"] == "a") & (x["t1"] == "strong")
                           & (x["t2"] == "h3")))
    href = F.when(link.isNotNull(), attr(link["tok"], "href"))
    name = _first(_texts(toks, lambda x: _is_text(x) & (x["p0"] == link["tpos"])))
    parts = F.transform(_texts(toks, lambda x: _is_text(x) & (x["cc"] >= 0)), lambda v: strip_ws(v))
    text = F.array_join(parts, "\n")
    html = strip_ws(_toks(toks, lambda x: x["cc"] >= 0))
    return href, name, text, html, F.lit(True)


def _fields_d(toks: Column, rec: Column) -> tuple[Column, ...]:
    own = _first(F.filter(toks, lambda x: x["rec_open"]))
    is_quote = own["tag"] == "blockquote"
    name = _first(_texts(toks, lambda x: _is_text(x) & (x["t0"] == "strong")))
    direct = _texts(toks, lambda x: _is_text(x) & F.when(is_quote, (x["t0"] == "p") & (x["p1"] == rec))
                    .otherwise(x["p0"] == rec))
    raw = F.array_join(direct, "\n")
    html = _toks(toks, lambda x: F.lit(True))
    return is_quote, name, raw, html


def posts_from_pages(pages: DataFrame) -> DataFrame:
    """E1 + E3 + E5 + E7 (+ E2, E4, E10 filters): posts of every page.

    Output: ``source, topic_id, page_no, pos_on_page, url, author_href,
    author_name, text, html``, ``h1`` (the title's texts) plus, for psyhelp24,
    ``role`` and the raw block name before carry-forward.
    """
    r = records(pages)
    toks = F.col("toks")
    fa, fb, fc = _fields_a(toks), _fields_b(toks), _fields_c(toks)
    d_quote, d_name, d_raw, d_html = _fields_d(toks, F.col("rec"))
    src = F.col("source")

    def pick(i):
        return F.when(src == A, fa[i]).when(src == B, fb[i]).when(src == C, fc[i])
    r = r.select(*PAGE_KEY, "rec", "rec_no",
                 pick(0).alias("author_href"), F.when(src == D, d_name).otherwise(pick(1)).alias("author_name"),
                 F.when(src == D, d_raw).otherwise(pick(2)).alias("text"),
                 F.when(src == D, d_html).otherwise(pick(3)).alias("html"),
                 F.when(src == A, fa[4]).otherwise(F.lit(True)).alias("has_text"),
                 F.when(src == D, F.when(d_quote, "1").otherwise("0")).alias("role"), "h1")
    # psy_su drops the header row (its first record)
    r = r.filter(~((src == A) & (F.col("rec_no") == 0)))
    # psyhelp24 starts at block 3, or 4 when block 3 is a quote
    wpage = Window.partitionBy(*PAGE_KEY)
    block3_quote = F.max(F.when(F.col("rec_no") == 3, F.col("role") == "1")).over(wpage)
    r = r.withColumn("_start", F.when(F.coalesce(block3_quote, F.lit(False)), 4).otherwise(3))
    r = r.filter((src != D) | (F.col("rec_no") >= F.col("_start"))).drop("_start")
    # A role's name is the first bold text seen so far for that role
    wrole = (Window.partitionBy(*PAGE_KEY, "role").orderBy("rec_no")
             .rowsBetween(Window.unboundedPreceding, 0))
    r = r.withColumn("author_name", F.when(src == D, F.first("author_name", ignorenulls=True).over(wrole))
                     .otherwise(F.col("author_name")))
    # Skip empty / one-character texts, strip a leading colon
    d_ok = F.coalesce(F.length("text") >= MIN_TEXT_CHARS, F.lit(False))
    d_text = F.when(F.col("text").startswith(":"), strip_ws(F.expr("substring(text, 2)"))).otherwise(strip_ws(F.col("text")))
    r = r.filter((src != D) | d_ok).withColumn("text", F.when(src == D, d_text).otherwise(F.col("text")))
    # psy_su keeps non-blank posts only
    r = r.withColumn("ready", (src != A) | (F.col("has_text") & (F.col("text") != "")))
    return r


def page_yield(extracted: DataFrame) -> DataFrame:
    """Per psy_su page, rows read and posts kept."""
    a = extracted.filter(F.col("source") == A)
    return a.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("ready").alias("n_ready"))


def guest_ids(posts: DataFrame, order_cols=("source", "topic_id", "page_no", "rec_no")) -> DataFrame:
    """``gst_<n>`` per guest name, n = order of first sight (null names
    count as one name). Distinct names ranked with R1; no single-partition
    window."""
    g = posts.filter(F.col("author_id").isNull() & (F.col("source") == C))
    first = g.groupBy("author_name").agg(F.min(F.struct(*order_cols)).alias("_f"))
    first = first.select("author_name", *[F.col("_f")[c].alias(c) for c in order_cols])
    ranked = global_offsets(first, list(order_cols), out_col="_n")
    return ranked.select("author_name", F.concat(F.lit(GUEST_PREFIX), F.col("_n").cast("string")).alias("guest_id"))


def extract_posts(pages: DataFrame) -> DataFrame:
    """E1-E15 end to end: posts table in the engine's schema plus ``page_no``.

    Rejected pages (E14) produce no posts; guests get ``gst_<n>`` ids (E6);
    ``pos`` is the sequence number inside the topic (E15).
    """
    r = materialize(posts_from_pages(pages).filter("ready"), "page_posts")
    p = pages.select(*PAGE_KEY, "url")
    title_b, title_c = _title_texts(F.col("h1"))
    r = r.join(p, PAGE_KEY).filter(_rejection(title_b, title_c).isNull()).drop("h1")
    r = r.withColumn("author_id", F.when(F.col("source") == D, F.col("role"))
                     .otherwise(author_id_from_link(F.col("source"), F.col("author_href"))))
    r = r.withColumn("url_topic", topic_id_from_url(F.col("source"), F.col("url")))
    # guest rows find their id by name, keys only and salted (one name may be
    # most guests), and bring it back by the row's own key
    own = [*PAGE_KEY, "rec_no"]
    salt = F.pmod(F.xxhash64(*own), F.lit(GUEST_SALTS))
    guests = r.filter(F.col("author_id").isNull() & (F.col("source") == C)).select(*own, "author_name", salt.alias("_salt"))
    gids = guest_ids(r).select(F.col("author_name").alias("_name"), "guest_id",
                               F.explode(F.sequence(F.lit(0).cast("long"), F.lit(GUEST_SALTS - 1).cast("long"))).alias("_s"))
    found = guests.join(gids, F.col("author_name").eqNullSafe(F.col("_name")) & (F.col("_salt") == F.col("_s")))
    r = r.join(found.select(*own, "guest_id"), own, "left")
    r = r.withColumn("author_id", F.coalesce("author_id", "guest_id"))
    # Sequence number inside the topic, bucketed by page range so a hot
    # topic is ranked by many tasks
    r = with_bucket(r, "page_no", PAGES_PER_BUCKET)
    r = scan_rank(r, ["source", "url_topic"], ["page_no", "rec_no"], "pos")
    return r.select("source", F.col("url_topic").alias("topic_id"), "url", "author_id", "author_name", "text",
                    "html", "page_no", "pos")


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages of sites A to C whose topic id did not parse, and of B and C whose title is empty."""
    t = html_tokens(pages.select(*PAGE_KEY, "html"), PAGE_KEY, ancestors=0).withColumn("_in_h1", inside(PAGE_KEY, is_el("h1")))
    h1 = F.array_sort(F.collect_list(F.when((F.col("kind") == "text") & (F.col("_in_h1") > 0), F.struct("tpos", "text"))))
    titles = t.groupBy(*PAGE_KEY).agg(F.transform(h1, lambda x: x["text"]).alias("h1"))
    p = pages.select(*PAGE_KEY, "url").join(titles, PAGE_KEY, "left")
    p = p.withColumn("reason", _rejection(*_title_texts(F.coalesce("h1", F.array().cast("array<string>")))))
    return p.filter(F.col("reason").isNotNull()).select(*PAGE_KEY, "url", "reason")


def _title_texts(h1: Column) -> tuple[Column, Column]:
    """The title as sites B and C read it from the texts of the h1."""
    nonempty = F.filter(F.transform(h1, lambda v: strip_ws(v)), lambda v: v != "")
    return F.array_join(nonempty, "-"), strip_ws(F.array_join(h1, " "))


def _rejection(title_b: Column, title_c: Column) -> Column:
    """Why a page of ``url`` yields no posts (E14); null if it does."""
    src = F.col("source")
    tid = topic_id_from_url(src, F.col("url"))
    title = F.when(src == B, title_b).when(src == C, title_c)
    untitled = src.isin(B, C) & (F.coalesce(title, F.lit("")) == "")
    return F.when(tid.isNull(), "topic_id").when(untitled, "title")
