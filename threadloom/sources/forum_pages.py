"""Forum topic pages built from ``conversations`` (stand-in harvest input).

Each conversation becomes one topic of the site the md5 rule of
``tables.py`` picks, rendered in that site's page layout with
``TURNS_PER_PAGE`` turns per page. Only markup is produced here; parsing it
back into posts is the extraction operators' job.

* psy_su: ``table.forum`` with a header row; author link is the third child
  of ``td.author``; body in ``div.text``; pages ``?page=N``.
* b17_ru: opening post in ``#table-forum-post`` on every page (excluded on
  pages after the first), replies in ``#topic_post_list``.
* psycheforum_ru: one ``article`` per post; ``system`` turns are guests
  (author link without a profile number, name = role + topic).
* psyhelp24_org: up to BLOCKS_PER_PAGE turns a page; title, psychologist and picture paragraphs, then
  client paragraphs and psychologist quote blocks with bold names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.sources.tables import SITE_SOURCES, _site_of, html_escape

TURNS_PER_PAGE = 3
BLOCKS_PER_PAGE = 64  # of psyhelp24_org
A, B, C, D = SITE_SOURCES


def _title(conv_id) -> F.Column:
    return F.concat(F.lit("Topic "), conv_id.cast("string"))


def _page_url(source, tid, page_no) -> F.Column:
    p = page_no.cast("string")
    word = F.when(_digit(tid, 2) == "0", "tema").otherwise("topic")  # a url without a topic id
    return (F.when(source == A, F.concat(F.lit("https://psy.su/club/forum/"), word, F.lit("/"), tid, F.lit("/"),
                                         F.when(page_no > 1, F.concat(F.lit("?page="), p)).otherwise(F.lit(""))))
            .when(source == B, F.concat(F.lit("https://www.b17.ru/forum/"), word, F.lit(".php?id="), tid,
                                        F.when(page_no > 1, F.concat(F.lit("&page="), p)).otherwise(F.lit(""))))
            .when(source == C, F.concat(F.lit("https://psycheforum.ru/"), word, F.lit("/"), tid, F.lit("-t/"),
                                        F.when(page_no > 1, F.concat(F.lit("page/"), p, F.lit("/"))).otherwise(F.lit(""))))
            .otherwise(F.concat(F.lit("https://psyhelp24.org/psihologicheskaya-konsultatsiya-"), tid, F.lit("/"))))


def _digit(key, n: int) -> F.Column:
    """The n-th hex digit of the key's md5: picks the pages that have a flaw."""
    return F.substring(F.md5(key), n, 1)


def _links_block(source, tid, url, page_no) -> F.Column:
    """Links of every form and rule, inside and outside a nav, and the pager of the site's layout."""
    nxt = (page_no + 1).cast("string")
    pager = (F.when(page_no > 2, F.lit(""))
             .when(source == B, F.concat(F.lit('<div class="body_padding"><div class="page-list"><span><a rel="prev" href="?id=0">0</a><a rel="nofollow" href="topic.php?id='), tid,
                                         F.lit("&amp;page="), nxt, F.lit('">next</a></span></div></div>')))
             .when(source == C, F.concat(F.lit('<ul><li class="ipsPagination_prev"><a href="#">p</a></li><li class="ipsPagination_next wide"><a href="https://psycheforum.ru/topic/'),
                                         tid, F.lit("-t/page/"), nxt, F.lit('/">next</a></li></ul>')))
             .otherwise(F.lit("")))
    return F.concat(
        F.lit('<nav class="crumbs wide"><a href="../">up</a><a href="?page='), nxt, F.lit('">more</a></nav>'), pager,
        F.lit('<footer><a href="//psycheforum.ru/forum/17-x/">a</a><a href="https://psycheforum.ru/forum/17-x/?do=markRead">b</a>'
              '<a href="https://www.b17.ru/forum/topic.php?id='), tid,
        F.lit('">c</a><a href="https://www.b17.ru/forum/topic.php?id='), tid,
        F.lit('&amp;p=2">d</a><a href="https://psycheforum.ru/topic/'), tid,
        F.lit('-t/">e</a><a href="https://psycheforum.ru/topic/3273-t/">f</a><a href="https://psyhelp24.org/psihologicheskaya-konsultatsiya-'), tid,
        F.lit('/">g</a><a href="#top">h</a><a href="">i</a><a href="./x/../y/./z.html?q=../r#s">j</a>'
              '<a href="../../../w">k</a><a href="/p/./q/..">l</a><a href="'),
        url, F.lit('#seen">m</a>'),
        F.lit('<p>&euro;5 &eacutet &amp;lt;b&amp;gt; &#38;lt;i&#x26;gt; &notit; &notin; &#150;</p><a href="?a=1&amp;copy=2&copy=3&lt">n</a>'),
        # some pages have tags of 20,000 characters
        F.when(_digit(tid, 5).isin("0", "1"), "<img alt=" + "x" * 20_000 + "><a href=/" + "y" * 9_000 + ">o</a>").otherwise(""), F.lit("</footer>"))


def link_pages(pages: DataFrame, forum_pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` of the harvested pages and of the topic pages (negative ids)."""
    topic = forum_pages.select((-(F.col("topic_id").cast("bigint") * 1000 + F.col("page_no") + 1)).alias("page_id"), "url", "html")
    return pages.select("page_id", "url", "html").unionByName(topic)


def _b_cells(role, text) -> F.Column:
    t = html_escape(F.coalesce(text, F.lit("")))
    return F.concat(F.lit('<td><p class="fio"><a href="/'), role, F.lit('/">'), role,
                    F.lit("</a></p></td><td>"), t, F.lit("</td>"))


def _row_html(source, role, text, tid) -> F.Column:
    t = html_escape(F.coalesce(text, F.lit("")))
    a = F.concat(F.lit('<tr><td class="author"><span>#</span><img src="/i.png"><a href="/club/profile/'), role,
                 F.lit('/">'), role, F.lit('</a></td><td><div class="text">'), t, F.lit("</div></td></tr>"))
    b = F.concat(F.lit('<div><table><tr>'), _b_cells(role, text), F.lit("</tr></table></div>"))
    prof = F.when(role == "user", F.lit("11")).when(role == "assistant", F.lit("22"))
    link = F.when(prof.isNotNull(),
                  F.concat(F.lit('<a href="https://psycheforum.ru/profile/'), prof, F.lit("-"), role, F.lit('/">'),
                           role, F.lit("</a>"))) \
            .otherwise(F.concat(F.lit('<a href="#">'), role, F.lit("_"), tid, F.lit("</a>")))
    c = F.concat(F.lit("<article><aside><h3><strong>"), link,
                 F.lit('</strong></h3></aside><div data-role="commentContent"><p>'), t, F.lit("</p></div></article>"))
    d = (F.when(role == "assistant", F.concat(F.lit("<blockquote><p><strong>"), role, F.lit("</strong>: "), t,
                                              F.lit("</p></blockquote>")))
          .when(role == "user", F.concat(F.lit("<p><strong>"), role, F.lit("</strong>: "), t, F.lit("</p>")))
          .otherwise(F.concat(F.lit("<p>"), t, F.lit("</p>"))))
    return F.when(source == A, a).when(source == B, b).when(source == C, c).otherwise(d)


def forum_pages_from_conversations(conversations: DataFrame, per_page: int = TURNS_PER_PAGE) -> DataFrame:
    """``source, topic_id, page_no, url, html`` for every topic page."""
    c = conversations.select("conv_id", "turn", "role", "text")
    tid = F.col("conv_id").cast("string")
    # psy_su has blank posts
    blank = (_site_of(tid) == A) & (_digit(F.concat(tid, F.lit(":"), F.col("turn").cast("string")), 3) == "0")
    c = c.select(_site_of(tid).alias("source"), tid.alias("topic_id"), "conv_id", "turn",
                 (F.floor(F.col("turn") / F.when(_site_of(tid) == D, BLOCKS_PER_PAGE).otherwise(per_page)) + 1).cast("int").alias("page_no"),
                 _row_html(_site_of(tid), F.col("role"), F.when(blank, F.lit(" ")).otherwise(F.col("text")), tid).alias("row_html"))
    # on its first page a b17 opening post sits only in #table-forum-post
    listed = ~((F.col("source") == B) & (F.col("turn") == 0))
    rows = (c.groupBy("source", "topic_id", "conv_id", "page_no")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(listed, F.struct("turn", "row_html")))),
                                           lambda x: x["row_html"]), "").alias("rows")))
    # the opening post of a b17 topic is repeated at the top of every page
    opening = (conversations.filter(F.col("turn") == 0)
               .select(F.col("conv_id").cast("string").alias("topic_id"),
                       F.concat(F.lit("<tr>"), _b_cells(F.col("role"), F.col("text")), F.lit("</tr>")).alias("opening")))
    p = rows.join(opening, ["topic_id"], "left")
    src, title = F.col("source"), html_escape(_title(F.col("conv_id")))
    page_no = F.col("page_no")
    body = F.col("rows")
    head = F.concat(F.lit("<html><head><title>"), title, F.lit("</title></head><body>"))
    h1 = F.when(_digit(F.col("topic_id"), 2) == "1", F.lit(" ")).otherwise(title)  # a page without a title
    url = _page_url(src, F.col("topic_id"), page_no)
    tail = F.concat(_links_block(src, F.col("topic_id"), html_escape(url), page_no), F.lit("</body></html>"),
                    F.when(_digit(F.col("topic_id"), 5).isin("1", "2"), "<a title=" + "z " * 10_000).otherwise(""))  # never closed
    a_html = F.concat(head, F.lit("<h1>"), title, F.lit('</h1><table class="forum"><tr><th>Author</th><th>Text</th></tr>'),
                      body, F.lit("</table>"), tail)
    b_html = F.concat(head, F.lit("<h1> "), h1, F.lit(' </h1><div class="body_padding"><div id="table-forum-post"><div><table>'),
                      F.coalesce(F.col("opening"), F.lit("")), F.lit('</table></div></div><div id="topic_post_list">'),
                      body, F.lit("</div></div>"), tail)
    c_html = F.concat(head, F.lit("<h1>"), h1, F.lit("</h1>"), body, tail)
    d_html = F.concat(head, F.lit("<h2>"), title, F.lit('</h2><div class="post-content"><p>'), title,
                      F.lit('</p><p>Psychologist</p><p><img src="/p.jpg"></p>'), body,
                      F.lit("</div>"), tail)
    html = F.when(src == A, a_html).when(src == B, b_html).when(src == C, c_html).otherwise(d_html)
    return p.select("source", "topic_id", "page_no", url.alias("url"), html.alias("html"))


def fetch_log(pages: DataFrame) -> DataFrame:
    """``url, status, body`` of a fetch of every page: a quarter are refused, half of those with the ban page."""
    from threadloom.operators.contracts import BLOCK_MARKER
    d = _digit(F.col("url"), 1)
    return pages.select("url", F.when(d.isin("0", "1", "2", "3"), 503).otherwise(200).alias("status"),
                        F.when(d.isin("0", "1", "4"), F.concat(F.lit("<p>"), F.lit(BLOCK_MARKER), F.lit("</p>"))).otherwise(F.col("html")).alias("body"))
