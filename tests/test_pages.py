from pyspark.sql import functions as F

from threadloom.operators import extract, links, pages
from threadloom.operators.html_tokens import PAGE_CONTAINERS, html_tokens, is_el


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_url_join_cases(spark):
    base = "http://h.example/a/b.html?x=1#f"
    cases = {"https://o/x": "https://o/x", "//cdn/x": "http://cdn/x", "/p": "http://h.example/p",
             "?q=2": "http://h.example/a/b.html?q=2", "#g": "http://h.example/a/b.html?x=1#g",
             "c.html": "http://h.example/a/c.html", "": "http://h.example/a/b.html?x=1",
             "../x.html": "http://h.example/x.html", "./d/./e/../f?u=../v": "http://h.example/a/d/f?u=../v",
             "../../../w": "http://h.example/w", "/p/./q/..": "http://h.example/p/", "..": "http://h.example/"}
    df = spark.createDataFrame([(base, h) for h in cases], "base string, href string")
    got = {r.href: r.u for r in df.select("href", links.url_join(F.col("base"), F.col("href")).alias("u")).collect()}
    assert got == cases
    one = spark.createDataFrame([("http://h.example", "x")], "base string, href string")
    assert one.select(links.url_join(F.col("base"), F.col("href"))).first()[0] == "http://h.example/x"


def test_links_skip_scripts_and_pagination(spark):
    html = ('<html><body><script>var a="<a href=\\"/no\\">";</script><nav><a href="/p1">1</a><a href="/p2">2</a>'
            '<a href="/p3">3</a></nav><!-- <a href="/c"> --><a href="/x?a=1&amp;b=2">x</a></body></html>')
    p = _pages(spark, [(1, "http://h/p1/", html), (2, "http://h/t?page=2", html), (3, "http://h/p3", html)])
    assert [r.href for r in links.links(p).filter("page_id = 1").orderBy("link_no").collect()] == [
        "/p1", "/p2", "/p3", "/x?a=1&b=2"]
    region = links.region_links(p, is_el("nav"), count_tags=PAGE_CONTAINERS)
    nxt = {r.page_id: r.next_href for r in links.next_page(p, region).collect()}
    assert nxt == {1: "/p2", 2: "/p1", 3: None}
    nt = {r.page_id: r.next_href for r in links.next_topic_page(p, region).collect()}
    assert nt == {1: "/p1", 2: "/p2", 3: "/p1"}


def test_link_rules(spark):
    urls = ["https://psycheforum.ru/topic/5-a/", "https://psycheforum.ru/topic/3273-ads/",
            "https://psycheforum.ru/forum/4-x/page/2/", "https://www.b17.ru/forum/topic.php?id=7&p=2",
            "https://www.b17.ru/forum/topic.php?id=7"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.rule for r in links.with_link_rule(df, "u").collect()]
    assert got == ["psycheforum_topic", None, None, None, "b17_topic"]


def test_token_table_ancestors_and_depth(spark):
    html = '<div class="a"><p>x<b>y</b></p><br><span>z</span></div>'
    t = html_tokens(_pages(spark, [(1, "u", html)]), ["page_id"], ancestors=2)
    rows = {r.text: r for r in t.filter("kind = 'text'").collect()}
    assert rows["y"].anc0["tag"] == "b" and rows["y"].anc1["tag"] == "p" and rows["y"].anc2["cls"] == "a"
    assert rows["z"].anc0["tag"] == "span" and rows["z"].d_before == 2
    depth = pages.depth_summary(pages.page_tokens(_pages(spark, [(1, "u", html)]), ancestors=0)).first()
    assert depth.end_depth == 0


def test_extraction_site_layouts(spark):
    a = ('<html><body><h1>T</h1><table class="forum"><tr><th>h</th></tr>'
         '<tr><td class="author"><span>#</span><img src="i"><a href="/club/profile/u1/">Ann</a></td>'
         '<td><div class="text"> hello <b>there</b> </div></td></tr>'
         '<tr><td class="author"><span>#</span><img src="i"><a href="/club/profile/u2/">Bob</a></td>'
         '<td><div class="text">  </div></td></tr></table></body></html>')
    d = ('<html><body><h2>T</h2><div class="post-content"><p>T</p><p>P</p><p><img src="x"></p>'
         '<blockquote><p><strong>Psy</strong>: intro</p></blockquote><p><strong>Cli</strong>: question</p>'
         '<p>x</p><blockquote><p>: answer</p></blockquote></div></body></html>')
    pg = spark.createDataFrame([("psy_su", "9", 1, "https://psy.su/club/forum/topic/9/", a),
                                ("psyhelp24_org", "4", 1, "https://psyhelp24.org/psihologicheskaya-konsultatsiya-4/", d)],
                               "source string, topic_id string, page_no int, url string, html string")
    r = extract.posts_from_pages(pg)
    pa = r.filter("source = 'psy_su'").orderBy("rec_no").collect()
    assert [(x.author_href, x.author_name, x.text, x.ready) for x in pa] == [
        ("/club/profile/u1/", "Ann", "hello \nthere", True), ("/club/profile/u2/", "Bob", "", False)]
    pd_ = r.filter("source = 'psyhelp24_org'").orderBy("rec_no").collect()
    # block 3 is a quote -> start at 4; 'x' has one character -> skipped
    assert [(x.role, x.author_name, x.text) for x in pd_] == [("0", "Cli", "question"), ("1", None, "answer")]
    posts = extract.extract_posts(pg).collect()
    assert {(p.source, p.topic_id, p.author_id, p.pos) for p in posts} == {
        ("psy_su", "9", "u1", 0), ("psyhelp24_org", "4", "0", 0), ("psyhelp24_org", "4", "1", 1)}


def test_tokenizer_quoted_gt_and_stray_lt(spark):
    html = '<div title="a>b" class=\'x>\'>1 < 2<b>bold</b></div>'
    t = html_tokens(_pages(spark, [(1, "u", html)]), ["page_id"], ancestors=1)
    rows = t.orderBy("tpos").collect()
    assert [r.kind for r in rows] == ["open", "text", "text", "text", "open", "text", "close", "close"]
    assert "".join(r.text for r in rows if r.kind == "text") == "1 < 2bold"
    assert rows[0].tag == "div" and rows[5].anc0["tag"] == "b" and rows[5].anc1["tag"] == "div"


def test_attribute_quoting_styles(spark):
    html = ("<div><a href='/s'>1</a><a href=/bare>2</a><a title=\"x>y\" href=\"/d\">3</a><a name=n>4</a>"
            "<p class=quote>t</p></div>")
    p = _pages(spark, [(1, "http://h/", html)])
    assert [r.href for r in links.links(p).orderBy("link_no").collect()] == ["/s", "/bare", "/d"]
    t = html_tokens(p, ["page_id"], ancestors=0).filter("kind = 'text' AND text = 't'").first()
    assert t.anc0["cls"] == "quote"


def test_numeric_references(spark):
    cases = {"&#65;&#x42;&#X63;": "ABc", "&#8212;": "\u2014", "&#x1F600;!": "\U0001F600!", "&amp;#60;": "&#60;", "&#;&#x;": "&#;&#x;",
             "&#0;": "\ufffd", "&#38;lt;b&#38;gt;": "&lt;b&gt;", "&amp;lt;": "&lt;", "&euro;&eacutet": "\u20acét", "&notit;&notin;": "\u00acit;\u2209", "&#150;": "\u2013", "&#xD800;": "\ufffd", "&#999999999;": "\ufffd", "a & b &lt;": "a & b <", "&#39;&#160;": "'\u00a0"}
    from threadloom.operators.html_tokens import decode_entities
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.d for r in df.select("t", decode_entities(F.col("t")).alias("d")).collect()} == cases


def test_only_void_tags_are_empty(spark):
    t = html_tokens(_pages(spark, [(1, "u", "<div><a href=/x/>q</a>r</div>s<br/>")]), ["page_id"], ancestors=1)
    text = {r.text: r.d_before for r in t.filter("kind = 'text'").collect()}
    assert text == {"q": 2, "r": 1, "s": 0}


def test_unclosed_and_stray_tags(spark):
    html = "<div>a<p>b<p>c<b>d<ul><li>e<li>f<ul><li>g</ul></ul>h</div>i</span></p>j"
    t = html_tokens(_pages(spark, [(1, "u", html)]), ["page_id"], ancestors=3)
    rows = {r.text: r for r in t.filter("kind = 'text'").collect()}
    inside = {k: [r[f"anc{i}"]["tag"] for i in range(4) if r.d_before > i and r[f"anc{i}"] is not None] for k, r in rows.items()}
    assert inside == {"a": ["div"], "b": ["p", "div"], "c": ["p", "div"], "d": ["p", "div"], "e": ["li", "ul", "div"],
                      "f": ["li", "ul", "div"], "g": ["li", "ul", "li", "ul"], "h": ["div"], "i": [], "j": []}


def test_extraction_with_class_tokens_and_open_paragraphs(spark):
    a = ('<html><body><table class="forum wide"><tr><th>h</th></tr><tr><td class="top author"><span>#</span><img src="i">'
         '<a href="/club/profile/u1/">Ann</a></td><td><div class="text x">hello<b> there</div></td></tr></table></body></html>')
    d = ('<html><body><div class="post-content"><p>T<p>P<p>I<p><strong>Cli</strong>: first<p><strong>Cli</strong>: second'
         '<blockquote><p><strong>Psy</strong>: reply</blockquote></div></body></html>')
    pg = spark.createDataFrame([("psy_su", "9", 1, "https://psy.su/club/forum/topic/9/", a), ("psy_su", "8", 1, "https://psy.su/club/forum/", a),
                                ("psyhelp24_org", "4", 1, "https://psyhelp24.org/psihologicheskaya-konsultatsiya-4/", d)],
                               "source string, topic_id string, page_no int, url string, html string")
    r = extract.posts_from_pages(pg).collect()
    assert [(x.author_name, x.text) for x in r if x.topic_id == "9"] == [("Ann", "hello\n there")]
    assert sorted((x.rec_no, x.role, x.author_name, x.text) for x in r if x.topic_id == "4") == [
        (3, "0", "Cli", "first"), (4, "0", "Cli", "second"), (5, "1", "Psy", "reply")]
    assert [(x.topic_id, x.reason) for x in extract.rejected_pages(pg).collect()] == [("8", "topic_id")]
    assert {x.topic_id for x in extract.extract_posts(pg).collect()} == {"9", "4"}


def test_next_page_first_and_frontier(spark):
    b = ('<div class="body_padding"><div class="page-list"><span><a rel="prev" href="?p=1">1</a><a rel="nofollow" href="../t?p=3">3</a></span></div></div>'
         '<li class="ipsPagination_next"><a href="/never">x</a></li>')
    c = '<ul><li class="a ipsPagination_next b"><span><a href="https://h/next#x">n</a></span></li><li class="ipsPagination_next"><a href="/2">y</a></li></ul>'
    p = _pages(spark, [(1, "https://h/a/t", b), (2, "https://h/c#top", c), (3, "https://h/d", "<a rel=nofollow href=/no>z</a>")])
    got = {r.page_id: r.next_href for r in links.next_page_first(p).collect()}
    assert got == {1: "https://h/t?p=3", 2: "https://h/next#x", 3: None}
    seen = _pages(spark, [(1, "https://h/c#top", '<a href="#y">self</a><a href="../c">up</a><a href="/new/./x">new</a><a href="//o/z">other</a>')])
    hosts = spark.createDataFrame([("h",)], "host string")
    assert [r.url for r in links.frontier(links.resolved_links(seen), seen, hosts).collect()] == ["https://h/new/x"]


def test_long_conversation_equals_sequential_fold(spark):
    from threadloom.operators import ranking
    from threadloom.sources.tables import posts_from_conversations
    rows = [(1, t, "user" if t % 3 else "assistant", None if t % 50 == 7 else f"text {t}") for t in range(0, 6000, 2)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    d = ranking.scan_lag(ranking.with_bucket(conv, "turn", 64), ["conv_id"], "turn", {"text": "pt", "role": "pr"})
    got = {r.turn: (r.pt, r.pr) for r in d.collect()}
    want, last = {}, (None, None)
    for _, t, role, text in rows:
        want[t], last = last, (text, role)
    assert got == want
    plan = posts_from_conversations(conv)._jdf.queryExecution().executedPlan().toString()
    assert "_bk" in plan and "windowspecdefinition(conv_id" in plan and "windowspecdefinition(conv_id#0L, turn" not in plan


def test_references_as_the_standard_has_them(spark):
    import html
    import random
    from html.entities import html5

    from threadloom.functions.references import decode_references
    r = random.Random(2)
    parts = ["&", "#", "x", "amp", "lt", ";", "copy", "=", "not", "in", "65", "8364", " ", "é", "&#", "&#x", "AElig"]
    cases = ["&" + n for n in html5] + ["&" + n.rstrip(";") + "x;" for n in html5]
    cases += ["".join(r.choice(parts) for _ in range(r.randint(1, 9))) for _ in range(3000)]
    cases += [f"&#{c};" for c in (9, 10, 32, 128, 129, 150, 159, 160, 0xD800, 0xDFFF, 0x10FFFE, 0x110000, 10**14, 0) if c != 0x10FFFE]
    df = spark.createDataFrame([(c,) for c in {*cases}], "t string")
    got = df.select("t", decode_references(F.col("t")).alias("d")).collect()
    assert [(x.t, x.d) for x in got if html.unescape(x.t) != x.d] == []
    attributes = {"?a=1&copy=2": "?a=1&copy=2", "&copy": "©", "&copy;=1": "©=1", "&ampx": "&ampx", "&amp;lt": "&lt", "&notin;": "∉", "&#38;lt;": "&lt;"}
    df = spark.createDataFrame([(c,) for c in attributes], "t string")
    assert {x.t: x.d for x in df.select("t", decode_references(F.col("t"), attribute=True).alias("d")).collect()} == attributes


def test_tags_of_a_megabyte(spark):
    n = 1 << 20
    rows = [(1, "http://h/", "<a " + "b" * n), (2, "http://h/", f"<div><img src=data:{'c' * n}>x</div>"),
            (3, "http://h/", f"<p><a href=/{'d' * n}>y</a></p>"), (4, "http://h/", f'<a title="{"<>" * (n // 2)}" href=/e>z</a>'),
            (5, "http://h/", "<a " * 50_000), (6, "http://h/", "<a '" + "f" * n + "<b>q</b>")]
    t = html_tokens(_pages(spark, rows), ["page_id"], ancestors=0)
    got = {r.page_id: (r.n, r.texts) for r in t.groupBy("page_id").agg(
        F.count("tok").alias("n"), F.concat_ws("|", F.sort_array(F.collect_list(F.when(F.length("text") < 9, F.col("text"))))).alias("texts")).collect()}
    assert {k: v for k, v in got.items() if k != 5} == {1: (2, "<"), 2: (4, "x"), 3: (5, "y"), 4: (3, "z"), 6: (5, "<|q")}
    assert got[5][0] == 100_000
    assert {r.page_id: len(r.href) for r in links.links(_pages(spark, rows)).collect()} == {3: n + 1, 4: 2}


def _windows_by_stage(df):
    """Window operators in a row of the physical plan, between two exchanges."""
    prepared = df._jdf.queryExecution().executedPlan().toString()
    counts, n = [], 0
    for line in prepared.splitlines():
        name = line.lstrip(" :+-*0123456789()").split("(")[0].split(" ")[0]
        if name == "Exchange":
            counts, n = [*counts, n], 0
        n += name == "Window"
    return [*counts, n]


def test_token_windows_are_spread_over_stages(spark):
    from threadloom.operators.extract import records
    from threadloom.operators.quotes import quote_pair_arrays
    pages = spark.createDataFrame([("psy_su", "1", 1, "u", "<p>t</p>")], "source string, topic_id string, page_no int, url string, html string")
    posts = pages.selectExpr("source", "topic_id", "cast(page_no as bigint) pos", "'https://psy.su/' url", "html")
    for out in (records(pages), quote_pair_arrays(posts)):
        by_stage = _windows_by_stage(out)
        assert sum(by_stage) >= 10 and max(by_stage) <= 13, by_stage


def test_region_ids_of_many_flags_equal_region_id_of_each(spark):
    from threadloom.operators.html_tokens import html_tokens, is_el, region_id, region_ids
    html = "<table><tr><td>a<b>c</b></td><td>d</td></tr></table>e<td>f<p>g<tr>h</td>i<div class='x text'>j</div>k"
    t = html_tokens(_pages(spark, [(1, "u", html), (2, "u", "plain"), (3, "u", "<p>q<p>r</p>")]), ["page_id"], ancestors=1)
    opened = F.col("is_elem")
    flags = {"a": opened & (F.col("tag") == "td"), "b": opened & is_el("div", cls="text")(F.col("anc0")), "c": opened & (F.col("tag") == "p")}
    both = region_ids(t, ["page_id"], flags)
    for n, flag in flags.items():
        both = both.withColumn(f"one_{n}", region_id(["page_id"], flag))
    rows = both.collect()
    assert rows and all(r[n] == r[f"one_{n}"] for r in rows for n in flags)
    assert any(r["a"] >= 0 for r in rows) and any(r["b"] >= 0 for r in rows)
