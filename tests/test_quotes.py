from threadloom.operators import quotes
from threadloom.sources.tables import WROTE_MARKER
from tests.conftest import make_posts

URL = {"a": "https://psy.su/club/forum/topic/1/", "b": "https://www.b17.ru/forum/topic.php?id=1",
       "c": "https://psycheforum.ru/topic/1-x/"}


def pairs(spark, rule, html):
    df = make_posts(spark, [(1, "u", "t", html, URL[rule])])
    return [(r.speaker0_text, r.speaker1_text)
            for r in quotes.quote_pairs(df).orderBy("k").collect()]


def test_site_a_basic(spark):
    h = '<div class="text"><div class="forum_quote"><div class="quote">sq</div></div>sr</div>'
    assert pairs(spark, "a", h) == [("sq", "sr")]


def test_site_a_two_quotes_and_lost_styled_text(spark):
    h = ('<div class="text">\n  <div class="forum_quote"><div class="name">N:</div><div class="quote">q one\n</div></div>'
         '<b>styled</b> r one\n<div class="forum_quote"><div class="quote">q two</div></div><em>x</em> r two</div>')
    # direct texts of the body: "\n  ", " r one\n", " r two" -> first is blank and dropped
    assert pairs(spark, "a", h) == [("q one", "r one"), ("q two", "r two")]
    # a second blank node shifts the zip, as in the reference
    h2 = h.replace("</div></div><b>", "</div></div>\n  <b>", 1)
    assert pairs(spark, "a", h2) == [("q one", ""), ("q two", "r one")]


def test_site_b_basic_and_entities(spark):
    h = f'<td class="mes qq"><div class="quote"><b>u {WROTE_MARKER}:</b>q</div>r &amp; s</td>'
    assert pairs(spark, "b", h) == [("q", "r & s")]


def test_site_b_nested_and_second_quote(spark):
    h = (f'<td class="mes qq"><div class="quote"><b>#0 x {WROTE_MARKER}:</b><br>'
         f'<div class="quote"><b>#0 y {WROTE_MARKER}:</b> inner </div><b>outer</b></div>'
         f'reply one<div class="quote"><b>w {WROTE_MARKER}:</b>frag a<br>frag b</div>reply two<br>line two</td>')
    assert pairs(spark, "b", h) == [("inner outer", "reply one"), ("frag a frag b", "reply two line two")]
    # without a header the first reply runs on to the end of the post
    h2 = h.replace(f"<b>w {WROTE_MARKER}:</b>", "")
    assert pairs(spark, "b", h2) == [("inner outer", "reply one frag a frag b reply two line two"),
                                     ("frag a frag b", "reply two line two")]


def test_site_b_header_only_and_empty_reply(spark):
    h = f'<td class="mes qq"><div class="quote"><b>z {WROTE_MARKER}:</b></div>line a<br>line b</td>'
    assert pairs(spark, "b", h) == []
    h2 = f'<td class="mes qq"><div class="quote">q</div></td>'
    assert pairs(spark, "b", h2) == [("q", "")]


def test_site_c_quote_of_two_paragraphs_then_another(spark):
    h = ('<div data-role="commentContent"><p>intro</p><blockquote class="q"><p>first one</p><p>and more</p></blockquote>'
         '<p>answer to it</p><p>in two parts</p><blockquote><div><p>second</p></div></blockquote><p>other answer</p>'
         '<small>not in a paragraph</small></div>')
    assert pairs(spark, "c", h) == [("first one and more", "answer to it in two parts"), ("second", "other answer")]


def test_site_c_no_reply_skipped_and_repeated_fragment(spark):
    h = '<div data-role="commentContent"><blockquote><p>q</p></blockquote></div>'
    assert pairs(spark, "c", h) == []
    # the first body text containing the fragment wins, even an earlier one
    h2 = ('<div data-role="commentContent"><p>say q here</p><blockquote><p>q</p></blockquote>'
          '<p>r</p></div>')
    assert pairs(spark, "c", h2) == [("q", "q\nr".replace("\n", " "))]


def test_other_url_has_no_quotes(spark):
    df = make_posts(spark, [(1, "u", "t", '<div class="text"><div class="forum_quote"><div class="quote">a</div></div>b</div>',
                             "https://psyhelp24.org/x")])
    assert quotes.quote_pairs(df).count() == 0


def test_tags_left_open(spark):
    a = '<div class="text"><div class="forum_quote"><div class="quote"><b>q</div></div>reply</div>'
    assert pairs(spark, "a", a) == [("q", "reply")]
    b = f'<td class="mes qq"><div class="quote"><b>w {WROTE_MARKER}:</b><b>q</div>reply</td>'
    assert pairs(spark, "b", b) == [("q", "reply")]
    c = '<div data-role="commentContent"><blockquote><p>q</blockquote><p>reply</p></div>'
    assert pairs(spark, "c", c) == [("q", "reply")]
    crossed = '<td class="mes qq"><b><div class="quote">q</b></div>reply</i> more</td>'
    assert pairs(spark, "b", crossed) == [("q", "reply more")]


def test_class_tokens_in_any_order(spark):
    h = '<div class="big text"><div class="x forum_quote"><div class="quote y">q</div></div>r</div>'
    assert pairs(spark, "a", h) == [("q", "r")]
