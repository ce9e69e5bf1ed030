"""Links and pagination on a pages table.

All column expressions (regex extraction, url arithmetic); region links use
the token table. Nothing here needs a shuffle except the region tokens and
the frontier's anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.references import decode_references
from threadloom.operators.html_tokens import DROP_PATTERN, TAG_REST, attr, html_tokens, inside, is_el, tag_part
from threadloom.session import materialize

# an <a ...> tag (quoted attribute values may hold '>') and the test for an href
A_TAG_PATTERN = r"(?i)<a\s" + TAG_REST
HAS_HREF = r"(?i)\shref\s*="

# ---------------------------------------------------------------------------
# Link rules of the sites, in the order they are tried.
# (name, allowed domain, allow pattern, deny pattern, denied topic ids)
# ---------------------------------------------------------------------------
LINK_RULES = (
    ("b17_topic", "b17.ru", r"\/forum\/topic\.php\?id=", r"&p=", ()),
    ("psycheforum_forum", "psycheforum.ru", r"/forum/",
     r"(\.xml\/?$)|(\-#$)|(\/#ip$)|(\?do\=markRead)|(#ipsLayout)|(\/page\/\d+)|(#elSortBy)|(advancedSearchForm)|(sortby=)",
     ()),
    ("psycheforum_topic", "psycheforum.ru", r"/topic/", r"(\/#comments)",
     ("154794", "136149", "154744", "154745", "44267", "135209", "154791", "154792", "154793", "44267",
      "3273", "154705", "154746", "154795")),
    ("psyhelp24_consultation", "psyhelp24.org", r"psihologicheskaya-konsultatsiya-", None, ()),
)
TOPIC_ID_IN_URL = r"topic\/(\d+)-"


def links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """L1: every ``<a href>`` of a page in document order (scripts, styles and
    comments removed first; entities in the value decoded)."""
    cleaned = F.regexp_replace(F.col("html"), DROP_PATTERN, "")
    tags = F.filter(F.regexp_extract_all(tag_part(cleaned)[0], F.lit(A_TAG_PATTERN), F.lit(0)), lambda t: t.rlike(HAS_HREF))
    hrefs = F.transform(tags, lambda t: attr(t, "href"))
    x = pages.select(key, "url", F.posexplode(hrefs).alias("link_no", "href"))
    return x.select(key, "url", F.col("link_no").cast("bigint").alias("link_no"),
                    decode_references(F.col("href"), attribute=True).alias("href"))


def _no_dots(path: Column) -> Column:
    """An absolute path without ``.`` and ``..`` segments (those above the root are dropped)."""
    parts = F.slice(F.split(path, "/", -1), 2, F.length(path) + 1)
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, s: F.when(s == ".", acc).when(
        s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))))
    kept = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(F.instr(path, "/.") > 0, F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def url_join(base: Column, href: Column) -> Column:
    """L4: resolve ``href`` against ``base`` (scheme, //host, /path, ?query,
    #fragment, relative path); dot segments of path references are removed."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*/|/)", 1)
    folder = F.when(folder != "", folder).otherwise("/")
    no_frag = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("/"), F.concat(origin, _no_dots(F.regexp_extract(href, r"^([^?#]*)", 1)), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)))
             .when(href.startswith("?"), F.concat(no_query, href))
             .when(href.startswith("#"), F.concat(no_frag, href))
             .when(href == "", no_frag)
             .otherwise(F.concat(origin, _no_dots(F.concat(folder, F.regexp_extract(href, r"^([^?#]*)", 1))), F.regexp_extract(href, r"^[^?#]*(.*)$", 1))))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)", 1))


def resolved_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    ln = links(pages, key)
    return ln.withColumn("abs_url", url_join(F.col("url"), F.col("href")))


def on_domain(host: Column, domain: str) -> Column:
    """Host is ``domain`` or one of its subdomains (allowed_domains)."""
    return (host == domain) | host.endswith("." + domain)


def with_link_rule(df: DataFrame, url_col: str = "abs_url", rules=LINK_RULES) -> DataFrame:
    """L2: ``df`` with ``rule``; the host is computed once."""
    return (df.withColumn("_host", url_host(F.col(url_col)))
              .withColumn("rule", link_rule(F.col(url_col), F.col("_host"), rules)).drop("_host"))


def link_rule(url: Column, host: Column, rules=LINK_RULES) -> Column:
    """L2: name of the first rule (of the site owning the url's domain) whose
    allow pattern matches and whose deny pattern / denied ids do not; null
    when no rule takes the link."""
    out = F.lit(None).cast("string")
    for name, domain, allow, deny, ids in reversed(rules):
        ok = on_domain(host, domain) & url.rlike(allow)
        if deny:
            ok = ok & ~url.rlike(deny)
        if ids:
            ok = ok & ~F.coalesce(F.regexp_extract(url, TOPIC_ID_IN_URL, 1).isin(*ids), F.lit(False))
        out = F.when(ok, F.lit(name)).otherwise(out)
    return out


def region_links(pages: DataFrame, region_pred, key: str = "page_id", count_tags=None) -> DataFrame:
    """L3: hrefs of ``a`` elements inside a region (an element predicate)."""
    t = html_tokens(pages.select(key, "html"), [key], count_tags=count_tags, ancestors=0, keep_cols=[])
    t = t.withColumn("_in", inside([key], region_pred))
    a = t.filter((F.col("kind") == "open") & (F.col("tag") == "a") & (F.col("_in") > 0))
    a = a.select(key, "tpos", decode_references(attr(F.col("tok"), "href"), attribute=True).alias("href"))
    w = Window.partitionBy(key).orderBy("tpos")
    return a.select(key, (F.row_number().over(w) - 1).cast("bigint").alias("link_no"), "href")


def _pager(region: DataFrame, key: str) -> DataFrame:
    return region.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("link_no", "href"))), lambda x: x["href"]).alias("pager"))


def next_page(pages: DataFrame, region: DataFrame, key: str = "page_id") -> DataFrame:
    """Next category page: the pager link after the current path, the
    first one when the current path is not listed, none after the last."""
    p = pages.select(key, "url").join(_pager(region, key), key, "left")
    path = F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    cur = F.regexp_replace(path, r"/$", "")
    pos = F.array_position(F.col("pager"), cur)
    nxt = F.when(F.size(F.coalesce("pager", F.array())) == 0, F.lit(None).cast("string")) \
           .when(pos == 0, F.try_element_at("pager", F.lit(1))) \
           .otherwise(F.try_element_at("pager", (pos + 1).cast("int")))
    return p.select(key, nxt.alias("next_href"))


def next_topic_page(pages: DataFrame, region: DataFrame, key: str = "page_id") -> DataFrame:
    """Without ``?page=`` the first pager link, else the link at index
    n - 1 for ``page=n``; none past the end."""
    p = pages.select(key, "url").join(_pager(region, key), key, "left")
    has = F.instr(F.col("url"), "?page=") > 0
    n = F.regexp_extract(F.col("url"), r"\?page=(\d+)", 1)
    idx = F.when(n != "", n.cast("int"))
    nxt = F.when(F.size(F.coalesce("pager", F.array())) == 0, F.lit(None).cast("string")) \
           .when(~has, F.try_element_at("pager", F.lit(1))) \
           .when(idx >= 1, F.try_element_at("pager", idx))
    return p.select(key, nxt.alias("next_href"))


def next_page_first(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """The follow-up link of two layouts: the first ``a`` with ``rel="nofollow"`` in
    ``div.body_padding > div.page-list > span`` (resolved), else the first link
    inside a ``li`` whose class contains ``ipsPagination_next`` (as written)."""
    t = html_tokens(pages.select(key, "html"), [key], ancestors=3)
    t = t.withColumn("_in", inside([key], is_el("li", part="ipsPagination_next")))
    href = decode_references(attr(F.col("tok"), "href"), attribute=True)
    is_a = (F.col("kind") == "open") & (F.col("tag") == "a")
    listed = (is_a & (attr(F.col("tok"), "rel") == "nofollow") & is_el("span")(F.col("anc1"))
              & (F.col("anc2")["cls"] == "page-list") & (F.col("anc3")["cls"] == "body_padding"))
    linked = (F.col("kind") == "open") & (F.col("_in") > 0) & (attr(F.col("tok"), "href") != "")
    first = lambda cond: F.min(F.when(cond, F.struct(F.col("tpos"), href.alias("href"))))["href"]
    found = t.filter(listed | linked).groupBy(key).agg(first(listed).alias("_b"), first(linked).alias("_c"))
    out = pages.select(key, "url").join(found, key, "left")
    return out.select(key, F.when(F.col("_b").isNotNull(), url_join(F.col("url"), F.col("_b"))).otherwise(F.col("_c")).alias("next_href"))


def frontier(links_df: DataFrame, fetched: DataFrame, allowed_hosts: DataFrame) -> DataFrame:
    """Distinct resolved links on an allowed host that were not fetched.

    ``allowed_hosts`` is a one-column table ``host``; urls are compared without
    their fragments. Links are made distinct first; both filters are joins
    (anti, semi), so neither side is collected.
    """
    bare = lambda u: F.regexp_replace(F.col(u), r"#.*$", "").alias("url")
    c = links_df.select(bare("abs_url")).distinct()
    c = c.join(fetched.select(bare("url")), "url", "left_anti")
    c = c.withColumn("host", url_host(F.col("url")))
    return c.join(allowed_hosts.select("host").distinct(), "host", "left_semi").select("url")


def frontier_run(seen, links_df: DataFrame, fetched: DataFrame, allowed_hosts: DataFrame) -> DataFrame:
    """L8 across runs: the urls this run hands out, and ``seen`` (a ``SeenUrls``) grown by them and by the ``fetched`` ones.

    A url is handed out once: in the run that first meets it, unless that run or
    an earlier one has fetched it.
    """
    seen.extend(fetched.select(F.regexp_replace("url", r"#.*$", "").alias("url")))
    new = materialize(seen.unseen(frontier(links_df, fetched, allowed_hosts)), "frontier")
    seen.extend(new)
    return new
