"""Page structure queries on the token table (T1-T6) and field loaders.

Pages are tokenised with ``PAGE_CONTAINERS`` as the depth-counting tags, so
unclosed ``p`` / ``b`` / ``li`` do not corrupt nesting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import strip_ws
from threadloom.operators.html_tokens import PAGE_CONTAINERS, attr, html_tokens, inside, is_el, token_no

KEY = "page_id"


def page_tokens(pages: DataFrame, ancestors: int = 1) -> DataFrame:
    """T1 on pages, one shuffle by page."""
    return html_tokens(pages.select(KEY, "html"), [KEY], count_tags=PAGE_CONTAINERS, ancestors=ancestors)


def token_table(tokens: DataFrame) -> DataFrame:
    """T1 + T2 flattened: kind, tag, depth and the parent element's tag."""
    is_end = (F.col("kind") == "close") & (F.col("delta") == -1)
    parent = F.when(F.col("is_elem") | is_end, F.col("anc1")["tag"]).otherwise(F.col("anc0")["tag"])
    return tokens.select(KEY, token_no(F.col("tpos")).alias("tpos"), "kind", "tag",
                         F.col("d_before").cast("bigint").alias("depth"), parent.alias("parent_tag"), "text")


def depth_summary(tokens: DataFrame) -> DataFrame:
    """Per page token and element counts, maximum and final depth."""
    return tokens.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count_if("is_elem").alias("n_elements"),
        F.max("d_after").cast("bigint").alias("max_depth"),
        F.max_by("d_after", "tpos").cast("bigint").alias("end_depth"))


def _ordered(cond: Column, value: Column) -> Column:
    coll = F.collect_list(F.when(cond, F.struct(F.col("tpos"), value.alias("v"))))
    return F.transform(F.array_sort(coll), lambda x: x["v"])


def element_texts(tokens: DataFrame, pred, name: str) -> DataFrame:
    """All text nodes under the elements matching ``pred`` (``//text()``), joined by newline."""
    t = tokens.withColumn("_in", inside([KEY], pred))
    g = t.groupBy(KEY).agg(_ordered((F.col("kind") == "text") & (F.col("_in") > 0), F.col("text")).alias("_t"))
    return g.select(KEY, F.array_join("_t", "\n").alias(name))


def direct_texts(tokens: DataFrame, pred, name: str) -> DataFrame:
    """T4: direct text nodes of the elements matching ``pred`` (``/text()``)."""
    cond = (F.col("kind") == "text") & pred(F.col("anc0"))
    g = tokens.groupBy(KEY).agg(_ordered(cond, F.col("text")).alias("_t"))
    return g.select(KEY, F.array_join("_t", "").alias(name))


def element_attr(tokens: DataFrame, tag: str, name: str) -> DataFrame:
    """T5: attribute of the first element with ``tag``."""
    cond = (F.col("kind") == "open") & (F.col("tag") == tag)
    g = tokens.groupBy(KEY).agg(F.min(F.when(cond, F.struct(F.col("tpos"), attr(F.col("tok"), name).alias("v"))))
                                .alias("_a"))
    return g.select(KEY, F.col("_a")["v"].alias(name))


def element_html(tokens: DataFrame, pred, name: str) -> DataFrame:
    """Markup of the first element matching ``pred``, from its open tag
    to its matching close tag (tokens concatenated in order)."""
    t = tokens.withColumn("_in", inside([KEY], pred))
    own = (F.col("is_elem") | ((F.col("kind") == "close") & (F.col("delta") == -1))) & pred(F.col("anc0"))
    g = t.groupBy(KEY).agg(_ordered((F.col("_in") > 0) | own, F.col("tok")).alias("_t"))
    return g.select(KEY, F.array_join("_t", "").alias(name))


# ---------------------------------------------------------------------------
# field loaders (X1-X3): map, join, first over ordered value arrays
# ---------------------------------------------------------------------------
def field_map_strip_nonempty(values: Column) -> Column:
    """Strip each value, map empty to None and drop it."""
    stripped = F.transform(values, lambda v: strip_ws(v))
    return F.filter(F.transform(stripped, lambda v: F.when(v != "", v)), lambda v: v.isNotNull())


def field_join(values: Column, sep: str) -> Column:
    """Join values with a separator (empty strings kept)."""
    return F.array_join(values, sep)


def field_first(values: Column) -> Column:
    """First non-null, non-empty value."""
    return F.try_element_at(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(1))


def nav_fields(tokens: DataFrame) -> DataFrame:
    """X1-X3 on the texts of the navigation links of every page."""
    t = tokens.withColumn("_in_nav", inside([KEY], is_el("nav")))
    g = t.groupBy(KEY).agg(_ordered((F.col("kind") == "text") & (F.col("_in_nav") > 0), F.col("text")).alias("_v"))
    mapped = field_map_strip_nonempty(F.col("_v"))
    return g.select(KEY, F.size(mapped).cast("bigint").alias("n_values"), field_join(mapped, "-").alias("joined"),
                    field_first(F.col("_v")).alias("first_value"))


def topic_titles(tokens: DataFrame) -> DataFrame:
    """The h1 title as each site reads it.

    A: first h1 direct text node; B: h1 texts stripped, empty dropped,
    joined by '-'; C: h1 texts joined by a space, then stripped;
    D: first text node of the first h2.
    """
    t = tokens.withColumn("_in_h1", inside([KEY], is_el("h1"))).withColumn("_in_h2", inside([KEY], is_el("h2")))
    is_text = F.col("kind") == "text"
    g = t.groupBy(KEY).agg(
        _ordered(is_text & is_el("h1")(F.col("anc0")), F.col("text")).alias("_h1d"),
        _ordered(is_text & (F.col("_in_h1") > 0), F.col("text")).alias("_h1"),
        _ordered(is_text & (F.col("_in_h2") > 0), F.col("text")).alias("_h2"))
    return g.select(KEY, F.try_element_at("_h1d", F.lit(1)).alias("title_a"),
                    field_join(field_map_strip_nonempty(F.col("_h1")), "-").alias("title_b"),
                    strip_ws(field_join(F.col("_h1"), " ")).alias("title_c"),
                    F.try_element_at("_h2", F.lit(1)).alias("title_d"))
