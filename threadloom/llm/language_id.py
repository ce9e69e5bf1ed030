"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in log space:

* the text: a multinomial model of hashed character trigrams, learnt from a
  bounded sample of documents with known language;
* the language the markup declares, and the address suffix (top-level domain):
  their likelihoods in each language come from grouped sums of the text
  posteriors over all pages;
* the host: a prior smoothed level by level, host towards domain towards all
  pages, from the same sums, without the page's own share.

The models learnt from documents are a table of languages x FEATURES (128 kB for
each of the languages, none of which is left out); whatever grows with the pages is
joined, hot hosts and suffixes apart from the others.
"""

from __future__ import annotations

import html
import pickle
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import skew_join_once, stage

FEATURES = 1 << 14
PER_LANGUAGE = 500  # documents of each language that the text model learns from: the bound of the sample
SMOOTH = 0.5  # added to every trigram count
EFFECTIVE = 30  # trigrams at most that a text counts for, since neighbours depend on each other
KAPPA = 5.0  # pages that a parent's prior weighs in its child's
NOISE = 0.02  # share of declarations and suffixes that say nothing about the language
SEED = 42
_ROWS, _BYTES = 500, 4 << 20
_CELLS = 1 << 20  # (page, language) pairs fused at a time
_SKIP = re.compile(r"<!--.*?-->|<(script|style|nav)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)


def visible_text(page: str | None) -> str:
    """Text outside tags, comments, scripts, styles and navigation, entities decoded."""
    return html.unescape(_SKIP.sub(" ", page or ""))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every character trigram of the lower-cased words, spaces at their ends."""
    flat, offsets = words.split(pa.array(["".join(c if c.isalpha() else " " for c in t.lower()) for t in texts], pa.string()))
    code, distinct = words.codes(flat)
    grams = [np.frombuffer(f"  {w.decode()} ".encode("utf-32-le"), dtype="<u4").astype(np.uint64) for w in distinct]
    hashed = [(((g[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (g[1:-1] * np.uint64(0xBF58476D1CE4E5B9)) ^ (g[2:] * np.uint64(0x94D049BB133111EB)))
               >> np.uint64(40)).astype(np.int64) % FEATURES for g in grams]
    size = np.fromiter(map(len, hashed), dtype=np.int64, count=len(hashed))
    pool = np.concatenate(hashed) if hashed else np.zeros(0, np.int64)
    sizes = size[code]
    place = (np.cumsum(size) - size)[code] - (np.cumsum(sizes) - sizes)
    feature = pool[np.repeat(place, sizes) + np.arange(int(sizes.sum()))]
    text = np.repeat(np.repeat(np.arange(len(texts)), np.diff(offsets)), sizes)
    return text, feature


def fit_text_model(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
                   per_language: int = PER_LANGUAGE) -> dict | None:
    """``languages`` (all there are) and ``logp`` (languages x FEATURES) from at most ``per_language`` whole texts each; None without any."""
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("_l"), F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    counted = known.groupBy("_l").count().collect()
    if not counted:
        return None
    languages = sorted(r[0] for r in counted)
    place = {x: i for i, x in enumerate(languages)}
    # rows that share a hash window hold about per_language documents of a language; texts never meet in one task
    share = F.element_at(F.create_map(*[x for r in counted for x in (F.lit(r[0]), F.lit(min(1.0, per_language / r[1])))]), F.col("_l"))
    drawn = known.where(F.pmod(F.xxhash64(F.lit(SEED), "_id", "_t"), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1, _ROWS, _BYTES):
                text, feature = trigrams([t or "" for t in part.column(1).to_pylist()])
                lang = np.array([place[x] for x in part.column(0).to_pylist()], dtype=np.int64)
                key, n = np.unique(lang[text] * FEATURES + feature, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n, pa.int64())], ["key", "n"])

    table = np.zeros(len(languages) * FEATURES)
    got = drawn.select("_l", "_t").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    table[np.asarray(got["key"], dtype=np.int64)] = np.asarray(got["n"], dtype=np.float64)
    table = table.reshape(len(languages), FEATURES)
    table += SMOOTH
    table /= table.sum(1, keepdims=True)
    return {"languages": languages, "logp": np.log(table, out=table)}


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def text_evidence(pages: DataFrame, model: dict, html_col: str) -> DataFrame:
    """``(_row.., ll, grams)``: tempered log-likelihoods of the page's text, relative to the likeliest language, and its number of trigrams."""
    held = pages.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    names = [c for c in pages.columns if c != html_col]

    def run(batches):
        logp = np.ascontiguousarray(pickle.loads(held.value)["logp"].T)
        for batch in batches:
            for part in words.slices(batch, 0, _ROWS, _BYTES):
                text, feature = trigrams([visible_text(t) for t in part.column(0).to_pylist()])
                ll = np.stack([np.bincount(text, weights=logp[feature, i], minlength=part.num_rows) for i in range(logp.shape[1])], axis=1)
                n = np.bincount(text, minlength=part.num_rows)[:, None]
                ll = ll * (np.minimum(n, EFFECTIVE) / np.maximum(n, 1))
                ll -= ll.max(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(list(ll), pa.list_(pa.float64())), pa.array(n[:, 0], pa.int64())],
                                                 [*names, "ll", "grams"])

    types = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in names)
    return pages.select(html_col, *names).mapInArrow(run, f"{types}, ll array<double>, grams long")


def _sums(rows: DataFrame, key: str, n: int, prefix: str) -> DataFrame:
    out = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.get("post", F.lit(i))).alias(f"_s{i}") for i in range(n)])
    return stage(out.select(key, "_n", F.array(*[f"_s{i}" for i in range(n)]).alias(prefix)), f"lang-{prefix}")


def identify(pages: DataFrame, model: dict | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, host, declared, suffix, text_lang, lang, probability)``, one row per page.

    declared is the primary subtag of the html element's lang attribute (2 or 3
    letters) or null; host and suffix are empty when the url has none. A kind of
    evidence that a page lacks is left out. text_lang is null when the page has
    no letters; without any evidence lang is the likeliest of all pages. Without
    a model (no document has a language) lang, text_lang and probability are null.
    Repeated rows and null ids are pages of their own.
    """
    url, page = F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(html_col), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    tag = F.regexp_extract(page, r"(?i)<html\b([^>]*)", 1)
    lang = F.lower(F.regexp_extract(tag, r"""(?i)(?:^|\s)lang\s*=\s*["']?\s*([a-z]{2,3})(?![a-z])""", 1))
    src = pages.select(F.col(id_col).alias("_id"), host.alias("host"), F.when(lang != "", lang).alias("declared"),
                       F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
                       F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), page.alias("_html"))
    if model is None:
        none = F.lit(None).cast("string")
        return src.select(F.col("_id").alias(id_col), "host", "declared", "suffix", none.alias("text_lang"), none.alias("lang"),
                          F.lit(None).cast("double").alias("probability"))
    names = model["languages"]
    n = len(names)
    # posteriors of the text alone: the soft counts behind all other evidence
    exps = F.transform("ll", F.exp)
    rows = text_evidence(src, model, "_html")
    rows = rows.withColumn("_e", exps).withColumn("_z", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
    rows = rows.withColumn("post", F.transform("_e", lambda x: x / F.col("_z"))).drop("_e", "_z")
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_said", F.coalesce("declared", F.lit(""))), "lang-rows")
    totals = rows.agg(*[F.sum(F.get("post", F.lit(i))) for i in range(n)]).first()
    totals = np.array([t or 0.0 for t in totals])
    overall = (totals + 1.0) / (totals.sum() + n)

    for key, kind in (("host", "host_sum"), ("domain", "domain_sum"), ("_said", "said_sum"), ("suffix", "suffix_sum")):
        sums = _sums(rows, key, n, kind)
        sums = sums.withColumn(kind, F.struct(F.col("_n").cast("double").alias("n"), F.col(kind).alias("s")))
        rows = skew_join_once(rows, sums, key, "_n", kind, salt="_row")
    args = pickle.dumps((names, totals, overall))

    def fuse(batches):
        names, totals, overall = pickle.loads(args)
        step = max(1, _CELLS // len(names))
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            col = {c: batch.column(c) for c in batch.schema.names}
            grid = lambda a: np.asarray(a.flatten(), dtype=np.float64).reshape(batch.num_rows, len(names))
            ll, post = grid(col["ll"]), grid(col["post"])
            sums = {k: (np.asarray(col[k].field("n"))[:, None], grid(col[k].field("s"))) for k in ("host_sum", "domain_sum", "said_sum", "suffix_sum")}

            def prior(kind, parent):  # of the key's other pages, smoothed towards the parent's
                count, s = sums[kind]
                return (np.maximum(s - post, 0) + KAPPA * parent) / (np.maximum(count - 1, 0) + KAPPA)

            def likelihood(kind):  # of the key given each language, from the other pages
                count, s = sums[kind]
                there = np.maximum(s - post, 0)
                share = np.maximum(count - 1, 0) / max(1.0, totals.sum() - 1)
                return (1 - NOISE) * (there + share) / (np.maximum(totals - post, 0) + 1.0) + NOISE * share + 1e-12

            score = ll + np.log(prior("host_sum", prior("domain_sum", overall)))
            said = np.asarray(pc.is_valid(col["declared"]))[:, None]
            score += np.where(said, np.log(likelihood("said_sum")), 0)
            score += np.where(np.asarray(pc.not_equal(col["suffix"], ""))[:, None], np.log(likelihood("suffix_sum")), 0)
            p = _softmax(score)
            best, text = p.argmax(1), ll.argmax(1)
            blank = np.asarray(col["grams"]) == 0
            yield pa.RecordBatch.from_arrays(
                [col["_id"], col["host"], col["declared"], col["suffix"],
                 pa.array([None if b else names[i] for i, b in zip(text, blank)], pa.string()),
                 pa.array([names[i] for i in best], pa.string()), pa.array(p.max(1))],
                ["_id", "host", "declared", "suffix", "text_lang", "lang", "probability"])

    rows = rows.select("_id", "host", "declared", "suffix", "ll", "grams", "post", "host_sum", "domain_sum", "said_sum", "suffix_sum")
    kind = pages.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(fuse, f"_id {kind}, host string, declared string, suffix string, text_lang string, lang string, probability double")
    return out.withColumnRenamed("_id", id_col)

