"""The operators as named queries over the whole driver tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from . import exact_dedup as exact
from . import language_id as language
from . import line_dedup as lines
from . import merkle_manifest as merkle
from . import mixing, packing, simhash
from . import periodic_runs as periodic
from . import quality_knn as quality
from . import sharding
from . import substring_dedup as substring
from . import topk_search as search
from threadloom.sources.tables import read_table

from .common import LOWER, UPPER, WORD, WS, documents, stage, workers_can_import


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """An installed public vocabulary (documents are packed with this one)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    out = quality.quality_scores(docs.withColumn("held_out", quality.held_out("doc_id")), model)
    return out.select("doc_id", "held_out", "score", "predicted")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, taken = mixing.mix(documents(spark, sf_dir))
    totals = taken.groupBy("_row").agg(F.sum("length").alias("taken"))
    return placed.join(totals, "_row", "left").select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), WS, ""), 256)
    return (exact.exact_dedup(documents(spark, sf_dir), carry={"text_sha256": digest})
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = search.quantised(read_table(spark, sf_dir, "embeddings")).withColumn("row", F.monotonically_increasing_id())
    vectors = stage(vectors, "topk-vectors")  # a row keeps its number
    return search.top_k(vectors.where("id % 50 = 0"), vectors)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit_text_model(documents(spark, sf_dir))
    return language.identify(read_table(spark, sf_dir, "pages"), model)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the documents, checked against rows of which a third is tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    row = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in merkle.FIELDS]
    out = merkle.merkle_manifest(documents(spark, sf_dir), carry={"forged": F.when(tampered, merkle.leaf_digest(row))})
    out = out.withColumn("folded_root", merkle.folded(F.coalesce("forged", "leaf"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents; one in ten repeats itself from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("_words")
    some = F.greatest(n, F.lit(1))
    a = g % some
    p = 1 + F.floor((some - a) / (3 + g % 8))
    word = lambda w, i: F.when(i < a, w).otherwise(F.get("_words", (a + (i - a) % p).cast("int")))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("_words", F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))))
    docs = docs.select("doc_id", F.when(F.col("_words").isNull(), F.col("text")).otherwise(F.array_join(F.transform("_words", word), " ")).alias("text"))
    out = periodic.periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), "_best.length",
        (-F.col("_best.period")).alias("period"), F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    out = bpe.decode_documents(bpe.encode_documents(documents(spark, sf_dir).select("doc_id", "text"), path).drop("text"), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def _ready(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_can_import(spark)
        return query(spark, sf_dir)

    return run


REGISTRY = {name: _ready(query) for name, query in {
    "op1_sharding": op1_sharding,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_topk_search": op6_topk_search,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_bpe": op13_bpe,
}.items()}
