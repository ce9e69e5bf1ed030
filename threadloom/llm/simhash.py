"""SimHash near-deduplication by multi-index hashing.

A 64-bit fingerprint is cut into two 32-bit segments. Two fingerprints within
3 bits differ by at most 1 bit in one of the segments, so every fingerprint
probes the table with the radius-1 Hamming ball (33 values) of each of its
segments, and every match is verified on the complete distance. Components of
the links are found by star contraction.

Work is per distinct fingerprint, so copies cost nothing. A segment value that
more than ``DENSE`` fingerprints share is not paired off: the fingerprints that
probe it are linked through shared points instead. x and y are within 3 bits
exactly if some 64-bit point is within 1 bit of one and 2 bits of the other, so
each point's fingerprints within 2 bits are linked to the smallest fingerprint
within 1 bit of it: at most 2,081 rows a fingerprint, whatever the bucket's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import words
from .common import connected_components, skew_join, stage

SHINGLE = 3
MAX_BITS = 3
SEED = 42
DENSE = 2048
_ROWS, _BYTES = 256, 4 << 20  # rows and text bytes handled at a time


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the word shingles (fewer words: the whole sequence; none: 0)."""
    words = (text or "").encode().lower().split()  # bytes: exactly A-Z and [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in
                  zip(starts[:len(words) - shingle + 1].tolist(), (ends[shingle - 1:] - 1).tolist())]
    h = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    value = 0
    for byte in range(8):
        counts = np.bincount(h[:, byte], minlength=256) @ _BITS
        for bit in np.flatnonzero(2 * counts > len(hashes)):
            value |= 1 << (8 * byte + int(bit))
    return value


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(_id, _th, fp)``, one row per input row: id, text hash, and the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1, _ROWS, _BYTES):
                fps = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fps.view(np.int64))], ["_id", "_th", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"), F.xxhash64(text_col).alias("_th"))
    return src.mapInArrow(run, "_id long, _th long, fp long")


def _segments(fp):
    """The table keys of a fingerprint: segment number above its 32 bits."""
    low = F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF))
    return low, F.shiftrightunsigned(fp, 32).bitwiseOR(F.lit(1 << 32))


#: The 2,081 bit masks of a radius-2 ball, with a flag for those of radius 1.
_BALL = """flatten(array(array(named_struct('mask', 0L, 'near', true)),
    flatten(transform(sequence(0, 63), i -> transform(sequence(i, 63), j ->
        named_struct('mask', shiftleft(1L, i) | shiftleft(1L, j), 'near', i = j))))))"""


def hamming_links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Edges ``(u, v)`` of distinct fingerprints ``fp``: every pair within 3 bits is joined by a path of them."""
    lo, hi = _segments("fp")
    table = fps.select("fp", F.explode(F.array(lo, hi)).alias("key"))
    sizes = table.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowded = stage(sizes.where(F.col("n") > dense).select("key"), "simhash-crowded")
    entries = (table.join(crowded, "key", "left_anti").select("key", F.col("fp").alias("other"))
               .unionByName(crowded.select("key", F.lit(None).cast("long").alias("other"))))
    flips = F.expr("transform(sequence(-1, 31), b -> if(b < 0, 0L, shiftleft(1L, b)))")
    probes = fps.select("fp", F.explode(F.flatten(F.array(
        F.transform(flips, lambda m: lo.bitwiseXOR(m)), F.transform(flips, lambda m: hi.bitwiseXOR(m))))).alias("key"))
    met = stage(probes.join(entries.hint("shuffle_hash"), "key").where(
        F.col("other").isNull() | ((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS)))
        .select("fp", "other"), "simhash-met")
    pairs = met.where("other is not null").select(F.col("fp").alias("u"), F.col("other").alias("v")).distinct()

    # the fingerprints that probe a crowded value: linked through points near them
    rest = met.where("other is null").select("fp").distinct()
    points = rest.select("fp", F.explode(F.expr(_BALL)).alias("b")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("b.mask")).alias("point"), "b.near")
    hubs = points.where("near").groupBy("point").agg(F.min("fp").alias("hub"))
    through = points.join(hubs, "point").select(F.col("fp").alias("u"), F.col("hub").alias("v")).where("u <> v").distinct()
    return pairs.unionByName(through)


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, dense: int) -> DataFrame:
    """``(_id, _th, fp, root, component_id)`` per input row; root is the component's smallest fingerprint."""
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    fps = stage(rows.groupBy("fp").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-fps")
    roots = stage(connected_components(hamming_links(fps.select("fp"), dense), "simhash-edges"), "simhash-roots")
    members = stage(fps.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "root", "first", "n"), "simhash-members")
    per_root = stage(members.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("m")), "simhash-classes")
    linked = skew_join(members, per_root, ["root"], "m").select("fp", "n", "root", "component_id")
    alone = (fps.join(roots.select(F.col("node").alias("fp")), "fp", "left_anti")
             .select("fp", "n", F.col("fp").alias("root"), F.col("first").alias("component_id")))
    per_fp = stage(linked.unionByName(alone), "simhash-labels")
    return skew_join(rows, per_fp, ["fp"], "n").select("_id", "_th", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       dense: int = DENSE) -> DataFrame:
    """``(id_col, fp, component_id)``, one row per input row.

    component_id is the smallest id reachable over links of at most 3 bits,
    the row's own included. Null and empty texts have fingerprint 0 and are
    linked like any other; rows with a null id belong to components but never
    name one (a component of null ids only has a null component_id).
    """
    return _labelled(docs, id_col, text_col, shingle, dense).select(F.col("_id").alias(id_col), "fp", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  dense: int = DENSE) -> DataFrame:
    """The rows of ``docs`` with one row per component: its smallest id (null last), then text hash; repeated rows once."""
    best = F.min(F.struct(F.col("_id").isNull().alias("a"), F.col("_id").alias("b"), F.col("_th").alias("c")))
    stay = _labelled(docs, id_col, text_col, shingle, dense).groupBy("root").agg(best.alias("_best"))
    stay = stay.select(F.col("_best.b").alias("_sid"), F.col("_best.c").alias("_sth"))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"), F.col(id_col).cast("long").alias("_id"),
                      F.xxhash64(text_col).alias("_th"))
    out = src.join(stay, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_th") == F.col("_sth")), "left_semi")
    once = F.row_number().over(Window.partitionBy("_id", "_th").orderBy("_id"))
    return out.withColumn("_k", once).where("_k = 1").select("_in.*")
