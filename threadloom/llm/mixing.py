"""Mixing sources to target weights, block by block.

Each source's words form one stream (its documents in a hashed order), cut into
blocks of ``block`` words. A source's target becomes a number of slots; every
slot takes one block: slot i of an epoch is mapped through a pseudorandom
permutation of the source's block indices, so an epoch takes each block once.
Every output shard draws how many of its slots each source fills from a
multinomial distribution over the sources' shares; a source's slots are dealt to
the shards in that order. What a source still misses after all draws fills the
last shards, and what it would have too much is left out, so that its total is
exact while the shards' mixtures vary as draws do. Slots and document pieces meet
in a join on (source, block). The last slot takes only the words still missing,
so a source's taken words hit its target to the word.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.operators.ranking import global_offsets

from .common import WORD, stage

BLOCK_WORDS = 512
SHARD_SLOTS = 4096
SPAN_SHARDS, GROUP_SOURCES = 256, 4096  # shards and sources that one task draws for
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 42
BUCKETS = 4096  # pieces a source's stream is measured in, so that a hot source is many tasks
_PLAN = ("sid", "size", "blocks", "slots", "last")
_SCHEMA = "sid long, shard long, slot long, epoch long, block long, words long"


def _round(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n), or its inverse: a Feistel network with cycle walking."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64((key * 8 + r) & (2**64 - 1)) for r in range(4)]

    def once(x):
        a, b = x >> shift, x & mask
        for k in reversed(keys) if inverse else keys:
            a, b = (b ^ (_round(a, k) & mask), a) if inverse else (b, a ^ (_round(b, k) & mask))
        return (a << shift) | b

    out = once(np.asarray(index).astype(np.uint64))
    while len(far := np.flatnonzero(out >= n)):
        out[far] = once(out[far])
    return out.astype(np.int64)


def _key(sid: int, epoch: int, seed: int) -> int:
    return int(_round(np.array([sid], np.uint64), np.array([seed * 1000 + epoch], np.uint64))[0])


def slot_plan(sid: int, size: int, target: float, block: int, seed: int) -> tuple[int, int, int]:
    """(blocks of the source, slots, words of the last slot) that take round(target) words."""
    want = math.floor(target + 0.5)
    if not size or not want:
        return 0, 0, 0
    blocks = -(-size // block)
    epochs, rest = divmod(want, size)
    if not rest:
        short = int(permute(np.array([blocks - 1]), blocks, _key(sid, epochs - 1, seed))[0])
        return blocks, epochs * blocks, size - (blocks - 1) * block if short == blocks - 1 else block
    tail = size - (blocks - 1) * block  # words of the last, short block, and the slot that takes it
    at = int(permute(np.array([blocks - 1]), blocks, _key(sid, epochs, seed), inverse=True)[0])
    if rest <= at * block:
        slots, last = -(-rest // block), (rest - 1) % block + 1
    elif rest <= at * block + tail:
        slots, last = at + 1, rest - at * block
    else:
        after = rest - at * block - tail
        slots, last = at + 1 + -(-after // block), (after - 1) % block + 1
    return blocks, epochs * blocks + slots, last


def _planning(block: int, seed: int):
    """Sources -> (sid, size, blocks, slots, last) as ``slot_plan`` has them."""

    def run(batches):
        for batch in batches:
            sid, size, target = (c.to_pylist() for c in batch.columns)
            plans = list(zip(*[slot_plan(*x, block, seed) for x in zip(sid, size, target)])) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (sid, size, *plans)], list(_PLAN))

    return run


def shard_draws(first: int, count: int, slots: int, group: int, groups: np.ndarray, shares: np.ndarray, seed: int) -> np.ndarray:
    """Slots of each source of a group in the shards from ``first`` on, one row a shard.

    A shard draws its ``slots`` over the groups of sources first (``groups`` has their
    shares) and what falls to a group over its sources, which is one multinomial draw
    over all sources.
    """
    out = np.zeros((count, len(shares)), dtype=np.int64)
    for i in range(count):
        mine = np.random.default_rng([seed, first + i]).multinomial(slots, groups / groups.sum())[group]
        out[i] = np.random.default_rng([seed, first + i, group]).multinomial(mine, shares / shares.sum())
    return out


def _drawing(shard_slots: int, groups: np.ndarray, seed: int):
    """(group, range of shards, its first shard, count, sources) -> slots each source draws in each shard, with those before in the range."""

    def run(batches):
        for batch in batches:
            for group, span, first, count, sources in zip(*(c.to_pylist() for c in batch.columns)):
                plan = np.array([[x[c] for c in _PLAN] for x in sources], dtype=np.int64)
                draws = shard_draws(first, count, shard_slots, group, groups, plan[:, 3].astype(float), seed)
                before = np.cumsum(draws, axis=0) - draws
                shard, source = np.nonzero(draws)
                n = draws[shard, source]
                cols = [*plan[source].T, np.full(len(n), span), shard + first, before[shard, source], n]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [*_PLAN, "span", "shard", "before", "n"])

    return run


def _dealing(block: int, seed: int):
    """Stretches of a source's slots -> the slots, with shard, epoch, block and words."""

    def run(batches):
        for batch in batches:
            for sid, size, blocks, slots, last, shard, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                slot = np.arange(start, min(start + n, slots))
                epoch = slot // blocks
                at = np.empty(len(slot), dtype=np.int64)
                for e in np.unique(epoch).tolist():
                    mine = epoch == e
                    at[mine] = permute(slot[mine] % blocks, blocks, _key(sid, e, seed))
                words = np.minimum(block, size - at * block)
                words[slot == slots - 1] = last
                cols = [np.full(len(slot), sid), np.full(len(slot), shard), slot, epoch, at, words]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["sid", "shard", "slot", "epoch", "block", "words"])

    return run


def drawn_slots(sources: DataFrame, block: int = BLOCK_WORDS, seed: int = SEED, shard_slots: int = SHARD_SLOTS,
                group_sources: int = GROUP_SOURCES) -> DataFrame:
    """Every slot of the mixture of ``sources`` ``(sid, size, target)``: sid, shard, slot, epoch, block, words.

    Shards have ``shard_slots`` slots, less what draws exceed a source's slots by;
    the last ones make up what sources still miss. Work is dealt out by
    (group of sources, range of shards); the driver sees one share a group.
    """
    spark = sources.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = stage(sources.select("sid", "size", F.col("target").cast("double")).mapInArrow(
        _planning(block, seed), ", ".join(f"{c} long" for c in _PLAN)), "mix-plan").where("slots > 0")
    group = F.floor(F.col("sid") / group_sources)
    shares = [r[1] for r in plan.groupBy(group.alias("g")).agg(F.sum("slots").alias("n")).orderBy("g").collect()]
    shards = int(sum(shares)) // shard_slots
    grouped = plan.groupBy(group.alias("g")).agg(F.sort_array(F.collect_list(F.struct(*_PLAN))).alias("s"))
    rank = F.row_number().over(Window.orderBy("g")) - 1  # one row a group
    grouped = grouped.select(rank.cast("long").alias("group"), "s")  # on its own: beside explode it would number the exploded rows
    spans = grouped.select("group", "s", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(max(0, -(-shards // SPAN_SHARDS) - 1)).cast("long"))).alias("span")).where(F.lit(shards) > 0)
    first = F.col("span") * SPAN_SHARDS
    spans = spans.select("group", "span", first.alias("first"), F.least(F.lit(SPAN_SHARDS), F.lit(shards) - first).cast("long").alias("count"),
                         "s")
    draws = stage(spans.repartition(n, "group", "span").mapInArrow(
        _drawing(shard_slots, np.array(shares, dtype=float), seed), ", ".join(f"{c} long" for c in (*_PLAN, "span", "shard", "before", "n"))), "mix-draws")
    ahead = draws.groupBy("sid", "span").agg(F.sum("n").alias("_n"))  # one row a source and SPAN_SHARDS shards
    w = Window.partitionBy("sid").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.select("sid", "span", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))
    drawn = draws.join(ahead, ["sid", "span"]).withColumn("start", F.col("_base") + F.col("before"))
    drawn = drawn.where("start < slots").select(*_PLAN, "shard", "start", "n")
    # what sources miss, one after the other, fills whole shards behind the drawn ones
    got = draws.groupBy("sid").agg(F.sum("n").alias("_got"))
    rest = plan.join(got, "sid", "left").withColumn("start", F.least("slots", F.coalesce("_got", F.lit(0))))
    rest = rest.withColumn("n", F.col("slots") - F.col("start")).where("n > 0").drop("_got")
    rest = global_offsets(rest, ["sid"], size_col="n", out_col="_off")
    rest = rest.withColumn("_shard", F.explode(F.sequence(F.floor(F.col("_off") / shard_slots), F.floor((F.col("_off") + F.col("n") - 1) / shard_slots))))
    low = F.greatest(F.col("_off"), F.col("_shard") * shard_slots)
    high = F.least(F.col("_off") + F.col("n"), (F.col("_shard") + 1) * shard_slots)
    rest = rest.select(*_PLAN, (F.col("_shard") + shards).alias("shard"),
                       (F.col("start") + low - F.col("_off")).alias("start"), (high - low).alias("n"))
    return drawn.unionByName(rest).repartition(n, "sid", "shard").mapInArrow(_dealing(block, seed), _SCHEMA)


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (sid, size) with target: weights by sid repeat, cap at ``cap`` times the size, excess reshared."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights)).cast("int") + 1)
    src = sources.withColumn("_w", weight.cast("double")).withColumn("_cap", F.col("size") * float(cap))
    total = float(src.agg(F.sum("size")).first()[0] or 0)
    scale, capped = 0.0, -1
    while True:  # each round caps at least one more source
        over = F.col("_w") * F.lit(scale) > F.col("_cap")
        n, used, free = src.agg(F.sum(over.cast("long")), F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_w")))).first()
        if (n or 0) == capped or not free:
            break
        capped, scale = n or 0, (total - (used or 0.0)) / free
    return src.withColumn("target", F.least(F.col("_w") * F.lit(scale), F.col("_cap"))).drop("_w", "_cap")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK_WORDS, seed: int = SEED,
        row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, taken)``: the measured input rows and what the mixture takes of them.

    rows: ``_row`` (unique), ``_id``, ``_th`` (text hash), size, source_size,
    target, one row per input row. taken: one row per slot and document piece
    in it: ``_row, shard, slot, epoch, start, length`` (words of the document).
    Sources rank by code point, null last, and weigh ``weights`` in turn. Null
    and empty texts have size 0 and are never taken; a null id is kept.
    ``row_col`` names a column that numbers the rows, if there is one.
    """
    number = [F.col(row_col).alias("_row")] if row_col else []
    rows = docs.select(*number, F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"), F.col(source_col).isNull().alias("_none"),
                       F.coalesce(F.col(source_col), F.lit("")).alias("_src"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = rows.withColumn("_mix", F.xxhash64("_id", "_th")).withColumn("_bucket", F.pmod("_mix", F.lit(BUCKETS)))
    rows = stage(rows if row_col else rows.withColumn("_row", F.monotonically_increasing_id()), "mix-rows")

    # sources and the places of their buckets; a hot source is BUCKETS rows here
    buckets = stage(rows.groupBy("_none", "_src", "_bucket").agg(F.sum("size").alias("_sum")), "mix-buckets")
    sources = buckets.groupBy("_none", "_src").agg(F.sum("_sum").alias("size"))
    ranks = global_offsets(sources.select("_none", "_src"), ["_none", "_src"], out_col="sid")
    sources = stage(with_targets(stage(sources.join(ranks, ["_none", "_src"]), "mix-sources"), weights), "mix-targets")
    w = Window.partitionBy("_none", "_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (buckets.withColumn("_base", F.coalesce(F.sum("_sum").over(w), F.lit(0)))
               .join(sources.withColumnRenamed("size", "source_size"), ["_none", "_src"]).drop("_sum"))
    w = (Window.partitionBy("_none", "_src", "_bucket").orderBy("_mix", "_id", "_th", "_row")
         .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(w), F.lit(0))).join(buckets, ["_none", "_src", "_bucket"])
    placed = stage(placed.select("_row", "_id", "_th", "size", "source_size", "target", "sid",
                                 (F.col("_base") + F.col("_before")).alias("_at")), "mix-placed")

    # slots: shards draw, slot numbers map to blocks
    drawn = drawn_slots(sources.select("sid", "size", "target"), block, seed)

    pieces = placed.where("size > 0").select("_row", "size", "sid", "_at", F.explode(F.sequence(
        F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("size") - 1) / block))).alias("block"))
    first = F.greatest(F.col("_at"), F.col("block") * block)
    last = F.least(F.col("_at") + F.col("size"), F.col("block") * block + F.col("words"))
    # both sides grow with the data and a task's rows say nothing of what they become, so no broadcast
    taken = pieces.join(drawn.hint("merge"), ["sid", "block"]).withColumn("length", last - first).where("length > 0")
    return placed, taken.select("_row", "shard", "slot", "epoch", (first - F.col("_at")).alias("start"), "length")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK_WORDS, seed: int = SEED, shards_col: str | None = None) -> DataFrame:
    """The mixture as rows of ``docs``: per document and epoch the words it takes, in order.

    A document taken whole keeps its text as it is; one taken in part keeps the
    taken words joined by one space; one not taken at all is absent. A document
    of size 0 has no words to take and stays, as it is. Input columns pass through, each
    row's own, also of rows with equal ids and texts. ``shards_col`` adds the output
    shards (array of long, ascending) that the words went to; an input column of that name gives way.
    """
    src = stage(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in")), "mix-input")
    flat = src.select("_row", *[F.col(f"_in.`{c}`").alias(n) for c, n in ((id_col, "_i"), (text_col, "_t"), (source_col, "_s"))])
    placed, taken = mix(flat, "_i", "_t", "_s", weights, block, seed, row_col="_row")
    parts = taken.groupBy("_row", "epoch").agg(F.sum("length").alias("_n"), F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_parts"),
                                               F.sort_array(F.collect_set("shard")).alias("_shards"))
    parts = (placed.select("_row", "size").join(parts, "_row", "left").where("size = 0 or _n is not null")
             .select("_row", "_parts", "_shards", (F.col("size") == F.coalesce("_n", F.lit(0))).alias("_whole")))
    out = src.join(parts, "_row")
    found = F.regexp_extract_all(F.col(f"_in.`{text_col}`"), F.lit(WORD), F.lit(0))
    some = F.array_join(F.flatten(F.transform("_parts", lambda p: F.slice("_words", (p["start"] + 1).cast("int"), p["length"].cast("int")))), " ")
    out = out.withColumn("_words", F.when(~F.col("_whole"), found))
    text = F.when(F.col("_whole"), F.col(f"_in.`{text_col}`")).otherwise(some)
    shards = [F.coalesce("_shards", F.array().cast("array<bigint>")).alias(shards_col)] if shards_col else []
    return out.select(*[text.alias(c) if c == text_col else F.col(f"_in.`{c}`").alias(c) for c in docs.columns if c != shards_col], *shards)
