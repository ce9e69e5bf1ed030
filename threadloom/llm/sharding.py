"""Sharding by balanced label propagation.

Documents that share a link key pull each other into one shard. Linked documents
start in hashed shards; in each round they see, through a join on their keys, how
many neighbours every shard holds and want to move to the one with most. A quota
lets only as many bytes into a shard as it has capacity left, largest groups
first. Documents without links have no neighbours to lose, so they fill what the
rounds leave, longest first, which makes the shards' bytes equal up to a short
document. A group larger than a shard fills shard after shard.

All of it is DataFrame functions. The driver sees sums per shard only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import skew_join_once, stage

SHARDS = 8
ROUNDS = 8  # of each phase, at most
RESERVE = 0.9
BUCKETS = 4096  # pieces that running sums are cut into
#: Documents longer than these shares of a shard are placed before the shorter ones.
TIERS = (1 / 16, 1 / 64, 1 / 256, 1 / 1024)


def _pick(values: list, index: Column) -> Column:
    """values[index] for a short list of numbers."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _cuts(rows: DataFrame, shard: str, rank: str, limits: list[float]) -> list[int]:
    """Per shard the last ``rank`` (bounded in number) up to which the bytes stay within its limit."""
    sums = rows.groupBy(shard, rank).agg(F.sum("size").alias("_b"))
    total = F.sum("_b").over(Window.partitionBy(shard).orderBy(rank))
    last = sums.withColumn("_t", total).where(F.col("_t") <= _pick(limits, F.col(shard))).groupBy(shard).agg(F.max(rank)).collect()
    out = [-1] * len(limits)
    for s, r in last:
        out[s] = r
    return out


def _loads(rows: DataFrame, n: int) -> list[int]:
    out = [0] * n
    for s, b in rows.groupBy("shard").agg(F.sum("size")).collect():
        out[s] = int(b)
    return out


def _before(rows: DataFrame, order: list[str], value: Column, part: list[str] | None = None) -> DataFrame:
    """``rows`` with ``_at``: the sum of ``value`` over the rows before it (in its part), bucket by bucket."""
    part = part or []
    rows = rows.withColumn("_bk", F.pmod(F.xxhash64(order[0]), F.lit(BUCKETS))).withColumn("_v", value)
    sums = rows.groupBy(*part, "_bk").agg(F.sum("_v").alias("_s"))  # at most BUCKETS rows a part
    w = Window.partitionBy(*part).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("_base", F.coalesce(F.sum("_s").over(w), F.lit(0))).drop("_s")
    w = Window.partitionBy(*part, "_bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_v").over(w), F.lit(0))).join(base, [*part, "_bk"])
    return rows.withColumn("_at", F.col("_base") + F.col("_in")).drop("_bk", "_v", "_base", "_in")


def _quotas(wanted: list[float], free: list[float], n: int) -> list[float]:
    """Bytes that may move from shard s to shard t (at s * n + t): no shard gains more than it has free."""
    quota = list(wanted)
    for _ in range(200):
        steady = True
        for t in range(n):
            into, out = sum(quota[t::n]), sum(quota[t * n:t * n + n])
            allowed = max(0.0, free[t] + out)
            if into > allowed * (1 + 1e-9):
                steady = False
                for s in range(n):
                    quota[s * n + t] *= allowed / into
        if steady:
            break
    return quota


def propagate(linked: DataFrame, n: int, capacity: float, rounds: int = ROUNDS) -> DataFrame:
    """``linked`` ``(row, size, keys)`` with a shard, after rounds of label propagation under the capacity.

    First the largest groups gather, up to the share RESERVE of each shard; then
    the smallest first, up to all of it. What leaves a shard makes room in the same
    round. A shard that had to refuse documents is closed until all are, so that
    a group too large for it turns to the next.
    """
    state = stage(linked.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")), "shards-state")
    for share, largest in ((RESERVE, True), (1.0, False)):
        closed: set[int] = set()
        for _ in range(rounds):
            loads = _loads(state, n)
            free = [max(share * capacity, sum(loads) / n) - x for x in loads]
            seen = state.select("row", F.explode("keys").alias("key"), "shard")
            counts = seen.groupBy("key").agg(*[F.count(F.when(F.col("shard") == i, 1)).alias(f"n{i}") for i in range(n)])
            counts = counts.select("key", F.array(*[f"n{i}" for i in range(n)]).alias("votes"), sum(F.col(f"n{i}") for i in range(n)).alias("all"))
            met = skew_join_once(seen, stage(counts, "shards-votes"), "key", "all", "votes", salt="row")
            votes = met.groupBy("row").agg(F.min("key").alias("k"), *[F.sum(F.get("votes", F.lit(i))).alias(f"v{i}") for i in range(n)])
            # ties go to open shards, then by a hash of the key, so that all of a group choose alike
            best = F.array_max(F.array(*[F.when(F.lit(i not in closed) | (F.col("shard") == i), F.struct(
                F.col(f"v{i}").alias("n"), F.lit(i not in closed).alias("open"), F.xxhash64("k", F.lit(i)).alias("tie"), F.lit(i).alias("to")))
                for i in range(n)]))
            wish = state.join(votes, "row").withColumn("_best", best)
            level = F.least(F.floor(F.log2(F.col("_best.n").cast("double"))), F.lit(40))
            rank = ((40 - level if largest else level) * 65536
                    + F.pmod(F.xxhash64("k"), F.lit(256)) * 256 + F.pmod(F.xxhash64("row"), F.lit(256)))
            wish = stage(wish.select("row", "size", "keys", "shard", F.col("_best.to").alias("to"), rank.cast("long").alias("rank")), "shards-wish")
            movers = wish.where("to <> shard").withColumn("flow", F.col("shard") * n + F.col("to"))
            wanted = [0.0] * (n * n)
            for flow, size in movers.groupBy("flow").agg(F.sum("size")).collect():  # n * n rows at most
                wanted[flow] = float(size)
            quota = _quotas(wanted, free, n)
            cuts = _cuts(movers, "flow", "rank", quota)
            if max(cuts) < 0:
                break
            closed |= {t for t in range(n) if sum(quota[t::n]) < 0.999 * sum(wanted[t::n])}
            if len(closed) == n:
                closed = set()
            moves = (F.col("to") != F.col("shard")) & (F.col("rank") <= _pick(cuts, F.col("shard") * n + F.col("to")))
            state = stage(wish.select("row", "size", "keys", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard")), "shards-state")
    return state


def balanced_shards(rows: DataFrame, n: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` ``(row, size, keys)`` with shard (0 to n - 1) and slot (gapless from 0 in each shard).

    ``row`` is unique, ``size`` positive, ``keys`` the array of link keys (null
    or empty: none). Shards' bytes are equal but for about half of the last
    documents placed; keys that many rows share are no hot spot.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = total / n
    seen = rows.select("row", "size", F.explode("keys").alias("key"))
    shared = stage(seen.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").withColumn("yes", F.lit(True)), "shards-keys")
    linked = skew_join_once(seen, shared, "key", "n", "yes", salt="row").groupBy("row").agg(
        F.first("size").alias("size"), F.sort_array(F.collect_set("key")).alias("keys"))
    state = propagate(linked, n, capacity, rounds)

    # what exceeds a shard (only if links leave no room) and what has no links is the pool
    loads = _loads(state, n)
    ranked = state.withColumn("rank", F.pmod(F.xxhash64(F.get("keys", F.lit(0))), F.lit(256)) * 256 + F.pmod(F.xxhash64("row"), F.lit(256)))
    cuts = [2**62 if b <= capacity else c for b, c in zip(loads, _cuts(ranked, "shard", "rank", [capacity] * n))]
    kept = ranked.withColumn("stays", F.col("rank") <= _pick(cuts, F.col("shard")))
    placed = stage(kept.where("stays").select("row", "size", "shard"), "shards-placed")
    pool = rows.select("row", "size").join(placed.select("row"), "row", "left_anti")
    tier = sum((F.col("size") <= F.lit(capacity * t)).cast("int") for t in TIERS)
    pool = stage(pool.withColumn("tier", tier), "shards-pool")
    loads, done = _loads(placed, n), [placed]
    sums = {t: int(b) for t, b in pool.groupBy("tier").agg(F.sum("size")).collect()}
    for t in sorted(sums):
        room = [max(0.0, capacity - b) for b in loads]
        share, edges = sums[t] / (sum(room) or 1), []
        for r in room:
            edges.append((edges[-1] if edges else 0.0) + r * share)
        middle = F.col("_at") + F.col("size") / 2
        at = sum((middle >= F.lit(e)).cast("int") for e in edges[:-1])
        part = _before(pool.where(F.col("tier") == t), ["row"], F.col("size"))
        part = stage(part.select("row", "size", F.lit(0).cast("int").alias("_z") if n == 1 else at.alias("_z")).withColumnRenamed("_z", "shard"), "shards-placed")
        done.append(part)
        loads = [a + b for a, b in zip(loads, _loads(part, n))]
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = _before(out.select("row", "shard"), ["row"], F.lit(1).cast("long"), ["shard"])
    return rows.join(out.select("row", "shard", F.col("_at").alias("slot")), "row")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHARDS) -> DataFrame:
    """``(id_col, size, text_crc32, key, shard, slot)``, one row per input row; equal texts are linked.

    size is the text's UTF-8 bytes plus 1 (null: 1, like an empty text, which it
    is linked with). Repeated rows and null ids are documents of their own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text).alias("key"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "shards-rows")
    placed = balanced_shards(rows.select("row", "size", F.array("key").alias("keys")), n)
    return rows.join(placed.select("row", "shard", "slot"), "row").select(
        F.col("_id").alias(id_col), "size", "text_crc32", "key", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
