"""Global rank / running offset without one big window partition.

A window with ``orderBy`` but no ``partitionBy`` sends every row to one task.
``global_offsets`` instead

1. range-partitions the rows by the order key (Spark samples the key, so a hot
   value is spread over as many partitions as it fills) and sorts inside
   each partition;
2. numbers the rows of each partition as they stream by (or sums their sizes,
   in Arrow batches), the payload riding along;
3. writes that pass once as a stage table, sums each partition from it (a
   table with at most ``num_partitions`` rows, a proven bound), turns the
   sums into partition base offsets, and broadcast-joins them by partition.

The result is exact: ``offset`` = sum of ``size_col`` over all rows strictly
before this row in ``order_cols`` order; with ``size_col=None`` it is the
0-based global rank. Rows are never joined on the order key, so null and
repeated keys keep their rows; nulls come first, and rows with equal keys
get their places in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROW_BITS = 33  # of monotonically_increasing_id: the row number inside its partition


def global_offsets(df: DataFrame, order_cols: Sequence[str], size_col: str | None = None,
                   out_col: str = "offset", num_partitions: int | None = None) -> DataFrame:
    """Exact running offset (or 0-based rank) of every row in ``order_cols`` order; all columns of ``df`` stay."""
    from threadloom.session import materialize
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    place = F.monotonically_increasing_id()
    if size_col is None:
        local = r.withColumn("_pid", F.shiftright(place, _ROW_BITS)).withColumn("_local", place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        local = local.withColumn("_sz", F.lit(1).cast("long"))
    else:
        r = r.withColumn("_pid", F.shiftright(place, _ROW_BITS)).withColumn("_sz", F.col(size_col).cast("long"))
        names = [*r.columns, "_local"]

        def scan(batches):
            carry = 0
            for b in batches:  # one partition, already sorted; batches arrive in order
                size = pc.fill_null(b.column(b.schema.get_field_index("_sz")), 0)
                end = pc.add(pc.cumulative_sum(size), pa.scalar(carry, pa.int64()))
                yield pa.RecordBatch.from_arrays([*b.columns, pc.subtract(end, size)], names)
                carry = end[-1].as_py() if b.num_rows else carry

        local = r.mapInArrow(scan, T.StructType([*r.schema.fields, T.StructField("_local", T.LongType())]))
    local = materialize(local, "ranked")
    totals = local.groupBy("_pid").agg(F.sum("_sz").alias("_tot"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    base = totals.select("_pid", F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias("_base"))
    return local.join(F.broadcast(base), "_pid").select(
        *df.columns, (F.col("_base") + F.col("_local")).cast("bigint").alias(out_col))


# ---------------------------------------------------------------------------
# Ordered scans inside a partition key without one task per key
# ---------------------------------------------------------------------------
# A hot key (a topic holding a third of all posts) must not become one window
# partition. Rows are cut into buckets of ``bucket_size`` consecutive order
# values; windows run per (key, bucket); a per-bucket summary (at most
# key_size / bucket_size rows per key) carries values across buckets.
DEFAULT_BUCKET = 1 << 16


def _same_key(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` that takes nulls as equal, so rows with a null key stay."""
    right = summary.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in summary.columns])
    cond = None
    for c in keys:
        same = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        cond = same if cond is None else cond & same
    return rows.join(right, cond).drop(*[f"_k_{c}" for c in keys])


def with_bucket(df: DataFrame, order_col: str, bucket_size: int = DEFAULT_BUCKET, name: str = "_bk") -> DataFrame:
    return df.withColumn(name, F.floor(F.col(order_col) / F.lit(bucket_size)).cast("bigint"))


def scan_first(df: DataFrame, part: list[str], order_col: str, value_col: str, out_col: str,
               bucket: str = "_bk") -> DataFrame:
    """``out_col`` = ``value_col`` of the first row (by ``order_col``) of the key;
    also ``out_col + '_pos'``: that row's order value.

    The per-bucket summary is read off the bucket window itself, one row per
    bucket.
    """
    wb = Window.partitionBy(*part, bucket).orderBy(order_col)
    d = (df.withColumn("_rn", F.row_number().over(wb))
           .withColumn("_bf", F.first(F.struct(F.col(order_col).alias("o"), F.col(value_col).alias("v")))
                       .over(wb.rowsBetween(Window.unboundedPreceding, 0))))
    s = d.filter(F.col("_rn") == 1).select(*part, bucket, "_bf")
    ws = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    s = s.select(*part, bucket, F.first("_bf").over(ws).alias("_ff"))
    s = s.select(*part, bucket, F.col("_ff")["v"].alias(out_col), F.col("_ff")["o"].alias(out_col + "_pos"))
    return _same_key(d.drop("_rn", "_bf"), s, [*part, bucket])


def scan_lag(df: DataFrame, part: list[str], order_col: str, columns: dict[str, str], bucket: str = "_bk") -> DataFrame:
    """Add the previous row's ``columns`` (old name -> new name) in ``order_col`` order of each key.

    ``lag`` runs per (key, bucket); a bucket's first row takes the last row of
    the bucket before it from a summary of one row per bucket.
    """
    wb = Window.partitionBy(*part, bucket).orderBy(order_col)
    held = F.struct(*[F.col(c).alias(new) for c, new in columns.items()])
    ends = df.groupBy(*part, bucket).agg(F.max_by(held, order_col).alias("_last"))
    before = ends.select(*part, bucket, F.lag("_last").over(Window.partitionBy(*part).orderBy(bucket)).alias("_before"))
    d = _same_key(df.withColumn("_prev", F.lag(held).over(wb)), before, [*part, bucket])
    prev = F.coalesce("_prev", "_before")
    return d.select(*df.columns, *[prev[new].alias(new) for new in columns.values()])


def scan_transitions(df: DataFrame, part: list[str], order_col: str, value_col: str, step, out_col: str,
                     bucket: str = "_bk") -> DataFrame:
    """Running count of ``step(prev, cur)`` over the rows of each key.

    ``step`` maps the previous row's ``value_col`` and this row's to a
    boolean; the first row of a key never counts. Equals
    ``sum(step(lag(v), v)) over (partition by key order by order_col)``,
    computed per bucket plus a per-bucket base from a summary of at most
    key_size / bucket_size rows per key.
    """
    wb = Window.partitionBy(*part, bucket).orderBy(order_col)
    run = wb.rowsBetween(Window.unboundedPreceding, 0)
    full = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = F.col(value_col)
    d = (df.withColumn("_rn", F.row_number().over(wb)).withColumn("_lp", F.lag(value_col).over(wb))
           .withColumn("_bfirst", F.first(value_col).over(full)).withColumn("_blast", F.last(value_col).over(full)))
    d = d.withColumn("_st", F.when(F.col("_rn") > 1, F.coalesce(step(F.col("_lp"), v), F.lit(False)))
                     .otherwise(F.lit(False)).cast("long"))
    d = d.withColumn("_lc", F.sum("_st").over(run)).withColumn("_tot", F.sum("_st").over(full))
    s = d.filter(F.col("_rn") == 1).select(*part, bucket, "_bfirst", "_blast", "_tot")
    ws = Window.partitionBy(*part).orderBy(bucket)
    s = s.withColumn("_prev_last", F.lag("_blast").over(ws))
    s = s.withColumn("_edge", F.when(F.lag(bucket).over(ws).isNull(), F.lit(0))
                     .otherwise(F.coalesce(step(F.col("_prev_last"), F.col("_bfirst")), F.lit(False)).cast("long")))
    s = s.withColumn("_base", F.coalesce(F.sum(F.col("_tot") + F.col("_edge"))
                                         .over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.select(*part, bucket, "_edge", "_base")
    d = _same_key(d, s, [*part, bucket])
    return d.withColumn(out_col, (F.col("_base") + F.col("_edge") + F.col("_lc")).cast("bigint")).drop(
        "_rn", "_lp", "_bfirst", "_blast", "_st", "_lc", "_tot", "_edge", "_base")


def scan_rank(df: DataFrame, part: list[str], order_cols: list[str], out_col: str,
              bucket: str = "_bk") -> DataFrame:
    """0-based ``row_number`` within each key in ``order_cols`` order.

    ``bucket`` must be monotone in the order (e.g. ``floor(first order column
    / size)``). Ranks are local per (key, bucket) plus the sizes of the
    earlier buckets, read off the same window (one row per bucket).
    """
    wb = Window.partitionBy(*part, bucket).orderBy(*order_cols)
    d = (df.withColumn("_rn", F.row_number().over(wb))
           .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy(*part, bucket))))
    s = d.filter(F.col("_rn") == 1).select(*part, bucket, "_cnt")
    ws = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(*part, bucket, F.coalesce(F.sum("_cnt").over(ws), F.lit(0)).alias("_base"))
    d = _same_key(d, s, [*part, bucket])
    return d.withColumn(out_col, (F.col("_base") + F.col("_rn") - 1).cast("bigint")).drop("_rn", "_cnt", "_base")


def scan_last(df: DataFrame, part: list[str], order_cols: list[str], value_col: str, out_col: str,
              bucket: str = "_bk") -> DataFrame:
    """``out_col`` = the last non-null ``value_col`` up to and including the row, in ``order_cols`` order of each key.

    The as-of primitive: rows that look something up hold null, rows that are
    looked up hold their value. ``bucket`` must be monotone in the order. The
    running value is local per (key, bucket); a bucket takes what the buckets
    before it end with from a summary of one row per bucket.
    """
    wb = Window.partitionBy(*part, bucket).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("_run", F.last(value_col, ignorenulls=True).over(wb))
    held = F.struct(*order_cols, F.col(value_col).alias("_v"))
    ends = df.groupBy(*part, bucket).agg(F.max(F.when(F.col(value_col).isNotNull(), held))["_v"].alias("_end"))
    before = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*part, bucket, F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    d = _same_key(d, ends, [*part, bucket])
    return d.select(*df.columns, F.coalesce("_run", "_carry").alias(out_col))


# A key is hot when it holds at least 1/HOT_KEYS of the summed weight, so there
# are at most HOT_KEYS hot keys: the proven bound of the broadcast below.
HOT_KEYS = 1024


def hot_key_join(rows: DataFrame, per_key: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``per_key`` (one row per key, ``weight`` = its share of the rows), nulls as equal.

    The rows of hot keys stay where they are and meet a broadcast of at most
    HOT_KEYS keys; the others meet in a shuffle. Both inputs are read twice:
    pass stage tables. ``how`` is inner or left; ``weight`` is dropped.
    """
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight).cast("double") * HOT_KEYS >= F.lit(float(total))
    named = lambda d: d.drop(weight).withColumnsRenamed({c: f"_k_{c}" for c in keys})
    same = None
    for c in keys:
        eq = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        same = eq if same is None else same & eq
    drop = [f"_k_{c}" for c in keys]
    few = F.broadcast(named(per_key.where(hot)))
    warm = rows.join(few, same, "inner").drop(*drop)
    cold = rows.join(few.select(*drop), same, "left_anti").join(named(per_key.where(~hot)), same, how).drop(*drop)
    return warm.unionByName(cold)
