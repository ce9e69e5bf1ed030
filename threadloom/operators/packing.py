"""Token blocks across line borders.

The token stream is every line's pre-tokens plus one newline token, in
dataset order. Line start offsets come from R1 (``global_offsets``); each
token's block is ``floor(offset / size)``; a block is a group of at most
``size`` tokens, so no group is unbounded. The last partial block is
dropped unless ``keep_last``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import PRETOKEN_PATTERN, normalize_ws
from threadloom.operators.ranking import global_offsets
from threadloom.session import materialize

BLOCK_SIZE = 2048  # fixed value: model context, no special-token room for this tokenizer
EVAL_BATCH = 4
# bump when the token stream or block layout changes, so cached blocks of an
# older layout are never read
BLOCK_FORMAT_VERSION = 1


def line_tokens(text: F.Column) -> F.Column:
    """Pre-tokens of a whitespace-mapped line followed by a newline token."""
    return F.concat(F.regexp_extract_all(normalize_ws(text), F.lit(PRETOKEN_PATTERN), 0), F.array(F.lit("\n")))


def pack_blocks(lines: DataFrame, order_cols: Sequence[str], text_col: str = "line",
                size: int = BLOCK_SIZE, keep_last: bool = False) -> DataFrame:
    """``block_id, n_tokens, block_text`` for every full block, and the
    last, shorter one with ``keep_last``.

    Each line is cut into the pieces that fall into each block it touches
    (``slice`` of its token array), so the shuffle to blocks moves about
    lines + blocks rows, not one row per token. A block gathers at most
    ``size`` tokens.
    """
    # lines are tokenised once; global_offsets writes them, tokens and all, in order
    t = materialize(lines.select(*order_cols, line_tokens(F.col(text_col)).alias("_toks"))
                    .withColumn("_n", F.size("_toks")), "line_tokens")
    t = global_offsets(t, list(order_cols), size_col="_n", out_col="_start")
    end = F.col("_start") + F.col("_n")
    first_b = F.floor(F.col("_start") / size)
    last_b = F.floor((end - 1) / size)
    pieces = t.select("_start", "_toks", "_n", F.explode(F.sequence(first_b, last_b)).alias("block_id"))
    lo = F.greatest(F.col("_start"), F.col("block_id") * size) - F.col("_start")
    hi = F.least(end, (F.col("block_id") + 1) * size) - F.col("_start")
    pieces = pieces.select(F.col("block_id").cast("bigint").alias("block_id"), "_start",
                           F.slice("_toks", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("_piece"))
    g = pieces.groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("_start", "_piece"))).alias("_p"))
    g = g.withColumn("_t", F.flatten(F.transform("_p", lambda x: x["_piece"])))
    if not keep_last:
        g = g.filter(F.size("_t") == size)
    return g.select("block_id", F.size("_t").cast("bigint").alias("n_tokens"), F.array_join("_t", "").alias("block_text"))


def pad_batches(blocks: DataFrame, batch: int = EVAL_BATCH, pad_token: str = "<pad>") -> DataFrame:
    """Batches of ``batch`` blocks, each padded with ``pad_token`` to the batch's longest.

    The batch max is a window partitioned by batch id (``batch`` rows per
    partition). ``padded_text`` is the block followed by its padding.
    """
    from pyspark.sql import Window
    b = blocks.withColumn("batch_id", F.floor(F.col("block_id") / batch).cast("bigint"))
    w = Window.partitionBy("batch_id")
    b = b.withColumn("padded_len", F.max("n_tokens").over(w))
    b = b.withColumn("n_pad", (F.col("padded_len") - F.col("n_tokens")).cast("bigint"))
    return b.select("block_id", "batch_id", "n_tokens", "padded_len", "n_pad", F.concat(
        "block_text", F.repeat(F.lit(pad_token), F.col("n_pad").cast("int"))).alias("padded_text"))
