"""Runs of repeated words, found through branching tandems in an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, at least
``min_exponent`` periods and ``min_words`` words long, that no neighbouring word
extends. Per batch of documents:

* suffixes are sorted by prefix doubling (documents never mix); the ranks of
  every doubling give the longest common prefixes of neighbours;
* each boundary between neighbours belongs to the LCP interval of its depth d.
  The suffixes i of the smaller child look up ``ISA[i + d]`` and ``ISA[i - d]``:
  if it lies in the interval too, a square of period d starts there, and it is
  a branching one if the words behind it differ. A sparse table of minima gives
  the intervals, so no tree is built;
* a run's last square is its branching one. Rotating it to the left as long as
  words repeat gives the run's start, and squares of a multiple of the period
  fall together with the run that ends where they end.

A run of at least e periods has e suffixes in its interval. Smaller intervals
are therefore left unsorted, which changes no run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words

MIN_WORDS = 6
MIN_EXPONENT = 4
_ROWS, _BYTES = 4000, 4 << 20  # rows and text bytes of a batch
_PROBES = 1 << 21  # suffixes looked up at a time
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "runs array<struct<start: bigint, length: bigint, period: bigint>>, n_words long, kept_text string"


def suffix_order(key: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffixes in order, ranks after each doubling).

    ``key`` orders single words (of different documents: different keys),
    ``end`` is where a word's document ends. Suffixes that share a prefix with
    fewer than ``least`` others, themselves counted, stay unsorted.
    """
    n = len(key)
    order = np.argsort(key)
    new = np.empty(n, dtype=bool)
    new[:1] = True
    np.not_equal(key[order[1:]], key[order[:-1]], out=new[1:])
    levels, width = [], 1
    while True:
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, n))
        rank = np.empty(n, dtype=np.int32)
        rank[order] = np.repeat(starts, size)
        levels.append(rank)
        at = np.flatnonzero(np.repeat(size >= least, size))
        if not len(at):
            return order, levels
        suffix = order[at]
        far = suffix + width
        inside = far < end[suffix]
        follow = np.where(inside, rank[np.where(inside, far, 0)].astype(np.int64) + 1, 0)
        pair = rank[suffix].astype(np.int64) * (n + 1) + follow
        by = np.argsort(pair)
        order[at], pair = suffix[by], pair[by]
        new[at[1:]] |= pair[1:] != pair[:-1]
        width *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], end: np.ndarray, least: int) -> np.ndarray:
    """Longest common prefix of each suffix with the one before it, 0 where the first word's group is smaller than ``least``."""
    n = len(order)
    out = np.zeros(n, dtype=np.int32)
    first = levels[0][order]
    size = np.bincount(first, minlength=n)
    k = np.flatnonzero(size[first] >= least)
    k = k[first[k] != k]
    a, b, got = order[k - 1], order[k], np.zeros(len(k), dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + got, b + got
        inside = (x < end[a]) & (y < end[b])
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        got += (inside & (levels[j][x] == levels[j][y])).astype(np.int64) << j
    out[k] = got
    return out


class _Minima:
    """Minima of all stretches whose length is a power of two; how far from a place values stay at or above a bound."""

    def __init__(self, values: np.ndarray, longest: int):
        self.table, width = [values], 1
        while width < longest:
            low = self.table[-1].copy()
            np.minimum(low[:-width], low[width:], out=low[:-width])
            self.table.append(low)
            width *= 2

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place so that all values from it up to before ``at`` reach ``bound``."""
        at = at.copy()
        for j in range(len(self.table) - 1, -1, -1):
            to = at - (1 << j)
            ok = to >= 0
            ok &= self.table[j][np.maximum(to, 0)] >= bound
            at[ok] = to[ok]
        return at

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The place behind the last one so that all values from ``at`` to it reach ``bound``."""
        at, n = at.copy(), len(self.table[0])
        for j in range(len(self.table) - 1, -1, -1):
            ok = at + (1 << j) <= n
            ok &= self.table[j][np.minimum(at, n - 1)] >= bound
            at[ok] += 1 << j
        return at


def branching_squares(code: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching squares that have ``least`` - 2 more copies of their period before them.

    ``begin`` and ``end`` say where each word's document lies; equal words of one document have equal ``code``.
    """
    none = np.zeros(0, dtype=np.int64)
    if not len(code):
        return none, none
    order, levels = suffix_order(begin.astype(np.int64) * (int(code.max()) + 1) + code, end, least)
    lcp = common_prefixes(order, levels, end, least)
    del levels
    # only places with a common prefix, and the one before each stretch of them, take part
    part = lcp > 0
    part[:-1] |= part[1:]
    at = np.flatnonzero(part)
    if not len(at):
        return none, none
    lcp, order = lcp[at], order[at].astype(np.int64)
    inverse = np.full(len(code), -1, dtype=np.int64)
    inverse[order] = np.arange(len(order))
    edges = np.flatnonzero(np.append(lcp == 0, True))
    minima = _Minima(lcp, int(np.diff(edges).max(initial=1)))
    k = np.flatnonzero(lcp > 0)
    depth = lcp[k].astype(np.int64)
    low, high = minima.left(k, depth) - 1, minima.right(k + 1, depth)  # the interval: low to before high
    big = (high - low >= least) & (depth * least <= (end - begin)[order[k]])
    k, depth, low, high = k[big], depth[big], low[big], high[big]
    split = minima.left(k, depth + 1) - 1  # of several boundaries of one depth, the left ones come first
    left_size, right_size = k - split, high - k
    size, first = np.minimum(left_size, right_size), np.where(left_size <= right_size, split, k)
    starts, periods, done, total = [], [], 0, np.cumsum(size)
    while done < len(k):
        upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + _PROBES, side="right")))
        s = slice(done, upto)
        which = np.repeat(np.arange(done, upto), size[s])
        i = order[np.arange(len(which)) - np.repeat(np.cumsum(size[s]) - size[s], size[s]) + first[which]]
        for sign in (1, -1):
            d, lo, hi = depth[which], low[which], high[which]
            start = i if sign == 1 else i - d
            # the square's two halves and the copies before it all start with the interval's words
            ok = (start - (least - 2) * d >= begin[i]) & (start + 2 * d <= end[i])
            at_, d, lo, hi, here = start[ok], d[ok], lo[ok], hi[ok], i[ok]
            for m in [1, 0, *range(-1, 1 - least, -1)]:
                there = inverse[at_ + m * d]
                ok = (there >= lo) & (there < hi)
                at_, d, lo, hi, here = at_[ok], d[ok], lo[ok], hi[ok], here[ok]
            after = at_ + 2 * d
            more = after < end[here]
            branches = ~more | (code[np.where(more, after, 0)] != code[at_ + d])
            starts.append(at_[branches])
            periods.append(d[branches])
        done = upto
    found = np.unique(np.stack([np.concatenate(periods or [none]), np.concatenate(starts or [none])]), axis=1)
    return found[1], found[0]


def _rotated(code: np.ndarray, begin: int, start: int, period: int) -> int:
    """Where the run of a square starts: the square moves left as long as the word before it repeats."""
    step = 64
    while start > begin:
        to = max(begin, start - step)
        differ = np.flatnonzero(code[to:start] != code[to + period:start + period])
        if len(differ):
            return to + int(differ[-1]) + 1
        start, step = to, step * 2
    return start


def runs_of(code: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS, min_exponent: float = MIN_EXPONENT) -> list[tuple]:
    """``(document, start, length, period)`` of all runs, by document, start and period."""
    size = np.diff(offsets)
    begin, end = np.repeat(offsets[:-1], size), np.repeat(offsets[1:], size)
    starts, periods = branching_squares(code, begin, end, int(min_exponent))
    ends: dict[int, list[tuple]] = {}  # where a run ends -> the runs that do
    for start, period in zip(starts.tolist(), periods.tolist()):  # short periods come first
        stop = start + 2 * period
        known = ends.setdefault(stop, [])
        if not any(period % q == 0 and s <= start for s, q in known):
            known.append((_rotated(code, int(begin[start]), start, period), period))
    found = [(s, stop - s, q) for stop, known in ends.items() for s, q in known
             if stop - s >= min_words and stop - s >= min_exponent * q]
    doc = np.searchsorted(offsets, [s for s, _, _ in found], side="right") - 1
    return sorted((int(d), s - int(offsets[d]), n, q) for d, (s, n, q) in zip(doc.tolist(), found))


def _finding(column: int, names: list[str], min_words: int, min_exponent: float):
    def run(batches):
        for batch in batches:
            for part in words.slices(batch, column, _ROWS, _BYTES):
                flat, at = words.split(part.column(column))
                code = np.asarray(words.codes(flat)[0]).astype(np.int64)
                keep = np.ones(len(code), dtype=bool)
                runs = [[] for _ in range(part.num_rows)]
                for doc, start, length, period in runs_of(code, at, min_words, min_exponent):
                    runs[doc].append({"start": start, "length": length, "period": period})
                    keep[at[doc] + start + period:at[doc] + start + length] = False
                left = np.concatenate([[0], np.cumsum(keep)])[at]
                kept = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), flat.filter(pa.array(keep)))
                text = pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(runs, RUNS), pa.array(np.diff(at), pa.int64()), text], names)

    return run


def periodic_runs(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, min_exponent: float = MIN_EXPONENT) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words, by start and period), ``n_words`` and ``kept_text``.

    Words are runs of characters other than ``[\\x20\\x09-\\x0D]``. ``kept_text``
    has the words, joined by one space, that no run contains after its first
    period. A null text has no words. Every row and column passes through, but
    input columns with the names of the new ones give way. ``min_exponent`` is
    at least 2.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    new = ("runs", "n_words", "kept_text")
    src = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new]).withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*src.schema.fields, *T.StructType.fromDDL(SCHEMA).fields])
    return src.mapInArrow(_finding(src.columns.index(text_col), schema.names, min_words, min_exponent), schema)
