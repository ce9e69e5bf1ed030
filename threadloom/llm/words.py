"""Words of a batch of texts as flat Arrow and numpy arrays.

A word is a run of characters other than ``[\\x20\\x09-\\x0D]``; Arrow's ASCII
white space is that same set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words one after the other, offsets: text i has words offsets[i] to offsets[i + 1])."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.ascii_split_whitespace(trimmed)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat, offsets = lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]
    empty = np.asarray(pc.equal(trimmed, ""))  # splits into one empty word
    if empty.any():
        keep = np.ones(len(flat), dtype=bool)
        keep[offsets[:-1][empty]] = False
        sizes = np.diff(offsets)
        sizes[empty] = 0
        flat, offsets = flat.filter(pa.array(keep)), np.concatenate([[0], np.cumsum(sizes)])
    return flat, offsets


def codes(flat: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """(code of each word, the distinct words)."""
    coded = flat.cast(pa.large_binary()).dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary.to_pylist()


def hashes(distinct: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct), dtype=np.uint64, count=len(distinct))


def slices(batch: pa.RecordBatch, column: int, rows: int, size: int):
    """The batch in parts of at most ``rows`` rows and about ``size`` bytes in ``column`` (one row at least)."""
    total = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(total, before + size, side="right"))))
        yield batch.slice(at, end - at)
        at = end
