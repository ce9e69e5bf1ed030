"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed features: its words' shapes and lengths, pairs of
neighbouring shapes, whether a word repeats the one before, and the words
themselves. A bounded sample of labelled documents gives inverse document
frequencies and, by singular value decomposition, a projection to a few
dimensions; both and the sample's vectors (documented bounds, a few MB) are
broadcast. Every document is projected in its task and compared with all labelled
vectors by exact cosine products, block by block; its nearest neighbours vote
with their labels, weighted by similarity.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words

FEATURES = 1 << 12  # hashed features
DIMENSIONS = 48
PER_LABEL = 1500  # labelled documents of each label: the bound of the sample
NEIGHBOURS = 25
POWER = 8  # of the similarity, in the vote's weight
PRIOR = 0.5  # score of a text that shares no feature with any labelled one
CUT = 0.3
FOLDS, HELD = 5, 0
SEED = 42
_ROWS, _BYTES = 1000, 4 << 20
_COUNTED = 1 << 20  # bytes of text whose words are counted at a time: a worker holds some 40 MB for them
_BLOCK = 2048  # documents a cosine product takes at a time


def held_out(id_col: str):
    """Rows that labels are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS)) == HELD


def _shape(word: str) -> str:
    """Letters to a or A, digits to 0, runs squeezed: 'Wort!!' -> 'Aa!'."""
    s = re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", word)
    s = re.sub(r"\d", "0", s)
    return re.sub(r"(.)\1+", r"\1", s)[:12]


_shapes: dict[bytes, int] = {}


def _shape_ids(distinct: list[bytes]) -> np.ndarray:
    """Hash of each distinct word's shape, with a bounded cache."""
    if len(_shapes) > 300_000:
        _shapes.clear()
    out = np.empty(len(distinct), dtype=np.uint64)
    for i, w in enumerate(distinct):
        got = _shapes.get(w)
        if got is None:
            got = _shapes[w] = xxhash.xxh64_intdigest(_shape(w.decode()).encode(), 1)
        out[i] = got
    return out


def feature_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, count) of a batch, whole texts."""
    flat, offsets = words.split(texts)
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    code, distinct = words.codes(flat)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    shape = _shape_ids(distinct)[code]
    length = np.minimum(np.array([len(w) for w in distinct]), 24).astype(np.uint64)[code]
    same = text[1:] == text[:-1]
    repeat = (code[1:] == code[:-1])[same]
    mixed = lambda x, kind: (x ^ np.uint64(kind * 0x9E3779B97F4A7C15 & 2**64 - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    parts = [
        (text, mixed(words.hashes(distinct, 7)[code], 1)),
        (text, mixed(shape, 2)),
        (text, mixed(length, 3)),
        (text[1:][same], mixed(shape[:-1][same] * np.uint64(3) + shape[1:][same], 4)),
        (text[1:][same], mixed(repeat.astype(np.uint64), 5)),
    ]
    place = np.concatenate([t * FEATURES + (h >> np.uint64(40)).astype(np.int64) % FEATURES for t, h in parts])
    key, count = np.unique(place, return_counts=True)
    return key // FEATURES, key % FEATURES, count.astype(np.float64)


def _project(texts: pa.Array, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors of a batch of texts (zero for texts without words)."""
    dense = np.zeros((len(texts), FEATURES), dtype=np.float32)
    at = 0
    for part in words.slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0, _ROWS, _COUNTED):
        text, feature, count = feature_rows(part.column(0))
        dense[at + text, feature] = (1 + np.log(count)) * weights[feature]
        at += part.num_rows
    out = dense @ basis
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def _sparse(batches):
    for batch in batches:
        for part in words.slices(batch, 1, _ROWS, _COUNTED):
            text, feature, count = feature_rows(part.column(1))
            bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(feature, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(count))], ["label", "feature", "count"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_label: int = PER_LABEL) -> dict | None:
    """The model: idf weights, projection, labelled unit vectors and labels; None if nothing is labelled.

    At most ``per_label`` documents of each label, those with the smallest
    hashed id that are not held out, are learnt from, with their whole texts.
    The driver receives at most FEATURES counts for each.
    """
    pool = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
    pool = pool.groupBy("_id").agg(F.min("_y").alias("_y"))
    chosen = [pool.where(F.col("_y") == y).orderBy(F.xxhash64(F.lit(SEED), "_id"), "_id").limit(per_label) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # 2 * per_label rows at most: a bounded broadcast
    sample = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
              .join(F.broadcast(chosen), "_id").select("_y", "_t", "_id"))
    got = sample.select(F.col("_y").cast("int"), "_t").mapInArrow(_sparse, "label int, feature array<int>, count array<double>").toArrow()
    if not got.num_rows:
        return None
    # a fixed order, copies once
    got = sorted({(r["label"], tuple(r["feature"]), tuple(r["count"])) for r in got.to_pylist()})
    x = np.zeros((len(got), FEATURES), dtype=np.float32)
    for i, (_, f, c) in enumerate(got):
        x[i, list(f)] = 1 + np.log(c)
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + np.float32(0.1)
    x *= weights
    basis = _basis(x, min(DIMENSIONS, len(x)))
    vectors = x @ basis
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return {"weights": weights, "basis": basis, "vectors": vectors / np.where(norm > 0, norm, 1),
            "labels": np.array([y for y, _, _ in got], dtype=np.float64)}


def _basis(x: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the ``rank`` largest singular values, by subspace iteration."""
    q = np.random.default_rng(SEED).normal(size=(x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v[:rank].T).astype(np.float32)


def vote(vectors: np.ndarray, model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of unit vectors: labels of the nearest labelled vectors, weighted by similarity."""
    out = np.full(len(vectors), PRIOR)
    k = min(neighbours, len(model["labels"]))
    for a in range(0, len(vectors), _BLOCK):
        cosine = vectors[a:a + _BLOCK] @ model["vectors"].T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.clip(np.take_along_axis(cosine, near, axis=1), 0, None).astype(np.float64) ** POWER
        total = w.sum(1)
        score = (w * model["labels"][near]).sum(1) / np.where(total > 0, total, 1)
        out[a:a + _BLOCK] = np.where(total > 1e-12, score, PRIOR)
    return np.clip(out, 0, 1)


def quality_scores(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with score (double) and predicted (int: score >= CUT), every row and its whole text.

    Null and empty texts, and every text if there is no model, score PRIOR.
    Only the text enters the score. Input columns named like an output are replaced.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    columns = [f"c{i}" for i in range(len(keep))]

    def run(batches):
        m = pickle.loads(held.value)
        for batch in batches:
            for part in words.slices(batch, 0, _ROWS, _BYTES):
                if m is None:
                    score = np.full(part.num_rows, PRIOR)
                else:
                    score = vote(_project(part.column(0), m["weights"], m["basis"]), m)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(score)], [*columns, "score"])

    src = docs.select(F.col(text_col).cast("string").alias("_t"), *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, columns)])
    types = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, columns))
    out = src.mapInArrow(run, f"{types}, score double")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, columns)], "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
