"""Exact top-k search by term-at-a-time accumulation over quantised vectors.

Components become integers; a dimension is a term and its non-zero components
are postings (vector, weight). Queries and candidates are cut into blocks of
bounded size. For each pair of blocks the query rows, sparse, scatter their
weighted postings term by term into a dense array of scores; a partition
selection keeps each row's k best, and the blocks' selections are merged by rank.
Every stated query meets every candidate block once; nothing is pruned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

K = 5
SCALE = 256
LAST_ID = 2**63 - 1  # stands for a null id inside tasks
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096  # rows: 32 MB of scores at most


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(id, v)`` with v = floor(scale * x) of each component, as longs.

    Rows with a null vector or a null or non-finite component take no part.
    Every other row stays, also one with a null or repeated id.
    """
    v = F.col(vector_col).cast("array<double>")
    ok = F.col(vector_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows as a dense integer matrix; components a row does not have are zero."""
    lists = column.combine_chunks()
    offsets = np.asarray(lists.offsets).astype(np.int64)
    values = np.asarray(lists.values.slice(offsets[0], offsets[-1] - offsets[0])).astype(np.int64)
    size = np.diff(offsets)
    out = np.zeros((len(size), width), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], size)] = values
    return out


def _accumulating(k: int):
    def run(table: pa.Table) -> pa.Table:
        is_query = np.asarray(table.column("is_query"))
        rows = np.asarray(table.column("row"))
        ids = np.asarray(pc.fill_null(table.column("id"), LAST_ID))
        lengths = np.diff(np.asarray(table.column("v").combine_chunks().offsets))
        m = _matrix(table.column("v"), int(lengths.max(initial=0)))
        queries, candidates = m[is_query], m[~is_query]
        query_row, candidate_row, candidate_id = rows[is_query], rows[~is_query], ids[~is_query]
        order = np.lexsort((candidate_row, candidate_id))  # ascending ids, so ties go to the smaller
        candidates, candidate_row, candidate_id = candidates[order], candidate_row[order], candidate_id[order]
        n = len(candidate_row)
        place = dict(zip(candidate_row.tolist(), range(n)))
        scores = np.zeros((len(query_row), n), dtype=np.int64)
        for term in range(m.shape[1]):
            having, posting = np.flatnonzero(queries[:, term]), np.flatnonzero(candidates[:, term])
            if len(having) == len(query_row) and len(posting) == n:
                scores += queries[:, term, None] * candidates[None, :, term]
            elif len(having) and len(posting):
                scores[np.ix_(having, posting)] += queries[having, term, None] * candidates[None, posting, term]
        out = [], [], [], [], []
        for q, q_id, s in zip(query_row.tolist(), ids[is_query].tolist(), scores):
            at = np.arange(n)
            if q in place:
                at = np.delete(at, place[q])
            if len(at) > k:
                kth = -np.partition(-s[at], k - 1)[k - 1]
                at = np.concatenate([at[s[at] > kth], at[s[at] == kth][:k]])
            at = at[np.argsort(-s[at], kind="stable")][:k]
            for column, values in zip(out, ([q] * len(at), [q_id] * len(at), candidate_row[at], candidate_id[at], s[at])):
                column.extend(values)
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("_q", "query_id", "_row", "vec_id", "score"), out)})

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` largest inner products, ties to the smaller id (null last).

    Inputs are ``(id, v)`` as ``quantised`` gives them, with more columns if
    ``row`` is among them: a number that tells rows apart and by which a query's
    own row, if it is a candidate, is left out. Without it the query's id does
    that. Repeated ids are rows of their own, as queries (each has its ``k``) and
    as candidates. With fewer than ``k`` candidates a query gets all of them.
    """
    keyed = lambda df: df if "row" in df.columns else df.withColumn("row", F.coalesce("id", F.lit(LAST_ID)))
    queries, candidates = stage(keyed(queries), "topk-queries"), stage(keyed(candidates), "topk-candidates")
    n_q = max(1, -(-queries.count() // QUERY_BLOCK))
    n_c = max(1, -(-candidates.count() // CANDIDATE_BLOCK))

    def dealt(rows: DataFrame, own: str, n_own: int, other: str, n_other: int, flag: bool) -> DataFrame:
        rows = rows.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n_own)))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long")))).select(
            "qb", "cb", F.lit(flag).alias("is_query"), "row", "id", "v")

    both = dealt(queries, "qb", n_q, "cb", n_c, True).unionByName(dealt(candidates, "cb", n_c, "qb", n_q, False))
    best = both.groupBy("qb", "cb").applyInArrow(_accumulating(k), "_q long, query_id long, _row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id", "_row"))
    known = lambda c: F.nullif(F.col(c), F.lit(LAST_ID)).alias(c)
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(known("query_id"), "rank", known("vec_id"), "score")
