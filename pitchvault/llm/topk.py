"""Exact top-k inner products by segment statistics, coarse to fine.

Vectors are cut into segments of equal length. Over a segment, the inner product of two
vectors is at most ``length * (mean * mean' + deviation * deviation')``; summed over the
segments this bounds the score from above, and with the norms the distance from below.
The bound of few long segments is cheapest, that of many short ones tightest: a query
first drops the candidates whose coarse bound is under the k-th best score it has, then
those whose finer bound is, and only survivors are scored exactly.

Candidates are read in chunks of ``CHUNK``, queries in blocks of ``BLOCK``. Every block of
queries meets every chunk in one task (a stated query set against all rows, in blocks);
a task hands on its best ``k`` per query, which are merged by a window.

Vectors that are null, empty, or hold null or non-finite components take no part. Vectors
of another length than the query's are no candidates of it. Ties go to the smaller vec_id.
A query is a vec_id; of its repeated rows the least vector counts, and rows with its own
vec_id are no candidates; other repeated rows are candidates each. Rows without vec_id take
no part. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitchvault.llm.common import stored

K = 20
LEVELS = (4, 16)  # segments per vector, coarse to fine
BLOCK = 4096
CHUNK = 16_384
_NONE = -(2**62)  # below any score
_EXACT = 2.0**52  # sums of products below this are exact in double precision


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviations of ``segments`` segments: their dot product bounds the rows'."""
    n, d = x.shape
    edges = np.linspace(0, d, min(segments, d) + 1).astype(int)
    lengths = np.diff(edges)
    means = np.add.reduceat(x, edges[:-1], axis=1) / lengths
    squares = np.add.reduceat(x * x, edges[:-1], axis=1)
    spread = np.sqrt(np.maximum(squares - lengths * means * means, 0))
    return np.hstack([means * np.sqrt(lengths), spread])


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < _EXACT:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def best(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int = K, levels: Sequence[int] = LEVELS, step: int = 512) -> pd.DataFrame:
    """The ``k`` best candidates of every query, by score and then by id."""
    order = np.lexsort((x_ids, -np.einsum("ij,ij->i", x.astype(float), x.astype(float))))
    x_ids, x = x_ids[order], x[order]  # long vectors first: they tend to set a high bar
    q_stats = [statistics(q.astype(float), s) for s in levels]
    x_stats = [statistics(x.astype(float), s) for s in levels]
    n = len(q)
    top_score, top_id = np.full((n, k), _NONE), np.full((n, k), np.iinfo(np.int64).max)
    for at in range(0, len(x), step):
        ids, part = x_ids[at : at + step], x[at : at + step]
        alive = q_ids[:, None] != ids
        for qs, xs in zip(q_stats, x_stats, strict=True):
            bound = qs @ xs[at : at + step].T
            alive &= bound + 1e-6 * (1 + np.abs(bound)) >= top_score[:, -1:]
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            continue
        scores = _scores(q[rows], part[cols])
        better = alive[np.ix_(rows, cols)] & (scores >= top_score[rows, -1:])
        for r in np.flatnonzero(better.any(axis=1)).tolist():
            found = np.flatnonzero(better[r])
            all_scores = np.concatenate([top_score[rows[r]], scores[r, found]])
            all_ids = np.concatenate([top_id[rows[r]], ids[cols[found]]])
            first = np.lexsort((all_ids, -all_scores))[:k]
            top_score[rows[r]], top_id[rows[r]] = all_scores[first], all_ids[first]
    some = top_score > _NONE
    return pd.DataFrame({"query_id": np.repeat(q_ids, some.sum(axis=1)), "vec_id": top_id[some], "score": top_score[some]})


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and ``v``: floor(scale * x) of the components, of the rows that take part."""
    whole = F.expr(f"transform(embedding, x -> CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))")
    sound = F.expr("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    return vectors.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, levels: Sequence[int] = LEVELS) -> DataFrame:
    """query_id, rank, vec_id, score for the query rows of ``vectors`` (vec_id, v) against all rows."""
    rows = stored(vectors.withColumn("d", F.size("v")), "vectors")
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min_by(F.struct("d", "v"), "v").alias("x")).select("vec_id", "x.*")
    n_queries, n_rows = queries.count(), rows.count()
    blocks, parts = -(-n_queries // BLOCK) or 1, -(-n_rows // CHUNK) or 1
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    q = queries.select("d", spread.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("asks"), "vec_id", "v")
    part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int")
    x = rows.select("d", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), part.alias("part"), F.lit(False).alias("asks"), "vec_id", "v")

    def cell(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy(bool)
        v = np.array(group["v"].tolist(), np.int64)
        ids = group["vec_id"].to_numpy()
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return best(ids[asks], v[asks], ids[~asks], v[~asks], k, levels)

    found = q.unionByName(x).groupBy("d", "block", "part").applyInPandas(cell, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
