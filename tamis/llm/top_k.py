"""Exact top-k inner-product search by Fagin's threshold algorithm."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


def finite(vector: Column) -> Column:
    """True for a vector that is there and whose components are all there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; components that a shorter vector lacks are 0."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The narrowest type in which every inner product of the rows is exact."""
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


class SortedLists:
    """The rows of one shard with, for each dimension, their positions in ascending order."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, kind: type):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[by_id], rows[by_id].astype(kind)
        self.order = np.argsort(self.rows, axis=0, kind="stable").T

    def search(self, query_id: int, query: np.ndarray, k: int, first_step: int = 16) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the k best rows other than the query's own, and the depth read.

        All lists are read in parallel from their best end.  No unseen row can score more
        than the values at the current depth allow; once the kth score is above that bound
        the search stops.  At equality it goes on, as a smaller id could still tie.
        """
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = self.ids == query_id
        best = np.zeros(0, np.int64)
        scores = np.zeros(0, self.rows.dtype)
        if not len(up) and not len(down):
            best = np.flatnonzero(~seen)[:k]
            return self.ids[best], np.zeros(len(best), np.int64), 0
        depth, step = 0, first_step
        while depth < n:
            end = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.order[up, n - end : n - depth].ravel()] = True
            met[self.order[down, depth:end].ravel()] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            if len(new):
                best = np.concatenate([best, new])
                scores = np.concatenate([scores, self.rows[new] @ query])
                # Positions ascend with the id, so they break ties as ids do.
                top = np.lexsort((best, -scores))[:k]
                best, scores = best[top], scores[top]
            bound = query[up] @ self.rows[self.order[up, n - end], up] + query[down] @ self.rows[self.order[down, end - 1], down]
            if len(best) == k and scores[-1] > bound:
                return self.ids[best], scores.astype(np.int64), end
            depth, step = end, step * 2
        return self.ids[best], scores.astype(np.int64), n


def exact_top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector",
    shard_rows: int = 8192, query_rows: int = 8192,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the k candidates of the largest inner product with each query.

    Candidates are dealt by a hash of their id into shards of about ``shard_rows`` rows, queries
    into blocks of about ``query_rows``; every (shard, block) is one task that sorts the shard's
    dimensions once and runs the threshold algorithm for each query.  The k best of each shard
    then compete.  A shard stays small however often one vector is repeated.

    A query's own row is no candidate; ties go to the smaller id.  Ids are integers.  Rows with a
    null id or vector take no part; an empty vector scores 0; a component that only one side has
    counts as 0; no candidates or queries give no rows.  Repeated ids are each a candidate; of
    queries with one id the smallest vector asks.
    """
    slim = lambda df: df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")
    )
    queries, candidates = slim(queries).groupBy("id").agg(F.min("v").alias("v")), slim(candidates)
    shards = max(1, -(-candidates.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), every(shards).alias("shard"))
    right = candidates.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"))

    def search(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(rows):
            width = max(asked["v"].map(len).max(), rows["v"].map(len).max())
            a, b = _matrix(asked["v"], width), _matrix(rows["v"], width)
            kind = _exact_type(a, b)
            lists = SortedLists(rows["id"].to_numpy(), b, kind)
            for query_id, query in zip(asked["id"], a.astype(kind)):
                ids, scores, _ = lists.search(query_id, query, k)
                found.append(pd.DataFrame({"query_id": query_id, "id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype="int64")

    keys = ("shard", "block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
