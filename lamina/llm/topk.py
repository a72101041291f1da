"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of (term, weight): the dimension and the quantised component.  Candidates are dealt into shards and queries
into blocks; one task holds one shard's postings and one block of queries.  For each term, the weights of the queries that have it are
multiplied with the term's postings and scattered into a dense array of scores; partition selection keeps k a query and shard, and the
shards' lists are merged with a second selection.  Every query meets every candidate exactly once, no vector is skipped, and what a
task holds is bounded by ``SHARD_ROWS`` and ``BLOCK_ROWS``, which don't depend on the data.

The work is queries x candidates by definition.  Queries are sent to every shard and candidates to every block of queries, never to the
driver: with q queries and n rows that is a copy of the candidates per ``BLOCK_ROWS`` queries and a copy of the queries per
``SHARD_ROWS`` rows.  Lists are cut to k before the only other shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import quoted

SHARD_ROWS, BLOCK_ROWS = 65_536, 8192  # candidates and queries of a task at most
LEAST_ROWS = 1024  # candidates of a task, if fewer tasks than cores would be left otherwise
AT_ONCE = 64, 2048  # queries and candidates whose scores are added up at once: they stay in a core's cache
LARGEST = 1 << 31  # rows whose largest component times their length stays below this are scored in int64, others in Python numbers


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))


def _matrix(vectors: pd.Series, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x terms of floor(scale * x), whether each row is large); missing terms are 0, vectors may differ in length."""
    width = max((len(v) for v in vectors), default=0)
    given = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        given[i, : len(v)] = v
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * given)
    large = np.abs(scaled).max(axis=1, initial=0) * max(width, 1) >= LARGEST
    out = np.where(large[:, None], 0, scaled).astype(np.int64)
    if large.any():
        out = out.astype(object)
        # a product beyond the doubles is that of a whole number
        out[large] = np.array([[int(y) if np.isfinite(y) else int(x) * scale for x, y in zip(*rows)] for rows in zip(given[large], scaled[large])], dtype=object)
    return out, large


def scores_of(queries: np.ndarray, large_queries: np.ndarray, candidates: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Exact scores (queries x candidates): only pairs with a large row are reckoned in Python numbers."""
    if not large_queries.any() and not large.any():
        return accumulate(queries.astype(np.int64), candidates.astype(np.int64))
    out = np.zeros((len(queries), len(candidates)), dtype=object)
    for q, c, kind in ((~large_queries, ~large, np.int64), (large_queries, ~large, object), (~large_queries, large, object), (large_queries, large, object)):
        if q.any() and c.any():
            out[np.ix_(q, c)] = accumulate(queries[q].astype(kind), candidates[c].astype(kind)).astype(object)
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores (queries x candidates), one term after the other."""
    scores = np.zeros((len(queries), len(candidates)), dtype=queries.dtype)
    by_term = np.ascontiguousarray(candidates.T)
    for at in range(0, len(candidates), AT_ONCE[1]):
        own, postings = scores[:, at : at + AT_ONCE[1]], by_term[:, at : at + AT_ONCE[1]]
        room = np.empty_like(own)
        for term in range(min(queries.shape[1], candidates.shape[1])):
            asked = np.flatnonzero(queries[:, term])
            posted = np.flatnonzero(postings[term])
            if not len(asked) or not len(posted):
                continue
            if len(asked) == len(queries) and len(posted) == postings.shape[1]:
                np.multiply(queries[:, term, None], postings[term], out=room)
                own += room
            else:
                own[np.ix_(asked, posted)] += np.multiply.outer(queries[asked, term], postings[term][posted])
    return scores


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one row: highest score, then smallest id."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        over, at = np.flatnonzero(scores > kth), np.flatnonzero(scores == kth)
        if len(at) > k - len(over):
            at = at[np.argpartition(ids[at], k - len(over) - 1)[: k - len(over)]]
        best = np.concatenate([over, at])
    else:
        best = np.arange(len(scores))
    return best[np.lexsort((ids[best], -scores[best]))]


def top_k(df: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k best of all rows of other ids, all if fewer.

    Score: inner product of the quantised vectors (missing components count 0); ties go to the smaller id.  Rows with a null id, and
    null vectors or ones that hold a null or non-finite component, take no part; an empty vector scores 0 with all.  Every row counts:
    rows that share an id, repeated ones too, are candidates each; as queries they share one list.  Scores are exact for
    components of any size; only one of the k best that is beyond a long raises an error rather than overflow.  Other columns aren't
    read.  An empty table, or one without queries, gives an empty result.
    """
    spark = df.sparkSession
    v = F.col(quoted([vector])[0])
    rows = df.select(F.col(quoted([id])[0]).cast("long").alias("id"), is_query.alias("asks"), v.cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    size = rows.select(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    shards = max(1, -(-size["n"] // SHARD_ROWS), min(-(-size["n"] // LEAST_ROWS), 2 * spark.sparkContext.defaultParallelism))
    blocks = max(1, -(-(size["q"] or 0) // BLOCK_ROWS))
    # dealt by row, so that repeated rows spread
    row = F.xxhash64(F.monotonically_increasing_id())
    asked = rows.select("id", "v", "asks", F.pmod(row, F.lit(blocks)).cast("int").alias("block")).where("asks").drop("asks")
    queries = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = rows.select("id", "v", F.pmod(row, F.lit(shards)).cast("int").alias("shard"))
    candidates = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(q) and len(c):
            cids, qids = c["id"].to_numpy(), q["id"].to_numpy()
            (postings, large), (asks, large_asks) = _matrix(c["v"], scale), _matrix(q["v"], scale)
            for at in range(0, len(q), AT_ONCE[0]):
                scores = scores_of(asks[at : at + AT_ONCE[0]], large_asks[at : at + AT_ONCE[0]], postings, large)
                for i, row in enumerate(scores, at):
                    others = np.flatnonzero(cids != qids[i])
                    best = others[select(row[others], cids[others], k)]
                    for column, values in zip(out.values(), (np.full(len(best), qids[i]), cids[best], row[best].astype(np.int64))):
                        column.append(values)
        return pd.DataFrame({c: np.concatenate(x) if x else np.empty(0, np.int64) for c, x in out.items()})

    lists = queries.groupBy("block", "shard").cogroup(candidates.groupBy("block", "shard")).applyInPandas(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
