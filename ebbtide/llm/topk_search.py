"""Exact top-k inner products with a vector-approximation file.

Every component is cut into cells of a power-of-two width per dimension, one byte each. The
scan of the cells gives each vector an upper and a lower bound of its score; exact vectors are
read in order of falling upper bound until no unread one can reach the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import pieces_for, stored

#: Rows of one block pair; a task holds one block of each side.
QUERY_BLOCK, VECTOR_BLOCK = 4096, 16384
CELLS = 256
FOUND = "query_id long, vec_id long, score long"
#: Beyond this a product of float64 bounds is no longer exact; the bound is widened by the rounding error.
EXACT = float(2**52)


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id and floor(scale * x) of every component; vectors that are null, empty or hold null or non-finite ones go."""
    x = F.col(vec_col).cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & ~F.exists("x", bad))
        .select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("x"))
    )


def _cells(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bits to drop per dimension so that the range of the data fits in one byte."""
    spread = (high.astype(object) - low.astype(object) + 1)
    return np.array([max(0, (int(s) - 1).bit_length() - 8) for s in spread], dtype=np.int64)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1).astype(np.int64)


def _searcher(k: int, low: list[int], high: list[int]):
    low, high = np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)

    def search(key: tuple, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and vectors.num_rows:
            q, v = _matrix(queries["x"], queries.num_rows), _matrix(vectors["x"], vectors.num_rows)
            qid, vid = queries["vec_id"].to_numpy(), vectors["vec_id"].to_numpy()
            drop = _cells(low, high)
            code = ((v - low) >> drop).astype(np.uint8)
            base = low.astype(np.float64)
            width = (2.0**drop) - 1
            cells = code.astype(np.float64) * 2.0**drop + base
            for at in range(0, len(q), 256):
                block = q[at : at + 256].astype(np.float64)
                floor_ = block @ cells.T
                slack = np.abs(block) @ np.abs(cells).max(axis=0)
                error = np.where(slack < EXACT, 0.0, slack * 2.0**-40)
                upper = floor_ + (np.maximum(block, 0) @ width + error)[:, None]
                lower = floor_ + (np.minimum(block, 0) @ width - error)[:, None]
                for i in range(len(block)):
                    ids, scores = _best(q[at + i], qid[at + i], v, vid, lower[i], upper[i], k)
                    out["query_id"] += [qid[at + i]] * len(ids)
                    out["vec_id"] += ids.tolist()
                    out["score"] += scores.tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    return search


def _best(q, qid, v, vid, lower, upper, k):
    """The k best of one block: a filter by bounds, then exact vectors in order of falling upper bound."""
    own = vid != qid
    n = int(own.sum())
    if not n:
        return vid[:0], vid[:0]
    lower = np.where(own, lower, -np.inf)
    sure = np.partition(lower, len(lower) - min(k, n))[len(lower) - min(k, n)]
    near = np.flatnonzero(own & (upper >= sure))
    near = near[np.argsort(-upper[near], kind="stable")]
    ids, scores = vid[:0], vid[:0]
    step = max(4 * k, 32)
    for at in range(0, len(near), step):
        if len(ids) >= k and upper[near[at]] < scores[k - 1]:
            break
        read = near[at : at + step]
        ids, scores = np.concatenate([ids, vid[read]]), np.concatenate([scores, v[read] @ q])
        order = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[order], scores[order]
    return ids, scores


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                scale: int = 256) -> DataFrame:
    """Each query's k highest integer inner products over all other rows: query_id, rank, vec_id, score.

    Ties go to the smaller vec_id. Queries and vectors meet block by block: one task holds
    one block of each and returns k rows per query, so no block grows with the data. Vectors
    of another length than the most frequent one take no part, nor do null ones or those with
    null or non-finite components, or without id. Rows repeated under one id are one vector
    (the largest). Scores must fit 64 bits. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    everything = integer_vectors(vectors, id_col, vec_col, scale)
    sizes = everything.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims, rows = sizes["n"], sizes["count"]
    whole = lambda df: df.where(F.size("x") == dims).groupBy("vec_id").agg(F.max("x").alias("x"))
    everything = stored(whole(everything), "vectors")
    asked = whole(integer_vectors(queries, id_col, vec_col, scale))
    ranges = everything.select(F.posexplode("x").alias("d", "c")).groupBy("d").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).orderBy("d").collect()
    low, high = [r["lo"] for r in ranges], [r["hi"] for r in ranges]
    nv, nq = pieces_for(rows, VECTOR_BLOCK), pieces_for(asked.count(), QUERY_BLOCK)
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = asked.withColumn("qb", block(nq)).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1))))
    right = everything.withColumn("vb", block(nv)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(_searcher(k, low, high), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
