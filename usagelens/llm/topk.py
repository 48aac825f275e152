"""Exact top-k by inner product with block-at-a-time pruning.

Vectors are rows of terms (their components, as integers). Similar vectors are laid side by side (ordered
by the signs of their components) and cut into blocks. A block keeps its forward index, the vectors
themselves, and for every term the largest and smallest value in it. The summed term maxima, each query
component times the extreme that suits its sign, bound every score in the block. A query visits blocks by
falling bound and scores whole blocks through the forward index until no bound reaches its k-th score.

Work is dealt out as (shard of blocks) x (batch of queries), both of bounded size. First each query is
scored in the shard that holds it; the k-th score found there is the floor with which it enters every
shard, so most shards are left after a look at their bounds. Only scores that reach the floor are sent on.

Scores are exact integers; ties go to the smaller id. Vectors that are null or hold null or non-finite
components take no part, nor do those with components that leave the range of 62-bit integers. Vectors of
different length are compared over the components that both have, an empty vector scores 0. Repeated rows
are rows of their own: each is a candidate for the other. Null ids are never queries and come last among
ties. Extra columns are ignored. An empty table gives an empty table.
"""

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import stored

K = 10
SCALE = 1024
BLOCK = 64  # vectors
SHARD = 1024
QUERIES = 4096  # in one batch


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, terms array<bigint>) of the rows that take part."""
    value = F.transform(vector_col, lambda x: x.cast("double") * scale)
    limit = float(2**62)
    fine = F.forall(value, lambda x: F.coalesce(F.abs(x) < limit, F.lit(False)))
    terms = F.transform(value, lambda x: F.floor(x).cast("bigint"))
    return rows.where(F.col(vector_col).isNotNull()).where(fine).select(F.col(id_col).alias("vec_id"), terms.alias("terms"))


def _place(terms: str) -> Column:
    """Sort key that brings vectors with equal signs together, leading components first."""
    return F.array_join(F.transform(F.slice(terms, 1, 24), lambda x: F.when(x < 0, "0").otherwise("1")), "")


def _matrix(lists) -> np.ndarray:
    width = max((len(x) for x in lists), default=0)
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where all sums stay exact."""
    width = min(queries.shape[1], vectors.shape[1])
    queries, vectors = queries[:, :width], vectors[:, :width]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(width, 1)
    if largest < 2.0**53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


def search_shard(ids, rows, vectors, query_rows, queries, floors, k: int, block: int = BLOCK):
    """Best k of a shard for each query with a score of at least its floor: (query row, id, row, score).

    ``rows`` name vectors beyond doubt, also where ids repeat; a query never meets its own row.
    """
    n = len(ids)
    blocks = [slice(a, min(n, a + block)) for a in range(0, n, block)]
    width = min(queries.shape[1], vectors.shape[1])
    high = np.array([vectors[b].max(axis=0, initial=-(2**62)) for b in blocks])[:, :width].astype(np.float64)
    low = np.array([vectors[b].min(axis=0, initial=2**62) for b in blocks])[:, :width].astype(np.float64)
    up, down = np.maximum(queries[:, :width], 0).astype(np.float64), np.minimum(queries[:, :width], 0).astype(np.float64)
    bounds = up @ high.T + down @ low.T
    bounds += np.abs(bounds) * 1e-9 + 1  # rounding never lowers a bound
    order = np.argsort(-bounds, axis=1, kind="stable")
    # queries go through their lists of blocks together: each turn scores the queries that still need one
    threshold = floors.astype(np.float64)
    best: list[list] = [[] for _ in range(len(queries))]
    live = np.arange(len(queries))
    for turn in range(len(blocks)):
        target = order[live, turn]
        need = bounds[live, target] >= threshold[live]
        live, target = live[need], target[need]
        if not len(live):
            break
        for b in np.unique(target):
            mine = live[target == b]
            where = blocks[b]
            scores = _products(queries[mine], vectors[where])
            for q, line in zip(mine.tolist(), scores, strict=True):
                good = np.flatnonzero(line >= threshold[q])
                if len(good):
                    own = query_rows[q]
                    best[q] += [(-int(line[j]), ids[where][j], rows[where][j]) for j in good.tolist() if rows[where][j] != own]
                    if len(best[q]) > k:
                        best[q] = sorted(best[q])[:k]
                    if len(best[q]) == k:
                        threshold[q] = max(threshold[q], -max(best[q])[0])
    for q, found in enumerate(best):
        for score, vec_id, row in sorted(found)[:k]:
            yield query_rows[q], vec_id, row, -score


_ID_LAST = 2**63 - 1


def _searched(k: int, block: int):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_row", "vec_id", "row", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({n: np.empty(0, np.int64) for n in names})
        left = left.sort_values("row")
        found = list(
            search_shard(
                left["order_id"].to_numpy(),
                left["row"].to_numpy(),
                _matrix(left["terms"].tolist()),
                right["query_row"].to_numpy(),
                _matrix(right["query_terms"].tolist()),
                right["floor"].to_numpy(),
                k,
                block,
            )
        )
        return pd.DataFrame(found, columns=names)

    return run


_FOUND = "query_row bigint, vec_id bigint, row bigint, score bigint"
_LEAST = -(2**63)


def top_k(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row for which ``is_query`` holds."""
    base = integer_vectors(rows, id_col, vector_col, scale)
    order = [_place("terms"), F.col("vec_id")]
    laid = base.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    # a shard is a stretch of one partition: the row number's high bits name the partition
    shard = F.shiftleft(F.shiftright("row", 33), 32) + F.floor(F.col("row").bitwiseAND((1 << 33) - 1) / SHARD)
    laid = stored(laid.withColumn("shard", shard).withColumn("order_id", F.coalesce("vec_id", F.lit(_ID_LAST))), "vectors")
    queries = laid.where(F.col("vec_id").isNotNull() & is_query)
    batches = max(1, ceil(queries.count() / QUERIES))
    # names of their own: both sides of a co-grouping come from one table
    queries = queries.select(
        F.col("shard").alias("home"),
        F.col("vec_id").alias("query_id"),
        F.col("row").alias("query_row"),
        F.col("terms").alias("query_terms"),
        F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int").alias("query_batch"),
    )
    vectors = laid.select("shard", "order_id", "row", "terms")
    # the shard that holds the query gives the floor
    at_home = queries.withColumn("floor", F.lit(_LEAST))
    home = vectors.groupBy("shard").cogroup(at_home.groupBy("home")).applyInPandas(_searched(k, BLOCK), _FOUND)
    floors = home.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(_LEAST)).alias("floor"))
    floors = stored(queries.join(floors, "query_row", "left").withColumn("floor", F.coalesce("floor", F.lit(_LEAST))), "floors")
    # every batch of queries meets every shard: the stated query set against all rows, in blocks
    shards = laid.select(F.col("shard").alias("query_shard")).distinct()
    asked = floors.join(_listed(shards, batches), "query_batch")
    offered = vectors.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    found = offered.groupBy("shard", "batch").cogroup(asked.groupBy("query_shard", "query_batch")).applyInPandas(_searched(k, BLOCK), _FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = floors.select("query_row", "query_id")
    return ranked.join(names, "query_row").select(
        "query_id", "rank", F.when(F.col("vec_id") < _ID_LAST, F.col("vec_id")).alias("vec_id"), "score"
    )


def _listed(shards: DataFrame, batches: int) -> DataFrame:
    """Every shard once per batch of queries."""
    return shards.withColumn("query_batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))


def nearest_embeddings(embeddings: DataFrame) -> DataFrame:
    """Queries: ids divisible by 100, against all rows; query_id, rank, vec_id, score."""
    return top_k(embeddings, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS t
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.t, c.t) AS BIGINT) AS score, q.r AS qr, c.r AS cr
    FROM v q JOIN v c ON q.r <> c.r
    WHERE q.vec_id % 100 = 0
), k AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, cr) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 10
"""
