"""Exact top-k inner products by no-random-access aggregation of sorted lists."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import written

SCALE = 256
TOP = 5
#: Candidates and queries that meet in one task; queries that read the lists together.
CANDIDATE_BLOCK, QUERY_BLOCK, QUERY_BATCH = 8192, 512, 64
#: Entries of each list that are read before bounds are first compared; then twice as many.
FIRST_DEPTH = 64


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, vector) with floor(scale * x), x as double, of every vector without null or non-finite components."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return (
        table.where(F.col("embedding").isNotNull())
        .where(~odd)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long"),
            F.transform(value, lambda x: F.floor(x * scale)).alias("vector"),
        )
    )


def _matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def sorted_access_top(queries: np.ndarray, items: np.ndarray, own: np.ndarray, k: int, slack: float = 0.0) -> list[np.ndarray]:
    """For each query the items that may be among its k best: all others have a lower score.

    There is a list per component and direction, sorted by the component: a query reads it
    from the end that raises its score. All lists are read in step. After depth t an item's
    score is at least what its read components give with the worst of every unread one, and
    at most the same with the list's value at t. A query stops once the k-th largest lower
    bound is above the bound of an item that no list has shown; what is left are the items
    whose upper bound reaches the k-th lower one. own: the query's own item, or -1. slack: how
    far a bound may be off by rounding.
    """
    n = len(items)
    order = np.sort(items, axis=0)
    rank = items.argsort(0, kind="stable").argsort(0, kind="stable")
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    out: list[np.ndarray] = [np.zeros(0, int)] * len(queries)
    active, depth = np.arange(len(queries)), min(FIRST_DEPTH, n)
    while len(active):
        top, bottom = order[n - depth], order[depth - 1]
        from_top, from_bottom = rank >= n - depth, rank < depth
        u, d = up[active].T, down[active].T
        lower = np.where(from_top, items, order[0]) @ u + np.where(from_bottom, items, order[-1]) @ d
        upper = np.where(from_top, items, top) @ u + np.where(from_bottom, items, bottom) @ d
        unseen = top @ u + bottom @ d
        mine = np.flatnonzero(own[active] >= 0)
        lower[own[active][mine], mine] = upper[own[active][mine], mine] = -np.inf
        kth = np.partition(lower, n - k, axis=0)[n - k] if n >= k else np.full(len(active), -np.inf)
        kth = kth - 2 * slack
        done = (unseen < kth) | (depth == n)
        for j in np.flatnonzero(done):
            keep = upper[:, j] >= kth[j]
            out[active[j]] = np.flatnonzero(keep & (upper[:, j] > -np.inf))
        active, depth = active[~done], min(2 * depth, n)
    return out


def _block_top(queries: pd.DataFrame, items: pd.DataFrame, k: int) -> pd.DataFrame:
    rows: list[tuple[int, int, int, int]] = []
    if len(queries) and len(items):
        width = max(map(len, [*queries["vector"], *items["vector"]]), default=0)
        q, c = _matrix(list(queries["vector"]), width), _matrix(list(items["vector"]), width)
        # beyond 2**53 sums of doubles round: bounds get room for it, and scores are summed as longs
        most = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(width, 1)
        slack, whole = (most * 2.0**-50, (q.astype(np.int64), c.astype(np.int64))) if most >= 2.0**53 else (0.0, (q, c))
        at = {r: i for i, r in enumerate(items["row"])}
        own = np.array([at.get(r, -1) for r in queries["row"]])
        ids, item_rows = items["vec_id"].to_numpy(), items["row"].to_numpy()
        for a in range(0, len(q), QUERY_BATCH):
            part = slice(a, a + QUERY_BATCH)
            for i, found in enumerate(sorted_access_top(q[part], c, own[part], k, slack), a):
                scores = whole[1][found] @ whole[0][i]
                best = np.lexsort((item_rows[found], ids[found], -scores))[:k]
                rows.extend((queries["row"].iloc[i], queries["vec_id"].iloc[i], ids[found[b]], int(scores[b])) for b in best)
    return pd.DataFrame(rows, columns=["row", "query_id", "vec_id", "score"], dtype="int64")


def top_inner_products(table: DataFrame, every: int = 50, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each vec_id divisible by `every`.

    Scores are integer inner products; ties go to the smaller vec_id. Queries and candidates
    meet in blocks of a fixed size, each block pair finds its best by sorted access and exact
    scores of what the bounds leave, and the best of the blocks are ranked.

    Vectors that are null or hold a null or non-finite component take no part; missing last
    components count as 0. Rows with a null vec_id are left out. Rows that repeat a vec_id are
    queries and candidates of their own, each with its own results. Scores are exact as long
    as they fit a long. Other columns are not read; an empty table gives an empty result.
    """
    vectors = written(integer_vectors(table.where(F.col("vec_id").isNotNull())), "vectors")
    queries = vectors.where(F.col("vec_id") % every == 0)
    blocks = max(1, math.ceil(vectors.count() / CANDIDATE_BLOCK))
    query_blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))

    def in_blocks(df: DataFrame, mine: str, n_mine: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(mine, F.pmod(F.xxhash64("row"), F.lit(n_mine)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    left = in_blocks(queries, "_q", query_blocks, "_c", blocks).groupBy("_q", "_c")
    right = in_blocks(vectors, "_c", blocks, "_q", query_blocks).groupBy("_q", "_c")

    def pair(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        return _block_top(one, two, k)

    found = left.cogroup(right).applyInPandas(pair, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


TOP_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x : CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
