"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt over blocks, and each block keeps one list per dimension sorted by component. A
query reads its lists from the end that its component favours, deeper and deeper; rows met for the first
time are scored in full; it stops once the best score that an unmet row could have, the sum over the
dimensions of the query's component times the list's value at the depth reached, is below its k-th score.
Blocks' results are merged. Queries are stated by a condition and also handled in blocks; every pair of
blocks is one group, so neither side is held whole.

Components become floor(scale * x), and count as LARGEST beyond it. Scores are exact, in the narrowest type that holds
them; where some may exceed 64 bits, ranks are still right and a score that does is NULL. A vector that is null or holds a null or non-finite component takes no
part; shorter vectors count as ending in zeros, so an empty one scores 0 with all. A null id is handled as the largest 64-bit number, which is no query.
Rows are told apart even with equal ids: a query leaves out its own row only. Ties go to the smaller id, then to the row read first. Fewer candidates than k give all. An empty table, or one without queries, gives no rows.
Only the id and the vector are read.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import materialize

BLOCK_ROWS = 16_384
QUERY_ROWS = 1_024
FIRST_DEPTH = 1 / 64  # of a block's rows; doubled each time
LAST_ID = (1 << 63) - 1
LARGEST = 1 << 56  # products of 2**14 such components can be added up in 38 digits


def best_first(scores: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The order by falling score, then rising place."""
    if scores.dtype == object:  # whole numbers of any size
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], places[i])), np.int64)
    return np.lexsort((places, -scores))


class SortedLists:
    """A block's vectors with a sorted list per dimension."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32).T.copy()  # ascending, per dimension
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)

    def top(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best, ties to the smaller position."""
        n = len(self.vectors)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        if own is not None:
            seen[own] = True
        best, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        reached, step = 0, max(k, int(n * FIRST_DEPTH))
        while True:
            depth = min(n, reached + step) if len(up) + len(down) else n
            if depth == n:
                new = np.flatnonzero(~seen)
            else:
                met = np.zeros(n, bool)
                met[self.order[up, n - depth : n - reached]] = True
                met[self.order[down, reached:depth]] = True
                new = np.flatnonzero(met & ~seen)
            if len(new):
                seen[new] = True
                found = (self.vectors @ query)[new] if len(new) > n // 4 else self.vectors[new] @ query
                best, scores = np.concatenate([best, new]), np.concatenate([scores, found])
                if len(best) > k:
                    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                    good = scores >= kth
                    best, scores = best[good], scores[good]
                    order = best_first(scores, best)[:k]
                    best, scores = best[order], scores[order]
            if depth == n:
                return best, scores
            if len(best) >= k:
                bound = self.values[up, n - depth] @ query[up] + self.values[down, depth - 1] @ query[down]
                if bound < scores.min():
                    return best, scores
            reached, step = depth, 2 * step


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def quantized(table: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, vector) with integer components, without the vectors that take no part."""
    vector = F.col(f"`{vector_col}`")
    value = lambda x: x.cast("double")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(value(x)) | (F.abs(value(x)) == float("inf")))
    return (
        table.where(vector.isNotNull())
        .where(~odd)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
            F.transform(vector, lambda x: F.greatest(F.least(F.floor(value(x) * float(scale)).cast("long"), F.lit(LARGEST)), F.lit(-LARGEST))).alias("vector"),
        )
    )


def top_k(
    table: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): for each row that `is_query` (of the column `id`) states, its k best others."""
    asks = F.coalesce(is_query, F.lit(False)) & (F.col("id") != LAST_ID)
    rows = materialize(quantized(table, scale, id_col, vector_col), "vectors")
    seen = rows.agg(
        F.count("*").alias("n"),
        F.sum(asks.cast("long")).alias("q"),
        F.max(F.size("vector")).alias("width"),
        F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))).alias("high"),
    ).first()
    width, high = seen.width or 0, seen.high or 0
    blocks = max(1, -(-seen.n // BLOCK_ROWS))
    groups = max(1, -(-(seen.q or 0) // QUERY_ROWS))
    # Sums of products must be exact: the narrowest type that holds them all.
    exact = width * high * high
    kind = np.float32 if exact < 1 << 24 else np.float64 if exact < 1 << 53 else np.int64 if exact < 1 << 63 else object
    score_type = "bigint" if kind is not object else "decimal(38,0)"

    deal = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked_columns = [F.col(c).alias(f"asked_{c}") for c in ("row", "id", "vector")]  # no name or column of both sides
    candidates = rows.select("row", "id", "vector", deal(blocks, 1).alias("block"), each(groups).alias("part"))
    queries = rows.where(asks).select(deal(groups, 2).alias("asked_part"), each(blocks).alias("asked_block"), *asked_columns)

    def scored(values: np.ndarray) -> np.ndarray | list[Decimal]:
        return values.astype(np.int64) if kind is not object else [Decimal(int(v)) for v in values]

    def search(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        names = ["row", "query_id", "other", "id", "score"]
        if not len(asked) or not len(held):
            return pd.DataFrame({n: pd.Series([], dtype="int64") for n in names})
        held = held.sort_values(["id", "row"])
        others, ids = held["row"].to_numpy(np.int64), held["id"].to_numpy(np.int64)
        place = dict(zip(others.tolist(), range(len(held)), strict=True))
        lists = SortedLists(_matrix(held["vector"], width).astype(kind))
        wanted = _matrix(asked["asked_vector"], width).astype(kind)
        found = [lists.top(q, k, place.get(row)) for row, q in zip(asked["asked_row"].tolist(), wanted, strict=True)]
        counts = [len(best) for best, _ in found]
        best = np.concatenate([x for x, _ in found])
        return pd.DataFrame(
            {
                "row": np.repeat(asked["asked_row"].to_numpy(np.int64), counts),
                "query_id": np.repeat(asked["asked_id"].to_numpy(np.int64), counts),
                "other": others[best],
                "id": ids[best],
                "score": scored(np.concatenate([x for _, x in found])),
            }
        )[names]

    found = (
        queries.groupBy("asked_block", "asked_part")
        .cogroup(candidates.groupBy("block", "part"))
        .applyInPandas(search, f"row bigint, query_id bigint, other bigint, id bigint, score {score_type}")
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id", "other")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.nullif("id", F.lit(LAST_ID)).alias("id"), F.expr("try_cast(score AS bigint)").alias("score"))
