"""Exact k-means rounds, each vector's nearest centroid found by the threshold algorithm.

The centroids, k of them, are kept as one sorted list of values per dimension. For a vector the lists are walked outward
from its own component, at each step one place further in every dimension, to whichever side is nearer. A centroid met for
the first time is measured in full. A centroid not met yet lies at least as far away, in every dimension, as that
dimension's frontier, so the walk stops once the sum of squared frontier distances strictly exceeds the best exact
distance; at equality it goes on, as ties go to the smaller number. All vectors of a block walk together.

Components become integers floor(scale * x), and distances, sums and means are exact: doubles where they hold them,
else 64-bit integers, else whole numbers of any size. A distance beyond 64 bits is NULL in the result, and so are the
sums it enters; the cluster is still right. Components beyond 64 bits count as the largest 64-bit numbers.

Per task and round, k partial sums are handed on; what reaches the driver is k centroids of `width` components, the
operator's parameters, whose product must not exceed MODEL_CELLS. The vectors are written once, in integers, and read
by every round, so a lost executor costs its part of one round.

Vectors that are null, of another length, or hold a null or non-finite component take no part. Null ids are hashed last
and kept; repeated rows are vectors of their own. Fewer vectors than k give fewer centroids. An empty table gives no
rows. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import small_batches
from tidemill.session import materialize

MODEL_CELLS = 1 << 20
BLOCK_CELLS = 1 << 18  # components of the vectors that walk together
LARGEST = (1 << 63) - 1

Model = list[list[int]]


def integer_vectors(table: DataFrame, width: int, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the vectors that take part, as a written table."""
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    known = table.where((F.size(vector) == width) & finite)
    return materialize(known.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole.alias("vector")), "vectors")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> Model:
    """The vectors whose ids have the smallest hashes, in that order; those of equal ids by their components."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(hashed.asc_nulls_last(), "vector").select("vector").limit(k)
    return [list(r.vector) for r in first.collect()]


def long_or_none(total: int | None) -> int | None:
    return None if total is None or total > LARGEST else int(total)


def exact_kind(width: int, high: int) -> type:
    """The narrowest type that holds every sum of `width` squared differences of numbers up to `high`."""
    most = width * (2 * high) ** 2
    return np.float64 if most < 1 << 53 else np.int64 if most <= LARGEST else object


class SortedCentroids:
    """The centroids with a sorted list of their values per dimension."""

    def __init__(self, model: Model, kind: type):
        self.values = np.array(model, kind)  # (k, width)
        self.kind = kind
        order = np.argsort(self.values, axis=0, kind="stable")
        ends = np.zeros((1, self.values.shape[1]), np.int64)
        self.order = np.concatenate([ends, order, ends]).T.copy()  # per dimension, with a place before and after
        self.sorted = np.take_along_axis(self.values, order, axis=0).T.copy()
        self.dims = np.arange(self.values.shape[1])

    def gaps(self, x: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance to the next place on either side, and where a side has none left, -1."""
        k = len(self.values)
        below = np.where(left > 0, x - self.sorted[self.dims, np.maximum(left - 1, 0)], -1)
        above = np.where(right <= k, self.sorted[self.dims, np.minimum(right - 1, k - 1)] - x, -1)
        return below, above

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid, and how many were measured in all."""
        n, k = len(x), len(self.values)
        best, number = np.zeros(n, self.kind), np.full(n, -1, np.int64)
        right = np.empty(x.shape, np.int64)
        for d in self.dims:
            right[:, d] = np.searchsorted(self.sorted[d], x[:, d]) + 1  # places are counted from 1
        left = right - 1
        met = np.zeros((n, k), bool)
        rows, measured = np.arange(n), 0
        below, above = self.gaps(x, left, right)
        while len(rows):
            down = (below >= 0) & ((above < 0) | (below <= above))
            place = np.where(down, left, right)
            new = np.zeros((len(rows), k), bool)
            new[np.arange(len(rows))[:, None], self.order[self.dims, place]] = True
            new &= ~met[rows]
            met[rows] |= new
            at, centroid = np.nonzero(new)  # by row, then by number
            measured += len(at)
            far = x[rows[at]] - self.values[centroid]
            far = (far * far).sum(axis=1)
            for c in np.unique(centroid).tolist():  # in ascending order, so a tie keeps the smaller number ...
                mine = np.flatnonzero(centroid == c)
                r, f = rows[at[mine]], far[mine]
                better = (number[r] < 0) | (f < best[r]) | ((f == best[r]) & (c < number[r]))  # ... of this step or before
                best[r[better]], number[r[better]] = f[better], c
            left, right = left - down, right + ~down
            below, above = self.gaps(x[rows], left, right)
            ended = ((below < 0) & (above < 0)).any(axis=1)  # a list read to its ends has shown every centroid
            frontier = np.where((above < 0) | ((below >= 0) & (below <= above)), below, above)
            open_rows = ~(ended | ((frontier * frontier).sum(axis=1) > best[rows]))
            rows, left, right = rows[open_rows], left[open_rows], right[open_rows]
            below, above = below[open_rows], above[open_rows]
        return number, best, measured


def _blocks(batches: Iterator[pa.RecordBatch], width: int, kind: type) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        step = max(1, BLOCK_CELLS // width)
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), flat.reshape(-1, width).astype(kind)


def next_centroids(vectors: DataFrame, model: Model, kind: type) -> Model:
    """Each centroid's new place: the floor of its vectors' mean in every dimension; without vectors, the old one."""
    width = len(model[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedCentroids(model, kind)
        sums, counts = np.zeros((len(model), width), object), np.zeros(len(model), np.int64)
        for _, x in _blocks(batches, width, kind):
            number, _, _ = lists.nearest(x)
            for c in np.unique(number).tolist():
                mine = x[number == c]
                whole = mine if kind is np.float64 else mine.astype(object)
                sums[c] += np.array([int(v) for v in whole.sum(axis=0)], object)
                counts[c] += len(mine)
        used = np.flatnonzero(counts).tolist()
        cells = [int(v) for c in used for v in sums[c]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for c in used for _ in range(width)], pa.int32()),
                pa.array(list(range(width)) * len(used), pa.int32()),
                pa.array([int(counts[c]) for c in used for _ in range(width)], pa.int64()),
                pa.array(cells, pa.decimal128(38, 0)),
            ],
            names=["cluster", "dim", "n", "total"],
        )

    parts = small_batches(vectors).mapInArrow(run, "cluster int, dim int, n bigint, total decimal(38,0)")
    found = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    moved = [list(c) for c in model]
    for r in found:
        moved[r.cluster][r.dim] = int(r.total) // r.n
    return moved


def assigned(vectors: DataFrame, model: Model, kind: type) -> DataFrame:
    """(id, cluster, distance) of every vector, as a written table."""
    width = len(model[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedCentroids(model, kind)
        for ids, x in _blocks(batches, width, kind):
            number, best, _ = lists.nearest(x)
            far = [int(v) if v <= LARGEST else None for v in best] if kind is object else best.astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(far, pa.int64())], names=["id", "cluster", "distance"])

    return materialize(small_batches(vectors).mapInArrow(run, "id bigint, cluster int, distance bigint"), "clusters")


def cluster(
    table: DataFrame,
    k: int = 16,
    rounds: int = 3,
    scale: float = 64.0,
    width: int = 64,
    seed: int = 1,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) per vector that takes part.

    `centroid` holds the final components of the vector's centroid.
    """
    if k * width > MODEL_CELLS:
        raise ValueError(f"{k} centroids of {width} components exceed {MODEL_CELLS} numbers")
    vectors = integer_vectors(table, width, scale, id_col, vector_col)
    high = vectors.agg(F.max(F.greatest(F.abs(F.array_max("vector").cast("decimal(20,0)")), F.abs(F.array_min("vector").cast("decimal(20,0)"))))).first()[0]
    kind = exact_kind(width, int(high or 0))
    model = first_centroids(vectors, k, seed)
    for _ in range(rounds if model else 0):
        model = next_centroids(vectors, model, kind)
    rows = assigned(vectors, model or [[0] * width], kind)
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("part")
    totals = {r.cluster: r.part for r in rows.groupBy("cluster").agg(whole).collect()}  # a row per centroid
    inertia = long_or_none(None if None in totals.values() else sum(totals.values()))
    found = [(c, long_or_none(totals.get(c)), inertia, values) for c, values in enumerate(model)]
    found = table.sparkSession.createDataFrame(found, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return rows.join(F.broadcast(found), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
