"""Centroid clustering whose assignment is the threshold algorithm over sorted centroid lists.

Vectors become integers floor(scale * x), so sums, means and distances are exact and no order of
addition can change a result.  A round assigns every vector to its nearest centroid and replaces
each non-empty centroid by the componentwise floor of its vectors' mean.

Assignment (``Lists.nearest``).  For each dimension the centroids are kept sorted by their value.
A vector enters every list at its own value and walks outward, in each list to the nearer of the
two next entries.  A centroid met in any list gets its exact distance once.  A centroid not met
yet is, in every dimension, at least as far as that list's frontier, so the sum of the squared
frontier distances bounds its distance from below: the walk ends when that sum strictly exceeds
the best exact distance.  (Strictly: at equality an unmet centroid may tie with a smaller number.)
All vectors of an Arrow batch walk together as numpy arrays; those that have ended leave.

Plan.  The integer vectors are written once.  Each round is one scan of them: tasks send one row
per cluster and dimension (partial sums), Spark adds them up, and the driver holds the k centroids
(k x dimensions numbers, bounded by the parameters, whatever the table's size).

Cases
  * vectors that are null, of another length, or hold a null or non-finite component take no part;
  * scaled components beyond ``component_limit(dims)`` (for 64 dimensions 2**27, that is |x| of
    131,072) count as that limit: squared distances are longs and could not be returned else;
  * null ids take part; their hash reads ``null``.  Rows repeating an id are vectors of their own;
  * fewer vectors than clusters: as many clusters as vectors; equal start vectors: the smaller
    number wins every tie, the other cluster stays empty and keeps its centroid;
  * empty table, or none that takes part: empty result.
Extra columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import quoted
from ratewise.sources.tables import cut_lineage

DIMS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
LONG_MAX = 2 ** 63 - 1
SLICE = 4096        # vectors that walk together


def component_limit(dims: int) -> int:
    """The largest power of two whose squared differences still add up to a long."""
    return 1 << (math.isqrt(LONG_MAX // dims).bit_length() - 2)


class Lists:
    """The centroids' sorted lists, one per dimension."""

    def __init__(self, centroids: list[list[int]]):
        self.c = np.array(centroids, dtype=np.int64)                    # k x dims
        self.order = np.argsort(self.c, axis=0, kind="stable")          # k x dims: centroid numbers
        self.values = np.take_along_axis(self.c, self.order, axis=0)    # k x dims: sorted values
        self.compared = 0                                               # exact distances so far

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row of ``x``."""
        parts = [self._walk(x[a:a + SLICE]) for a in range(0, len(x), SLICE)]
        return (np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)]),
                np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]))

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, dims = self.c.shape
        far = np.int64(LONG_MAX)
        number, best = np.full(len(x), k, dtype=np.int64), np.full(len(x), far)
        seen = np.zeros((len(x), k), dtype=bool)
        # the next entry to the right of each list, and to the left
        right = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        open_rows, d = np.arange(len(x)), np.arange(dims)
        for _ in range(k):
            v, lo, hi = x[open_rows], left[open_rows], right[open_rows]
            to_left = np.where(lo >= 0, v - self.values[np.maximum(lo, 0), d], far)
            to_right = np.where(hi < k, self.values[np.minimum(hi, k - 1), d] - v, far)
            leftward = to_left < to_right
            met = self.order[np.where(leftward, np.maximum(lo, 0), np.minimum(hi, k - 1)), d]
            frontier = np.minimum(to_left, to_right)
            left[open_rows] = lo - leftward
            right[open_rows] = hi + ~leftward
            # exact distances of the centroids met for the first time
            new = np.zeros((len(open_rows), k), dtype=bool)
            new[np.arange(len(open_rows))[:, None], met] = True
            new &= ~seen[open_rows]
            seen[open_rows] |= new
            for j in np.flatnonzero(new.any(axis=0)):
                at = np.flatnonzero(new[:, j])
                rows = open_rows[at]
                self.compared += len(at)
                dist = ((v[at] - self.c[j]) ** 2).sum(axis=1)
                nearer = (dist < best[rows]) | ((dist == best[rows]) & (j < number[rows]))
                best[rows[nearer]], number[rows[nearer]] = dist[nearer], j
            ended = (frontier ** 2).sum(axis=1) > best[open_rows]
            open_rows = open_rows[~ended]
            if not len(open_rows):
                break
        return number, best


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``(id, x array<bigint>)`` of the vectors that take part."""
    limit = float(component_limit(dims))
    v = df.select(quoted(id_col).alias("id"), quoted(vector_col).cast("array<double>").alias("v"))
    good = (F.size("v") == dims) & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return v.filter(F.coalesce(good, F.lit(False))).select("id", F.transform(
        "v", lambda e: F.floor(F.greatest(F.least(e * float(scale), F.lit(limit)), F.lit(-limit))).cast("bigint")).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _totals(vectors: DataFrame, centroids: list[list[int]], dims: int) -> dict[int, tuple[int, list[int]]]:
    """Per non-empty cluster: how many vectors, and their componentwise sums."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        sums = [[0] * (dims + 1) for _ in centroids]     # Python integers: no overflow
        for b in batches:
            x = _matrix(b.column(0), dims)
            number, _ = lists.nearest(x)
            for j in np.unique(number):
                own = x[number == j]
                for d, s in enumerate([*own.sum(axis=0).tolist(), len(own)]):
                    sums[j][d] += s
        rows = [(j, d, Decimal(s)) for j, r in enumerate(sums) if r[dims] for d, s in enumerate(r)]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.decimal128(38, 0))], names=["cluster", "dim", "s"])

    parts = vectors.select("x").mapInArrow(partial, "cluster int, dim int, s decimal(38,0)")
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "dim").agg(F.sum("s").alias("s")).collect():     # at most k x (dims + 1) rows
        out.setdefault(r["cluster"], [0] * (dims + 1))[r["dim"]] = int(r["s"])
    return {j: (r[dims], r[:dims]) for j, r in out.items()}


def fit(vectors: DataFrame, k: int, rounds: int, seed: int, dims: int) -> list[list[int]]:
    """The centroids after ``rounds`` rounds (fewer if a round changes nothing: all later ones would not either)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    start = vectors.select(key.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    centroids = [list(r["x"]) for r in start]
    for _ in range(rounds if centroids else 0):
        totals = _totals(vectors, centroids, dims)
        moved = [[s // totals[j][0] for s in totals[j][1]] if j in totals else c for j, c in enumerate(centroids)]
        if moved == centroids:
            break
        centroids = moved
    return centroids


def clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE,
             k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid`` (array of the final centroid) of every vector."""
    spark = df.sparkSession
    vectors = cut_lineage(integer_vectors(df, id_col, vector_col, dims, scale))      # read once per round
    centroids = fit(vectors, k, rounds, seed, dims)
    id_type = vectors.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for b in batches:
            number, distance = lists.nearest(_matrix(b.column(1), dims))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number, pa.int32()), pa.array(distance)],
                                             names=["id", "cluster", "distance"])

    found = cut_lineage(vectors.mapInArrow(assign, f"id {id_type}, cluster int, distance bigint"))   # read twice
    if not centroids:
        return found.select("id", "cluster", "distance", F.lit(None).cast("bigint").alias("cluster_inertia"),
                            F.lit(None).cast("bigint").alias("inertia"), F.lit(None).cast("array<bigint>").alias("centroid"))
    sums = {r["cluster"]: int(r["s"]) for r in
            found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}   # k rows
    held = lambda n: min(n, LONG_MAX)
    facts = spark.createDataFrame([(j, held(s), held(sum(sums.values())), centroids[j]) for j, s in sums.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    # k rows at most
    return found.join(F.broadcast(facts), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
