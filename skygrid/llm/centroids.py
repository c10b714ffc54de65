"""Centroid clustering with a threshold algorithm for the nearest centroid.

For every dimension the centroids stand in a list sorted by their value.  A
vector starts at its own value in each list and walks outward, one centroid a
step, the nearer side first.  A centroid met for the first time gets its exact
distance.  What is not met yet lies, in every dimension, no nearer than the
walk has come; so once the sum of these frontier distances strictly exceeds
the best exact distance, no other centroid can be nearer or as near.

Vectors are turned into integers first, so sums, means and distances are exact
and results don't depend on how rows are dealt to tasks.  A round is one pass
over the vectors, which returns one row of sums per task and cluster; only the
centroids (``k`` times ``dims`` numbers) reach the driver and the closures.

Cases
-----
* vectors that are null, have another number of components, or a component
  that is null or not finite are left out;
* a vector with a component beyond +-131072 has distances beyond 64 bits: it
  is returned with null results and takes no part;
* repeated rows count and are returned as often as they occur;
* ties go to the centroid with the smaller number; a centroid without vectors
  stays where it is;
* rows with a null id are clustered, but never start a centroid;
* fewer vectors than centroids: as many centroids as vectors; an empty table:
  an empty result;
* other columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import bound_batches, cut_lineage, map_batches

DIMS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3:"
_REACH = 1 << 27        # of an integer component: 64 squares of differences fit in 64 bits
_ROWS = 2048            # vectors walked at a time


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each row of integers ``x``, and its squared distance."""
    k, dims = centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    far = np.full((1, dims), 4 * _REACH)
    values, order = np.vstack([-far, values, far]), np.vstack([order[:1], order, order[:1]])
    dim = np.arange(dims)
    right = np.stack([np.searchsorted(values[:, d], x[:, d], "right") for d in range(dims)], axis=1)
    left = right - 1
    best = np.full(len(x), np.iinfo(np.int64).max)
    who = np.zeros(len(x), np.int64)
    met = np.zeros((len(x), k), bool)
    walking = np.arange(len(x))
    while len(walking):
        own = x[walking]
        lower, upper = own - values[left, dim], values[right, dim] - own
        down = lower <= upper
        frontier = np.where(down, lower, upper)
        reached = np.zeros((len(walking), k), bool)
        reached[np.arange(len(walking))[:, None], order[np.where(down, left, right), dim]] = True
        left, right = left - down, right + ~down
        row, c = np.nonzero(reached & ~met[walking])
        met[walking] |= reached
        exact = np.full((len(walking), k), np.iinfo(np.int64).max)
        diff = own[row] - centroids[c]
        exact[row, c] = np.einsum("ij,ij->i", diff, diff)
        nearer = exact.argmin(axis=1)
        distance = exact[np.arange(len(walking)), nearer]
        better = (distance < best[walking]) | ((distance == best[walking]) & (nearer < who[walking]))
        best[walking[better]], who[walking[better]] = distance[better], nearer[better]
        on = (np.einsum("ij,ij->i", frontier, frontier) <= best[walking]) & ~met[walking].all(axis=1)
        walking, left, right = walking[on], left[on], right[on]
    return who, best


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``(id, vector)`` of the usable vectors as integers ``floor(scale * x)``; null where out of reach."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vector")).where(
        F.size("vector") == dims)

    def run(batch: pa.RecordBatch):
        ids, lists = batch.columns
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
        usable = np.isfinite(values).all(axis=1)
        with np.errstate(over="ignore"):
            scaled = np.floor(values[usable] * scale)
        near = (np.abs(scaled) <= _REACH).all(axis=1)
        whole = np.where(near[:, None], scaled, 0).astype(np.int32)
        found = pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1) * dims, pa.int32()),
                                         pa.array(whole.ravel()), mask=pa.array(~near)) if len(whole) else \
            pa.array([], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(usable)), found], names=["id", "vector"])
    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"id {kind}, vector array<int>")


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def _sums(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(cluster, pos, total, n)`` over all vectors, added up in each task first."""
    bound_batches(kept.sparkSession)
    k, dims = centroids.shape

    def run(batches):
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            matrix = _matrix(batch, dims)
            for at in range(0, len(matrix), _ROWS):
                x = matrix[at:at + _ROWS]
                who, _ = nearest(x, centroids)
                n += np.bincount(who, minlength=k)
                for c in np.unique(who):
                    total[c] += x[who == c].sum(axis=0)
        filled = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), pa.array(n[filled]),
             pa.array([total[c] for c in filled], pa.list_(pa.int64()))], names=["cluster", "n", "total"])
    parts = kept.mapInArrow(run, "cluster int, n long, total array<long>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("pos", "total"))
    return each.groupBy("cluster", "pos").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"),
                                              F.sum("n").alias("n"))


def first_centroids(kept: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id, in the order of the hashes."""
    hashed = kept.where("id IS NOT NULL").select(
        F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256).alias("hash"), "vector")
    return np.array([r.vector for r in hashed.orderBy("hash", "vector").limit(k).collect()], np.int64)


def fit(kept: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds of assignment and componentwise floored means."""
    for _ in range(rounds):
        for r in _sums(kept, centroids).collect():      # k x dims rows
            centroids[r.cluster, r.pos] = int(r.total) // r.n
    return centroids


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS,
            k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """``(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per usable vector."""
    whole = cut_lineage(integer_vectors(vectors, id_col, vec_col, dims, scale), "vectors")
    kept = whole.where("vector IS NOT NULL")
    centroids = first_centroids(kept, k, seed)
    results = ["cluster int", "distance long"]
    if len(centroids):
        centroids = fit(kept, centroids, rounds)

        def run(batch: pa.RecordBatch):
            found = [nearest(x, centroids) for m in [_matrix(batch, dims)]
                     for x in (m[at:at + _ROWS] for at in range(0, len(m), _ROWS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.concatenate([w for w, _ in found]).astype(np.int32)),
                 pa.array(np.concatenate([d for _, d in found]))], names=["id", "cluster", "distance"])
        kind = whole.schema["id"].dataType.simpleString()
        placed = cut_lineage(map_batches(kept, run, f"id {kind}, {', '.join(results)}"), "clusters")
    else:       # no vector, or none with an id
        placed = kept.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    out_of_reach = whole.where("vector IS NULL").select(
        "id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    spread = {r.cluster: int(r.d) for r in placed.where("cluster IS NOT NULL").groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}      # k rows
    top = (1 << 63) - 1
    described = [(c, spread.get(c, 0) if spread.get(c, 0) <= top else None,
                  hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
                 for c in range(len(centroids))]
    about = vectors.sparkSession.createDataFrame(described, "of int, cluster_inertia long, centroid_sha256 string")
    total = sum(spread.values())
    joined = placed.unionByName(out_of_reach).join(F.broadcast(about), F.col("cluster") == F.col("of"), "left")
    inertia = F.when(F.col("cluster").isNotNull(), F.lit(total if total <= top else None).cast("long"))
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia",
                         inertia.alias("inertia"), "centroid_sha256")
