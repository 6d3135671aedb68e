"""Centroid clustering by Ball k-means on integer vectors, exact in every round.

A cluster is a ball: its centroid and the largest distance of a member. A member x of ball i can only leave for a
centroid j with d(c_i, c_j) <= 2 d(x, c_i), so centroids farther than twice the ball's radius are no neighbours at all. The
halved distances to the neighbours, in ascending order, cut the ball: members within the first one are its stable core
and are compared with nothing; those in the annulus behind the n-th are compared exactly with the n nearest neighbours
only. Balls are made of the members that a task holds at a time, whose radius is at most the whole ball's, so
no neighbour is missed. Squared distances are integers and compared as 4 d(x, c_i)^2 < d(c_i, c_j)^2, so ties are exact: the
smaller number wins.

A round reads the vectors with their cluster, moves members, and sums by cluster and component: what reaches the driver is k
rows for each component, whatever the input. The vectors are written again with their clusters only once in REFRESH rounds; between, a task
repeats the last moves of its members from the centroids of those rounds, which is cheaper than writing all vectors.
Written tables lie in the shared folder and go when they are replaced.

Defined cases: vectors that are null, have another number of components, or hold a null or non-finite one take no part.
Rows that share an id are members of their own; of equal hashes, those with the smaller vector are centroids first (repeated rows may
give equal centroids, of which the smaller number gets all members and the other stays empty). A null id hashes as an empty
one. With fewer vectors than k there are as many clusters as vectors; an empty table gives an empty result. Components beyond LARGEST
after scaling would not leave room for a squared distance in 64 bits and raise an error. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import map_arrow, released, stored

K, DIMS, ROUNDS, SCALE, SALT = 8, 64, 10, 1024, "3"
#: Rounds between two written assignments.
REFRESH = 4
LARGEST = 1 << 27
#: Vectors that are compared at once.
BLOCK = 4096
_HELD = "vec_id bigint, vec binary, cluster int"


def kept(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vec array<bigint>) of the vectors that take part."""
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = (F.size(vector_col) == dims) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # beyond LARGEST an error follows, so that larger values needn't fit
    whole = F.transform(values, lambda x: F.floor(F.greatest(F.least(F.lit(float(scale)) * x, F.lit(2.0 * LARGEST)), F.lit(-2.0 * LARGEST))).cast("bigint"))
    return vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.when(good, whole).alias("vec")).where("vec IS NOT NULL")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as 32-bit integers, all in cluster 0."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(1).flatten().to_numpy()
        if len(values) and np.abs(values).max() > LARGEST:
            raise OverflowError(f"components beyond {LARGEST} are too large for 64-bit distances")
        packed = values.astype("<i4").reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "vec": pa.array([v.tobytes() for v in packed], pa.binary()), "cluster": pa.array(np.zeros(batch.num_rows, np.int32))})


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one row, exact."""
    d = x.astype(np.int64) - y.astype(np.int64)
    return np.einsum("ij,ij->i", d, d)


def moved(points: np.ndarray, cluster: np.ndarray, centroids: np.ndarray, count: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, and its squared distance, given the balls that the points were members of. ``count`` gains the
    number of distances computed."""
    between = np.stack([squared(centroids, c) for c in centroids])
    out, best = cluster.copy(), np.zeros(len(points), np.int64)
    for i in np.unique(cluster).tolist():
        at = np.flatnonzero(cluster == i)
        own = squared(points[at], centroids[i])
        best[at] = own
        near = np.argsort(between[i], kind="stable")
        near = near[(near != i) & (between[i][near] <= 4 * own.max())]  # the ball's neighbours
        edges = between[i][near]
        reach = np.searchsorted(edges, 4 * own, "right")  # 0: stable core; n: compare with the n nearest neighbours
        for n, j in enumerate(near.tolist()):
            inside = at[reach > n]
            if count is not None:
                count[0] += len(inside)
            d = squared(points[inside], centroids[j])
            nearer = (d < best[inside]) | ((d == best[inside]) & (j < out[inside]))
            out[inside[nearer]], best[inside[nearer]] = j, d[nearer]
    return out, best


def _members(batches: Iterator[pa.RecordBatch], history: list[np.ndarray]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, vectors, clusters, distances) after the assignments to each of the centroids of ``history``."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(at, BLOCK)
            points = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").reshape(batch.num_rows, -1)
            cluster, distance = batch.column(2).to_numpy(), None
            for centroids in history:
                cluster, distance = moved(points, cluster, centroids)
            yield batch, points, cluster, distance


def _sums(history: list[np.ndarray]):  # noqa: ANN202
    """A task's (cluster, component, total, n)."""
    k, dims = history[-1].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, points, cluster, _ in _members(batches, history):
            n += np.bincount(cluster, minlength=k)
            for i in np.unique(cluster).tolist():
                total[i] += points[cluster == i].sum(axis=0, dtype=np.int64)
        clusters, parts = np.divmod(np.arange(k * dims), dims)
        yield pa.RecordBatch.from_pydict({"cluster": clusters.astype(np.int32), "part": parts.astype(np.int32), "total": total.ravel(), "n": np.repeat(n, dims)})

    return run


def _assigned(history: list[np.ndarray], distances: bool):  # noqa: ANN202
    """The rows with their clusters; their distances instead of their vectors if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in _members(batches, history):
            new = pa.array(cluster.astype(np.int32))
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "cluster": new, "distance": distance} if distances else {"vec_id": batch.column(0), "vec": batch.column(1), "cluster": new})

    return run


def first_centroids(rows: DataFrame, k: int = K, salt: str = SALT) -> np.ndarray:
    """The vectors with the smallest hashes, in their order."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = rows.select(key.alias("key"), "vec").orderBy("key", "vec").limit(k).collect()
    return np.array([r.vec for r in first], np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, dims: int = DIMS, rounds: int = ROUNDS, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that takes part."""
    spark, rows = vectors.sparkSession, kept(vectors, id_col, vector_col, dims, scale)
    schema = f"{id_col} bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    centroids = first_centroids(rows, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    held, history = stored(map_arrow(rows, _pack, _HELD)), []
    for _ in range(rounds):
        history.append(centroids)
        if len(history) > REFRESH:
            before, held = held, stored(map_arrow(held, _assigned(history[:-1], False), _HELD))
            released(before)
            history = history[-1:]
        sums = map_arrow(held, _sums(history), "cluster int, part int, total bigint, n bigint").groupBy("cluster", "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        centroids = centroids.copy()
        for r in sums.where("n > 0").collect():  # at most k rows for each component
            centroids[r.cluster, r.part] = r.total // r.n
    done = stored(map_arrow(held, _assigned([*history, centroids], True), "vec_id bigint, cluster int, distance bigint"))
    released(held)
    inertia = done.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # a row for each cluster
    names = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    facts = {r.cluster: r for r in inertia.join(names, "cluster").collect()}
    total = sum(r.cluster_inertia for r in facts.values())
    facts = spark.createDataFrame([(i, r.cluster_inertia, total, r.centroid_sha256) for i, r in facts.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return done.join(F.broadcast(facts), "cluster").select(F.col("vec_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
