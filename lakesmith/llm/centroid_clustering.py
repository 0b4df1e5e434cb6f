"""Centroid clustering with geometric drift tightening.

Every vector keeps its cluster and one lower bound on its distance to all other
centroids.  When centroids move, the bound must be loosened; the triangle
inequality takes the full drift.  Here a cluster's vectors lie in a sphere
around its old centroid, and how much nearer a moved centroid can come to any
point of that sphere is a planar question (sphere centre, old and new place of
the centroid span a plane).  The answer is less than the drift, often negative.
A vector whose own centroid is surely the nearest keeps its cluster; the others
are ambiguous and scanned against all centroids in exact integer arithmetic.

The vectors are written once, packed in blocks, to a table bucketed by block;
each pass writes only clusters and bounds, bucketed alike, so vectors and state
meet without a shuffle.  A pass also writes what the vectors that changed their
cluster add to and take from the sums of components; Spark adds these up, and
one row per cluster reaches the driver.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakesmith.llm._vectors import finite, limit, matrix, whole
from lakesmith.session import fresh_dir

#: vectors in a packed block
BLOCK = 1024
#: input bytes for each bucket of the tables
BUCKET_BYTES = 128 << 20
#: what rounding may cost a bound, as a share of the quantity
SLACK = 1e-6

CLUSTER, BOUND = np.dtype("<i4"), np.dtype("<f8")
STATE = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("cluster", T.BinaryType()), T.StructField("bound", T.BinaryType()),
    T.StructField("scanned", T.LongType()),
    T.StructField("sums", T.ArrayType(T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", T.ArrayType(T.LongType()))]))),
    T.StructField("reach", T.ArrayType(T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("radius", T.DoubleType())]))),
])


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to integer centroids."""
    if not len(x) or not len(centroids):
        return np.zeros((len(x), len(centroids)), np.int64)
    most = int(np.abs(x).max(initial=0)) + int(np.abs(centroids).max(initial=0))
    if most * most * x.shape[1] < 1 << 52:   # every term below is a whole number that a double holds
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None]).astype(np.int64)
    a, out = x.astype(np.int64), np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids.astype(np.int64)):
        out[:, j] = ((a - c) ** 2).sum(1)
    return out


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster, the most by which any other centroid can have come nearer to a point of its sphere.

    Cluster ``i`` lies in the sphere around ``old[i]`` with ``radius[i]``;
    centroid ``j`` moves from ``old[j]`` to ``new[j]`` by ``p``.  Two bounds hold:

    - seen from the middle of the move, the points that come nearer by more than
      ``p * cos(a)`` lie inside the cone of half angle ``a`` about the direction of
      the move (the asymptotes of a hyperbola whose foci are both places), so the
      smallest angle of the sphere gives a bound, zero at least;
    - along the move the distance to a point falls by the cosine of its angle,
      which shrinks for every point off the line; so where the line misses the
      sphere, the smallest angle seen from the old place gives a bound, which may
      be negative: the centroid goes away.
    """
    k = len(old)
    old, new, r = old.astype(np.float64), new.astype(np.float64), radius.astype(np.float64) * (1 + SLACK)
    most = np.full(k, -np.inf)
    for j in range(k):
        move = new[j] - old[j]
        p = float(np.sqrt(move @ move))
        if p == 0:
            bound = np.zeros(k)
        else:
            u = move / p
            w = old - (old[j] + new[j]) / 2
            along = w @ u
            off = np.sqrt(((w - along[:, None] * u) ** 2).sum(1))
            middle = np.where((off <= r) & (along > 0), 1.0, np.maximum(0, _cosine(along, off, r)))
            bound = np.where(along**2 + off**2 > r**2, p * middle, p)
            start = np.where(off > r, p * _cosine(along + p / 2, off, r), p)
            bound = np.minimum(p, np.minimum(bound, start) + SLACK * p)
        bound[j] = -np.inf
        most = np.maximum(most, bound)
    return np.where(np.isfinite(most), most, 0.0)


def _cosine(along: np.ndarray, off: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Cosine of the smallest angle under which a circle of radius ``r`` at ``(along, off)`` is seen from outside."""
    d2 = along**2 + off**2
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(d2 > r**2, np.clip((along * np.sqrt(np.maximum(0, d2 - r**2)) + off * r) / d2, -1, 1), 1.0)


def _half_gaps(centroids: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the nearest other one."""
    d = np.sqrt(squared_distances(centroids, centroids).astype(np.float64))
    np.fill_diagonal(d, np.inf)
    return d.min(axis=1, initial=np.inf) / 2


class Move:
    """Centroids of a pass and what their move did to the bounds."""

    def __init__(self, centroids: np.ndarray, loosen: np.ndarray | None = None):
        self.centroids, self.loosen, self.gaps = centroids, loosen, _half_gaps(centroids)

    def assign(self, x: np.ndarray, cluster: np.ndarray | None, bound: np.ndarray | None):
        """``(cluster, own squared distance, lower bound, scanned)`` of a block; clusters and bounds are of the pass before."""
        if cluster is None:
            cluster, own, bound = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), np.zeros(len(x))
            unsure = np.arange(len(x))
        else:
            cluster, bound = cluster.astype(np.int64), bound - self.loosen[cluster]
            own = ((x.astype(np.int64) - self.centroids[cluster]) ** 2).sum(1)
            away = np.sqrt(own.astype(np.float64))
            unsure = np.flatnonzero(away + SLACK * (away + 1) >= np.maximum(bound, self.gaps[cluster]))
        if len(unsure):
            d = squared_distances(x[unsure], self.centroids)
            best = d.argmin(axis=1)   # the first, so the smaller number on ties
            row = np.arange(len(unsure))
            cluster[unsure], own[unsure] = best, d[row, best]
            d[row, best] = np.iinfo(np.int64).max
            bound[unsure] = np.sqrt(d.min(axis=1).astype(np.float64))
        return cluster, own, bound, len(unsure)


def _pack(batches, schema: pa.Schema, dims: int):
    """Blocks ``(block, ids, vectors)``; small components are stored in two bytes."""
    first, n = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        x = matrix(batch.column(1), dims)
        for a in range(0, batch.num_rows, BLOCK):
            part = x[a:a + BLOCK]
            small = np.abs(part).max(initial=0) < 1 << 15
            ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), batch.column(0).slice(a, BLOCK))
            yield pa.RecordBatch.from_arrays([pa.array([first + n], pa.int64()), ids.cast(schema.field("ids").type), pa.array([part.astype("<i2" if small else "<i4").tobytes()], pa.binary())], schema=schema)
            n += 1


def _unpack(packed: bytes, dims: int, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<i{len(packed) // (dims * n)}").reshape(n, dims)


def _added(x: np.ndarray, cluster: np.ndarray, sign: int, into: dict) -> None:
    for c in np.unique(cluster):
        part = x[cluster == c]
        n, total = into.get(int(c), (0, 0))
        into[int(c)] = (n + sign * len(part), total + sign * part.sum(axis=0, dtype=np.int64))


def _blocks(batch: pa.RecordBatch, dims: int, first: bool):
    """``(position, vectors, cluster, bound)`` of a batch's blocks."""
    for i in range(batch.num_rows):
        n = len(batch.column("ids")[i])
        x = _unpack(batch.column("vectors")[i].as_py(), dims, n)
        if first:
            yield i, x, None, None
        else:
            yield i, x, np.frombuffer(batch.column("cluster")[i].as_py(), CLUSTER), np.frombuffer(batch.column("bound")[i].as_py(), BOUND).copy()


def _pass(batches, move: Move, schema: pa.Schema, dims: int, first: bool):
    for batch in batches:
        out = []
        for i, x, before, bound in _blocks(batch, dims, first):
            cluster, own, bound, scanned = move.assign(x, before, bound)
            sums: dict = {}
            if before is None:
                _added(x, cluster, 1, sums)
            else:
                gone = cluster != before
                _added(x[gone], cluster[gone], 1, sums)
                _added(x[gone], before[gone], -1, sums)
            away = np.sqrt(own.astype(np.float64))
            out.append({
                "block": batch.column("block")[i].as_py(), "cluster": cluster.astype(CLUSTER).tobytes(), "bound": bound.astype(BOUND).tobytes(), "scanned": scanned,
                "sums": [{"cluster": c, "n": n, "total": total} for c, (n, total) in sums.items()],
                "reach": [{"cluster": int(c), "radius": float(away[cluster == c].max())} for c in np.unique(cluster)],
            })
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _last_pass(batches, move: Move, schema: pa.Schema, dims: int, first: bool):
    for batch in batches:
        for i, x, before, bound in _blocks(batch, dims, first):
            cluster, own, _, _ = move.assign(x, before, bound)
            ids = batch.column("ids").slice(i, 1).flatten()
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(own)], schema=schema)


def centroid_clustering(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64,
    clusters: int = 40, rounds: int = 5, salt: str = "2", tally: list | None = None,
) -> DataFrame:
    """Per kept vector: id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Kept are vectors of exactly ``dims`` components, none null or non-finite
    (nor so large that squared distances leave a long: ``_vectors.limit``).
    Components are ``floor(256 * x)``.  The ``clusters`` vectors of the smallest
    SHA-256 of ``salt:id`` start as centroids (all, if fewer; equal ids in order
    of their vectors, a null id last); ``rounds`` times the vectors are assigned
    and each centroid with vectors becomes the floor of their mean; then they
    are assigned once more.  Ties go to the smaller number; an empty cluster's
    centroid stays.  Repeated rows are vectors of their own.  A table without a
    kept vector gives an empty result.  Other columns are not read.

    ``clusters * dims`` values and one row per cluster pass through the driver
    each round.  ``tally``, if given, gets the number of vectors that each pass
    scanned against all centroids.
    """
    spark = vectors.sparkSession
    ids = vectors.schema[id_col].dataType
    kept = vectors.where(
        (F.coalesce(F.size(F.col(vector_col)), F.lit(-1)) == dims) & finite(F.col(vector_col), limit(dims))
    ).select(F.col(id_col).alias("id"), whole(F.col(vector_col)).alias("x"))
    start = kept.orderBy(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "x").limit(clusters).collect()
    centroids = np.array([r.x for r in start], np.int64).reshape(len(start), dims)

    path, run = fresh_dir(spark, "centroid_clustering"), uuid.uuid4().hex
    result = T.StructType([T.StructField(id_col, ids), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    packed = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(ids)), T.StructField("vectors", T.BinaryType())])
    buckets = _buckets(vectors)
    made: list[str] = []

    def bucketed(df: DataFrame, name: str) -> DataFrame:
        made.append(f"clustering_{run}_{name}")
        df.write.format("parquet").bucketBy(buckets, "block").sortBy("block").saveAsTable(made[-1])
        return spark.table(made[-1])

    try:
        if len(start):
            packed_arrow = to_arrow_schema(packed)
            table = bucketed(kept.mapInArrow(lambda it: _pack(it, packed_arrow, dims), packed), "vectors")
        else:
            table = spark.createDataFrame([], packed)
        state, move = None, Move(centroids)
        state_arrow, result_arrow = to_arrow_schema(STATE), to_arrow_schema(result)
        totals = np.zeros((len(start), dims + 1), np.int64)   # of the components, and the vectors' number
        for n in range(rounds if len(start) else 0):
            now, first = move, state is None
            joined = table if first else table.join(state.select("block", "cluster", "bound"), "block")
            state = bucketed(joined.mapInArrow(lambda it, m=now, f=first: _pass(it, m, state_arrow, dims, f), STATE), f"state_{n}")
            radius = np.zeros(len(start))
            for r in _summed(state):
                if r.place is None:
                    radius[r.cluster] = r.radius
                else:
                    totals[r.cluster, r.place] += r.value
            if tally is not None:
                tally.append(state.agg(F.sum("scanned")).first()[0])
            held = totals[:, dims] > 0
            moved = centroids.copy()
            moved[held] = totals[held, :dims] // totals[held, dims:]
            move, centroids = Move(moved, loosening(centroids, moved, radius)), moved
        now, first = move, state is None
        joined = table if first else table.join(state.select("block", "cluster", "bound"), "block")
        joined.mapInArrow(lambda it: _last_pass(it, now, result_arrow, dims, first), result).write.parquet(f"{path}/assigned")
    finally:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    assigned = spark.read.schema(result).parquet(f"{path}/assigned")
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    told = spark.createDataFrame(
        [(c, inertia.get(c, 0), sum(inertia.values()), ",".join(map(str, row))) for c, row in enumerate(centroids.tolist())],
        "cluster int, cluster_inertia long, inertia long, listed string",
    ).select("cluster", "cluster_inertia", "inertia", F.sha2("listed", 256).alias("centroid_sha256"))
    return assigned.join(F.broadcast(told), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _summed(state: DataFrame) -> list:
    """``(cluster, place, value, radius)``: added-up components, the vectors' number behind them, and at no place the largest radius."""
    sums = state.selectExpr("inline(sums)").selectExpr("cluster", "posexplode(array_append(total, n)) AS (place, value)", "CAST(NULL AS double) AS radius")
    reach = state.selectExpr("inline(reach)").selectExpr("cluster", "CAST(NULL AS int) AS place", "CAST(NULL AS long) AS value", "radius")
    return sums.unionAll(reach).groupBy("cluster", "place").agg(F.sum("value").alias("value"), F.max("radius").alias("radius")).collect()


def _buckets(df: DataFrame) -> int:
    """Buckets by the planner's estimate of the input; a frame without files has none, and gets the shuffle partitions."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    unknown = size >= 1 << 60
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return min(most, int(spark.conf.get("spark.sql.shuffle.partitions")) if unknown else max(spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES)))
