"""k-means on integer vectors with bounds that are loosened by planar geometry.

A vector keeps its centroid without a scan while the distance to it is below a lower bound of the
distances to all others. When centroid j moves from p to q, the distance to it shrinks by at most
the drift |p - q|; but the vectors of a cluster lie in a sphere around their own centroid, and for a
vector x the shrinkage |x - p| - |x - q| is at most |p - q| times the cosine of the angle at the
middle of p and q between the movement and x, because |x - p| + |x - q| is at least twice the
distance of x from that middle. In the plane of p, q and the sphere's centre, the smallest such
angle of any point of the sphere is that of the centre less the half-angle under which the sphere is
seen from the middle. So a lower bound is loosened by the drift times the cosine of that angle, which
is nothing for centroids that move away. Vectors that the bounds leave open are scanned exactly.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from locrank import storage

#: Components beyond this are set to it, so that squared distances fit into 64 bits.
MOST = 2**27
#: Products of smaller components add up exactly in floating point.
_EXACT = 2**22
#: For rounding: bounds count only where they differ by more than this share.
_SLACK = 1e-9

_STATE = "vec_id {id}, x array<int>, cluster int, distance long, lower double"


def integer_vectors(frame, dims=64, scale=256):
    """vec_id, x of the rows of frame(vec_id, embedding) with dims finite components: floor(scale * component)."""
    usable = (F.size("embedding") == dims) & F.forall(
        "embedding", lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf"))
    )

    def whole(e):
        return F.floor(F.greatest(F.least(e.cast("double") * scale, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int")

    return frame.where(F.coalesce(usable, F.lit(False))).select("vec_id", F.transform("embedding", whole).alias("x"))


def squared_distances(x, centroids):
    """Exact squared distances of integer vectors from centroids, one row per vector."""
    largest = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if largest <= _EXACT:
        x, centroids = x.astype(np.float64), centroids.astype(np.float64)
    cross = x @ centroids.T
    return ((x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1) - 2 * cross).astype(np.int64)


def loosening(centres, radii, old, new):
    """For each sphere i, the most that the distance of a point in it to any other centroid can have shrunk.

    Sphere i holds the vectors of cluster i, whose own centroid is left out.
    """
    moves = (new - old).astype(float)
    drift = np.linalg.norm(moves, axis=1)
    away = centres.astype(float)[:, None, :] - (old + new)[None, :, :] / 2
    distance = np.linalg.norm(away, axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.einsum("ijd,jd->ij", away, moves) / (distance * drift)
        angle = np.arccos(np.clip(cosine, -1, 1)) - np.arcsin(np.clip(radii[:, None] / distance, 0, 1))
    inside = distance <= radii[:, None] * (1 + _SLACK)
    most = np.where(inside, 1.0, np.cos(np.clip(angle, 0, np.pi / 2)))
    loosened = np.where(drift > 0, drift * most, 0.0)
    np.fill_diagonal(loosened, 0.0)
    return loosened.max(axis=1, initial=0.0) * (1 + _SLACK)


def half_gaps(centroids):
    """Half the distance of each centroid from the nearest other one."""
    gaps = np.sqrt(squared_distances(centroids, centroids).astype(float))
    np.fill_diagonal(gaps, np.inf)
    return gaps.min(axis=1, initial=np.inf) / 2


def assigned(x, centroids, cluster=None, lower=None):
    """cluster, squared distance, lower bound for the other centroids and whether it was scanned, per vector.

    cluster and lower are what held before, lower already loosened; without them all are scanned.
    """
    n = len(x)
    if cluster is None:
        scan, cluster = np.ones(n, bool), np.zeros(n, np.int32)
        distance, lower = np.zeros(n, np.int64), np.zeros(n)
    else:
        cluster = cluster.copy()
        apart = x - centroids[cluster]
        distance = np.einsum("ij,ij->i", apart, apart)
        lower = np.maximum(lower, 0.0)
        safe = np.maximum(lower, half_gaps(centroids)[cluster]) * (1 - _SLACK)
        scan = ~(np.sqrt(distance.astype(float)) * (1 + _SLACK) < safe)
    if scan.any():
        to_all = squared_distances(x[scan], centroids)
        nearest = to_all.argmin(axis=1)
        rows = np.arange(len(nearest))
        cluster[scan], distance[scan] = nearest, to_all[rows, nearest]
        to_all[rows, nearest] = np.iinfo(np.int64).max
        lower[scan] = np.sqrt(to_all.min(axis=1).astype(float)) * (1 - _SLACK)
    return cluster, distance, lower, scan


def _assign(centroids, loosened, dims):
    def scan(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, dims).astype(np.int64)
            if loosened is None:
                cluster, distance, lower, _ = assigned(x, centroids)
            else:
                before = batch.column("cluster").to_numpy()
                lower = batch.column("lower").to_numpy() - loosened[before]
                cluster, distance, lower, _ = assigned(x, centroids, before, lower)
            columns = [batch.column("vec_id"), batch.column("x"), pa.array(cluster, pa.int32())]
            columns += [pa.array(distance, pa.int64()), pa.array(lower, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "x", "cluster", "distance", "lower"])

    return scan


def first_centroids(vectors, k, seed):
    """The vectors of the k smallest SHA-256 of `seed:vec_id`, in that order; ties by id and vector."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(hashed.asc_nulls_last(), F.col("vec_id").asc_nulls_last(), "x").limit(k)
    return [row.x for row in first.select("x").collect()]


def clustered(frame, k=40, rounds=5, dims=64, scale=256, seed=2):
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid for every usable row of frame(vec_id, embedding).

    Usable are rows with dims components, none null or non-finite. Their components become
    floor(scale * component). In each round all vectors go to the nearest centroid, the one of the
    smaller number among equals, and centroids with vectors move to the floor of their mean; after
    the last round all are assigned once more. centroid has the components of the final centroid.

    * Other rows give no row; null ids and repeated rows count like any other, also as first centroids.
    * With fewer than k usable rows there are as many centroids; none give no row.
    * Components beyond 2^27 after scaling count as 2^27. Sums of distances beyond 64 bits are null.
    * Other columns are ignored.

    A round reads and writes the vectors with their bounds once and adds them up per cluster in the
    map tasks; k x dims numbers pass through the driver. A table is removed once the next is written.
    """
    spark = frame.sparkSession
    kind = dict(frame.dtypes)["vec_id"]
    at = storage.scratch_dir(spark, "vectors")
    state = storage.keep(integer_vectors(frame, dims, scale), "vectors", at)
    centroids = np.array(first_centroids(state, k, seed), np.int64).reshape(-1, dims)
    loosened = None
    for turn in range(rounds + 1):
        done = storage.scratch_dir(spark, "clusters")
        state = state.mapInArrow(_assign(centroids, loosened, dims), _STATE.format(id=kind))
        state = storage.keep(state, "clusters", done)
        storage.delete(spark, at)
        at = done
        sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(dims)] if turn < rounds else []
        totals = state.groupBy("cluster").agg(
            F.count("*").alias("n"), F.max("distance").alias("far"), F.try_sum("distance").alias("inertia"), *sums
        )
        totals = totals.collect()
        if turn < rounds:
            old, radii = centroids, np.zeros(len(centroids))
            centroids = old.copy()
            for row in totals:
                centroids[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
                radii[row.cluster] = np.sqrt(float(row.far)) * (1 + _SLACK)
            loosened = loosening(old, radii, old, centroids)
    whole = sum(row.inertia or 0 for row in totals)
    whole = whole if all(row.inertia is not None for row in totals) and whole < 2**63 else None
    ends = [(row.cluster, row.inertia, whole, centroids[row.cluster].tolist()) for row in totals]
    ends = spark.createDataFrame(ends, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(ends), "cluster")


def digest(components):
    """Lower-case hex SHA-256 of integers joined by commas."""
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()


def op12_centroids(spark, sf_dir):
    """Cluster of each vector after five rounds, with the sums of distances and a digest of the centroid."""
    found = clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    hashed = F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")).cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", hashed.alias("centroid_sha256"))


def _rounds_sql(rounds=5):
    """Common table expressions a0, c1, a1, ... of assignments and centroids."""
    parts = []
    for turn in range(rounds + 1):
        parts.append(f"""a{turn} AS MATERIALIZED (
  SELECT n, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
    SELECT n, j, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v, c{turn}) GROUP BY n)""")
        if turn < rounds:
            parts.append(f"""c{turn + 1} AS MATERIALIZED (
  SELECT j, coalesce(m, c) AS c FROM c{turn} LEFT JOIN (
    SELECT j, list(((s - ((s % q) + q) % q) // q)::BIGINT ORDER BY i) AS m FROM (
      SELECT j, i, sum(e)::BIGINT AS s, count(*) AS q
      FROM (SELECT n, j, unnest(x) AS e, unnest(range(64)) AS i FROM v JOIN a{turn} USING (n)) GROUP BY j, i)
    GROUP BY j) USING (j))""")
    return ",\n".join(parts)


OP12_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), vec_id, x) - 1 AS j, x AS c FROM v
  QUALIFY j < 40),
{_rounds_sql()}
SELECT vec_id, j::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a5 USING (n) JOIN c5 USING (j)
"""
