"""Centroid clustering with exact integer dot products that follow the changes of the centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import discard, stored

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Scaled components are below this in size, so that squared distances fit 64 bits.
LARGEST = 1 << 27
STATE = "vec_id long, v array<int>, norm long, dots array<long>, cluster int, distance long"


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v, norm): vectors with exactly `dimensions` components, none null or non-finite, as integers floor(256 * x).

    A vector with a component of 2**27 or more in size after scaling is left out like a non-finite one."""
    x = F.transform(F.col(vector_col), lambda e: F.col("scale") * e.cast("double"))
    whole = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector_col, F.lit(float(SCALE)).alias("scale")).select("vec_id", x.alias("x"))
    # A comparison with a null or with NaN is not true, so such vectors have fewer good components.
    good = F.size(F.filter("x", lambda e: (e >= -float(LARGEST)) & (e < float(LARGEST))))
    whole = whole.where((F.size("x") == dimensions) & (good == dimensions))
    whole = whole.select("vec_id", F.transform("x", lambda e: F.floor(e).cast("int")).alias("v"))
    return whole.withColumn("norm", F.aggregate("v", F.lit(0).cast("long"), lambda s, e: s + e.cast("long") * e.cast("long")))


def first_centroids(kept: DataFrame, dimensions: int, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least sha256 of `seed:vec_id`, in that order; of equal ones that with the least components first.

    A null id comes after all others. There are as many as vectors if those are fewer."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(order.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), dimensions)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel(), kind))


def moved(before: np.ndarray, after: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(centroid, components that change, by how much) of the centroids that change at all."""
    change = after - before
    return [(int(k), np.flatnonzero(change[k]), change[k][np.flatnonzero(change[k])]) for k in np.flatnonzero(change.any(axis=1))]


def follow(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """The state after the centroids moved: dot products changed by what changed, nearest centroids found anew.

    A row keeps its dot products with all centroids. A centroid that did not move costs nothing; one that moved costs a
    product for each of its components that changed. Sums of integers are exact, so there is no drift."""
    k, width = after.shape
    changes, squares = moved(before, after), (after * after).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, norm = _matrix(batch.column(1), width), batch.column(2).to_numpy()
            dots = _matrix(batch.column(3), k) if batch.num_columns > 3 else np.zeros((len(v), k), np.int64)
            for centroid, places, by in changes:
                dots[:, centroid] += v[:, places] @ by
            distances = norm[:, None] - 2 * dots + squares
            nearest = distances.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), _lists(dots, pa.int64()), pa.array(nearest.astype(np.int32)), pa.array(distances[np.arange(len(v)), nearest])],
                names=["vec_id", "v", "norm", "dots", "cluster", "distance"],
            )

    return state.select(*[c for c in ("vec_id", "v", "norm", "dots") if c in state.columns]).mapInArrow(run, STATE)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; an empty one stays. One row per cluster reaches the driver."""
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*[F.sum(F.get("v", F.lit(j))) for j in range(centroids.shape[1])]).alias("s"))
    out = centroids.copy()
    for row in sums.collect():
        out[row["cluster"]] = [s // row["n"] for s in row["s"]]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, v, norm, dots, cluster, distance) of the kept vectors, and the final centroids.

    Lloyd's rounds over integer vectors: each assigns all vectors to the nearest centroid (squared distance; of equal ones the
    one with the smaller number) and moves every centroid that has vectors to their mean. Vectors are assigned once more at the end.

    Distances are never computed from scratch after the start: a table in the shared folder holds, for each vector, its dot products
    with all centroids, and each round writes it anew with only the changes added (`follow`). At the start centroids move from zero.
    The driver sees `clusters` rows a round. Vectors with null ids and repeated ids or vectors are vectors like others;
    those of another length, with a null or non-finite component, or null altogether, are left out. No vectors, no rows."""
    kept = stored(scaled(vectors, id_col, vector_col, dimensions), "vectors")
    centroids = first_centroids(kept, dimensions, clusters)
    if not len(centroids):
        return kept.sparkSession.createDataFrame([], STATE), centroids
    state = stored(follow(kept, np.zeros_like(centroids), centroids), "dots")
    discard(kept)
    for _ in range(rounds):
        after = means(state, centroids)
        if (after == centroids).all():
            break  # nothing moves any more, so no later round would change anything
        last, state = state, stored(follow(state, centroids, after), "dots")
        discard(last)
        centroids = after
    return state, centroids


def clusters_of(vectors: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, of `cluster`."""
    state, centroids = cluster(vectors)
    per_cluster = state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    inertia = sum(r["d"] for r in per_cluster)
    digest = {r["cluster"]: hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest() for r in per_cluster}
    table = state.sparkSession.createDataFrame([(r["cluster"], r["d"], inertia, digest[r["cluster"]]) for r in per_cluster], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_in_sql() -> str:
    """Rounds of the same clustering from scratch: all distances by joins."""
    parts = []
    for n in range(ROUNDS + 1):
        parts.append(f"""
near{n} AS MATERIALIZED (
  SELECT row_no, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
    SELECT p.row_no, q.c, sum((p.x - q.x) * (p.x - q.x))::BIGINT AS d FROM parts p JOIN c{n} q ON p.j = q.j GROUP BY ALL) GROUP BY row_no)""")
        if n < ROUNDS:
            parts.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT q.c, q.j, CASE WHEN m.s IS NULL THEN q.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x FROM c{n} q LEFT JOIN (
    SELECT cluster, j, sum(x)::BIGINT AS s, count(*) AS n FROM near{n} JOIN parts USING (row_no) GROUP BY ALL) m ON m.cluster = q.c AND m.j = q.j)""")
    return ",".join(parts)


SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id, [floor({SCALE} * e::DOUBLE)::BIGINT for e in embedding] AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([e for e in embedding if isfinite(e)]) = {DIMENSIONS}),
parts AS MATERIALIZED (SELECT row_no, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept),
first AS (SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v)) - 1 AS c, row_no FROM kept),
c0 AS MATERIALIZED (SELECT c, j, x FROM first JOIN parts USING (row_no) WHERE c < {CLUSTERS}),
{_rounds_in_sql()},
digests AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS h FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM near{ROUNDS} JOIN kept USING (row_no) JOIN digests ON c = cluster"""
