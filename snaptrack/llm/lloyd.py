"""Centroid clustering: exact integer Lloyd rounds, sharded by dimension.

A vector becomes integers and is cut into blocks of `COLUMNS` columns. A row of the stored table is
one shard of a chunk of vectors: a matrix of as many rows as the chunk has vectors. In each round a
shard's tasks, which hold that shard's slice of the centroids only, give the partial squared
distances of their chunks; the blocks of a chunk are then added by key, and the nearest centroid is
taken (the smaller number of equals). Every shard adds up the vectors of each cluster in its own
columns, task by task, and from these sums its slice of the centroids is updated.

Integers make all sums exact, whatever the order of tasks. Clusters may be as uneven as they like:
work is dealt by chunk, and a cluster's sums are one row per task and column. A round shuffles
8 * clusters bytes per vector and shard, and the blocks once for the update; every round ends in a
written table, where lineage ends. Through the driver go the centroids (clusters x dimensions
numbers, at most `MOST_CENTROID_CELLS`) and one row per cluster.

Defined results: vectors that are null, of another length, or that hold null or non-finite
components are left out; integers beyond +-2^30 / sqrt(dimensions) count as that bound, so that no
distance leaves 64 bits; a null id hashes as the empty string; rows that repeat an id are vectors of
their own (of equal hashes the smaller vector starts first); fewer vectors than centroids start as
many clusters as there are vectors; a sum of distances that 64 bits cannot hold is null; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.common import col, scratch, written

DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Columns of a shard; vectors of a chunk at most, and distances of a chunk at most.
COLUMNS, CHUNK, DISTANCES = 16, 2048, 1 << 19
MOST_CENTROID_CELLS = 1 << 24


def integers(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """(id, v): the vectors that are kept, as floors of `scale` times their components."""
    most = isqrt((1 << 60) // dimensions)
    v = col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(float(most))), F.lit(float(-most)))).cast("long"))
    return vectors.filter((F.size(v) == dimensions) & finite).select(col(id_col).alias("id"), whole.alias("v"))


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in kept.orderBy(digest, "v").limit(clusters).collect()], np.int64)


def blocks(kept: DataFrame, columns: int, chunk: int) -> DataFrame:
    """(shard, chunk, ids, block): the columns of a shard for a chunk of vectors, as little-endian
    32-bit integers; ids in the first shard only. Each shard has files of its own."""
    id_type = kept.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for b in batches:
            for low in range(0, b.num_rows, chunk):
                ids, v = b.column(0).slice(low, chunk), b.column(1).slice(low, chunk)
                matrix = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1).astype("<i4")
                parts = [np.ascontiguousarray(matrix[:, at : at + columns]).tobytes() for at in range(0, matrix.shape[1], columns)]
                for shard, block in enumerate(parts):
                    own = pa.array([ids.to_pylist() if not shard else None], pa.list_(ids.type))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard], pa.int32()), pa.array([number]), own, pa.array([block], pa.binary())], ["shard", "chunk", "ids", "block"]
                    )
                number += 1

    made = kept.mapInArrow(rows, f"shard int, chunk long, ids array<{id_type}>, block binary")
    path = scratch(kept.sparkSession, "column-blocks")
    made.write.partitionBy("shard").parquet(path)
    return kept.sparkSession.read.schema(made.schema).parquet(path)


def partial_distances(table: DataFrame, shard: int, part: np.ndarray) -> DataFrame:
    """(chunk, part): squared distances in one shard's columns to its slice of the centroids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (part * part).sum(1)
        for b in batches:
            for chunk, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(block, "<i4").reshape(-1, part.shape[1]).astype(np.int64)
                found = (x * x).sum(1)[:, None] - 2 * (x @ part.T) + squares
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([found.astype("<i8").tobytes()], pa.binary())], ["chunk", "part"])

    own = table.filter(F.col("shard") == shard).select("chunk", "block")
    return own.mapInArrow(rows, "chunk long, part binary")


def assigned(table: DataFrame, centroids: np.ndarray, columns: int) -> DataFrame:
    """(chunk, clusters, distances): the nearest centroid of each of a chunk's vectors."""
    shards = [centroids[:, at : at + columns] for at in range(0, centroids.shape[1], columns)]
    parts = reduce(DataFrame.unionAll, [partial_distances(table, k, part) for k, part in enumerate(shards)])
    n = len(centroids)

    def nearest(group: pa.Table) -> pa.Table:
        # One row a shard.
        total = sum(np.frombuffer(p, "<i8") for p in group.column("part").to_pylist()).reshape(-1, n)
        cluster = total.argmin(1)
        least = total[np.arange(len(total)), cluster]
        return pa.table({
            "chunk": group.column("chunk").slice(0, 1),
            "clusters": pa.array([cluster.astype("<i4").tobytes()], pa.binary()),
            "distances": pa.array([least.astype("<i8").tobytes()], pa.binary()),
        })

    return written(parts.groupBy("chunk").applyInArrow(nearest, "chunk long, clusters binary, distances binary"), "assigned")


def updated(table: DataFrame, nearest: DataFrame, centroids: np.ndarray, columns: int) -> np.ndarray:
    """Centroids after a round: floors of the means of their vectors; empty ones stay."""
    n = len(centroids)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for b in batches:
            for shard, block, clusters in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                own = np.frombuffer(clusters, "<i4")
                x = np.frombuffer(block, "<i4").reshape(len(own), -1).astype(np.int64)
                total = sums.setdefault(shard, np.zeros((n, x.shape[1]), np.int64))
                np.add.at(total, own, x)
                counts[shard] = counts.get(shard, 0) + np.bincount(own, minlength=n)
        for shard, total in sums.items():
            cluster, column = (a.ravel() for a in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (np.full(total.size, shard), cluster, column, total.ravel(), counts[shard][cluster])],
                ["shard", "cluster", "column", "total", "n"],
            )

    joined = table.select("chunk", "shard", "block").join(nearest.select("chunk", "clusters"), "chunk").select("shard", "block", "clusters")
    sums = joined.mapInArrow(rows, "shard long, cluster long, column long, total long, n long").groupBy("shard", "cluster", "column").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    found = centroids.copy()
    for r in sums.collect():
        if r["n"]:
            found[r["cluster"], r["shard"] * columns + r["column"]] = r["total"] // r["n"]
    return found


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE,
    clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, columns: int = COLUMNS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector that is kept, and the final centroids."""
    if clusters * dimensions > MOST_CENTROID_CELLS:
        raise ValueError("clusters x dimensions is too large")
    kept = integers(vectors, id_col, vector_col, dimensions, scale)
    id_type = kept.schema["id"].dataType.simpleString()
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"id {id_type}, cluster int, distance long"), centroids
    table = blocks(kept, columns, max(1, min(CHUNK, DISTANCES // clusters)))
    for _ in range(rounds):
        centroids = updated(table, assigned(table, centroids, columns), centroids, columns)
    final = assigned(table, centroids, columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(k, 1).flatten(), pa.array(np.frombuffer(b.column(1)[k].as_py(), "<i4")),
                        pa.array(np.frombuffer(b.column(2)[k].as_py(), "<i8")),
                    ],
                    ["id", "cluster", "distance"],
                )

    named = table.filter("shard = 0").select("chunk", "ids").join(final, "chunk")
    return named.select("ids", "clusters", "distances").mapInArrow(rows, f"id {id_type}, cluster int, distance long"), centroids


def op13(vectors: DataFrame) -> DataFrame:
    spark = vectors.sparkSession
    found, centroids = cluster(vectors.select("vec_id", "embedding"))
    found = written(found, "clustered")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One row a cluster.
    sums = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    inertia = _long(sum(sums.values()))
    per_cluster = spark.createDataFrame(
        [(k, _long(sums.get(k, 0)), inertia, d) for k, d in enumerate(digests)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(n: int) -> int | None:
    return n if n < 1 << 63 else None


def _round_sql(k: int) -> str:
    """Assignments a{k} to the centroids c{k}, and the centroids c{k + 1} after them."""
    return f"""
    a{k} AS MATERIALIZED (
      SELECT rid, arg_min(num, [distance, num]) AS cluster, min(distance) AS distance FROM (
        SELECT rid, num, list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS distance FROM kept, c{k})
      GROUP BY rid),
    c{k + 1} AS MATERIALIZED (
      SELECT num, coalesce(moved, c) AS c FROM c{k} LEFT JOIN (
        SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY j) AS moved FROM (
          SELECT cluster, j, sum(v[j])::BIGINT AS total, count(*) AS n
          FROM a{k} JOIN kept USING (rid), (SELECT unnest(range(1, {DIMENSIONS} + 1)) AS j) GROUP BY cluster, j)
        GROUP BY cluster) ON num = cluster)"""


ORACLE = f"""
  WITH kept AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
    c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY digest, v) - 1 AS num, v AS c
      FROM (SELECT *, sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS digest FROM kept) ORDER BY digest, v LIMIT {CLUSTERS}),
    {",".join(_round_sql(k) for k in range(ROUNDS + 1)).strip()}
  SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
  FROM a{ROUNDS} JOIN kept USING (rid) JOIN c{ROUNDS} ON num = cluster"""
