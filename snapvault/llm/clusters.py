"""Centroid clustering on integers, with a table of distances to fixed pivots.

Every vector's distance to a few pivots, themselves vectors of the data far from each other, is computed once and stored
with it. In each round the centroids' distances to the same pivots are known on the driver; how much the two differ at
any pivot bounds the distance between vector and centroid from below. The centroid with the smallest bound gets an exact integer
distance first, and of the others only those whose bound does not exceed it. So the result is that of comparing with
all centroids, ties included, whatever the pivots are; they decide only how much is left to compare.

A round is one job over the stored table without an exchange of vectors: a task gives sums and counts of each cluster.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import hashed_sample, read
from snapvault.session import settled

LIMIT = 1 << 27  # of a component: 64 squared differences of such numbers fit in a long
PIVOTS = 12
PIVOT_SAMPLE = 2000  # vectors among which the pivots are sought
OUTPUT = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def finite(vector: Column) -> Column:
    """Not null, and neither null, NaN nor infinite anywhere."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))


def integer_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 1024) -> DataFrame:
    """``key`` and ``x``, the components times ``scale`` rounded down, of vectors with exactly ``dim`` finite components."""
    v = F.col(f"`{vector}`")
    kept = vectors.where((F.size(v) == dim) & finite(v))
    return kept.select(F.col(f"`{key}`").alias("key"), F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls as rows of ``width`` numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def squared(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one centre, or each to its own."""
    away = x - centre
    return np.einsum("ij,ij->i", away, away)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows, each the one with the largest sum of distances to those before."""
    chosen, total = [], np.zeros(len(sample))
    at = 0
    while len(sample) and len(chosen) < n:
        chosen.append(sample[at])
        total += np.sqrt(squared(sample, sample[at]))
        total[(sample == sample[at]).all(axis=1)] = -np.inf
        at = int(total.argmax())
        if total[at] == -np.inf:
            break
    return np.array(chosen, dtype=np.int64)


class Nearest:
    """The nearest centroid of integer vectors whose distances to the pivots are known."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.centroids = centroids
        self._to_pivots = np.sqrt([squared(centroids, p) for p in pivots]).reshape(len(pivots), len(centroids))
        self.compared = 0  # exact distances so far

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances to all centroids. Taken down by more than roots and differences can be off."""
        low = np.zeros((len(to_pivots), len(self.centroids)))
        for mine, own in zip(to_pivots.T, self._to_pivots, strict=True):
            slack = 1e-12 * (mine[:, None] + own)
            np.maximum(low, np.abs(mine[:, None] - own) - slack, out=low)
        return low

    def find(self, x: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (of equals the smallest) and its exact squared distance."""
        low = self.bounds(to_pivots)
        low *= low
        low *= 1 - 1e-12
        first = low.argmin(axis=1)
        number, best = first.copy(), squared(x, self.centroids[first])
        self.compared += len(x)
        for k, centre in enumerate(self.centroids):
            left = np.flatnonzero((low[:, k] <= best) & (first != k))
            found = squared(x[left], centre)
            closer = (found < best[left]) | ((found == best[left]) & (k < number[left]))
            number[left[closer]], best[left[closer]] = k, found[closer]
            self.compared += len(left)
        return number, best


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` (``key``, ``x``) with ``to_pivots``."""
    width, kind = pivots.shape[1], rows.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(1), width)
            if len(x) and max(x.max(), -x.min()) > LIMIT:
                raise ValueError(f"a component is beyond {LIMIT}: squared distances do not fit in a long")
            away = np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(away.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["key", "x", "to_pivots"])

    return rows.mapInArrow(run, f"key {kind}, x array<bigint>, to_pivots array<double>")


def assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``key``, ``cluster`` and ``distance`` of every vector."""
    width, kind = centroids.shape[1], table.schema["key"].dataType.simpleString()

    def run(batches):
        nearest = Nearest(centroids, pivots)
        for batch in batches:
            number, distance = nearest.find(matrix(batch.column(1), width), matrix(batch.column(2), len(pivots)))
            arrays = [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "cluster", "distance"])

    return table.select("key", "x", "to_pivots").mapInArrow(run, f"key {kind}, cluster int, distance bigint")


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: the exact mean of their vectors, each component rounded down."""
    many, width = centroids.shape

    def run(batches):
        nearest, n, sums = Nearest(centroids, pivots), np.zeros(many, np.int64), np.zeros((many, width), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), width)
            number, _ = nearest.find(x, matrix(batch.column(1), len(pivots)))
            for k in np.unique(number):
                mine = x[number == k]
                n[k] += len(mine)
                sums[k] += mine.sum(axis=0)
        own = np.flatnonzero(n)
        arrays = [pa.array(own.astype(np.int32)), pa.array(n[own]), pa.array(sums[own].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "n", "sums"])

    parts = table.select("x", "to_pivots").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    parts = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    total = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    new = centroids.copy()
    for r in total.collect():  # one row a component of a centroid
        new[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return new


def cluster(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 1024,
    clusters: int = 8, rounds: int = 10, seed: int = 3, pivots: int = PIVOTS,
) -> DataFrame:
    """Key, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every kept vector.

    Kept are vectors with exactly ``dim`` components, none null, NaN or infinite; others give no row. Centroids start as the kept
    vectors with the smallest SHA-256 of ``<seed>:<key>``; null keys come last, and of repeated keys the smaller vector first. With
    fewer vectors than ``clusters`` there are fewer centroids. Repeated rows count as often as they stand. Ties go to the smaller
    number; an empty cluster keeps its centroid. An empty table gives no rows. Other columns are not looked at, whatever
    their names; a key named like a column of the result raises. So does a component beyond 2^27 after scaling, since distances
    would not fit in a long. The pivots come from at most 2,000 vectors; they have no influence on the result.
    """
    if key in OUTPUT:
        raise ValueError(f"the key has the name of a column of the result: {key}")
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, key=key, vector=vector, dim=dim, scale=scale)
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    start = rows.orderBy(code.asc_nulls_last(), "x").select("x").limit(clusters).collect()
    centroids = np.array([r["x"] for r in start], dtype=np.int64).reshape(-1, dim)
    sample = hashed_sample(rows.select("x"), F.xxhash64("x"), PIVOT_SAMPLE).collect() if start else []
    chosen = choose_pivots(np.array([r["x"] for r in sample], dtype=np.int64).reshape(-1, dim), pivots)
    if len(chosen):
        table = settled(pivot_table(rows, chosen), "pivot-table")
        for _ in range(rounds):
            new = moved(table, centroids, chosen)
            if (new == centroids).all():
                break  # so will all rounds to come
            centroids = new
        found = settled(assigned(table, centroids, chosen), "clusters")
    else:
        found = rows.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).limit(0)
    each = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole = sum(int(r["total"]) for r in each)
    facts = [
        (r["cluster"], int(r["total"]), whole, hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
        for r in each
    ]
    told = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    joined = found.join(F.broadcast(told), "cluster")  # at most a row a centroid
    return joined.select(F.col("key").alias(key), *OUTPUT)


def query(spark, sf_dir):
    return cluster(read(spark, sf_dir, "embeddings"))


def _sql(rounds: int = 10) -> str:
    parts = [
        """kept AS MATERIALIZED (
SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: isfinite(c))) = 64)""",
        """c0 AS MATERIALIZED (
SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS INTEGER) AS k, x AS c
FROM (SELECT x, sha256('3:' || vec_id) AS h FROM kept ORDER BY h NULLS LAST, x LIMIT 8))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
SELECT r, min(struct_pack(d := d, k := k)) AS best FROM (
  SELECT r, k, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept CROSS JOIN c{i})
GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
SELECT k, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN (
  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c FROM (
    SELECT best.k AS k, pos, sum(x[pos]) AS s, count(*) AS n
    FROM a{i} JOIN kept USING (r) CROSS JOIN (SELECT unnest(range(1, 65)) AS pos) GROUP BY 1, 2)
  GROUP BY k) m USING (k))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.best.k AS cluster, CAST(a.best.d AS BIGINT) AS distance,
       CAST(sum(a.best.d) OVER (PARTITION BY a.best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} z ON z.k = a.best.k"""


SQL = _sql()
