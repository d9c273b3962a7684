"""Whitening directions of vectors from the singular values of the centred rows, never from a covariance matrix.

Components become integers, so their sums, and with them every row's deviation from the mean, are exact. Each task reduces its
centred rows block by block to one triangular factor; factors are combined in a tree of fixed fan-in until one is left. That
factor, as small as the vectors are long, is made bidiagonal by Householder reflections on the driver. Quotient-difference
sweeps with shifts (dqds) find the squared singular values to high relative accuracy: one over the sum of the inverse
pivots of a sweep never exceeds the smallest value that is left, so such a shift is always safe. The right singular vectors come from
twisted factorisations, one solve a value, and are made orthogonal where values lie close.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.clusters import finite, matrix
from snapvault.llm.common import read
from snapvault.session import settled

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
FAN_IN = 64  # triangular factors that one task combines
LIMIT = 1 << 62
CLOSE = 1e-3  # relative distance below which singular vectors are made orthogonal to each other
NOTHING = 1e-12  # of the largest singular value: what is smaller has no direction
EPS = float(np.finfo(float).eps)
TINY = 1e-290
OUTPUT = ("component", "n", "deviation", "whitened", "explained", "identity_error")


# --- dense work on one small matrix ------------------------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vector v and value a, such that x - 2 v (v.x) is a in its first place and 0 elsewhere."""
    norm = float(np.linalg.norm(x))
    v = x.copy()
    if norm == 0:
        return v, 0.0
    a = -norm if x[0] > 0 else norm
    v[0] -= a
    length = float(np.linalg.norm(v))
    return (v / length, a) if length else (v, a)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, the one above, and the orthogonal V of r = U B V^T."""
    b, n = r.copy(), r.shape[1]
    right = np.eye(n)
    for k in range(n):
        v, _ = _reflector(b[k:, k])
        b[k:, k:] -= 2 * np.outer(v, v @ b[k:, k:])
        if k + 2 < n:
            v, _ = _reflector(b[k, k + 1 :])
            b[k:, k + 1 :] -= 2 * np.outer(b[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(b).copy(), np.diag(b, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform of B^T B to that minus ``shift``; None if the shift was too large. The last list holds the pivots."""
    d = q[0] - shift
    new_q, new_e, pivots = [], [], [d]
    for i, x in enumerate(e):
        if d < 0:
            return None
        total = d + x
        if total < TINY:
            total = TINY
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(x * ratio)
        d = d * ratio - shift
        pivots.append(d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, pivots


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> list[float]:
    """Of one bidiagonal block, in falling order."""
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above]
    found, sigma, lost = [], 0.0, 0.0  # sigma + lost: what all shifts so far took away, in twice the precision
    shift = safe = 0.0
    while len(q) > 1:
        if e[-1] <= (EPS * EPS) * (sigma + q[-1]) or e[-1] < TINY:
            found.append(sigma + (q.pop() + lost))
            e.pop()
            shift = 0.0
            continue
        swept = _sweep(q, e, shift)
        if swept is None:
            shift = safe * (1 - 1e-3) if shift > safe else 0.0
            continue
        q, e, pivots = swept
        before, sigma = sigma, sigma + shift
        lost += shift - (sigma - before)
        least = min(pivots)
        safe = 1 / sum(1 / p for p in pivots) if least > TINY else 0.0
        # Where one value is far below the rest, the safe bound is as good as that value; else a bolder one is tried first.
        shift = safe if safe > 0.9 * least else max(safe, 0.7 * least)
        if shift < EPS * EPS * sigma:
            shift = 0.0
    found.append(sigma + (q[0] + lost))
    return sorted((max(x, 0.0) for x in found), reverse=True)


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray]:
    """Twist quality by place, and the unit vector for each place, as columns: candidates for the right singular vector."""
    m = len(diagonal)
    q, e, product = diagonal**2, above**2, diagonal[:-1] * above
    down, up = np.empty(m), np.empty(m)
    lower, upper = np.empty(max(m - 1, 0)), np.empty(max(m - 1, 0))
    down[0], up[-1] = -value, q[-1] - value
    least = max(value, TINY) * EPS * EPS

    def pivot(x):
        return x if abs(x) > least else least

    for i in range(m - 1):
        p = pivot(q[i] + down[i])
        lower[i] = product[i] / p
        down[i + 1] = e[i] * (down[i] / p) - value
    for i in range(m - 2, -1, -1):
        p = pivot(e[i] + up[i + 1])
        upper[i] = product[i] / p
        up[i] = q[i] * (up[i + 1] / p) - value
    return np.abs(down + up + value), np.stack([lower, upper])


def _vector(place: int, factors: np.ndarray) -> np.ndarray:
    lower, upper = factors
    z = np.zeros(len(lower) + 1)
    z[place] = 1.0
    for i in range(place - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(place, len(upper)):
        z[i + 1] = -upper[i] * z[i]
        if abs(z[i + 1]) > 1e100:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: list[float]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    close: list[np.ndarray] = []
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            close = []
        quality, factors = twisted(diagonal, above, value)
        best, rest = None, -1.0
        for place in np.argsort(quality):
            z = _vector(int(place), factors)
            for _ in range(2):
                for other in close:
                    z = z - (other @ z) * other
            norm = float(np.linalg.norm(z))
            if norm > rest:
                best, rest = z / norm if norm else z, norm
            if rest > 0.1:
                break  # else it lies among the vectors before, as those of equal values can: another twist
        for other in close:
            best = best - (other @ best) * other
        best = best / np.linalg.norm(best)
        close.append(best)
        out.append(best)
    return out


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a square ``r`` in falling order and, as columns, the right singular vectors with a direction.

    Values below 1e-12 of the largest are rounding: they are 0 and have no column. A vector's largest entry is positive.
    """
    n, scale = r.shape[1], float(np.abs(r).max(initial=0.0))
    if not scale:
        return np.zeros(n), np.zeros((n, 0))
    diagonal, above, right = bidiagonal(r / scale)
    cut = EPS * float(np.hypot(diagonal, np.append(above, 0)).max()) / 64
    borders = [0, *(np.flatnonzero(np.abs(above) <= cut) + 1).tolist(), n]
    blocks = [(a, b, squared_singular_values(diagonal[a:b], above[a : b - 1])) for a, b in zip(borders, borders[1:])]
    largest = max(values[0] for _, _, values in blocks)
    found = []
    for a, b, values in blocks:
        told = [v for v in values if v > NOTHING**2 * largest]
        for value, z in zip(told, _block_vectors(diagonal[a:b], above[a : b - 1], told), strict=True):
            v = right[:, a:b] @ z
            found.append((value, v * np.sign(v[np.abs(v).argmax()])))
    found.sort(key=lambda f: -f[0])
    singular = np.zeros(n)
    singular[: len(found)] = [scale * np.sqrt(value) for value, _ in found]
    return singular, np.stack([v for _, v in found], axis=1)


# --- over all rows -------------------------------------------------------------------------------------


def _triangle(rows: np.ndarray, width: int) -> np.ndarray:
    """The triangular factor, with rows of zeros where there are fewer rows than columns."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def _factors(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """``number`` of the task and its triangular factor ``r``."""
    width, total = len(sums), np.array(sums, dtype=np.int64)

    def run(batches):
        from pyspark import TaskContext

        r = np.zeros((0, width))
        for batch in batches:
            x = matrix(batch.column(0), width)
            for at in range(0, len(x), 4096):
                centred = (n * x[at : at + 4096] - total) / n
                r = _triangle(np.vstack([r, centred]), width)
        if len(r):
            arrays = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["number", "r"])

    return rows.select("x").mapInArrow(run, "number bigint, r array<double>")


def triangular(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangular factor of all centred rows of ``x``: factors of tasks, combined ``FAN_IN`` at a time."""
    width = len(sums)

    def combine(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("number")
        number = ordered.column("number")[0].as_py() // FAN_IN
        r = _triangle(np.concatenate([matrix(c, width) for c in ordered.column("r").chunks]), width)
        return pa.table({"number": pa.array([number], pa.int64()), "r": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})

    factors = settled(_factors(rows, n, sums), "factors")
    tasks = factors.agg(F.max("number") + 1).first()[0]
    while tasks > 1:
        group = F.floor(F.col("number") / FAN_IN).alias("group")
        factors = settled(factors.groupBy(group).applyInArrow(combine, "number bigint, r array<double>"), "factors")
        tasks = -(-tasks // FAN_IN)
    return np.array(factors.first()["r"]).reshape(width, width)


def _summed(rows: DataFrame, column: str, work, width: int, kind: str) -> list:
    """Sum over tasks of what ``work`` makes of each batch's rows of ``column``: ``width`` numbers, added in the task first."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["part"])

    element = "bigint" if kind.startswith("decimal") else kind
    parts = rows.select(column).mapInArrow(run, f"part array<{element}>").select(F.posexplode("part").alias("at", "part"))
    sums = {r["at"]: r["total"] for r in parts.groupBy("at").agg(F.sum(F.col("part").cast(kind)).alias("total")).collect()}
    return [sums[i] for i in range(width)]


def whiten(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """A row for each remaining vector and component: key, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``.

    Vectors that are null, or hold a null, NaN or infinite component, are out. The others must agree on a length; where they do not,
    those of the most frequent length stay (of equally frequent ones the longest). Repeated rows count as often as they stand, null
    and repeated keys are kept as they are. Components of a vector are ``floor(scale * c) + shift``. ``deviation`` is exact; where
    it, or a sum, does not fit in a long, the job fails. Equal eigenvalues have any orthogonal directions of their space. A
    component without variance (fewer vectors than dimensions, constant columns) has no direction: ``whitened`` is null there, and
    ``identity_error`` speaks of the others (null, if there are none). An empty table gives no rows. Other columns are not
    looked at, whatever their names; a key named like a column of the result raises.
    """
    if key in OUTPUT:
        raise ValueError(f"the key has the name of a column of the result: {key}")
    kind = vectors.schema[key].dataType.simpleString()
    v = F.col(f"`{vector}`")
    whole = vectors.where(finite(v) & (F.size(v) > 0)).select(F.col(f"`{key}`").alias("key"), v.alias("v"))
    sizes = whole.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    names = [F.col("key").alias(key), *OUTPUT]
    if sizes is None:
        empty = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], f"key {kind}, {empty}").select(*names)
    width, n = sizes["size"], sizes["count"]
    components = min(components, width)
    scaled = F.transform("v", lambda c: F.floor(c.cast("double") * scale) + shift).alias("x")
    rows = settled(whole.where(F.size("v") == width).select("key", scaled), "whitening-rows")
    largest = rows.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0]
    if n * largest > LIMIT:
        raise ValueError(f"{n} vectors with components up to {largest} are beyond what a long holds")

    sums = [int(s) for s in _summed(rows, "x", lambda c: matrix(c, width).sum(axis=0), width, "decimal(38,0)")]
    singular, found = directions(triangular(rows, n, sums))
    values = singular**2 / n
    trace = float(values.sum())
    told = min(components, found.shape[1])
    turn = found[:, :told] / np.sqrt(values[:told])
    total = np.array(sums, dtype=np.int64)

    def project(batches):
        for batch in batches:
            away = n * matrix(batch.column(1), width) - total
            if int(np.abs(away).max(initial=0)) ** 2 * width < LIMIT:
                deviation = pa.array((away * away).sum(axis=1))
            else:
                deviation = pa.array([sum(a * a for a in row) for row in away.tolist()], pa.int64())
            white = np.full((len(away), components), np.nan)
            white[:, :told] = (away / n) @ turn
            lists = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel(), from_pandas=True), components).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], names=["key", "deviation", "w"])

    white = settled(rows.mapInArrow(project, f"key {kind}, deviation bigint, w array<double>"), "whitened")
    error = identity_error(white, components, told, n)
    explained = F.array(*[F.lit(float(values[k] / trace) if trace else None).cast("double") for k in range(components)])
    flat = white.select("key", "deviation", F.posexplode("w").alias("at", "whitened"))
    return flat.select(
        "key", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    ).select(*names)


def identity_error(white: DataFrame, components: int, told: int, n: int) -> float | None:
    """Largest absolute entry of the covariance of the first ``told`` numbers of ``w``, over all rows, minus the identity."""
    if not told:
        return None

    def numbers(column):
        return matrix(column, components)[:, :told]

    mean = np.array(_summed(white, "w", lambda c: numbers(c).sum(axis=0), told, "double")) / n

    def products(column):
        away = numbers(column) - mean
        return (away.T @ away).ravel()

    second = np.array(_summed(white, "w", products, told * told, "double")).reshape(told, told) / n
    return float(np.abs(second - np.eye(told)).max())


def query(spark, sf_dir):
    return whiten(read(spark, sf_dir, "embeddings"))
