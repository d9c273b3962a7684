"""Clustering against plain rounds that compare every vector with every centroid, and its SQL on the given table."""

import hashlib

import duckdb
import numpy as np
import pytest
from helpers import SF, collected

from snapvault.llm import clusters

DIM = 64


def plain(rows, k=8, rounds=10, seed=3, dim=DIM, scale=1024):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dim and all(c is not None and np.isfinite(c) for c in vector):
            kept.append((key, [int(np.floor(float(c) * scale)) for c in vector]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for i in range(len(centres)):
            mine = [x for (_, x), o in zip(kept, own) if o == i]
            if mine:
                centres[i] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(x) for _, x in kept]
    inertia = sum(d for d, _ in last)
    out = []
    for (key, _), (d, i) in zip(kept, last):
        digest = hashlib.sha256(",".join(map(str, centres[i])).encode()).hexdigest()
        out.append((key, i, d, sum(e for e, j in last if j == i), inertia, digest))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert collected(clusters.query(spark, SF)) == sorted(con.execute(clusters.SQL).fetchall(), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_rounds(spark, seed):
    """Coarse numbers, so that equal distances and repeated vectors are frequent."""
    draw = np.random.default_rng(seed)
    x = draw.integers(-2, 3, size=(150, DIM)) * (draw.random((150, DIM)) < 0.05) / 1024.0
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]
    assert collected(clusters.cluster(frame(spark, rows))) == plain(rows)


def awkward():
    draw = np.random.default_rng(9)
    some = [[float(np.float32(c)) for c in v] for v in draw.normal(size=(30, DIM))]
    rows = [(i, v) for i, v in enumerate(some)]
    rows += [(3, some[3]), (3, some[4]), (None, some[5]), (None, some[0]), (50, None), (51, []), (52, some[0][:63]), (53, [*some[0], 1.0])]
    rows += [(54, [*some[0][:63], None]), (55, [float("nan"), *some[0][:63]]), (56, [float("-inf"), *some[0][:63]]), (57, [-0.0] * DIM)]
    return rows + [(58, [1e-40] * DIM), (59, [-1e-40] * DIM), (60, [1000.0] * DIM)]


def test_awkward_rows(spark):
    assert collected(clusters.cluster(frame(spark, awkward()))) == plain(awkward())


@pytest.mark.parametrize("n", [0, 1, 5, 8])
def test_few_vectors(spark, n):
    rows = awkward()[:n]
    assert collected(clusters.cluster(frame(spark, rows))) == plain(rows)


def test_only_rows_that_are_not_kept(spark):
    assert clusters.cluster(frame(spark, [(1, None), (2, [1.0])])).collect() == []


def test_equal_vectors_leave_empty_clusters(spark):
    rows = [(i, [0.5] * DIM) for i in range(20)]
    found = collected(clusters.cluster(frame(spark, rows)))
    assert found == plain(rows) and {r[1] for r in found} == {0}


def test_other_columns_and_their_names_do_not_matter(spark):
    rows = awkward()[:20]
    wide = frame(spark, rows).selectExpr("vec_id", "embedding", "1 AS key", "2 AS x", "3 AS cluster", "4 AS distance", "5 AS to_pivots")
    assert collected(clusters.cluster(wide)) == plain(rows)


def test_name_of_a_result_and_numbers_too_large(spark):
    with pytest.raises(ValueError):
        clusters.cluster(frame(spark, []).withColumnRenamed("vec_id", "cluster"), key="cluster")
    with pytest.raises(Exception, match="do not fit"):
        clusters.cluster(frame(spark, [(1, [1e9] * DIM)])).collect()


def test_pivots_spare_comparisons_and_never_the_nearest():
    draw = np.random.default_rng(4)
    middle = draw.integers(-3000, 3000, size=(8, 16))
    x = (middle[draw.integers(0, 8, 4000)] + draw.integers(-100, 100, size=(4000, 16))).astype(np.int64)
    pivots = clusters.choose_pivots(x[:500], 12)
    assert len({tuple(p) for p in pivots}) == 12
    away = np.sqrt(np.stack([clusters.squared(x, p) for p in pivots], axis=1))
    nearest = clusters.Nearest(middle.astype(np.int64), pivots)
    number, distance = nearest.find(x, away)
    every = np.stack([clusters.squared(x, c) for c in middle], axis=1)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert nearest.compared < 0.3 * every.size
    assert (nearest.bounds(away) <= np.sqrt(every)).all()
