"""Whitening against a dense eigenvalue solver and exact sums; the small-matrix steps on awkward matrices."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import SF

from snapvault.llm import whitening


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def check(found, rows, components=32):
    """``rows``: those that remain, with different keys."""
    x = np.floor(np.array([[float(np.float32(c)) for c in v] for _, v in rows]) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    centred = away / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    told = int((values > 1e-20 * max(values[0], 1e-300)).sum()) if values[0] > 1e-12 else 0
    by_key = {key: i for i, (key, _) in enumerate(rows)}
    components = min(components, x.shape[1])
    assert len(found) == n * components and {r["n"] for r in found} == {n}
    white = np.full((n, components), np.nan)
    for r in found:
        i, k = by_key[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == int((away[i] ** 2).sum())
        if r["whitened"] is not None:
            white[i, k] = r["whitened"]
        if values.sum() > 1e-12:
            assert abs(r["explained"] - values[k] / values.sum()) <= 1e-10
    rank = int(np.linalg.matrix_rank(centred)) if n > 1 else 0
    told = min(components, rank)
    assert np.isnan(white[:, told:]).all() and not np.isnan(white[:, :told]).any()
    if told:
        w = white[:, :told]
        assert np.abs(w.T @ w / n - np.eye(told)).max() < 1e-9
        assert {r["identity_error"] for r in found} != {None} and found[0]["identity_error"] < 1e-9
        # Each whitened component is the projection on an eigenvector: turning the data back gives its variance.
        back = w.T @ centred / n
        assert np.abs(np.linalg.norm(back, axis=1) ** 2 - values[:told]).max() < 1e-8 * values[0]
        apart = [k for k in range(told) if min(abs(values[k] - v) for j, v in enumerate(values) if j != k) > 1e-6 * values[0]] if len(values) > 1 else [0]
        plain = centred @ vectors[:, :told] / np.sqrt(values[:told])
        for k in apart:
            sign = np.sign(w[:, k] @ plain[:, k])
            assert np.abs(w[:, k] - sign * plain[:, k]).max() < 1e-7
    else:
        assert {r["identity_error"] for r in found} == {None}


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    check(whitening.query(spark, SF).collect(), rows)


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_few_vectors_and_narrow_ones(spark, n):
    draw = np.random.default_rng(n)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.normal(size=(n, 10)))]
    check(whitening.whiten(frame(spark, rows).repartition(3)).collect(), rows)


def test_constant_repeated_and_zero_columns(spark):
    draw = np.random.default_rng(2)
    x = draw.integers(-3, 4, size=(60, 12)).astype(float)
    x[:, 4] = 2.5
    x[:, 7] = x[:, 1]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_equal_rows_have_no_directions(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(5)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert len(found) == 15 and {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found} == {(0, None, None, None)}


def test_rows_that_are_out_nulls_and_repeats(spark):
    draw = np.random.default_rng(6)
    good = [[float(np.float32(c)) for c in v] for v in draw.normal(size=(20, 4))]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 2.0, 3.0]), (104, [float("inf"), 0.0, 0.0, 0.0])]
    bad += [(105, [1.0, 2.0, 3.0])]  # of another length than most
    rows = [(i, v) for i, v in enumerate(good)]
    check(whitening.whiten(frame(spark, rows + bad)).collect(), rows)
    odd = [(None, good[0]), (None, good[1]), (7, good[2]), (7, good[2])] + rows[3:]
    found = whitening.whiten(frame(spark, odd)).collect()
    assert len(found) == 4 * len(odd) and sum(r["vec_id"] is None for r in found) == 8


def test_no_rows_and_names(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).columns == ["vec_id", *whitening.OUTPUT]
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, []).withColumnRenamed("vec_id", "n"), key="n")
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(6)]
    wide = frame(spark, rows).selectExpr("vec_id", "embedding", "1 AS key", "2 AS n", "3 AS component", "4 AS x", "5 AS w")
    check(whitening.whiten(wide).collect(), rows)


def test_factors_are_combined_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    draw = np.random.default_rng(8)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.normal(size=(50, 6)))]
    check(whitening.whiten(frame(spark, rows).repartition(7)).collect(), rows)


def test_deviations_beyond_64_bits_fail(spark):
    rows = [(i, [float(2**40 * (i % 2)), 0.0]) for i in range(4)]
    with pytest.raises(Exception):
        whitening.whiten(frame(spark, rows)).collect()


MATRICES = {
    "random": np.random.default_rng(1).normal(size=(300, 64)),
    "wide": np.random.default_rng(1).normal(size=(20, 64)),
    "identity": np.eye(30),
    "reversed": np.eye(30)[::-1] * 3,
    "orthogonal": np.linalg.qr(np.random.default_rng(2).normal(size=(40, 40)))[0],
    "graded": np.random.default_rng(3).normal(size=(100, 20)) * np.logspace(0, -9, 20),
    "graded up": np.random.default_rng(3).normal(size=(100, 20)) * np.logspace(-9, 0, 20),
    "bidiagonal": np.eye(21) + np.eye(21, k=1),
    "close pairs": np.diag(np.abs(np.arange(21) - 10.0) + 1e-3) + np.eye(21, k=1),
    "rank one": np.outer(np.arange(10.0), np.ones(8)),
    "one": np.ones((10, 1)),
    "zero": np.zeros((4, 5)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_directions(name):
    a = MATRICES[name]
    width = a.shape[1]
    singular, v = whitening.directions(whitening._triangle(a, width))
    want = np.zeros(width)
    own = np.linalg.svd(a, compute_uv=False)
    want[: len(own)] = own[:width]
    told = v.shape[1]
    assert told == int((want > 1e-12 * max(want[0], 1e-300)).sum()) if want[0] else told == 0
    assert np.abs(singular - want).max() <= 1e-13 * max(want[0], 1)
    assert np.abs(v.T @ v - np.eye(told)).max(initial=0) < 1e-11
    assert np.abs(a.T @ (a @ v) - v * singular[:told] ** 2).max(initial=0) <= 1e-12 * max(want[0], 1) ** 2


@pytest.mark.parametrize("seed", range(30))
def test_directions_of_small_whole_numbers(seed):
    draw = np.random.default_rng(seed)
    a = draw.integers(-2, 3, size=(int(draw.integers(1, 30)), int(draw.integers(1, 20)))).astype(float)
    singular, v = whitening.directions(whitening._triangle(a, a.shape[1]))
    assert v.shape[1] == np.linalg.matrix_rank(a)
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max(initial=0) < 1e-11
    assert np.abs(a.T @ (a @ v) - v * singular[: v.shape[1]] ** 2).max(initial=0) < 1e-10 * (1 + singular[0]) ** 2
