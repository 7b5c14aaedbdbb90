"""Whitening against numpy over the whole table."""

import math

import numpy as np
import pytest
from conftest import SMALL

from labelflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n long"


def table(spark, vectors):
    rows = [(i, None if v is None else [None if e is None else float(e) for e in v], 7, 7) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def expected(vectors, k):
    """Rows by id and component: n, deviation, whitened up to the sign, explained."""
    x = [[math.floor(1024 * float(np.float32(e))) + 100000 for e in v] for _, v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    d = [[n * a - b for a, b in zip(row, s)] for row in x]
    centred = np.array(d, dtype=float) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    y = centred @ axes / np.sqrt(values)
    return {(i, c + 1): (n, sum(e * e for e in d[r]), y[r, c], values[c] / np.trace(covariance))
            for r, (i, _) in enumerate(vectors) for c in range(k)}


def check(got, want, k):
    assert len(got) == len(want)
    signs = {}
    for r in got:
        n, deviation, y, share = want[(r.vec_id, r.component)]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(share, rel=1e-9)
        if abs(y) > 1e-3:
            signs.setdefault(r.component, math.copysign(1, y * r.whitened))
        assert signs.get(r.component, 1.0) * r.whitened == pytest.approx(y, abs=1e-7)
        assert r.identity_error < 1e-9
    assert len(signs) == k


def test_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 70)  # blocks of five rows, most partitions with a rest
    rng = np.random.default_rng(3)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(173, 13)) * np.arange(1, 14))]
    got = whitening.whiten(table(spark, vectors).repartition(7)).collect()
    check(got, expected(vectors, 8), 8)


def test_whole_small_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    check(whitening.whiten(df).collect(), expected(vectors, 8), 8)


def test_left_out_and_widths(spark):
    rng = np.random.default_rng(4)
    whole = [(i, v) for i, v in enumerate(rng.normal(size=(40, 3)))]
    other = [(100 + i, v) for i, v in enumerate(rng.normal(size=(20, 2)))]
    bad = [(200, None), (201, []), (202, [1, None, 2]), (203, [1, float("nan"), 2]), (204, [float("inf"), 0, 1]),
           (205, [1e30, 0, 0])]
    got = whitening.whiten(table(spark, whole + bad + other)).collect()
    check([r for r in got if r.vec_id < 100], expected(whole, 3), 3)
    check([r for r in got if r.vec_id >= 100], expected(other, 2), 2)


def test_no_variance_and_repeats(spark):
    same = whitening.whiten(table(spark, [(1, [1, 2]), (1, [1, 2]), (None, [1, 2])])).collect()
    assert len(same) == 6
    assert all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (3, 0, None, 0.0, None) for r in same)
    line = whitening.whiten(table(spark, [(1, [1, 5]), (2, [2, 5]), (2, [2, 5])])).collect()
    assert sorted(r.component for r in line if r.whitened is None) == [2, 2, 2]
    assert all(r.identity_error < 1e-9 for r in line)
    assert whitening.whiten(table(spark, [])).count() == 0


def test_large_entries_are_exact_or_null(spark):
    rows = [(1, [9e8, 0]), (2, [0, 1]), (3, [-9e8, 3])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows)).collect()}
    assert got[1] is None and got[3] is None
    assert got[2] is not None
