"""Embedding whitening against numpy, over awkward vectors."""

import math

import numpy as np
import pytest

from snaplytics.llm import whitening
from snaplytics.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<float>, x int, white int, vec_ID2 int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)


def brute(rows, k):
    keep = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in keep], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    values, vectors = np.linalg.eigh((fit - s / n).T @ (fit - s / n) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return [i for i, _ in keep], n, ((n * x - s) ** 2).sum(1), (x - s / n) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def vectors(n, width, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, width)) * np.linspace(1, 3, width)).tolist()


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_whitened_rows_equal_numpy(spark, monkeypatch, block_rows):
    monkeypatch.setattr(whitening.block_matrix, "__defaults__", (block_rows,))
    rows = list(enumerate(vectors(120, 5)))
    rows += [(200 + i, rows[0][1]) for i in range(300)]  # one vector holds most rows
    rows += [(None, rows[1][1]), (7, rows[7][1]), (900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]),
             (903, [float("nan")] * 5), (904, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    ids, n, deviation, white, explained = brute(rows, 5)
    got = whiten(table(spark, rows)).collect()
    assert len(got) == 5 * len(ids)
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    want = sorted((-1 if i is None else i, c + 1, int(deviation[j]), abs(white[j, c]), explained[c])
                  for j, i in enumerate(ids) for c in range(5))
    have = sorted((-1 if r.vec_id is None else r.vec_id, r.component, r.deviation, abs(r.whitened), r.explained) for r in got)
    assert [w[:3] for w in want] == [h[:3] for h in have]
    assert np.allclose([w[3:] for w in want], [h[3:] for h in have], atol=1e-9)
    for c in range(1, 6):  # one sign for all rows
        mine = {r.vec_id: r.whitened for r in got if r.component == c}
        products = [mine[i] * white[j, c - 1] for j, i in enumerate(ids) if abs(white[j, c - 1]) > 1e-6]
        assert min(products) > 0 or max(products) < 0


def test_other_lengths_go_and_no_variance_is_zero(spark):
    got = whiten(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [1.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got) == [
        (i, c, 1, 0, 0.0, 0.0, 0.0) for i in (1, 2) for c in (1, 2)]


def test_deviation_beyond_a_long_is_null(spark):
    got = whiten(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.5])])).collect()
    assert {r.vec_id: r.deviation is None for r in got} == {1: True, 2: True, 3: False}
    assert all(math.isfinite(r.whitened) for r in got)


def test_empty_table(spark):
    empty = whiten(table(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
