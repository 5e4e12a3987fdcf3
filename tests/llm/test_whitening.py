"""op13 against exact integer arithmetic and a dense eigendecomposition."""

import math

import numpy as np
import pytest

from metamart.llm import queries, whitening
from tests.conftest import SF0001
from tests.llm.cases import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    """Covariance from exact integers, decomposed densely in double precision."""
    keep = [(r[0], [math.floor(256 * float(np.float32(c))) for c in r[1]]) for r in rows
            if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    d = max((len(x) for _, x in keep), default=0)
    keep = [(i, x + [0] * (d - len(x))) for i, x in keep]
    fit = sorted({tuple(x) for _, x in keep})
    n = len(fit)
    sums = [sum(x[j] for x in fit) for j in range(d)]
    scaled = np.array([[n * v - s for v, s in zip(x, sums, strict=True)] for x in fit], dtype=object).reshape(n, d)
    v = (scaled.T.dot(scaled)).astype(float) / float(n) ** 3 if n else np.zeros((0, 0))
    e, w = np.linalg.eigh(v)
    rank = np.linalg.matrix_rank(scaled.astype(float)) if n else 0
    return keep, n, sums, e[::-1], w[:, ::-1], np.trace(v), rank


def check(rows, result, tol=1e-9):
    keep, n, sums, e, w, trace, rank = expected(rows)
    k = min(4, len(sums))
    got = {}
    for r in result:
        got.setdefault(r.component, []).append(r)
    assert len(result) == len(keep) * k and set(got) == set(range(1, k + 1) if keep else ())
    order = {i: x for i, x in keep}
    for c, part in got.items():
        assert {r.n for r in part} == {n}
        for r in part:
            x = order[r.vec_id]
            assert r.deviation == sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))
        if c > rank:
            assert all(r.whitened is None for r in part)
            continue
        assert all(r.identity_error <= 1e-9 for r in part)
        if e[c - 1] <= 1e-10 * trace:        # beyond the dense decomposition of the covariance
            continue
        mine = np.array([r.whitened for r in part])
        want = np.array([(np.array(order[r.vec_id]) - np.array(sums) / n) @ w[:, c - 1] for r in part]) / math.sqrt(e[c - 1])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) <= tol * max(1, np.abs(want).max())
        assert all(abs(r.explained - e[c - 1] / trace) <= 1e-9 for r in part)


def run(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return df, whitening.whitened(df).collect()


def test_query_equals_dense(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    check(rows, queries.op13_whitening(spark, SF0001).collect())


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=6)], 0) for i in range(60)]
    rows += [(100, None, 0), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (102, [float("nan")] * 6, 0), (103, [float("inf")] * 6, 1),
             (104, [-0.0] * 6, 1), (105, [1.0, 2.0], 1), (106, [], 1), (107, rows[0][1], 2)]
    df, result = run(spark, rows)
    check(rows, result)
    assert sorted(map(tuple, whitening.whitened(with_clashes(df)).collect())) == sorted(map(tuple, result))


def test_repeated_rows_count_once_in_the_fit(spark):
    rng = np.random.default_rng(4)
    base = [[float(v) for v in rng.normal(size=5)] for _ in range(20)]
    _, once = run(spark, [(i, v, 0) for i, v in enumerate(base)])
    _, often = run(spark, [(i % 20, base[i % 20], 0) for i in range(20)] + [(3, base[3], 0)] * 500)
    assert {r.n for r in often} == {20} and len(often) == 4 * 520
    a = {(r.vec_id, r.component): abs(r.whitened) for r in once}
    assert all(abs(abs(r.whitened) - a[r.vec_id, r.component]) < 1e-9 for r in often)


@pytest.mark.parametrize("kind", ["collinear", "wide", "one", "constant", "few"])
def test_hard_tables(spark, kind):
    rng = np.random.default_rng(6)
    if kind == "collinear":          # columns that all but repeat each other
        base = rng.normal(size=(300, 3)) * [1000, 1, 0.02]
        rows = base @ rng.normal(size=(3, 8))
    elif kind == "wide":             # columns of very different scale
        rows = rng.normal(size=(300, 6)) * [1e4, 1e2, 1, 0.1, 0.05, 0.02]
    elif kind == "one":
        rows = np.ones((3, 5))
    elif kind == "constant":
        rows = np.column_stack([rng.normal(size=50), np.full(50, 7.0), rng.normal(size=50), np.zeros(50)])
    else:                            # fewer distinct vectors than components
        rows = np.repeat(rng.normal(size=(3, 7)), 4, axis=0)
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(rows)]
    check(rows, run(spark, rows)[1], tol=1e-6)


def test_no_rows(spark):
    assert run(spark, [])[1] == [] and run(spark, [(1, None, 0)])[1] == []
    assert run(spark, [(1, [], 0)])[1] == []


def test_huge_entries_do_not_overflow(spark):
    rows = [(i, [s * 1e30, float(i), 1.0, 2.0], 0) for i, s in enumerate((1.0, -1.0, 1.0, 0.0))]
    result = run(spark, rows)[1]
    assert len(result) == 16 and any(r.deviation is None for r in result)
