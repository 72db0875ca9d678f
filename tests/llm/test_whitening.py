"""Whitening against plain numpy and exact arithmetic, and on awkward rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tallybrook.llm import queries
from tallybrook.llm import whitening as wh
from tallybrook.llm.common import table

SCHEMA = "vec_id bigint, embedding array<float>, component int, n string, whitened double"


def expected(vectors, most=8):
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(row[j] for row in x) for j in range(d)]
    far = [[n * row[j] - sums[j] for j in range(d)] for row in x]
    matrix = np.array(
        [[float(Fraction(sum(r[i] * r[j] for r in far), n**3)) for j in range(d)] for i in range(d)]
    )
    values, q = np.linalg.eigh(matrix)
    order = np.argsort(-values)[:most]
    return n, [sum(v * v for v in row) for row in far], matrix, values[order], q[:, order], np.array(far) / n


def by_component(rows):
    found = {}
    for r in rows:
        found.setdefault(r.component, {})[r.vec_id] = r
    return found


def compare(rows, ids, vectors):
    n, deviation, matrix, values, q, centred = expected(vectors)
    found = by_component(rows)
    assert sorted(found) == list(range(1, min(8, len(matrix)) + 1))
    for k, (value, vector) in enumerate(zip(values, q.T), 1):
        got = found[k]
        assert set(got) == set(ids)
        want = centred @ vector / math.sqrt(value)
        mine = np.array([got[i].whitened for i in ids])
        sign = np.sign(mine @ want)
        assert np.abs(mine * sign - want).max() < 1e-8
        for i, dev in zip(ids, deviation):
            assert (got[i].n, got[i].deviation) == (n, dev)
            assert got[i].explained == pytest.approx(value / np.trace(matrix), rel=1e-9)
            assert got[i].identity_error < 1e-9


def test_query_equals_numpy(spark, sf_dir):
    source = table(spark, sf_dir, "embeddings").collect()
    rows = queries.op12_whiten_slices(spark, sf_dir).collect()
    assert len(rows) == 8 * len(source)
    assert len({r.identity_error for r in rows}) == 1
    compare(rows, [r.vec_id for r in source], [r.embedding for r in source])


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [[float(np.float32(c)) for c in rng.normal(0, s, 3)] for s in (0.1, 1, 10, 100) for _ in range(6)]
    good += [good[0], good[0]]
    rows = [(i, v) for i, v in enumerate(good)]
    bad = [None, [], [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [3e38] * 3]
    rows += [(100 + i, v) for i, v in enumerate(bad)]
    frame = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA).repartition(4)
    got = wh.whiten(frame).collect()
    compare(got, list(range(len(good))), good)
    # repeated and null ids are vectors like any other
    odd = spark.createDataFrame([(i % 2 or None, v, 1, "x", 0.5) for i, v in rows], SCHEMA)
    assert wh.whiten(odd).count() == 3 * len(good)


def test_no_variance(spark):
    def rows(vectors):
        return wh.whiten(spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in enumerate(vectors)], SCHEMA)).count()

    assert rows([[1.0, 2.0]]) == 0
    assert rows([[1.0, 2.0]] * 5) == 0
    assert rows([[1.0, 2.0], [2.0, 2.0]]) == 2  # one direction only
    empty = spark.createDataFrame([], SCHEMA)
    assert wh.whiten(empty).count() == 0 and wh.whiten(empty).columns[0] == "vec_id"


def test_exact_products_of_any_size():
    rng = np.random.default_rng(1)
    for bound in (10, 1 << 20, 1 << 34):
        y = rng.integers(-bound, bound, (5000, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert wh._exact_products(y).tolist() == want


def test_counts_and_components():
    rng = np.random.default_rng(5)
    for case in range(40):
        d = int(rng.integers(1, 40))
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        values = np.sort(rng.exponential(1, d) ** 3)[::-1]
        if case % 4 == 1:
            values[: d // 2] = values[0]  # equal ones
        if case % 4 == 2:
            values[d // 3 :] = 0  # of lower rank
        if case % 4 == 3:
            values = 1 + 1e-7 * np.arange(d, 0, -1)  # close ones
        matrix = q * values @ q.T
        matrix = (matrix + matrix.T) / 2
        for shift in np.concatenate([rng.uniform(-0.5, values[0] + 1, 5), (values[:-1] + values[1:]) / 2]):
            if np.abs(values - shift).min() > 1e-9:
                assert wh.count_above(matrix, shift) == (values > shift).sum()
        found, vectors = wh.leading_components(matrix)
        want = [v for v in values[:8] if v > wh.FLAT * values.sum()]
        assert np.allclose(found, want, rtol=1e-9, atol=1e-12 * values.sum())
        assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-9)
        assert np.abs(vectors @ matrix - found[:, None] * vectors).max(initial=0) <= 1e-11 * values.sum()


def test_indefinite_pivots():
    """Zero diagonals need blocks of two."""
    for matrix in ([[0, 1], [1, 0]], [[0, 1, 2], [1, 0, 3], [2, 3, 0]], [[0] * 3] * 3):
        matrix = np.array(matrix, float)
        for shift in (-4.5, -0.3, 0.0, 0.5, 3.0):
            if np.abs(np.linalg.eigvalsh(matrix) - shift).min() > 1e-9:
                assert wh.count_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()
