import random
from fractions import Fraction

import numpy as np
import pytest

from tickloom.llm import whitening as w
from tickloom.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


def leverrier(matrix):
    """The characteristic polynomial by traces, in fractions."""
    d = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    m, poly = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(d)) + (poly[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = [[sum(a[i][x] * m[x][j] for x in range(d)) for j in range(d)] for i in range(d)]
        poly.append(-sum(am[i][i] for i in range(d)) / k)
    return [int(v) for v in reversed(poly)]


def symmetric(rng, d, size):
    low = [[rng.randint(-size, size) if rng.random() < 0.7 else 0 for _ in range(i + 1)] for i in range(d)]
    return [[low[max(i, j)][min(i, j)] for j in range(d)] for i in range(d)]


@pytest.mark.parametrize(("d", "size"), [(1, 5), (2, 10**6), (5, 3), (7, 10**25), (9, 1), (4, 0)])
def test_polynomial_against_another_method(spark, d, size):
    matrix = symmetric(random.Random(d), d, size)
    assert w.characteristic_polynomial(spark, matrix) == leverrier(matrix)


def test_primes():
    found = w.primes_below(1 << 20, 9000)
    assert found == sorted(found, reverse=True) and found[0] == 1048573
    assert all(p % q for p in found[::50] for q in range(2, 1025))
    assert len(w.primes_below(1 << 31, 5)) == 5 and w.primes_below(1 << 31, 1) == [(1 << 31) - 1]


def test_roots_simple_multiple_and_zero():
    poly = [1]
    for root in (0, 0, 3, 7, 7, 7, 10**30):  # (t - root) for each
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    roots, s = w.largest_roots(poly, 7)
    assert [r >> s if r % (1 << s) == 0 else Fraction(r, 1 << s) for r in roots] == [10**30, 7, 7, 7, 3, 0, 0]
    # the golden ratio's square and its inverse, to 128 bits
    roots, s = w.largest_roots([1, -3, 1], 2)
    for r, sign in zip(roots, (1, -1)):
        near = Fraction(r, 1 << s)
        assert abs(near * near - 3 * near + 1) < Fraction(1, 1 << 120) and (near > 1) == (sign > 0)


def test_components_of_equal_roots_are_at_right_angles():
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(6, 6)))
    blocks = [[5 if i == j else 0 for j in range(6)] for i in range(6)]
    blocks[0][0] = blocks[1][1] = 9
    blocks[2][3] = blocks[3][2] = 4  # roots 9, 9, 9, 5, 5, 1
    got = w.component_vectors(blocks, [9, 9, 9, 5], 0)
    assert np.abs(got @ got.T - np.eye(4)).max() < 1e-12
    assert np.abs(got @ np.array(blocks) - np.array([[9], [9], [9], [5]]) * got).max() < 1e-12


def test_exact_products_of_any_size():
    rng = random.Random(2)
    for size in (3, 10**6, (1 << 63) - 1):
        x = [[rng.randint(-size - 1, size) for _ in range(3)] for _ in range(50)]
        sums, products = w.exact_products(np.array(x, np.int64))
        assert sums == [sum(r[k] for r in x) for k in range(3)]
        assert products == [sum(r[i] * r[j] for r in x) for i in range(3) for j in range(i + 1)]


def plainly(vectors, k=4):
    x = np.floor(256 * np.array(vectors, np.float64))
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    values, parts = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    values, parts = values[::-1][:k], parts[:, ::-1][:, :k]
    deviation = ((len(fit) * x - fit.sum(axis=0)) ** 2).sum(axis=1)
    return len(fit), deviation, (x - mean) @ parts / np.sqrt(values), values / np.var(fit, axis=0).sum()


def test_rows_against_numpy_with_nulls_repeats_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    sound = [[float(v) for v in rng.normal(size=5) * [9, 5, 3, 2, 1]] for _ in range(60)]
    rows = [(k, v, 0.0, "x") for k, v in enumerate(sound)]
    rows += [(100 + k, sound[0], 0.0, "x") for k in range(30)]  # a third of the rows, one vector
    rows += [(None, sound[1], 0.0, "x"), (7, sound[7], 0.0, "x"), (201, None, 0.0, "x"), (202, [], 0.0, "x"),
             (203, [1.0, None, 1.0, 1.0, 1.0], 0.0, "x"), (204, [float("nan")] * 5, 0.0, "x"), (205, [float("inf"), 0.0, 0.0, 0.0, 0.0], 0.0, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened double, x string").repartition(4)
    got = w.whitened(df).collect()
    n, deviation, want, explained = plainly([*sound, *[sound[0]] * 30, sound[1], sound[7]])
    assert n == 60 and len(got) == 92 * 4
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == 60 and r.identity_error < 1e-9 and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    signs = np.sign([by_id[0][c].whitened for c in range(1, 5)]) * np.sign(want[0])
    for k, v in enumerate(sound):
        r = by_id[k]
        assert r[1].deviation == deviation[k]
        assert np.abs(np.array([r[c].whitened for c in range(1, 5)]) - want[k] * signs).max() < 1e-9
    assert sum(r.vec_id is None for r in got) == 4 and sum(r.vec_id == 7 for r in got) == 8


def test_degenerate_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert w.whitened(spark.createDataFrame([], kind)).count() == 0
    one = w.whitened(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kind)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, None)] * 6
    line = w.whitened(spark.createDataFrame([(k, [float(k), float(2 * k)]) for k in range(3)], kind)).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)} and line[0].identity_error < 1e-12
    mixed = w.whitened(spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [1.0, 2.0, 3.0]), (4, [0.0, 2.0, 5.0])], kind)).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in mixed) == sorted(
        [(1, 1, 2), (2, 1, 2), *[(v, c, 2) for v in (3, 4) for c in (1, 2, 3)]])


def test_entries_beyond_a_long_are_held_and_deviations_beyond_one_are_null(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.5, 2.0])], "vec_id long, embedding array<double>")
    got = w.whitened(df).collect()
    assert {r.deviation for r in got} == {None} or all(r.deviation is None for r in got if r.vec_id < 3)
    assert all(abs(r.identity_error) < 1e-9 for r in got)


def test_query_against_numpy(spark):
    got = QUERIES["op13_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    rows = table(spark, SF, "embeddings").orderBy("vec_id").collect()
    n, deviation, want, explained = plainly([r.embedding for r in rows])
    assert len(got) == 4 * len(rows) and (got.n == n).all() and (got.identity_error < 1e-9).all()
    assert got.deviation.tolist() == np.repeat(deviation, 4).astype(np.int64).tolist()
    assert np.abs(np.abs(got.whitened.to_numpy().reshape(-1, 4)) - np.abs(want)).max() < 1e-9
    assert np.abs(got.explained.to_numpy()[:4] / explained - 1).max() < 1e-9
