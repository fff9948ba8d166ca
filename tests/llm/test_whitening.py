from __future__ import annotations

import math

import numpy as np

from archivesearch.llm.whitening import exact_deviations, from_keys, integer_keys, whiten

VECTORS = "vec_id bigint, embedding array<float>, label int"


def make(n, dim, seed, hot=0):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(n, dim)) * np.linspace(3, 0.3, dim)).astype(np.float32)
    v[:hot] = v[0]
    return [(i, [float(x) for x in row], 0) for i, row in enumerate(v)]


def check(rows, got, components):
    """Against whitening all rows as they are, without grouping, in numpy."""
    good = [(i, v) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * e) + 100000 for e in v] for _, v in good])
    n, total = len(x), x.sum(axis=0)
    off = x - total / n
    values, basis = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)[:components]
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert set(by) == set(range(1, len(order) + 1))
    for c, k in enumerate(order, 1):
        mine = sorted(by[c], key=lambda r: r.vec_id if "vec_id" in r else r.id)
        z = off @ basis[:, k] / math.sqrt(values[k])
        white = np.array([r.whitened for r in mine])
        sign = np.sign(white @ z)
        assert np.allclose(white * sign, z, atol=1e-6)
        assert all(r.n == n and abs(r.explained / (values[k] / values.sum()) - 1) < 1e-9 for r in mine)
        assert [r.deviation for r in mine] == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, total)) for v in x]
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-6


def test_equals_plain_whitening_with_a_hot_vector(spark, table):
    rows = make(900, 12, 1, hot=300)
    check(rows, whiten(table(rows, VECTORS, files=5)).collect(), 8)


def test_few_dimensions_and_repeated_rows(spark, table):
    rows = make(40, 3, 2)
    rows += rows[:7]
    frame = table(rows, VECTORS)
    got = whiten(frame).collect()
    assert len(got) == 47 * 3
    assert {r.component for r in got} == {1, 2, 3} and max(r.identity_error for r in got) < 1e-9


def test_invalid_vectors_are_left_out(spark, table):
    rows = make(50, 4, 3)
    bad = [(100, None, 0), (101, [1.0, None, 2.0, 3.0], 0), (102, [1.0, float("nan"), 2.0, 3.0], 0),
           (103, [float("inf"), 1.0, 2.0, 3.0], 0), (104, [-float("inf"), 1.0, 2.0, 3.0], 0), (105, [1.0, 2.0], 0), (106, [], 0)]
    got = whiten(table(rows + bad, VECTORS)).collect()
    check(rows, got, 4)


def test_degenerate_and_empty_tables(spark, table):
    assert whiten(table([], VECTORS)).count() == 0
    assert whiten(table([(1, None, 0)], VECTORS)).count() == 0
    same = whiten(table([(i, [1.0, 2.0], 0) for i in range(5)], VECTORS))
    assert same.count() == 0 and same.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = whiten(table([(i, [float(i), 1.0, 2.0 * i], 0) for i in range(20)], VECTORS)).collect()
    assert {r.component for r in flat} == {1} and len(flat) == 20


def test_weights_of_one_count_each_distinct_vector_once(spark, table):
    rows = make(60, 5, 4, hot=30)
    once = {tuple(v): (i, v, 0) for i, v, _ in reversed(rows)}
    counted = {(r.id, r.component): abs(r.whitened) for r in whiten(table(rows, VECTORS), weighted=False).collect()}
    alone = {(r.id, r.component): abs(r.whitened) for r in whiten(table(list(once.values()), VECTORS)).collect()}
    assert len(counted) == 60 * 5
    assert all(math.isclose(counted[k], z, abs_tol=1e-9) for k, z in alone.items())


def test_clashing_columns(spark, table):
    rows = [(i, v, 1, b"x", 2, 0.5, "d") for i, v, _ in make(30, 3, 5)]
    frame = table(rows, "vec_id bigint, embedding array<double>, id int, x binary, copies int, z double, digest string")
    got = whiten(frame).collect()
    assert len(got) == 90


def test_keys_and_deviations_of_wide_values_are_exact():
    v = np.array([[0.5, -0.25, 1e30], [0.5, -0.25, 3.0], [2.0**40, 0.0, 0.0]])
    import pyarrow as pa

    x = from_keys(pa.array(integer_keys(v), pa.binary()), 3)
    assert x[1].tolist() == [100512, 99744, 103072] and x[2, 0] == 2**50 + 100000
    assert x[0, 2] == 2**52 + 100000
    total = [int(t) for t in x.astype(object).sum(axis=0)]
    want = [sum((3 * int(a) - t) ** 2 for a, t in zip(row, total)) for row in x.tolist()]
    assert exact_deviations(x, 3, total) == [w if w < 2**63 else None for w in want]
