"""Embedding whitening against plain numpy and exact integers."""

from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm import whitening
from ledgerlens.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, n string, component string, key string"


def brute(rows, weights="one"):
    """Rows (vec_id, component, n, deviation, whitened up to sign, explained) by the definition."""
    kept = []
    for r in rows:
        if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1]):
            kept.append((r[0], tuple(int(np.floor(np.float64(np.float32(c)) * 256)) for c in r[1])))
    distinct = sorted({x for _, x in kept})
    copies = [sum(x == y for _, y in kept) if weights == "copies" else 1 for x in distinct]
    n = sum(copies)
    d = len(distinct[0])
    sums = [sum(w * x[i] for w, x in zip(copies, distinct)) for i in range(d)]
    y = np.array([[float(Fraction(n * x[i] - sums[i], n)) for i in range(d)] for x in distinct])
    v = (y * np.array(copies)[:, None]).T @ y / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:4]
    out = []
    for vec_id, x in kept:
        t = [n * c - s for c, s in zip(x, sums)]
        for k, j in enumerate(order):
            z = float(np.array([float(Fraction(a, n)) for a in t]) @ vectors[:, j]) / np.sqrt(values[j])
            out.append((vec_id, k + 1, n, sum(a * a for a in t), z, values[j] / v.trace()))
    return out


def as_rows(df):
    return [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in df.collect()]


def same(got, want):
    """Equal up to one sign per component."""
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], round(abs(r[4]), 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for c in {r[1] for r in want}:
        g = np.array([r[4:] for r in got if r[1] == c])
        w = np.array([r[4:] for r in want if r[1] == c])
        sign = np.sign(g[np.abs(w[:, 0]).argmax(), 0] * w[np.abs(w[:, 0]).argmax(), 0])
        assert np.allclose(g[:, 0], sign * w[:, 0], rtol=1e-8, atol=1e-8) and np.allclose(g[:, 1], w[:, 1], rtol=1e-9)


def vectors(seed, n=120, d=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) * np.array([3, 2, 1.5, 1, 0.7, 0.4])[:d] + 5
    return [(i, [float(c) for c in v]) for i, v in enumerate(base.astype(np.float32))]


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_whitening_equals_the_definition(spark, weights):
    rows = vectors(1)
    rows += [(1000 + i, rows[3][1]) for i in range(80)] + [(None, rows[5][1]), (7, rows[7][1]), (7, rows[8][1])]
    rows += [(1, None), (2, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3, [float("nan")] * 6), (4, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    out = whitening.whiten(df, weights=weights)
    same(as_rows(out), brute(rows, weights))
    errors = {r.identity_error for r in out.collect()}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_registered_query_equals_the_definition(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    out = QUERIES["op13_embedding_whitening"](spark, path)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same(as_rows(out), brute(rows))
    assert out.agg({"identity_error": "max"}).first()[0] < 1e-6


def test_one_vector_no_variance_empty_and_other_lengths(spark):
    make = lambda rows: spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None), (2, [])])).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # nothing to scale
    flat = [(i, [float(i), 1.0, 2.0]) for i in range(5)]  # one dimension varies: one component
    got = whitening.whiten(make(flat)).collect()
    assert {(r.vec_id, r.component) for r in got} == {(i, 1) for i in range(5)} and got[0].explained == pytest.approx(1)
    short, long = vectors(2, 40, 2), [(i + 500, v) for i, v in vectors(3, 40, 5)]
    out = as_rows(whitening.whiten(make(short + long)))
    same([r for r in out if r[0] < 500], [r for r in brute(short) if r[1] <= 2])
    same([r for r in out if r[0] >= 500], brute(long))


def test_huge_entries_stay_exact_or_null(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    out = whitening.whiten(df).collect()
    assert {r.vec_id for r in out} == {1, 2, 3} and all(r.deviation is None for r in out if r.vec_id != 3)
    big = [(i, [float(10 ** 6 + i * 1000), float(i * i)]) for i in range(50)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in big], SCHEMA)
    same(as_rows(whitening.whiten(df)), brute(big))
