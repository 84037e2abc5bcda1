"""Whitening against numpy's own eigendecomposition, and exact sums against Python's integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantloom.llm import whitening
from plantloom.llm.whitening import divide, op13_whitening, polar_factor, spectrum

SF = "/root/testdata/sf0.01"


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values),) * 2))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 100, 40), 2.0 ** -np.arange(30), np.r_[np.ones(5), 2 * np.ones(5), 3.0],
    np.r_[np.zeros(10), 1, 2, 3], np.r_[1e6, 1e6 + 1e-3, 1, 1 + 1e-9, 0], np.array([5.0]),
    np.array([2.0, -3.0]), np.full(8, 7.0), np.zeros(4), np.array([-1, -1, 4, 4, 4, 1e-12])])
def test_spectrum_equals_numpys(values):
    a = symmetric(np.random.default_rng(3), values)
    found, vectors = spectrum(a)
    norm = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - np.sort(np.linalg.eigvalsh(a))[::-1]).max() <= 1e-13 * norm * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * norm * len(a)


def test_polar_factor_has_the_eigenvalues_signs():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    values = np.r_[np.linspace(-5, -1e-6, 8), np.linspace(1e-9, 3, 12)]
    a = q @ np.diag(values) @ q.T
    sign = polar_factor((a + a.T) / 2)
    assert np.abs(sign - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-6
    assert np.abs(sign @ sign - np.eye(20)).max() < 1e-12


def test_every_split_goes_through_the_projectors(monkeypatch):
    calls = []
    real = whitening.polar_factor
    monkeypatch.setattr(whitening, "polar_factor", lambda a: calls.append(len(a)) or real(a))
    divide(symmetric(np.random.default_rng(5), np.linspace(1, 9, 17)))
    assert calls[0] == 17 and len(calls) >= 8


def expected(vectors):
    """Brute force over a list of (id, vector): rows as the query returns them."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    centred = np.array([[c - s // n for c, s in zip(x, sums)] for x in fit], float)
    cov = np.cov(centred.T, bias=True)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:16], basis[:, ::-1][:, :16]
    out = {}
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        w = (np.array(x) - mean) @ basis / np.sqrt(values)
        out[i] = deviation, w, values / np.trace(cov)
    return n, out


def test_whole_table_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, want = expected([(r.vec_id, r.embedding) for r in table])
    got = op13_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = got.collect()
    assert len(rows) == 16 * len(want) and {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    signs = {}
    for r in rows:
        deviation, w, share = want[r.vec_id]
        k = r.component - 1
        assert r.deviation == deviation
        assert r.explained == pytest.approx(share[k], rel=1e-9)
        if abs(w[k]) > 1e-3:
            signs.setdefault(k, math.copysign(1, w[k] * r.whitened))
        assert r.whitened * signs.get(k, 1) == pytest.approx(w[k], abs=1e-6)


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, row string")


def run(spark, rows):
    found = whitening.whole_numbers(embeddings(spark, rows))
    model = whitening.fit(found, 16)
    return model, whitening.whitened(found, model)


def test_awkward_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i, [float(c) for c in rng.normal(size=5)], "x", "r") for i in range(40)]
    bad = [(100, None, "x", "r"), (101, [1.0, None, 1.0, 1.0, 1.0], None, None), (102, [], "x", "r"),
           (103, [1.0, float("nan"), 1.0, 1.0, 1.0], "x", "r"), (104, [float("inf")] + [0.0] * 4, "x", "r"),
           (105, [1.0, 2.0], "x", "r"), (106, [float("-inf")] + [0.0] * 4, None, "r"), (107, [1e30] + [0.0] * 4, "", "")]
    repeated = [good[0], (None, good[0][1], None, None)] * 30
    model, found = run(spark, good + bad + repeated)
    assert model.n == len({tuple(math.floor(64 * np.float32(c)) for c in v) for _, v, *_ in good})
    ids = [r.vec_id for r in found.select("row.vec_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted([r[0] for r in good] + [0] * 30)
    assert found.select("row.*").columns == ["vec_id", "embedding", "x", "row"]
    alone = run(spark, good)[0]
    assert (model.n, model.sums) == (alone.n, alone.sums)
    assert np.array_equal(model.values, alone.values)
    assert whitening.identity_error(whitening.whole_numbers(embeddings(spark, good + repeated)), model) < 1e-9


def test_directions_without_spread_are_left_out(spark):
    rng = np.random.default_rng(7)
    flat = [(i, [float(a), float(a) + 8, 3.0, float(b)], "", "") for i, (a, b) in enumerate(rng.integers(0, 50, (60, 2)))]
    model, found = run(spark, flat)
    assert len(model.values) == 2
    assert {len(r.whitened) for r in found.collect()} == {2}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "", "")] * 3, [(1, None, "", "")], [(1, [], "", "")]])
def test_nothing_to_fit(spark, rows):
    model, found = run(spark, rows)
    assert not len(model.values)
    assert all(list(r.whitened) == [] for r in found.collect())


def test_sums_stay_exact_for_large_entries(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * 1e9], "", "") for i in range(50)]
    found = whitening.whole_numbers(embeddings(spark, rows))
    model = whitening.fit(found)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v, *_ in rows]
    assert list(model.sums) == [sum(c) for c in zip(*x)]
    for r in whitening.whitened(found, model).collect():
        exact = sum((50 * c - s) ** 2 for c, s in zip(x[r.row.vec_id], model.sums))
        assert r.deviation == (exact if exact < 2 ** 63 else None)
    y = np.array(x, float) - np.array(model.sums) / 50
    assert model.values == pytest.approx(np.linalg.eigvalsh(y.T @ y / 50)[::-1], rel=1e-9)


def test_query_on_a_table_without_rows(spark, tmp_path):
    embeddings(spark, []).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op13_whitening(spark, str(tmp_path))
    assert got.count() == 0 and len(got.columns) == 7
    assert got.select(F.max("n")).first()[0] is None
