"""Whitening against a decomposition of the whole covariance."""

import numpy as np
import pytest

from ledgerloom.llm import whitening
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def coded(vectors):
    return np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000


def expected(vectors, most=16):
    """x of all rows, fit size, deviations, eigenvalues, whitened values (either sign)."""
    x = coded(vectors)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = [i for i in np.argsort(values)[::-1] if values[i] > 1e-12 * values.max()][:most]
    white = ((n * x - sums) / n) @ axes[:, order] / np.sqrt(values[order])
    return n, ((n * x - sums) ** 2).sum(axis=1), values[order] / values.sum(), white


def held_to(rows, ids, vectors, most=16):
    n, deviations, explained, white = expected(vectors, most)
    k = len(explained)
    got = sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows)
    order = np.argsort(ids, kind="stable")
    assert [(g[0], g[1]) for g in got] == [(ids[i], c) for i in order for c in range(1, k + 1)]
    assert {g[2] for g in got} == {n}
    assert [g[3] for g in got] == [int(deviations[i]) for i in order for _ in range(k)]
    values = np.array([g[4] for g in got]).reshape(-1, k)
    signs = np.sign((values * white[order]).sum(axis=0))
    assert np.abs(values * signs - white[order]).max() < 1e-8
    assert np.allclose([g[5] for g in got[:k]], explained, rtol=1e-9)
    assert len({g[6] for g in got}) == 1 and got[0][6] < 1e-9


@pytest.mark.parametrize("seed", range(40))
def test_rank_one_update(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 24))
    square = rng.normal(size=(d, d))
    values, vectors = np.linalg.eigh(square @ square.T)
    if seed % 2:
        values = np.round(values)  # equal values are deflated
    change = rng.normal(size=d) * (rng.random(d) < 0.6) * 10.0 ** rng.integers(-9, 4)
    matrix = vectors @ np.diag(values) @ vectors.T + np.outer(change, change)
    new, axes = whitening.rank_one_update(values, vectors, change)
    assert np.all(np.diff(new) >= 0)
    assert np.abs(axes @ np.diag(new) @ axes.T - matrix).max() < 1e-12 * max(1, np.abs(matrix).max())
    assert np.abs(axes.T @ axes - np.eye(d)).max() < 1e-12


@pytest.mark.parametrize("block", [1, 7, 100])
def test_spectra_of_parts_combine(block):
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, size=(150, 12)) * rng.integers(1, 5, size=12) + 1_000_000
    parts = [whitening.Spectrum(12) for _ in range(3)]
    for part, rows in zip(parts, (x[:90], x[90:91], x[91:])):
        for start in range(0, len(rows), block):
            part.add(rows[start:start + block])
    whole = whitening.Spectrum(12)
    for part in parts:
        whole.combine(part)
    scatter = np.cov(x.T, bias=True) * len(x)
    assert whole.n == len(x) and list(whole.sums) == list(x.sum(axis=0))
    assert np.abs(whole.vectors @ np.diag(whole.values) @ whole.vectors.T - scatter).max() < 1e-9 * scatter.max()


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    held_to(QUERIES["op11_whitening"](spark, SF).collect(), [r[0] for r in rows], [r[1] for r in rows])


SCHEMA = "vec_id long, embedding array<double>, component string, n string, row int, x int, part int, scaled int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "c", "n", 1, 2, 3, 4) for i, v in vectors], SCHEMA)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    kept = [(i, list(map(float, rng.normal(size=3)))) for i in range(30)]
    kept += [(100 + i, [0.5, -0.5, 3.0]) for i in range(40)]  # a hot vector
    dropped = [
        (200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 0.0, 0.0]), (203, [0.0, float("-inf"), 0.0]), (204, []),
        (205, [1.0, 2.0]), (206, [1.0, 2.0, 3.0, 4.0]), (207, [1e300, 0.0, 0.0]),
    ]
    found = whitening.whitening_report(table(spark, kept + dropped).repartition(5)).collect()
    held_to(found, [i for i, _ in kept], [v for _, v in kept])


def test_repeated_rows_are_whitened_each(spark):
    vectors = [(i, [float(i), float(i * i % 5)]) for i in range(8)]
    once = whitening.whitening_report(table(spark, vectors)).collect()
    twice = whitening.whitening_report(table(spark, vectors + vectors[:3])).collect()
    assert len(twice) == len(once) + 6
    assert {tuple(r) for r in twice} == {tuple(r) for r in once}


def test_no_variance_and_no_rows(spark):
    assert whitening.whitening_report(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whitening_report(table(spark, [(1, None)])).collect() == []
    empty = whitening.whitening_report(table(spark, []))
    assert empty.collect() == []
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_flat_dimension_gives_no_component(spark):
    vectors = [(i, [float(i), 1.0, float(i % 3)]) for i in range(12)]
    held_to(whitening.whitening_report(table(spark, vectors)).collect(), [i for i, _ in vectors], [v for _, v in vectors])


def test_large_entries_stay_exact(spark):
    vectors = [(i, [1e9 + i, 2.0 * i * i]) for i in range(20)]
    found = whitening.whitening_report(table(spark, vectors)).collect()
    x = coded([v for _, v in vectors])
    sums = x.sum(axis=0)
    assert {r.vec_id: r.deviation for r in found} == {i: sum((20 * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums)) for i in range(20)}
    wide = [(i, [1e16 + 4 * i, float(i)]) for i in range(20)]
    assert {r.deviation is not None for r in whitening.whitening_report(table(spark, wide)).collect()} == {True}
    wider = [(i, [1e16 * i, float(i)]) for i in range(20)]
    assert {r.deviation for r in whitening.whitening_report(table(spark, wider)).collect()} == {None}


def test_extra_columns_go_along(spark):
    found = whitening.whitened(table(spark, [(i, [float(i), float(i * i % 7)]) for i in range(9)]), components=1).collect()
    assert len(found) == 9 and {(r.row.component, r.row.n, r.row.x, r.component, r.n) for r in found} == {("c", "n", 2, 1, 9)}
