import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.llm import embedding_whitening as whitening


def run(df, wanted=8):
    rows = whitening.encoded(whitening.whole_numbers(df))
    return whitening.whitened(rows, whitening.fit(rows, wanted)).collect()


def table(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, x int, id string, n int, data binary, component int"
    return spark.createDataFrame([(i, v, 0, 1, "i", 2, b"d", 3) for i, v in rows], schema)


def check(found, rows, wanted=8):
    """Against the eigenvectors of the covariance matrix."""
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows], object)
    n, total = len(x), x.sum(axis=0)
    centred = x.astype(float) - np.array([s / n for s in total])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    size = min(wanted, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == n * size
    by_row = {}
    for r in found:
        by_row.setdefault((r.id, int(r.deviation)), []).append(r)
    deviations = [(i, int(((n * own - total) ** 2).sum())) for (i, _), own in zip(rows, x, strict=True)]
    assert sorted(by_row, key=repr) == sorted(set(deviations), key=repr)
    assert all(r.n == n and 0 <= r.identity_error <= 1e-9 for r in found)
    for k in range(size):
        own = {r.explained for r in found if r.component == k + 1}
        assert len(own) == 1 and abs(own.pop() / (values[k] / values.sum()) - 1) < 1e-9
    return by_row, centred, values[:size], vectors[:, :size], deviations


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(1)
    mixed = rng.normal(size=(300, 12)) * np.geomspace(1, 1e-2, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0] + 0.3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    extra = [(900, None), (901, [1.0, None] + [0.0] * 10), (902, [float("nan")] * 12), (903, [float("inf")] * 12)]
    by_row, centred, values, vectors, deviations = check(run(table(spark, rows + extra)), rows)
    expected = centred @ vectors / np.sqrt(values)
    got = np.array([[r.whitened for r in sorted(by_row[d], key=lambda r: r.component)] for d in deviations])
    signs = np.sign((expected * got).sum(axis=0))
    assert np.abs(got - expected * signs).max() < 1e-6


def test_equal_deviations_are_all_found(spark):
    """Spheres: a single Krylov chain sees one component of several."""
    rows = [(2 * k + s, [0.0] * k + [0.5 if s else -0.5] + [0.0] * (11 - k)) for k in range(12) for s in (0, 1)]
    rows += [(100 + i, v) for i, (_, v) in enumerate(rows[:8])]  # the first four dimensions hold twice the variance
    found = run(table(spark, rows), wanted=6)
    by_component = {r.component: r.explained for r in found}
    assert len(by_component) == 6 and max(r.identity_error for r in found) < 1e-9
    assert np.allclose([by_component[k] for k in range(1, 7)], [0.125] * 4 + [0.0625] * 2, atol=2e-3)


def test_long_vectors_stop_early(spark, monkeypatch):
    rng = np.random.default_rng(3)
    parts = rng.normal(size=(200, 90)) * np.concatenate([[2, 2, 1.2, 0.9, 0.7, 0.5, 0.4, 0.3], np.full(82, 1e-2)])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(parts)]
    passes = []
    step = whitening._Chain.step
    monkeypatch.setattr(whitening._Chain, "step", lambda self, d: passes.append(1) or step(self, d))
    check(run(table(spark, rows)), rows)
    assert len(passes) < 90


@pytest.mark.parametrize(
    "rows",
    [
        [(1, [0.1, 0.2]), (2, [0.3, 0.1]), (None, [0.1, 0.2]), (1, [0.1, 0.2])],
        [(1, [0.5, 0.0, 0.0]), (2, [-0.25, 0.0, 0.0])],
        [(1, [1e6, -3e8]), (2, [5e8, 7.0]), (3, [0.0, 1.0])],
    ],
)
def test_few_rows_repeats_and_large_numbers(spark, rows):
    found = run(table(spark, rows))
    check(found, rows)


def test_nothing_to_whiten(spark):
    assert run(table(spark, [])) == []
    assert run(table(spark, [(1, None), (2, [])])) == []
    assert run(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])) == []


def test_vectors_of_unequal_length_and_doubles(spark):
    rows = [(1, [0.5, 0.25, 0.125]), (2, [0.75]), (3, [0.1, 0.9]), (4, [])]
    padded = [(i, v + [0.0] * (3 - len(v))) for i, v in rows]
    doubles = table(spark, rows).withColumn("embedding", F.col("embedding").cast("array<double>"))
    check(run(table(spark, rows)), padded)
    check(run(doubles), padded)
    with pytest.raises(Exception, match="beyond 2"):
        run(table(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])]))
