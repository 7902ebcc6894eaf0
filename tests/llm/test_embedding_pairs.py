import itertools

import numpy as np

from salesloom.llm import embedding_pairs
from test_ngram_join import smallest


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int, cell int")


def test_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(40):
        base = rng.standard_normal(32)
        for _ in range(rng.integers(1, 9)):
            near = base + rng.choice([0.0, 0.02, 0.08, 0.14, 0.2]) * rng.standard_normal(32)
            rows.append((len(rows), near.astype("f4").tolist(), int(k % 3), 0, 0))
    first = rows[0][1]
    rows += [(900, first, 0, 0, 0), (901, first, 0, 0, 0), (902, first, None, 0, 0), (903, None, 0, 0, 0)]
    rows += [(904, [0.0] * 32, 0, 0, 0), (905, [float("nan")] * 32, 0, 0, 0), (906, first[:5], 0, 0, 0)]
    rows += [(907, [None, *first[1:]], 0, 0, 0), (908, [float("inf"), *first[1:]], 0, 0, 0)]
    vectors = {r[0]: (np.array(r[1], float), r[2]) for r in rows if r[0] < 902}
    pairs = []
    for a, b in itertools.combinations(vectors, 2):
        (x, p), (y, q) = vectors[a], vectors[b]
        if p == q and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
            pairs.append((a, b))
    least = smallest(pairs, [r[0] for r in rows])
    links = {r[0]: sum(r[0] in pair for pair in pairs) for r in rows}
    found = embedding_pairs.near_duplicates(table(spark, rows)).collect()
    assert len(pairs) > 60
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == {
        i: (links[i], least[i], least[i] == i) for i in links
    }


def test_hot_group_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(k, (base + 0.01 * rng.standard_normal(16)).astype("f4").tolist(), 1, 0, 0) for k in range(300)]
    monkeypatch.setattr(embedding_pairs, "TILE_DATA", 64)
    monkeypatch.setattr(embedding_pairs, "TILE_QUERIES", 32)
    found = embedding_pairs.near_duplicates(table(spark, rows)).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(299, 0)}


def test_empty_and_null_ids(spark):
    rows = [(None, [1.0, 0.0], 1, 0, 0), (1, [1.0, 0.0], 1, 0, 0)]
    assert embedding_pairs.near_duplicates(table(spark, rows).limit(0)).collect() == []
    found = embedding_pairs.near_duplicates(table(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == [(1, 0, 1, True), (None, 0, None, True)]


def test_least_collisions_is_calibrated():
    rng = np.random.default_rng(2)
    hits = (np.abs(rng.standard_normal((200_000, embedding_pairs.PROJECTIONS))) <= embedding_pairs.COUNT_WINDOW).sum(axis=1)
    assert (hits < embedding_pairs.least_collisions()).mean() <= 1e-4
