import hashlib
import random

import numpy as np
import pytest

from salesloom.llm import exact_dedup, fuse_filter


@pytest.mark.parametrize("size", [0, 1, 2, 3, 50, 5000])
def test_filter_holds_its_keys_and_few_others(size):
    rng = np.random.default_rng(size)
    keys = rng.integers(0, 1 << 62, size).astype(np.uint64)
    built = fuse_filter.build(np.concatenate([keys, keys]))
    assert fuse_filter.contains(built, keys).all()
    others = rng.integers(1 << 62, (1 << 63) - 1, 50_000).astype(np.uint64)
    assert fuse_filter.contains(built, others).mean() < 0.01


def brute(rows):
    groups = {}
    for doc, text in rows:
        same = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(same, []).append((-len(text or ""), doc is None, doc))
    found = []
    for doc, text in rows:
        same = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        keep = min(groups[same], key=lambda g: (g[0], g[1], g[2] or 0))[2]
        found.append((doc, keep, len(groups[same]), doc == keep, hashlib.sha256(same.encode()).hexdigest()))
    return sorted(found, key=repr)


def test_against_brute_force(texts):
    rng = random.Random(3)
    words = ["ab", "a b", "é x", "é  x", "", None, "  ", "🙂", "q" * 100_000, "q " * 100_000]
    rows = [(i, rng.choice(words)) for i in range(300)] + [(7, "ab"), (None, "alone"), (None, "ab")]
    out = exact_dedup.dedup(texts(rows))
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)


def test_screen_finds_every_digest_of_the_snapshot(texts):
    old = exact_dedup.fingerprints(texts([(i, f"text {i}") for i in range(200)]))
    new = exact_dedup.classes_of(exact_dedup.fingerprints(texts([(i, f"text {i}") for i in range(150, 1150)])))
    snapshot = exact_dedup.take_snapshot(old)
    screened = exact_dedup.screen(snapshot, new).join(snapshot.classes.select("digest", "n"), "digest", "left")
    rows = screened.collect()
    assert len(rows) == 1000
    assert all(r.positive for r in rows if r.n)
    assert sum(r.positive for r in rows if not r.n) < 30
    totals = {(r.digest, r.n) for r in exact_dedup.fold_in(snapshot, new).collect()}
    assert len(totals) == 1150 and sum(n for _, n in totals) == 1200


def test_copies_go_and_columns_stay(texts):
    docs = texts([(1, "a b"), (2, "ab"), (3, None), (4, ""), (None, "c"), (5, "a  b")])
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 3, 5]


def test_empty_table(texts):
    assert exact_dedup.dedup(texts([(1, "x")]).limit(0)).collect() == []
