import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from salesloom.llm import ngram_join
from salesloom.llm.components import connected_components
from salesloom.llm.shared import written
from salesloom.llm.shingles import Bands, Parities, block_keys, parity, shingle_set


def shingles(text, words):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def smallest(pairs, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, words, numerator, denominator):
    sets = {i: shingles(t, words) for i, t in rows}
    pairs = [
        (a, b)
        for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and sets[b] and denominator * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b])
    ]
    least = smallest(pairs, sets)
    return sorted((i, len(s), least[i]) for i, s in sets.items())


def corpus(seed, count=260):
    """Random texts, exact copies, and chains and groups of near copies of any closeness."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(count):
        kind = rng.random()
        if texts and kind < 0.55:
            text = rng.choice(texts[-40:]).split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 8, 20, 60, 150, 400]))]
            if kind > 0.8:
                text += passage
        texts.append(rng.choice([" ", "\n", "  "]).join(text))
    return list(enumerate(texts))


@pytest.mark.parametrize(("words", "numerator"), [(3, 90), (5, 80)])
def test_against_all_pairs(texts, words, numerator):
    rows = corpus(words) + [(1000, None), (1001, ""), (1002, " \t"), (1003, "One two"), (1004, "one TWO")]
    out = ngram_join.join(texts(rows), words, numerator, 100)
    assert sorted(map(tuple, out.collect())) == brute(rows, words, numerator, 100)


def test_rows_without_id_and_empty_table(texts):
    rows = [(None, "a b c d"), (1, "a b c d"), (2, "a b c d"), (2, "a b c d")]
    out = ngram_join.join(texts(rows), 3, 90, 100)
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, 2, 1), (2, 2, 1), (2, 2, 1), (None, 2, None)]
    assert ngram_join.join(texts(rows).limit(0), 3, 90, 100).collect() == []
    left = ngram_join.without_near_copies(texts(rows), 3, 90)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1]


def test_hot_keys_lose_no_link(texts):
    """Nearly every key counts as hot, so the exact step has to tell the classes of a tree apart."""
    rows = corpus(11, 160)
    out = ngram_join.join(texts(rows).repartition(3), 3, 90, 100, hot_key=2)
    assert sorted(map(tuple, out.collect())) == brute(rows, 3, 90, 100)


def test_cut_hot_keys():
    keys = np.array([5, 7, 5, 5, 5, 9, 7, 5], np.uint64)
    nodes = np.array([3, 1, -2, 8, 3, 4, 6, 0])
    kept, owners, links, hot = ngram_join._cut_hot(keys, nodes, 3, np.array([], np.uint64))
    assert list(zip(kept.tolist(), owners.tolist())) == [(5, -2), (7, 1), (7, 6), (9, 4)]
    assert links.tolist() == [[-2, 0], [-2, 3], [-2, 8]] and hot.tolist() == [5]
    kept, owners, links, hot = ngram_join._cut_hot(keys, nodes, 9, np.array([7], np.uint64))
    assert len(kept) == 6 and links.tolist() == [[1, 6]] and hot.tolist() == [7]
    assert [len(x) for x in ngram_join._cut_hot(keys[:0], nodes[:0], 3, keys[:0])] == [0, 0, 0, 0]


def test_sent_bytes_do_not_grow_with_the_buckets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(300))) for i in range(60)]
    table = spark.createDataFrame(rows, "id long, text string")
    sent = {}
    for buckets in (8, 1024):
        found = ngram_join.key_packets(table.coalesce(1), 5, Bands(80, 100), buckets, 2000).collect()
        sent[buckets] = sum(len(r["keys"]) + len(r["nodes"]) + len(r["hot"]) for r in found)
    assert sent[8] == sent[1024] > 0


def test_rows_of_shared_keys_do_not_grow_with_the_classes(spark, monkeypatch):
    """Every class shares keys in every bucket; there were as many rows as classes in all buckets together."""
    made = {}

    def counted(df, name):
        out = written(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    for count in (60, 240):
        rows = []
        for i in range(count):
            at = rng.randrange(120)
            rows.append((i, " ".join([*base[:at], f"own{i}", *base[at + 1 :]])))
        out = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100)
        assert {r.component_id for r in out.collect()} == {0}
    few, many = made["shared-keys"]
    assert many == few <= 8 * 8


def test_shared_keys_reach_their_classes():
    keys, nodes = np.array([9, 5, 5, 9, 7, 9], "<u8"), np.array([-3, 4, 11, 4, 4, 20], "<i8")
    rows = [(1, keys.tobytes(), nodes.tobytes(), b"")]
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary()), ("hot", pa.binary())])
    table = pa.Table.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=schema)

    def by_class(hot_key):
        sent = ngram_join._shared_keys(table, hot_key, 3).to_pylist()
        assert len({row["part"] for row in sent}) == len(sent)
        found = {}
        for row in (r for r in sent if r["part"] >= 0):
            part = ngram_join._keys_by_class(pa.Table.from_pylist([row]))
            found |= {r["node"]: np.frombuffer(r["keys"], "<u8").tolist() for r in part.to_pylist()}
        links = [(row["keys"], row["nodes"]) for row in sent if row["part"] < 0]
        return found, [tuple(np.frombuffer(end, "<i8").tolist() for end in pair) for pair in links]

    assert by_class(9) == ({-3: [9], 4: [5, 9], 11: [5], 20: [9]}, [])
    assert by_class(2) == ({4: [5], 11: [5]}, [([-3, -3], [4, 20])])


def test_near_copies_by_id_and_text(texts):
    """An id with two texts: only the one that is a near copy goes; of equal rows one stays."""
    near = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, near), (2, near + " x"), (2, other), (3, other), (1, near), (4, ""), (4, ""), (None, near)]
    left = ngram_join.without_near_copies(texts(rows), 5, 80)
    assert left.columns == texts(rows).columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(1, near), (2, other), (4, ""), (4, ""), (None, near)], key=repr
    )


def test_linked_sets_share_a_block():
    rng = np.random.default_rng(5)
    for numerator in (80, 90):
        bands = Bands(numerator, 100)
        for size in (1, 2, 5, 9, 10, 30, 77, 300, 1500):
            for _ in range(20):
                a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
                b = rng.permutation(a)[: max(1, -(-numerator * len(a) // 100))]
                b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, 0).astype(np.uint64)]))
                if not bands.linked(len(b), len(a) + len(b)):
                    continue
                keys = [{k for cut in bands.of(len(s)) for k in block_keys(s, *cut).tolist()} for s in (a, b)]
                assert keys[0] & keys[1]
                sketches = [parity(a), parity(b)]
                both = Parities(np.array([len(a), len(b)]), np.array([0, len(sketches[0])]), np.concatenate(sketches))
                assert both.distances(np.array([0]), np.array([1]))[0] <= len(a) - len(b)


def test_unrelated_sets_share_no_key():
    """Blocks of few elements, empty ones too, had the same 64 parity bits in many sets that have nothing in common."""
    rng, bands = np.random.default_rng(9), Bands(80, 100)
    for size in (3, 5, 9, 14, 30, 77, 120, 300, 1500):
        found = [np.unique(rng.integers(0, 1 << 64, size, np.uint64)) for _ in range(400)]
        keys = [np.unique(np.concatenate([block_keys(s, *cut) for cut in bands.of(len(s))])) for s in found]
        assert len(np.unique(np.concatenate(keys))) == sum(map(len, keys))


def test_small_linked_sets_share_a_key():
    """Also where the only blocks without a difference are empty."""
    rng, bands = np.random.default_rng(3), Bands(80, 100)
    for size in (3, 4, 5, 6, 8, 9, 10, 13, 20, 36, 60, 100):
        for _ in range(400):
            a = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
            dropped = int(rng.integers(0, size // 5 + 1))
            b = np.concatenate([rng.permutation(a)[dropped:], rng.integers(0, 1 << 64, size // 5 - dropped, np.uint64)])
            b = np.unique(b)
            if bands.linked(len(np.intersect1d(a, b)), len(a) + len(b)):
                keys = [{k for cut in bands.of(len(s)) for k in block_keys(s, *cut).tolist()} for s in (a, b)]
                assert keys[0] & keys[1]


def test_sketches_are_sent_for_what_classes_share(spark, monkeypatch):
    """Classes that share nothing sent keys and sketches, and a pair did so for each of its many keys."""
    sent = []

    def seen(classes, buckets):
        sent.extend(classes.collect())
        return packets(classes, buckets)

    packets = ngram_join.packets
    monkeypatch.setattr(ngram_join, "packets", seen)
    rng = random.Random(2)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(rng.choice([20, 40, 90, 300]))] for _ in range(300)]
    pairs = [[f"w{rng.randrange(10**6)}" for _ in range(300)] for _ in range(3)]
    texts += [*pairs, *([*words[:-1], "end"] for words in pairs)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    out = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100)
    assert {r.doc_id: r.component_id for r in out.collect()} == {i: i - 3 if i > 302 else i for i, _ in rows}
    assert sorted((len(r["keys"]), r["n"]) for r in sent) == [(8, 296)] * 6


def test_keys_of_the_same_classes_are_one():
    keys = np.array([2, 2, 5, 5, 5, 7, 7, 9, 9, 9], "<u8")
    nodes = np.array([-4, 1, -4, 1, 6, -4, 1, -4, 1, 6], "<i8")
    names, owners = ngram_join._named_by_classes(keys, nodes)
    found = {name: sorted(owners[names == name].tolist()) for name in names.tolist()}
    assert len(owners) == 5 and sorted(found.values()) == [[-4, 1], [-4, 1, 6]]
    again, _ = ngram_join._named_by_classes(keys[:2] + np.uint64(90), nodes[:2])
    assert found[again[0]] == [-4, 1]
    assert [len(x) for x in ngram_join._named_by_classes(keys[:0], nodes[:0])] == [0, 0]


def test_shingles_of_long_and_odd_texts():
    assert len(shingle_set("A b\x0bC d É", 2)) == 3
    assert (shingle_set("Ab CD é", 2) == shingle_set("aB cd é", 2)).all()
    assert (shingle_set("É", 1) != shingle_set("é", 1)).all()
    assert len(shingle_set("x " * 300_000, 3)) == 1
    assert len(shingle_set(" ".join(map(str, range(50_000))), 3)) == 49_998


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    real = [(a, b) for a, b in edges if a != b]
    assert {r.id: r.component for r in found} == smallest(real, {x for e in real for x in e})
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
