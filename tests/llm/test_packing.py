import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from salesloom.llm import packing, shared, words
from salesloom.llm.words import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def odd_texts(seed, count):
    rng = random.Random(seed)
    letters = list("ab e'sthe  \n\t\r\x0b\x1c\x85  　é漢字🙂1²٣._-İſ")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(count)]
    return [*texts, "", " ", "don't we're  x's,\n they'll", "<|endoftext|> a <|endoftext|>", "a" * 3000]


def test_fragments_give_the_ids_of_the_library(tokenizer):
    texts = odd_texts(1, 4000)
    expected = tokenizer.encode_batch(texts, add_special_tokens=False)
    with open(PATH, encoding="utf-8") as file:
        found = list(Encoder(file.read()).encode(texts))
    assert found == [np.array(e.ids, "<u4").tobytes() for e in expected]


def test_every_id_in_one_piece_of_a_full_sequence(texts, tokenizer):
    rng = random.Random(2)
    words = ["alpha", "beta,", "gamma.", "delta\n", "häufig", "😀"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 50, 300, 700, 1500, 6000])))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "no id")]
    docs = texts(rows).repartition(3)
    found = packing.pack(docs, PATH).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length, r.tier, r.step_group))
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        parts = sorted(pieces[doc])
        assert b"".join(p[1] for p in parts) == ids
        assert [p[0] for p in parts] == [sum(len(q[1]) for q in parts[:k]) // 4 for k in range(len(parts))]
        assert {p[2] for p in parts} == {len(ids) // 4}
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:k]) for k in range(len(parts))]
        total = sum(p[1] for p in parts)
        assert total == parts[0][2] and total & (total - 1) == 0 and total <= 2048
    assert len({r.tier for r in found} & {2048, 1024, 512, 256}) >= 3


def test_step_groups_are_balanced(texts):
    rows = [(i, "word " * n) for i, n in enumerate([40, 300, 900, 1700] * 60)]
    cost = defaultdict(lambda: defaultdict(int))
    for r in packing.pack(texts(rows).coalesce(1), PATH, with_ids=False).collect():
        if r.tier == 2048:
            cost[r.tier][r.step_group] += r.length**2
    loads = list(cost[2048].values())
    assert len(loads) > 2 and max(loads) < 1.5 * sum(loads) / len(loads)


def test_empty_table(texts):
    assert packing.pack(texts([(1, "x")]).limit(0), PATH).collect() == []


def test_letters_of_every_script_are_one_pretoken(tokenizer):
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    texts = [f"x a{letter}b" for letter in letters]
    expected = tokenizer.encode_batch(texts, add_special_tokens=False)
    with open(PATH, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    assert encoder._merger
    found = list(encoder.encode(texts))
    assert [t for t, f, e in zip(texts, found, expected, strict=True) if f != np.array(e.ids, "<u4").tobytes()] == []


def test_a_vocabulary_whose_tokens_do_not_encode_to_themselves_is_left_to_the_library():
    with open(PATH, encoding="utf-8") as file:
        parts = json.load(file)
    letters = [token for token in parts["model"]["vocab"] if len(token) == 1]
    # "abc" is listed as ab + c, but b and c are joined first, so it never occurs
    merges = [["b", "c"], ["a", "b"], ["ab", "c"]]
    vocab = {token: n for n, token in enumerate([*letters, "bc", "ab", "abc"])}
    parts["model"] |= {"merges": merges, "vocab": vocab}
    parts["added_tokens"] = []
    encoder = Encoder(json.dumps(parts))
    assert encoder._merger is None
    expected = Tokenizer.from_str(json.dumps(parts)).encode("x abc abab", add_special_tokens=False).ids
    assert next(encoder.encode(["x abc abab"])) == np.array(expected, "<u4").tobytes()


def test_workers_forget_fragments_between_tasks(spark):
    """Idle workers count for their executor's memory; they held every fragment of earlier tasks."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, f"some words{i} and more{i * 7}") for i in range(500)], "doc_id long, text string")
    assert packing.pack(docs.repartition(2), path).count() > 0
    with open(path, encoding="utf-8") as file:
        tokenizer = file.read()

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(words.encoder(tokenizer)._known)]})

    probed = spark.range(4, numPartitions=2).mapInArrow(held, "n long").collect()
    assert [r.n for r in probed] == [0, 0]


def test_memory_goes_back_at_the_end_of_a_task(monkeypatch):
    ended = []
    monkeypatch.setattr(shared, "_free", lambda: ended.append(len(ended)))
    work = shared.lean(lambda batches: (2 * b for b in batches))
    rows = work([1, 2])
    assert next(rows) == 2 and not ended
    assert list(rows) == [4] and ended == [0]
    assert shared.lean_groups(lambda group: group + 1)(1) == 2 and ended == [0, 1]
