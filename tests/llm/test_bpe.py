import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from salesloom.llm import bpe
from test_packing import odd_texts


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_fold_gives_the_ids_of_the_library(spark, ranks, library):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghinorstuäé漢🙂") for _ in range(rng.randint(1, 18))) for _ in range(400)]
    rows = spark.createDataFrame([(w,) for w in words], "word string").coalesce(2)
    found = rows.select("word", F.element_at(bpe.encoded_words(F.array("word"), ranks), 1).alias("ids")).collect()
    assert all(list(r.ids) == library._encode_single_piece(r.word) for r in found)


def test_merges_in_python_agree(ranks, library):
    rng = random.Random(2)
    for size in (1, 2, 7, 60, 255, 256, 257, 3000):
        word = "".join(rng.choice("abcdeforst") for _ in range(size))
        expected = library._encode_single_piece(word)
        assert bpe.merged(word.encode(), ranks) == expected
        if word.encode() not in ranks:
            assert bpe.merged_with_heap(word.encode(), ranks) == expected


@pytest.mark.parametrize("words", [5, 1 << 18])
def test_texts_against_the_library(texts, ranks, library, monkeypatch, words):
    monkeypatch.setattr(bpe, "DICTIONARY", words)
    rows = list(enumerate(odd_texts(3, 600))) + [(5000, None), (None, "no id"), (7, "again"), (5001, "the  end\n\n now" * 5000)]
    docs = texts(rows)
    found = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    expected = sorted(
        (repr(i), np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), hashlib.sha256((t or "").encode()).digest())
        for i, t in rows
    )
    assert sorted((repr(r.doc_id), bytes(r.ids), hashlib.sha256(r.bytes).digest()) for r in found) == expected


def test_empty_table(texts, ranks):
    ids = bpe.encode(texts([(1, "x")]).limit(0), ranks, public_tokenizers.PATTERN)
    assert bpe.decode(ids, ranks).collect() == []


def test_fragments_are_cut_as_word_by_word():
    words = bpe.words_of(public_tokenizers.PATTERN)
    assert bpe._SPACES == [c for c in map(chr, range(0x110000)) if c.isspace() and c != " "]
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "é", " ", " ", "\n", "\xa0", "\u2003", "\x00", "b"][: rng.randint(1, 9)]) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    for text in texts:
        parts = text.split(" ")
        apart = "" not in parts[1:] and not any(
            (k and p[:1].isspace()) or (k < len(parts) - 1 and p[-1:].isspace()) for k, p in enumerate(parts)
        )
        assert words.fragments(text) == (parts if apart else None)


def test_decoding_joins_the_pieces_of_any_ids(spark, ranks):
    tokens = sorted(ranks, key=ranks.__getitem__)
    rng = random.Random(9)
    ids = [b"", None, *(np.array([rng.randrange(len(tokens)) for _ in range(n)], "<u4").tobytes() for n in (1, 2, 5000))]
    rows = spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids binary").coalesce(1)
    found = {r.doc_id: bytes(r.bytes) for r in bpe.decode(rows, ranks).collect()}
    assert found == {i: b"".join(tokens[k] for k in np.frombuffer(x or b"", "<u4")) for i, x in enumerate(ids)}
