import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesloom.llm import language_id, toxicity


def held(i, parts):
    return zlib.crc32(str(i).encode()) % parts


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    words = ["house", "tree", "river", "green", "walk", "bread", "stone", "light"]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(["idiot", "scumbag", "moron"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), "x"))
    rows += [(9000, None), (9001, ""), (9002, "house tree river green walk bread stone light " * 20_000), (None, "tree"), (9003, "IDIOT moron")]
    labels += [(None, 1, "x"), (7000, None, "x"), (7001, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    found = {r.doc_id: r.toxicity for r in toxicity.scored(docs, model).collect()}
    assert len(found) == 605 and all(0 <= s <= 1 for s in found.values())
    wrong = [i for i in range(600) if held(i, 5) == 0 and (found[i] >= 0.5) != (i % 5 == 0)]
    assert len(wrong) <= 2
    assert found[9000] == found[9001] < 0.5 and found[9002] < 0.5 < found[9003]
    again = toxicity.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    assert all(np.array_equal(a, b) for a, b in zip(model, again, strict=True))


def test_toxicity_without_labels_or_rows(labelled):
    docs, labels = labelled
    assert toxicity.train(docs, labels.limit(0), F.lit(True)) is None
    assert {r.toxicity for r in toxicity.scored(docs, None).collect()} == {0.0}
    only = toxicity.train(docs, labels.where("toxic = 0"), F.lit(True))
    assert all(r.toxicity < 0.5 for r in toxicity.scored(docs, only).collect())
    assert toxicity.scored(docs.limit(0), only).collect() == []


def test_toxicity_gradient_is_right():
    rng = np.random.default_rng(1)
    found = toxicity._minimum(lambda w: (float(((w - 3) ** 2).sum() + w[0] ** 4), 2 * (w - 3) + np.eye(4)[0] * 4 * w[0] ** 3), rng.normal(size=4))
    assert np.allclose(found[1:], 3, atol=1e-3) and abs(4 * found[0] ** 3 + 2 * (found[0] - 3)) < 1e-2


LANGUAGES = {"aa": "tion ing the and wher with ould", "bb": "sch keit und die ver nicht aus", "cc": "oux eau les que dans ère çon"}


def words(rng, lang, n):
    syllables = LANGUAGES[lang].split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_on_held_out_rows(spark, texts):
    rng = random.Random(4)
    truth = {i: rng.choice(list(LANGUAGES)) for i in range(300)}
    rows = [(i, words(rng, lang, rng.randint(5, 80)), lang, "t") for i, lang in truth.items()]
    rows += [(900, None, "aa", "t"), (901, "12 :-)", "aa", "t"), (902, "", None, "t"), (903, words(rng, "bb", 30_000), None, "t"), (904, "𝒜", None, "t"), (None, "the and", "bb", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, id string")
    samples = language_id.learn(docs, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    assert [name for name, _ in samples] == sorted(LANGUAGES)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identified(docs, samples).collect()}
    assert sum(found[i][0] != lang for i, lang in truth.items() if held(i, 3) == 1) <= 1
    assert found[900] == found[901] == found[902] == ("und", 0.0)
    assert found[903][0] == "bb" and found[904][0] in LANGUAGES
    assert all(0 <= score <= 1 for _, score in found.values())
    assert {r.lang_pred for r in language_id.identified(docs, ()).collect()} == {"und"}
    assert language_id.identified(docs.limit(0), samples).collect() == []
    assert language_id.learn(docs.limit(0), F.lit(True)) == ()


def test_phrases_against_a_plain_parse():
    rng = random.Random(6)
    samples = (("aa", words(rng, "aa", 300)), ("bb", words(rng, "bb", 300)))
    parser = language_id.Parser(samples)
    texts = [words(rng, rng.choice(["aa", "bb", "cc"]), n) for n in (1, 3, 40, 900)] + ["?"]

    def plain(text, sample):
        symbols, known = (bytes(parser.symbols(t).tolist()) for t in (text, sample))
        known = known[: language_id.SAMPLE_CHARS]
        phrases = 0
        for start in range(0, len(symbols), language_id.SEGMENT):
            part, match = symbols[start : start + language_id.SEGMENT], b""
            for symbol in part:
                if match + bytes([symbol]) in known:
                    match += bytes([symbol])
                    continue
                phrases += 1  # the longest match ends
                match = bytes([symbol]) if bytes([symbol]) in known else b""
            phrases += match != b""
        return phrases

    found = parser.phrases([parser.symbols(t) for t in texts])
    expected = [[plain(t, s) * parser._weights[k] for t in texts] for k, (_, s) in enumerate(samples)]
    assert np.allclose(found, expected)


def test_scripts_of_many_letters_and_beyond_the_basic_plane(monkeypatch):
    """Letters are told apart however many there are; both forms of the transitions answer alike."""
    rng = random.Random(9)
    many = [chr(0x4E00 + 2 * k) for k in range(700)]
    others = [chr(0x4E00 + 2 * k + 1) for k in range(700)]
    gothic = [chr(0x10330 + k) for k in range(26)]
    runs = {"aa": many, "bb": others, "cc": gothic, "dd": gothic[::-1][:13]}

    def text(lang, n):
        start = rng.randrange(len(runs[lang]))
        return "".join(runs[lang][(start + k) % len(runs[lang])] for k in range(n))

    samples = tuple((lang, " ".join(text(lang, 40) for _ in range(200))) for lang in runs)
    questions = [(lang, " ".join(text(lang, 20) for _ in range(3))) for lang in runs for _ in range(10)]
    dense = language_id.Parser(samples)
    found = dense.identify([t for _, t in questions])
    assert [name for name, _ in found] == [lang for lang, _ in questions]
    monkeypatch.setattr(language_id, "TABLE_CELLS", 0)
    assert language_id.Parser(samples).identify([t for _, t in questions]) == found


def test_samples_come_from_many_texts_and_any_place(spark):
    rows = [(k, "x" * 50_000 + chr(0x100 + k) * 50_000, "aa") for k in range(80)] + [(k, "same text", "bb") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (_, long), (_, short) = language_id.learn(docs, F.lit(True))
    passages = long.split(" ")
    assert len(passages) == language_id.SAMPLE_DOCS and len(long) <= language_id.SAMPLE_CHARS < len(long) + 200
    assert len({len(p) for p in passages}) == 1 and 10 < sum(p[0] == "x" for p in passages) < 54
    assert short == "same text"


def test_toxicity_fit_against_plain_features():
    """Features, ratios, norms and the minimum itself, without blocks or hashing by numpy."""
    rng = random.Random(2)
    words = ["tree", "river", "idiot", "moron"]
    texts = [" ".join(rng.choice(words[: 2 + 2 * (k % 2)]) for _ in range(rng.randint(1, 9))) for k in range(60)]
    labels = np.array([float("idiot" in t or "moron" in t) for t in texts])

    def plain(text):
        data, places = f" {text.lower()} ".encode(), set()
        for order in toxicity.ORDERS:
            for start in range(len(data) - order + 1):
                value = data[start]
                for byte in data[start + 1 : start + order]:
                    value = value * 0x01000193 % 2**32 ^ byte
                places.add(value * 0x9E3779B1 % 2**32 >> 32 - toxicity.BITS)
        return places

    mark = np.empty(1 << toxicity.BITS, np.int32)
    rows = [toxicity._features(t, mark) for t in texts]
    assert all(set(r.tolist()) == plain(t) and len(r) == len(plain(t)) for r, t in zip(rows, texts, strict=True))
    weights, squares, intercept = toxicity._fitted(rows, labels)
    used = sorted(set().union(*map(plain, texts)))
    counts = [{p: 1 + sum(p in plain(t) for t, y in zip(texts, labels, strict=True) if y == c) for p in used} for c in (0, 1)]
    totals = [sum(c.values()) + (1 << toxicity.BITS) - len(used) for c in counts]
    ratio = np.array([np.log(counts[1][p] / totals[1] / (counts[0][p] / totals[0])) for p in used])
    assert np.allclose(squares[used], ratio**2, rtol=1e-5)
    matrix = np.array([[p in plain(t) for p in used] for t in texts]) * ratio
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    free = weights[used] / ratio
    error = 1 / (1 + np.exp(-(matrix @ free + intercept))) - labels
    slope = matrix.T @ error / len(texts) + 2 * toxicity.PENALTY * free
    at_start = matrix.T @ (1 / (1 + np.exp(-intercept)) - labels) / len(texts)
    assert np.abs(slope).max() < 0.02 * np.abs(at_start).max()


def test_toxicity_learns_alike_from_repeated_ids(labelled):
    docs, labels = labelled
    learn = F.lit(True)
    many = docs.union(docs.where("doc_id = 5")).repartition(7)
    first, again = (toxicity.train(d, labels, learn) for d in (many, many.repartition(3)))
    assert all(np.array_equal(a, b) for a, b in zip(first, again, strict=True))


def test_toxicity_features_leave_in_small_batches():
    """A batch of long texts has several times their size in features, which the JVM would keep room for."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz 0123456789", k=20_000)) for _ in range(60)]
    numbers = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([numbers, numbers, numbers.cast(pa.int32()), pa.array(texts)], [*toxicity._ORDER, "text"])
    found = list(toxicity._featured([batch]))
    assert max(b.column("places").nbytes for b in found) < 2 * toxicity.BATCH_BYTES
    assert [i for b in found for i in b.column("id_hash").to_pylist()] == list(range(len(texts)))
    mark = np.empty(1 << toxicity.BITS, np.int32)
    places = [p for b in found for p in b.column("places").to_pylist()]
    assert places == [toxicity._features(t, mark).astype("<u4").tobytes() for t in texts]
