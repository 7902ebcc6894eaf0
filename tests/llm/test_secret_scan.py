import random
import re

from pyspark.sql import functions as F

from salesloom.llm import secret_scan

NAME = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
RULES = (
    ("assign", re.compile(rf"""({NAME}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def brute(text):
    found = []
    for number, (kind, pattern, group, least) in enumerate(RULES):
        found += [
            (m.start(), number, f"{kind}:{m.start()}:{m.end()}")
            for m in pattern.finditer(text or "")
            if len(m.group(group)) >= least
        ]
    return ",".join(f[2] for f in sorted(found))


def random_texts(seed, count):
    rng = random.Random(seed)
    parts = ["token", "SECRET", "api_key", "ApiKey", "passwd", "=", ": ", '"', "'", " ", "short", "longenough1", "AKIA", "é", "🙂"]
    parts += ["AKIA" + "Q7" * 8, "0123456789abcdef" * 2, "deadbeef", "\n", "=secret:abcdefghi"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(count)]


def test_base_spans_against_python(texts):
    rows = list(enumerate(random_texts(1, 500))) + [(900, None), (901, ""), (None, "token=abcdefgh"), (902, "x " * 200_000 + "token=abcdefgh")]
    found = secret_scan.scan(texts(rows)).select("doc_id", secret_scan.listed(F.col("base")).alias("base")).collect()
    assert sorted((repr(r.doc_id), r.base) for r in found) == sorted((repr(i), brute(t)) for i, t in rows)


def test_markov_models_find_random_strings(spark, texts):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    syllables = ["ing", "tion", "ver", "lich", "ment", "con", "ter", "an", "er", "ous"]
    rows = []
    for i in range(300):
        word = "".join(rng.choice(syllables) for _ in range(8))
        rows.append((i, f"some {word} and {word[:17]} text"))
    for i in range(300, 340):
        rows.append((i, "password = " + "".join(rng.choice(letters) for _ in range(40))))
    hidden = "".join(rng.choice(letters) for _ in range(40))
    rows.append((999, f"über {hidden} hier"))
    out = {r.doc_id: r.s for r in secret_scan.scan(texts(rows)).select("doc_id", secret_scan.listed(F.col("spans")).alias("s")).collect()}
    assert out[999] == "markov:5:45"
    assert all(out[i] == "" for i in range(300))
    assert all(out[i].startswith("assign:0:") and "markov" not in out[i] for i in range(300, 340))
    clean = {r.doc_id: r.text for r in secret_scan.redacted(texts(rows)).collect()}
    assert clean[999] == "über [secret] hier" and clean[0] == rows[0][1] and clean[300] == "[secret]"


def test_redacted_keeps_columns_and_empty_tables(texts):
    docs = texts([(1, None), (2, "a token=abcdefgh b 0123456789abcdef0123456789abcdef"), (3, "")])
    out = secret_scan.redacted(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: None, 2: "a [secret] b [secret]", 3: ""}
    assert secret_scan.scan(docs.limit(0)).collect() == []


def test_many_matches_in_one_text(spark, texts):
    def text(n):
        return " ".join(f"token=abcdefgh{k} internationalised_words{'xyz'[k % 3]} secret: {'ab' * 20} é" for k in range(n))

    rows = [(1, text(5_000)), (2, text(3)), (3, "plain")]
    found = secret_scan.scan(texts(rows)).select("doc_id", secret_scan.listed(F.col("base")).alias("base")).collect()
    assert {r.doc_id: r.base for r in found} == {i: brute(t) for i, t in rows}
    for i, t in rows:
        clean = re.sub(rf"(?:{NAME})[=:] ?[a-z0-9]+", "[secret]", t)
        assert secret_scan.redacted(texts([(i, t)])).first().text == clean


def test_tokens_outside_of_spans(spark):
    rng = random.Random(7)
    span = "array<struct<start:int,kind:int,end:int,value:string>>"

    def spans(kinds, count):
        found = []
        for kind in kinds:
            at = 0
            for _ in range(rng.randint(0, count)):
                at += rng.randint(0, 30)
                found.append((at, kind, at + rng.randint(1, 40), "v"))
                at = found[-1][2]
        return found

    rows = [(i, spans(range(3), 6), spans([3], 8)) for i in range(200)] + [(900, spans(range(3), 400), spans([3], 900))]
    rows += [(901, [], spans([3], 5)), (902, spans([0], 5), [])]
    frame = spark.createDataFrame(rows, f"id int, base {span}, tokens {span}")
    out = frame.select("id", secret_scan._outside(F.col("tokens"), F.col("base")).alias("left")).collect()
    for r in out:
        _, base, tokens = next(x for x in rows if x[0] == r.id)
        assert [tuple(t) for t in r.left] == [t for t in tokens if not any(b[0] < t[2] and t[0] < b[2] for b in base)]
