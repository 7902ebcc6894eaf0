"""Secret scan: fixed rules, and Markov models of random strings and ordinary identifiers.

Three rules find base spans: values assigned to a secret's name (``assign``), access keys (``access``) and long
hexadecimal runs (``hex``). Everything else that looks like one token of 16 or more characters is judged by two
first-order character Markov models: if the mean log-likelihood ratio of its transitions exceeds
``THRESHOLD``, it is a span of kind ``markov``; one without lower-case letters is judged in lower case. Base spans stay as they are; a token that overlaps one is not judged.

The models are trained from labelled samples: a table of values and whether each is random. By default these are the
distinct values of the base spans and the distinct long tokens outside of them that consist of words, over all documents. Their transition
counts have at most 67 x 67 entries for either class. All work is built-in expressions; lists of matches are folded in
parts of ``PART``, so the time of a text grows with its length and matches, not with their square.

Offsets are code points, end exclusive; matches of a kind are leftmost and do not overlap. A null text counts as
empty and has no spans. Without a sample of either class nothing is added. A null id stays null, rows that repeat are
scanned one by one, empty tables give no rows, and only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from salesloom.llm.shared import fresh_name, literal_doubles, written

#: Fixed patterns of the rules: kind, pattern, group of the value, its least length.
RULES = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Long tokens of ordinary text or secrets.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: What a long token must look like to be a sample of an ordinary identifier: words, each capitalised or not.
IDENTIFIER = r"^[A-Z]?[a-z]+(?:[+/_=-]*[A-Z]?[a-z]{2,})*$"
#: Weight of a character's share of all characters in the estimate of a transition to it.
BACK_OFF = 8
#: Natural logarithm by which a transition must on average be likelier in a random string.
THRESHOLD = 0.5

#: Rows that a fold appends to one array, which it copies each time.
PART = 128

KINDS = (*(rule[0] for rule in RULES), "markov")
_SPAN = "struct<start:int,kind:int,end:int,value:string>"
_SPANS = f"array<{_SPAN}>"
_PIECE = "struct<from:int,to:int>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; a lambda would work it out for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _parts(rows: Column) -> Column:
    """An array in parts of ``PART`` elements; one empty part if it has none."""

    def cut(bound: Column) -> Column:
        last = F.floor((F.greatest(F.size(bound), F.lit(1)) - 1) / PART).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(bound, k * PART + 1, F.lit(PART)))

    return _let(rows, cut)


def _folded(rows: Column, zero: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """All that ``step(carry, row)`` finds, an array of ``kind`` besides the next carry, row by row."""

    def one(done: Column, row: Column) -> Column:
        carry, found = step(done["carry"], row)
        return F.struct(carry.alias("carry"), F.concat(done["found"], found).alias("found"))

    def part(done: Column, some: Column) -> Column:
        start = F.struct(done["carry"].alias("carry"), F.array().cast(f"array<{kind}>").alias("found"))

        def whole(end: Column) -> Column:
            return F.struct(end["carry"].alias("carry"), F.concat(done["found"], F.array(end["found"])).alias("found"))

        return F.aggregate(some, start, one, whole)

    start = F.struct(zero.alias("carry"), F.array().cast(f"array<array<{kind}>>").alias("found"))
    return F.aggregate(_parts(rows), start, part, lambda end: F.flatten(end["found"]))


def _matches(text: Column, pattern: str, kind: int, group: int, least: int) -> Column:
    """Spans of one rule: the gaps between the matches and the matches themselves add up to offsets."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.split(text, pattern, -1)
    rows = F.zip_with(
        F.zip_with(whole, values, lambda m, v: F.struct(F.length(m).alias("size"), v.alias("value"))),
        F.slice(gaps, F.lit(1), F.size(whole)),
        lambda m, gap: F.struct(F.length(gap).alias("gap"), m["size"].alias("size"), m["value"].alias("value")),
    )

    def following(at: Column, row: Column) -> tuple[Column, Column]:
        begin = at + row["gap"]
        end = begin + row["size"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), row["value"].alias("value"))
        return end, F.when(F.length(row["value"]) >= least, F.array(span)).otherwise(F.array().cast(_SPANS))

    found = _folded(rows, F.lit(0), _SPAN, following)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    return F.concat(*(_matches(text, p, kind, group, least) for kind, (_, p, group, least) in enumerate(RULES)))


def tokens(text: Column) -> Column:
    return _matches(text, TOKEN, len(RULES), 0, 0)


def _outside(found_tokens: Column, spans: Column) -> Column:
    """The tokens that overlap none of the spans: one sweep forward and one back over both, in order of start."""
    none = F.array().cast(_SPANS)
    token = len(RULES)

    def past(reached: Column, span: Column) -> tuple[Column, Column]:
        """Drops tokens that begin before the end of an earlier span."""
        is_token = span["kind"] == token
        kept = F.when(is_token & (span["start"] < reached), none).otherwise(F.array(span))
        return F.when(is_token, reached).otherwise(F.greatest(reached, span["end"])), kept

    def ahead(begin: Column, span: Column) -> tuple[Column, Column]:
        """Drops tokens that end behind the start of a later span, and the spans."""
        is_token = span["kind"] == token
        kept = F.when(is_token & (span["end"] <= begin), F.array(span)).otherwise(none)
        return F.when(is_token, begin).otherwise(span["start"]), kept

    forward = _folded(F.array_sort(F.concat(spans, found_tokens)), F.lit(0), _SPAN, past)
    back = F.reverse(_folded(F.reverse(forward), F.lit(2**31 - 1), _SPAN, ahead))
    return F.when((F.size(found_tokens) == 0) | (F.size(spans) == 0), found_tokens).otherwise(back)


def found(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, base (spans of the rules), others (long tokens outside of them); written, so texts are read once."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    rows = rows.select("id", base_spans(F.col("text")).alias("base"), tokens(F.col("text")).alias("tokens"))
    others = _outside(F.col("tokens"), F.col("base"))
    return written(rows.select("id", "base", others.alias("others")), "secret-spans")


def samples_of(rows: DataFrame) -> DataFrame:
    """value, random: the labelled samples that the rules give. Copies count once."""
    labelled = rows.select(
        F.explode(
            F.concat(
                F.transform("base", lambda s: F.struct(s["value"].alias("value"), F.lit(True).alias("random"))),
                F.transform(
                    F.filter("others", lambda s: s["value"].rlike(IDENTIFIER)),
                    lambda s: F.struct(s["value"].alias("value"), F.lit(False).alias("random")),
                ),
            )
        ).alias("sample")
    ).select("sample.*")
    return labelled.groupBy("value").agg(F.max("random").alias("random"))


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, "", -1), lambda c: c != "")


def transition_counts(samples: DataFrame) -> list[Row]:
    """random, first, second, n for the character pairs of the samples; at most 67 x 67 rows for either class."""
    known = F.filter(_characters(F.col("value")), lambda c: F.lit(ALPHABET).contains(c))
    pairs = samples.select("random", known.alias("characters")).select(
        "random",
        F.explode(
            F.zip_with(
                "characters",
                F.slice("characters", F.lit(2), F.size("characters")),
                lambda a, b: F.struct(a.alias("first"), b.alias("second")),
            )
        ).alias("pair"),
    )
    pairs = pairs.where("pair.second is not null").groupBy("random", "pair.first", "pair.second")
    return pairs.agg(F.count(F.lit(1)).alias("n")).collect()


def log_ratios(counts: list[Row]) -> list[float] | None:
    """Log of the transition probability in random strings over that in identifiers, by 128 * first + second."""
    if {row["random"] for row in counts} != {True, False}:
        return None
    n = {(row["random"], row["first"], row["second"]): row["n"] for row in counts}
    logs = {}
    for kind in (True, False):
        into = {b: sum(n.get((kind, a, b), 0) for a in ALPHABET) + 1 for b in ALPHABET}
        share = {b: into[b] / sum(into.values()) for b in ALPHABET}  # of a character wherever it stands
        for a in ALPHABET:
            total = sum(n.get((kind, a, b), 0) for b in ALPHABET) + BACK_OFF
            for b in ALPHABET:
                logs[kind, a, b] = math.log((n.get((kind, a, b), 0) + BACK_OFF * share[b]) / total)
    ratios = [0.0] * (128 * 128)
    for a in ALPHABET:
        for b in ALPHABET:
            ratios[128 * ord(a) + ord(b)] = logs[True, a, b] - logs[False, a, b]
    return ratios


def _random(token: Column, ratios: list[float]) -> Column:
    """Whether the mean log ratio of a token's transitions exceeds the threshold."""
    value = token["value"]
    value = F.when(value == F.upper(value), F.lower(value)).otherwise(value)  # a word in capitals is still a word
    codes = F.transform(_characters(value), F.ascii)
    table = literal_doubles(ratios)
    pairs = F.zip_with(codes, F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: a * 128 + b)
    total = F.aggregate(
        F.filter(pairs, lambda p: p.isNotNull()), F.lit(0.0), lambda sum_, p: sum_ + F.element_at(table, p + 1)
    )
    return total > THRESHOLD * (F.length(token["value"]) - 1)


def with_markov(base: Column, others: Column, ratios: list[float] | None) -> Column:
    """Base spans and the judged tokens, in order of start and kind."""
    if ratios is None:
        return F.array_sort(base)
    return F.array_sort(F.concat(base, F.filter(others, lambda t: _random(t, ratios))))


def learned(rows: DataFrame) -> list[float] | None:
    return log_ratios(transition_counts(samples_of(rows)))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, spans (start, kind as a number of ``KINDS``, end, value), base (the spans of the rules)."""
    rows = found(docs, id_column, text_column)
    spans = with_markov(F.col("base"), F.col("others"), learned(rows))
    return rows.select(F.col("id").alias(id_column), spans.alias("spans"), F.array_sort("base").alias("base"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redacted(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``[secret]``; spans that overlap by one mark together.

    All other columns stay as they are, whatever their names. A null text stays null.
    """
    base, found_tokens, plain = fresh_name("base"), fresh_name("tokens"), fresh_name("plain")
    ratios = learned(found(docs, id_column, text_column))
    text = F.col(text_column)
    anything = text.rlike("|".join(f"(?:{rule[1]})" for rule in RULES)) | text.rlike(TOKEN)
    rows = docs.withColumns({base: base_spans(text), found_tokens: tokens(text)})
    spans = with_markov(F.col(base), _outside(F.col(found_tokens), F.col(base)), ratios)
    size = F.length(text)
    last = F.struct(size.alias("start"), F.lit(0).alias("kind"), size.alias("end"), F.lit("").alias("value"))

    def between(at: Column, span: Column) -> tuple[Column, Column]:
        """What lies between the marks; a span that begins before the end of an earlier one makes the mark longer."""
        piece = F.struct(at.alias("from"), span["start"].alias("to"))
        kept = F.when(span["start"] >= at, F.array(piece)).otherwise(F.array().cast(f"array<{_PIECE}>"))
        return F.greatest(at, span["end"]), kept

    def marked(pieces: Column) -> Column:
        begin = F.element_at(pieces, 1)["from"]
        part = F.substring(text, begin + 1, F.element_at(pieces, -1)["to"] - begin)
        return _let(
            F.struct(part.alias("text"), begin.alias("begin"), pieces.alias("pieces")),
            lambda bound: F.array_join(
                F.transform(
                    bound["pieces"],
                    lambda p: F.substring(bound["text"], p["from"] - bound["begin"] + 1, p["to"] - p["from"]),
                ),
                "[secret]",
            ),
        )

    rows = rows.withColumn(plain, _folded(F.concat(spans, F.array(last.cast(_SPAN))), F.lit(0), _PIECE, between))
    clean = F.array_join(F.transform(_parts(F.col(plain)), marked), "[secret]")
    return rows.withColumn(text_column, F.when(anything, clean).otherwise(text)).drop(base, found_tokens, plain)
