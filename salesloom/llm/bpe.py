"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding.

Words are the matches of a pattern. Their counts over all documents give the ``DICTIONARY`` commonest, which are
encoded once: a fold of Spark's higher-order functions starts from the word's single bytes and joins, step by step, the
leftmost neighbours of lowest rank; ranks come from a literal map, dealt into buckets by a checksum because Spark
searches a map from its first entry. The dictionary, of bounded size, is broadcast, and a pass over the documents
replaces their words by ids. Decoding concatenates the byte pieces of the ids.

The words that the dictionary lacks are merged by the same rule in the tasks, each once per remembered fragment: there
are many of them, nearly all of which occur once, and folding them in place took several times the check's limit (see
the README). Long words are merged with a heap, because the fold and a plain loop take quadratic time.

A null text counts as empty and has no ids. Null ids of documents stay null, rows that repeat are encoded one by one,
extra columns are not read, and an empty table gives no rows. Texts are encoded without special tokens: their strings
are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.shared import parts_for, written

#: Words with ids of their own in the broadcast dictionary, at most.
DICTIONARY = 1 << 18
#: Words of more bytes are merged with a heap and are not in the dictionary.
LONG_BYTES = 256
#: Fragments a task counts or remembers before it starts anew.
REMEMBERED = 400_000
BUCKETS = 1 << 14
#: Bytes of ids or text in a batch on its way to the JVM.
BATCH_BYTES = 8 << 20
_NEVER = (1 << 31) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a token in base64 and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


# The fold ----------------------------------------------------------------------------------------------------------


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal: an array of small maps from the hexadecimal token to its rank."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        key = token.hex()
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def encoded_words(words: Column, ranks: dict[bytes, int]) -> Column:
    """Ids (array<array<int>>) of an array of words. The literal stands in the expression once: tasks receive it."""
    return _let(rank_literal(ranks), lambda table: F.transform(words, lambda word: folded(word, table)))


def folded(word: Column, table: Column) -> Column:
    """Ids (array<int>) of one word."""

    def rank(token: Column) -> Column:
        bucket = (F.crc32(token) % BUCKETS + 1).cast("int")
        return F.element_at(F.element_at(table, bucket), token)

    def pair(left: Column, right: Column) -> Column:
        return F.coalesce(rank(F.concat(left, right)), F.lit(_NEVER))

    def part(state: Column, at: Column) -> Column:
        return F.get(state["parts"], at - 1)

    def merged(state: Column, at: Column) -> Column:
        """The state after parts ``at`` and ``at + 1`` have become one."""
        size = F.size(state["parts"])
        new = F.concat(part(state, at), part(state, at + 1))
        before = F.when(at > 1, F.array(pair(part(state, at - 1), new))).otherwise(F.array().cast("array<int>"))
        after = F.when(at + 2 <= size, F.array(pair(new, part(state, at + 2)))).otherwise(F.array().cast("array<int>"))
        return F.struct(
            F.concat(F.slice(state["parts"], F.lit(1), at - 1), F.array(new), F.slice(state["parts"], at + 2, size)).alias(
                "parts"
            ),
            F.concat(
                F.slice(state["ranks"], F.lit(1), F.greatest(at - 2, F.lit(0))),
                before,
                after,
                F.slice(state["ranks"], at + 2, size),
            ).alias("ranks"),
        )

    def step(state: Column, _: Column) -> Column:
        return _let(
            F.coalesce(F.array_min(state["ranks"]), F.lit(_NEVER)),
            lambda least: F.when(least == _NEVER, state).otherwise(
                _let(F.array_position(state["ranks"], least).cast("int"), lambda at: merged(state, at))
            ),
        )

    def merges(key: Column) -> Column:
        size = (F.length(key) / 2).cast("int")
        single = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(key, 2 * i - 1, F.lit(2)))
        following = F.slice(single, F.lit(2), size)
        pairs = F.slice(F.zip_with(single, following, pair), F.lit(1), size - 1)
        start = F.struct(single.alias("parts"), pairs.alias("ranks"))
        steps = F.sequence(F.lit(2), size)
        return F.aggregate(steps, start, step, lambda state: F.transform(state["parts"], rank))

    def whole(key: Column) -> Column:
        found = rank(key)
        return F.when(found.isNotNull(), F.array(found)).otherwise(merges(key))

    return _let(F.lower(F.hex(word)), whole)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in Python."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_BYTES:
        return merged_with_heap(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, _NEVER) for a, b in pairwise(parts)]
    while pairs and (least := min(pairs)) < _NEVER:
        at = pairs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], _NEVER)
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], _NEVER)
    return [ranks[p] for p in parts]


def merged_with_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word: a heap of pairs and links between the parts that are left."""
    parts = [word[i : i + 1] for i in range(len(word))]
    after = [*range(1, len(parts)), -1]
    before = [-1, *range(len(parts) - 1)]
    heap: list[tuple[int, int, bytes]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] >= 0:
            joined = parts[at] + parts[after[at]]
            if joined in ranks:
                heapq.heappush(heap, (ranks[joined], at, joined))

    for at in range(len(parts)):
        offer(at)
    while heap:
        _, at, joined = heapq.heappop(heap)
        if not parts[at] or after[at] < 0 or parts[at] + parts[after[at]] != joined:
            continue  # one of the two parts has been joined with another meanwhile
        gone = after[at]
        parts[at], parts[gone] = joined, b""
        after[at] = after[gone]
        if after[at] >= 0:
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [ranks[p] for p in parts if p]


# Words -------------------------------------------------------------------------------------------------------------


#: White space other than the plain space.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


class Words:
    """Words of texts by a pattern. Texts are cut before single spaces between other characters, where the pattern
    cuts too, so each distinct fragment is matched once."""

    def __init__(self, pattern: str):
        import regex

        self._find = regex.compile(pattern).findall

    def of(self, text: str) -> list[str]:
        return self._find(text)

    def fragments(self, text: str) -> list[str] | None:
        """The fragments without their leading spaces (the first has none), or None if the text can't be cut so."""
        if "  " in text or text.endswith(" "):
            return None
        for space in _SPACES:
            if space in text and (space + " " in text or " " + space in text):
                return None
        return text.split(" ")


@functools.lru_cache(maxsize=2)
def words_of(pattern: str) -> Words:
    return Words(pattern)


def word_counts(texts: DataFrame, pattern: str) -> DataFrame:
    """word, n over all rows of ``texts`` (one column, text), counted in tasks before they are dealt out."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, fragments, firsts = words_of(pattern), Counter(), Counter()

        def out() -> Iterator[pa.RecordBatch]:
            found: Counter[str] = Counter()
            for lead, counter in ((" ", fragments), ("", firsts)):
                for fragment, n in counter.items():
                    for word in words.of(lead + fragment):
                        if len(word) <= LONG_BYTES // 4:  # longer ones are rare and never in the dictionary
                            found[word] += n
                counter.clear()
            columns = [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for value in batch.column("text"):
                text = value.as_py()
                parts = words.fragments(text)
                if parts is None:
                    firsts[text] += 1
                else:
                    firsts[parts[0]] += 1
                    fragments.update(parts[1:])
                if len(fragments) + len(firsts) > REMEMBERED:
                    yield from out()
        yield from out()

    rows = texts.mapInArrow(counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(texts: DataFrame, pattern: str, ranks: dict[bytes, int]) -> dict[str, bytes]:
    """Ids of the commonest words: whole classes of like counts, so far as they have at most DICTIONARY words."""
    counts = written(word_counts(texts, pattern), "words").withColumn("size", F.floor(F.log2("n") * 8))
    room, least = DICTIONARY, None
    for row in counts.groupBy("size").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("size")).collect():
        room -= row["words"]
        if room < 0:
            break
        least = row["size"]
    if least is None:
        return {}
    chosen = counts.where(F.col("size") >= least).select("word").repartition(parts_for(texts))
    chosen = chosen.select("word", F.element_at(encoded_words(F.array("word"), ranks), 1).alias("ids"))
    return {row["word"]: np.asarray(row["ids"], "<u4").tobytes() for row in chosen.toLocalIterator()}


# Documents ---------------------------------------------------------------------------------------------------------


class _Lookup:
    """Ids of whole texts; remembers fragments."""

    def __init__(self, pattern: str, known: dict[str, bytes], ranks: dict[bytes, int]):
        self._words, self._known, self._ranks = words_of(pattern), known, ranks
        self._fragments: dict[str, bytes] = {}

    def _looked_up(self, text: str) -> bytes:
        found = []
        for word in self._words.of(text):
            ids = self._known.get(word)
            if ids is None:
                ids = np.asarray(merged(word.encode(), self._ranks), "<u4").tobytes()
            found.append(ids)
        return b"".join(found)

    def _of_fragment(self, fragment: str) -> bytes:
        if len(self._fragments) >= REMEMBERED:
            self._fragments.clear()
        found = self._fragments[fragment] = self._looked_up(" " + fragment)
        return found

    def ids(self, text: str) -> bytes:
        parts = self._words.fragments(text)
        if parts is None:
            return self._looked_up(text)
        get = self._fragments.get
        return b"".join([self._looked_up(parts[0]), *[get(p) or self._of_fragment(p) for p in parts[1:]]])


def _batches(rows: Iterable[tuple], kinds: list[pa.DataType], names: list[str], size) -> Iterator[pa.RecordBatch]:
    """Record batches of about BATCH_BYTES by ``size`` of a row."""
    held, held_bytes = [], 0

    def out() -> pa.RecordBatch:
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for row in rows:
        held.append(row)
        held_bytes += size(row)
        if held_bytes >= BATCH_BYTES:
            yield out()
            held, held_bytes = [], 0
    if held:
        yield out()


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, ids (little-endian unsigned 32-bit integers) of every whole text."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext
    known = context.broadcast(dictionary(rows.select("text"), pattern, ranks))  # at most DICTIONARY words
    sent = context.broadcast(ranks)

    def looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(pattern, known.value, sent.value)
        for batch in batches:
            found = ((i.as_py(), lookup.ids(t.as_py())) for i, t in zip(batch["id"], batch["text"], strict=True))
            kinds = [batch.schema.field("id").type, pa.binary()]
            yield from _batches(found, kinds, ["id", "ids"], lambda row: len(row[1]) + 64)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(looked_up, f"id {kind}, ids binary").withColumnRenamed("id", id_column)


def decode(rows: DataFrame, ranks: dict[bytes, int], id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """id, ids, bytes: the concatenated pieces of the ids."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    sent = rows.sparkSession.sparkContext.broadcast(tokens)

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(sent.value, pa.binary())

        def content(ids: bytes) -> bytes:
            taken = pieces.take(pa.array(np.frombuffer(ids, "<u4")))  # its pieces lie one after the other
            return taken.buffers()[2].to_pybytes() if ids else b""

        for batch in batches:
            held = ((i.as_py(), ids.as_py() or b"") for i, ids in zip(batch["id"], batch["ids"], strict=True))
            found = ((i, ids, content(ids)) for i, ids in held)
            kinds = [batch.schema.field("id").type, pa.binary(), pa.binary()]
            yield from _batches(found, kinds, ["id", "ids", "bytes"], lambda row: len(row[1]) + len(row[2]) + 64)

    rows = rows.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(decoded, f"id {kind}, ids binary, bytes binary").withColumnRenamed("id", id_column)
