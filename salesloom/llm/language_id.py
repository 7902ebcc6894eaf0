"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds every substring of a sample of labelled text. A text is parsed from left to
right into phrases, each the longest match in the automaton and the character that ends it (Ziv and Merhav, 1993).
The phrases, each weighted by the logarithm of the sample's length, estimate the cross entropy of the text and the
language; the language with the smallest product wins, ties go to the smaller name. Texts are parsed as lower-case letters, with one
separator for any run of other characters, whole, in segments of ``SEGMENT`` characters; many segments take a step
through all automata together.

Samples are at most ``SAMPLE_CHARS`` characters of each language, from at most ``SAMPLE_DOCS`` different labelled texts
chosen by their hash. A text gives a passage of at most ``PASSAGE`` characters from a place that its hash chooses, and
passages are cut to one length where together they are longer than a sample. Only these samples leave the cluster's
tables; every Python worker builds its automata from them once. More than ``MAX_LANGUAGES`` labels are an error. Every
letter of the samples has a symbol of its own; letters that no sample has are alike, as none of them continues a match.

A text whose letters no sample has gets the language of the shortest sample. A null text and a text without a letter give ``und`` with score 0, and so does any text if nothing was learned. With
one language every other text gets it with score 1; else the score is the runner-up's share of the sum of both
products, from 0.5 to 1. Rows without a language or an id are not learned from. Rows that repeat are answered alike.
Only the named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_CHARS = 1 << 15
SAMPLE_DOCS = 64
MAX_LANGUAGES = 64
#: Characters of one text in a sample at most.
PASSAGE = SAMPLE_CHARS // 8
SEGMENT = 512
#: Entries of a table of all (state, symbol) at most; beyond it only the transitions that exist are kept, sorted.
TABLE_CELLS = 1 << 25
#: Symbols parsed together.
TOGETHER = 1 << 20

UNDETERMINED = "und"


def _automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the root."""
    following: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for symbol in text.tolist():
        new = len(following)
        following.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in following[at]:
            following[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = following[at][symbol]
            if longest[at] + 1 == longest[target]:
                link[new] = target
            else:
                twin = len(following)
                following.append(dict(following[target]))
                longest.append(longest[at] + 1)
                link.append(link[target])
                while at >= 0 and following[at].get(symbol) == target:
                    following[at][symbol] = twin
                    at = link[at]
                link[target] = link[new] = twin
        last = new
    return following


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@functools.lru_cache(maxsize=1)
def _lowered() -> np.ndarray:
    """Lower-case letter of every code point, 0 for those that are no letters."""
    letters = filter(str.isalpha, map(chr, range(sys.maxunicode + 1)))
    pairs = np.array([(ord(c), ord(c.lower()[0])) for c in letters], np.int32)
    table = np.zeros(sys.maxunicode + 1, np.int32)
    table[pairs[:, 0]] = pairs[:, 1]
    return table


class Parser:
    """The automata of all languages: (state, symbol) gives the next state, or the complement of the state after the
    symbol has ended a phrase. Symbol 0 is a separator, the last one stands for all letters that no sample has."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in samples]
        letters = np.unique(np.concatenate([np.zeros(1, np.int32), *(_lowered()[_codes(text)] for _, text in samples)]))
        self._width = len(letters) + 1
        lowered = _lowered()
        place = np.minimum(np.searchsorted(letters, lowered), len(letters) - 1)
        self._symbol_of = np.where(letters[place] == lowered, place, self._width - 1).astype(np.int32)
        self._roots, self._weights, size = [], [], 0
        keys, targets, symbol_after = [], [], []
        for _, text in samples:
            symbols = self.symbols(text)[:SAMPLE_CHARS]
            following = _automaton(symbols)
            for state, row in enumerate(following, size):
                keys.append(np.fromiter(row, np.int64, len(row)) + state * self._width)
                targets.append(np.fromiter(row.values(), np.int32, len(row)) + np.int32(size))
            fallback = np.full(self._width, ~size, np.int64)
            for symbol, state in following[0].items():
                fallback[symbol] = ~(state + size)
            symbol_after.append(fallback)
            self._roots.append(size)
            self._weights.append(math.log2(len(symbols) + 2))
            size += len(following)
        self._keys, self._targets = np.concatenate(keys), np.concatenate(targets)
        order = np.argsort(self._keys)
        self._keys, self._targets = self._keys[order], self._targets[order]
        self._after = np.concatenate(symbol_after).astype(np.int32)  # by language and symbol
        self._table = None
        if size * self._width <= TABLE_CELLS:
            counts = np.diff([*self._roots, size])
            self._table = np.repeat(self._after.reshape(len(counts), -1), counts, axis=0).ravel()
            self._table[self._keys] = self._targets

    def _following(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Next states of all languages (rows) and segments (columns)."""
        at = states * self._width
        at += symbols
        if self._table is not None:
            return self._table.take(at)
        place = np.minimum(np.searchsorted(self._keys, at), len(self._keys) - 1)
        languages = np.arange(len(self._roots))[:, None] * self._width
        return np.where(self._keys[place] == at, self._targets[place], self._after[languages + symbols])

    def symbols(self, text: str) -> np.ndarray:
        found = self._symbol_of[_codes(text)]
        return found[(found != 0) | np.concatenate([[True], found[:-1] != 0])]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Weighted phrases per language (rows) and text (columns)."""
        data = np.concatenate(texts)
        ends = np.cumsum([len(t) for t in texts])
        starts = np.concatenate([np.arange(e - len(t), e, SEGMENT) for e, t in zip(ends, texts, strict=True)])
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // SEGMENT) for t in texts])
        lengths = np.minimum(SEGMENT, ends[owner] - starts)
        order = np.argsort(-lengths, kind="stable")
        starts, owner, lengths = starts[order], owner[order], lengths[order]
        roots = np.array(self._roots, np.int64)[:, None]
        states = np.repeat(roots, len(starts), axis=1)
        counts = np.zeros(states.shape, np.int64)
        active = np.searchsorted(-lengths, -np.arange(SEGMENT), side="left")  # segments longer than each step
        for step in range(int(lengths[0]) if len(lengths) else 0):
            n = active[step]
            following = self._following(states[:, :n], data[starts[:n] + step])
            counts[:, :n] += following < 0
            following ^= following >> 31
            states[:, :n] = following
        counts += states != roots
        total = np.zeros((len(roots), len(texts)))
        for row, found in zip(total, counts, strict=True):
            row += np.bincount(owner, weights=found, minlength=len(texts))
        return total * np.array(self._weights)[:, None]

    def identify(self, texts: list[str]) -> list[tuple[str, float]]:
        found = [self.symbols(text) for text in texts]
        known = [s.any() or any(map(str.isalpha, t)) for s, t in zip(found, texts, strict=True)]
        answers = [(UNDETERMINED, 0.0)] * len(texts)
        chosen = [i for i, k in enumerate(known) if k]
        if chosen:
            total = self.phrases([found[i] for i in chosen])
            best = total.argmin(axis=0)  # names are in order, so the first of equals
            for column, i in enumerate(chosen):
                least = total[best[column], column]
                rest = np.delete(total[:, column], best[column])
                second = rest.min() if len(rest) else math.inf
                score = 1.0 if math.isinf(second) else second / (least + second) if least + second else 0.5
                answers[i] = self.names[best[column]], float(score)
        return answers


@functools.lru_cache(maxsize=1)
def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(samples)


def learn(
    docs: DataFrame, learnable: Column, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> tuple[tuple[str, str], ...]:
    """(language, sample) in order of names, from the rows that satisfy ``learnable``."""
    named = F.col(lang_column).isNotNull() & F.col(text_column).isNotNull() & F.col(id_column).isNotNull()
    texts = docs.where(learnable & named).select(
        F.col(lang_column).alias("lang"), F.xxhash64(text_column).alias("turn"), F.col(text_column).alias("text")
    )
    turns = texts.select("lang", "turn").distinct()
    turns = turns.withColumn("number", F.row_number().over(W.partitionBy("lang").orderBy("turn")))
    turns = turns.where(F.col("number") <= SAMPLE_DOCS).limit(MAX_LANGUAGES * SAMPLE_DOCS + 1)
    places = F.greatest(F.length("text") - PASSAGE + 1, F.lit(1))
    passage = F.substring("text", (F.pmod("turn", places) + 1).cast("int"), F.lit(PASSAGE))
    rows = texts.join(F.broadcast(turns), ["lang", "turn"]).select("lang", "number", passage.alias("passage"))
    passages: dict[str, list[tuple[int, str]]] = {}
    for row in rows.distinct().limit(2 * MAX_LANGUAGES * SAMPLE_DOCS).collect():
        passages.setdefault(row.lang, []).append((row.number, row.passage))
    if len(passages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return tuple((lang, _sample([p for _, p in sorted(found)])) for lang, found in sorted(passages.items()))


def _sample(passages: list[str]) -> str:
    """Passages joined, those cut that are longer than an even share of what the shorter ones leave."""
    left, share = SAMPLE_CHARS - len(passages), 0
    for shorter, size in enumerate(sorted(map(len, passages))):
        share = left // (len(passages) - shorter)
        if size > share:
            break
        left -= size
    else:
        share = PASSAGE
    return " ".join(p[:share] for p in passages)


def identified(
    docs: DataFrame, samples: tuple[tuple[str, str], ...], id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, lang_pred, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(samples)

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers: list[tuple[str, float]] = []
            texts = [text.as_py() or "" for text in batch.column("text")]
            if sent.value:
                known, group, size = parser(sent.value), [], 0
                for text in texts:
                    group.append(text)
                    size += len(text)
                    if size >= TOGETHER:
                        answers += known.identify(group)
                        group, size = [], 0
                answers += known.identify(group)
            else:
                answers = [(UNDETERMINED, 0.0)] * len(texts)
            names, scores = (list(column) for column in zip(*answers, strict=True)) if answers else ([], [])
            arrays = [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [id_column, "lang_pred", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(answer, f"`{id_column}` {kind}, lang_pred string, score double")
