"""Token ids of whole texts by a byte-level BPE of the ``tokenizers`` library, one call per distinct fragment.

A text is cut before every single space between two characters that are not white space. The pre-tokenizer of
byte-level BPE always cuts there too, so the fragments can be encoded by themselves, and natural text repeats them.
A text with any other white space next to a space is encoded as it is.

A space and letters are one pre-token, so they need the merges only. These are done by ``tiktoken``, which joins the two
neighbours whose joint bytes have the lowest rank, however they are cut. This is the same as the listed merges if every
token, encoded by itself, gives that one token: two neighbours that make up a token's bytes were made by merges inside
these bytes alone, hence are the two that the list joins last. A vocabulary is asked for this when it is loaded; one
without this property, or with a normalizer, takes the way of all other fragments.
"""

from __future__ import annotations

import functools
import json
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fragments a task remembers; about 200 bytes each.
REMEMBERED = 800_000
#: Characters of texts whose fragments are looked up together.
TOGETHER = 1 << 22
#: Fragments that are encoded as one text.
LINES = 1024


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)).difference(plain))
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _merger(tokenizer_json: str, model):
    """(tiktoken encoding for lines of letters, token id of each of its ranks), or None if results could differ."""
    import tiktoken

    parts = json.loads(tokenizer_json)
    settings = parts["model"]
    letters = _byte_letters()
    added = [token["content"] for token in parts.get("added_tokens") or []]
    if parts.get("normalizer") or settings.get("dropout") or not letters.keys() <= settings["vocab"].keys():
        return None
    if settings.get("continuing_subword_prefix") or settings.get("end_of_word_suffix"):
        return None
    if any(all(c == " " or c.isalpha() for c in content) for content in added):  # would be found inside of words
        return None
    pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in settings["merges"]]
    tokens = [*letters, *map("".join, pairs)]
    whole = all([found.value for found in model.tokenize(token)] == [token] for token in tokens)
    if not whole or len(set(tokens)) < len(tokens):
        return None
    ranks = {bytes(map(letters.__getitem__, token)): rank for rank, token in enumerate(tokens)}
    encoding = tiktoken.Encoding("merges", pat_str=r"\n| [^\n]+", mergeable_ranks=ranks, special_tokens={})
    return encoding, np.array([settings["vocab"][token] for token in tokens], dtype="<u4")


class Encoder:
    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer_json)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        (self._break,) = self._tokenizer.encode("\n", add_special_tokens=False).ids
        self._merger = _merger(tokenizer_json, self._tokenizer.model)
        self._known: dict[str, bytes | None] = {}
        self._ends: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(one.ids, dtype="<u4").tobytes() for one in found]

    def _learn(self, fragments: set[str]) -> None:
        known = self._known
        new = fragments.difference(known)
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            self._ends.clear()
            new = fragments
        plain, lined, marked = [], [], []
        for fragment in new:
            stem = fragment.rstrip(string.punctuation)
            if len(stem) < len(fragment) and stem.isalpha():  # the pre-tokenizer cuts between letters and marks
                marked.append((fragment, stem, fragment[len(stem) :]))
            elif fragment.isprintable() and fragment:  # without any white space
                plain.append(fragment)
            elif all(line.isprintable() and line for line in fragment.split("\n")):
                lined.append(fragment)
            elif fragment and not fragment[0].isspace() and not fragment[-1].isspace():
                known[fragment] = self._encoded([" " + fragment])[0]
            else:
                known[fragment] = None  # more white space than one space at this place
        stems = {stem for _, stem, _ in marked}.difference(known)
        stems.update(plain)
        letters = [f for f in stems if f.isalpha()]
        others = [f for f in stems if not f.isalpha()]
        for fragments, by_merges in ((letters, self._merger), (others + lined, None)):
            for start in range(0, len(fragments), LINES):
                self._learn_lines(fragments[start : start + LINES], by_merges)
        ends = list({end for *_, end in marked}.difference(self._ends))
        self._ends.update(zip(ends, self._encoded(ends), strict=True))
        for fragment, stem, end in marked:
            known[fragment] = known[stem] + self._ends[end]

    def _learn_lines(self, fragments: list[str], by_merges) -> None:
        """Fragments are encoded as the lines of one text: a line break is a token by itself unless white space precedes
        it or two follow each other. A fragment may hold such line breaks too."""
        text = " " + "\n ".join(fragments) + "\n"
        if by_merges:
            encoding, ids_of_ranks = by_merges
            ids = ids_of_ranks[encoding.encode_to_numpy(text, disallowed_special=())]
        else:
            ids = np.asarray(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        last = np.cumsum([fragment.count("\n") + 1 for fragment in fragments]) - 1
        ends = (4 * np.flatnonzero(ids == self._break)[last]).tolist()
        data, begins = ids.tobytes(), [0, *(end + 4 for end in ends[:-1])]
        self._known.update(zip(fragments, [data[b:e] for b, e in zip(begins, ends, strict=True)], strict=True))

    def forget(self) -> None:
        """Drops the remembered fragments."""
        self._known, self._ends = {}, {}

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        group, chars = [], 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars >= TOGETHER:
                yield from self._group(group)
                group, chars = [], 0
        if group:
            yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        """Every distinct fragment is looked up once; numpy puts the ids of all texts together."""
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = parts.offsets.to_numpy()
        starts, size = starts[:-1], starts[-1]
        coded = parts.values.dictionary_encode()
        places = coded.indices.to_numpy().copy()
        distinct = coded.dictionary.to_pylist()
        later = np.ones(size, dtype=bool)
        later[starts] = False  # the first fragment of a text has no space before it
        used = np.bincount(places[later], minlength=len(distinct)) > 0
        self._learn({fragment for fragment, is_used in zip(distinct, used.tolist(), strict=True) if is_used})
        firsts = [distinct[place] for place in places[starts].tolist()]
        places[starts] = np.arange(len(distinct), len(distinct) + len(texts))
        found = [*map(self._known.get, distinct), *self._encoded(firsts)]

        unknown = np.fromiter((ids is None for ids in found), dtype=bool, count=len(found))
        whole = np.logical_or.reduceat(unknown[places], starts)
        several = np.diff(starts, append=size) > 1
        whole |= several & np.fromiter((f[-1:].isspace() for f in firsts), dtype=bool, count=len(firsts))

        lengths = np.fromiter((len(ids or b"") // 4 for ids in found), dtype=np.int64, count=len(found))
        table = np.frombuffer(b"".join(ids or b"" for ids in found), dtype="<u4")
        begins = np.cumsum(lengths) - lengths
        counts = lengths[places]
        ends = np.cumsum(counts)
        ids = table[np.repeat(begins[places] - (ends - counts), counts) + np.arange(ends[-1])]
        limits = [0, *ends[np.append(starts[1:], size) - 1].tolist()]
        for number, (text, by_itself) in enumerate(zip(texts, whole.tolist(), strict=True)):
            if by_itself:
                yield self._encoded([text])[0]
            else:
                yield ids[limits[number] : limits[number + 1]].tobytes()


@functools.lru_cache(maxsize=2)
def encoder(tokenizer_json: str) -> Encoder:
    """One encoder per Python worker, so later tasks need not load it again; each forgets its fragments at its end."""
    return Encoder(tokenizer_json)
