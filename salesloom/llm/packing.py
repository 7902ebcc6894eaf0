"""Hierarchical multi-length packing of documents into fixed-size training sequences.

A document's ids, ended by an end id, first fill whole windows of the longest tier. What is left is routed to the
shortest tier (2048, 1024, 512 or 256 ids) that holds it. Tiers are packed from long to short: a document of the
tier opens a window, and the gap is filled from the shorter tiers, with the longest document that fits or, if none
does, with a cut from the shortest one. Every window is full, so no sequence is padded; the last ids of a partition
go to windows of smaller powers of two. Full windows are dealt to step groups of one tier and equal token budget so
that the groups have about the same attention cost (the sum of squared piece lengths).

Every scan partition packs its own documents in one pass with a bounded pool, without a shuffle: a partition that
runs again gives the same rows. A null text counts as empty and gives the end id alone; a null id stays null; rows
that repeat an id are packed one by one. Only the two named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm import words
from salesloom.llm.shared import lean

TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: Ids that wait in a partition's pool before they are packed together.
POOL_IDS = 1 << 21
#: Ids of a step group: 16 windows of the longest tier, or as many ids in shorter ones.
STEP_IDS = 16 * TIERS[0]

_SCHEMA = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, "
    "tier int, step_group long"
)


class _Packer:
    """Packs the documents of one partition. A tail is (length, serial, doc_id, start, bytes, doc_tokens)."""

    def __init__(self, partition: int):
        self._sequence = self._group = partition << 32
        self._pool: list[tuple] = []
        self._full: list[list[tuple]] = []
        self.waiting = self._serial = 0

    def add(self, doc_id, ids: bytes) -> None:
        tokens, window = len(ids) // 4, TIERS[0]
        self.waiting += tokens
        for start in range(0, tokens - tokens % window, window):
            self._full.append([(window, 0, doc_id, start, ids[4 * start : 4 * (start + window)], tokens)])
        if tokens % window:
            start = tokens - tokens % window
            self._put(doc_id, start, ids[4 * start :], tokens)

    def _put(self, doc_id, start: int, ids: bytes, tokens: int) -> None:
        self._serial += 1
        insort(self._pool, (len(ids) // 4, self._serial, doc_id, start, ids, tokens))

    def _cut(self, tail: tuple, length: int) -> tuple:
        """The first ``length`` ids of a longer tail; the others go back to the pool."""
        _, serial, doc_id, start, ids, tokens = tail
        self._put(doc_id, start + length, ids[4 * length :], tokens)
        return length, serial, doc_id, start, ids[: 4 * length], tokens

    def _window(self, size: int) -> list[tuple]:
        pieces, gap = [], size
        while gap:
            at = bisect_right(self._pool, (gap, self._serial + 1)) - 1
            if not pieces:
                at = len(self._pool) - 1  # the longest opens the window
            tail = self._pool.pop(max(at, 0))
            if tail[0] > gap:
                tail = self._cut(tail, gap)
            pieces.append(tail)
            gap -= tail[0]
        return pieces

    def packed(self, last: bool) -> Iterator[tuple]:
        """Rows of all windows that can be filled; with ``last`` none of the ids stays."""
        tiers = {TIERS[0]: self._full}
        rest = sum(tail[0] for tail in self._pool)
        small = [1 << k for k in range(TIERS[-1].bit_length() - 2, -1, -1)] if last else []
        for size in (*TIERS, *small):
            least = size // 2 if size in TIERS[:-1] else 0
            while rest >= size and self._pool[-1][0] > least:
                tiers.setdefault(size, []).append(self._window(size))
                rest -= size
        self._full, self.waiting = [], rest
        for size, windows in tiers.items():
            yield from self._grouped(size, windows)

    def _grouped(self, size: int, windows: list[list[tuple]]) -> Iterator[tuple]:
        groups = -(-len(windows) * size // STEP_IDS)
        windows.sort(key=lambda pieces: -sum(p[0] ** 2 for p in pieces))  # stable: the same rows on every run
        for number, pieces in enumerate(windows):
            turn, place = divmod(number, groups)
            group = self._group + (groups - 1 - place if turn % 2 else place)
            offset = 0
            for length, _, doc_id, start, ids, tokens in pieces:
                yield doc_id, start, length, zlib.crc32(ids), tokens, self._sequence, offset, size, group, ids
                offset += length
            self._sequence += 1
        self._group += groups


def pack(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, ids.

    ``ids`` holds little-endian unsigned 32-bit integers; ``with_ids=False`` leaves them out.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    schema = _SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString()) + ", ids binary" * with_ids
    end = END_ID.to_bytes(4, "little")

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = words.encoder(tokenizer.value)
        try:
            yield from packed_by(encoder, batches)
        finally:
            encoder.forget()

    def packed_by(encoder: words.Encoder, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId())

        def out(last: bool) -> Iterator[pa.RecordBatch]:
            columns = list(zip(*packer.packed(last), strict=True))
            if columns:
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names)

        kinds = None
        for batch in batches:
            if kinds is None:
                kinds = [batch.schema.field("doc_id").type, *[pa.int64()] * 6, pa.int32(), pa.int64()]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier"]
                names += ["step_group"]
                if with_ids:
                    kinds.append(pa.binary())
                    names.append("ids")
            ids = encoder.encode(text.as_py() for text in batch.column("text"))
            for doc_id, tokens in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                packer.add(doc_id, tokens + end)
                if packer.waiting >= POOL_IDS:
                    yield from out(last=False)
        if kinds is not None:
            yield from out(last=True)

    return rows.mapInArrow(lean(packed), schema)
