"""Cheapest repair of the turn structure of conversations by depth-first branch and bound.

A conversation's rows come by turn (nulls first); rows of one turn come by role, then by the first ``PREFIX`` characters
of the text, then by a digest of it. The first fault of a row counts: blank (no character but white space), duplicate
(role and text seen earlier), truncated (the last character that is not white space is none of ``.!?``). Edits are Keep
(0), Rerole to user or assistant (3), Delete (4; blank and duplicate rows have to go) and Insert of a user or assistant
row without text (3); a truncated row that stays costs 3 more. The cheapest edits are wanted after which the initials
of the roles read ``(s?(ua)+)?``; of equally cheap ones, those whose initials in order (the audit) are least in ASCII.

``search`` walks the edits depth first over an explicit stack. A node is (rows consumed, last initial that stays). The
table of a node holds the least (cost, audit) it was reached with, and a prefix that isn't less is given up: at equal
costs two audits of one node differ before either ends, so their order is that of all their continuations. A prefix is
given up, too, when its cost and a lower bound for the remaining rows exceed the incumbent, or equal it with a greater
audit. The search ends with the stack, which proves the incumbent.

Rows are range-partitioned in their order without their texts, so a conversation of any length is spread over tasks.
A task solves conversations of at most ``SEGMENT`` rows that lie inside of it; of others it solves segments, for each
initial they may be entered with, and these few figures are joined per conversation. The repaired texts are streamed in
order, conversation by conversation.

A null role or text counts as one space. A role without characters has no initial and is not kept. Rows with a null
id are one conversation. Rows repeated with turn, role and text are duplicates. A conversation given in ``ids`` without
rows has zeros and an empty audit. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.shared import written

#: Rows that are searched together at most.
SEGMENT = 512
#: Characters of a text that rows of one turn are sorted by before its digest.
PREFIX = 32

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_REROLE, _DELETE, _INSERT, _TRUNCATED = 3, 4, 3, 3
#: A row as a byte: the state its initial leads to (0: none), plus marks.
CUT, MUST_GO = 4, 8
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_BLANK = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def _bounds(kinds: bytes) -> list[list[int]]:
    """Lower bounds by state and rows consumed.

    With nothing kept yet, every row at its cheapest. Later, the cheapest alternation of users and assistants whose
    end may be open.
    """
    n = len(kinds)
    empty, after_assistant, after_user = ([0] * (n + 1) for _ in range(3))
    for i in range(n - 1, -1, -1):
        kind = kinds[i]
        initial, cost = kind & 3, _TRUNCATED if kind & CUT else 0
        least = _DELETE if kind & MUST_GO else min(_DELETE, cost + (0 if initial else _REROLE))
        empty[i] = empty[i + 1] + least
        for own, other, fits, misfits in (
            (after_assistant, after_user, USER, ASSISTANT),
            (after_user, after_assistant, ASSISTANT, USER),
        ):
            low = _DELETE + own[i + 1]
            if not kind & MUST_GO:
                low = min(low, cost + (0 if initial == fits else _REROLE) + other[i + 1])
                if initial == misfits:
                    low = min(low, _INSERT + cost + own[i + 1])
            own[i] = low
    return [empty, after_assistant, after_user, after_assistant]


def search(kinds: bytes, entry: int = EMPTY, close: bool = True) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) by the state after the rows; with ``close`` only that of a complete conversation (EMPTY)."""
    n, low = len(kinds), _bounds(kinds)
    reached = {(0, entry): (0, "")}
    incumbent: dict[int, tuple[int, str]] = {}
    #: States that a state can end in.
    ends = {s: [EMPTY] if close else [USER, ASSISTANT] for s in (USER, ASSISTANT)}
    ends[SYSTEM] = [EMPTY] if close else [SYSTEM, USER, ASSISTANT]
    first = any(k & 3 == SYSTEM and not k & MUST_GO for k in kinds)
    ends[EMPTY] = [EMPTY] if close else [EMPTY, *[SYSTEM] * first, USER, ASSISTANT]
    if not n:
        ends = {s: [EMPTY if close else entry] for s in range(4)}

    def hopeless(i: int, state: int, cost: int, audit: str) -> bool:
        least = cost + low[state][i]
        for end in ends[state]:
            if end not in incumbent:
                return False
            best, best_audit = incumbent[end]
            if least < best or least == best and audit <= best_audit[: len(audit)]:
                return False
        return True

    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if reached[i, state] != (cost, audit) or hopeless(i, state, cost, audit):
            continue  # a better prefix came to this node, or nothing better can follow
        following = ASSISTANT if state == USER else USER
        moves = []
        if i < n:
            kind = kinds[i]
            moves.append((_DELETE, "D", i + 1, state))
            if not kind & MUST_GO:
                initial, more = kind & 3, _TRUNCATED if kind & CUT else 0
                if initial == following or initial == SYSTEM and state == EMPTY:
                    moves.append((more, "K", i + 1, initial))
                moves.append((_REROLE + more, "R", i + 1, following))
        elif not close or state in (EMPTY, ASSISTANT):
            end = EMPTY if close else state
            if end not in incumbent or (cost, audit) < incumbent[end]:
                incumbent[end] = cost, audit
        if i < n or close:
            moves.append((_INSERT, "I", i, following))
        ranked = sorted(((cost + c + low[s][j], letter, cost + c, j, s) for c, letter, j, s in moves), reverse=True)
        for _, letter, spent, j, s in ranked:  # the most promising edit ends on top of the stack
            label = spent, audit + letter
            if ((j, s) not in reached or label < reached[j, s]) and not hopeless(j, s, *label):
                reached[j, s] = label
                stack.append((j, s, *label))
    return incumbent


def joined(tables: Iterable[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, str]:
    """Least (cost, audit) of a conversation from its segments in order: entry state to the results of ``search``."""
    reached = {EMPTY: (0, "")}
    for table in tables:
        after: dict[int, tuple[int, str]] = {}
        for entry, (cost, audit) in reached.items():
            for end, (more, letters) in table[entry].items():
                label = cost + more, audit + letters
                if end not in after or label < after[end]:
                    after[end] = label
        reached = after
    inserts = {EMPTY: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
    return min((cost + _INSERT * inserts[s], audit + "I" * inserts[s]) for s, (cost, audit) in reached.items())


class _Segment:
    """Counts and row kinds of consecutive rows of a conversation."""

    def __init__(self, opens: bool):
        self.opens, self.kinds = opens, bytearray()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.first = self.last = None
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        kind = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial, 0)
        if fault:
            self.counts[fault] += 1
            kind |= CUT if fault == "truncated" else MUST_GO
        if self.first is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.counts["turns"] += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.kinds.append(kind)

    def row(self, conv, place: int, whole: bool) -> tuple:
        """With ``whole`` the conversation's result, else a table of results for each state it may be entered in."""
        kinds = bytes(self.kinds)
        entries = [EMPTY] if self.opens else range(4)
        found = {EMPTY: search(kinds)} if whole else {e: search(kinds, e, close=False) for e in entries}
        table = [(e, x, *result) for e, ends in found.items() for x, result in ends.items()]
        columns = [list(c) for c in zip(*table, strict=True)]
        return conv, whole, place, *self.counts.values(), self.first, self.last, self.low, self.high, *columns


_SEGMENTS = (
    "conv {id}, whole boolean, place long, blank long, duplicate long, truncated long, illegal long, turns long, "
    "first string, last string, low long, high long, entries array<int>, ends array<int>, costs array<long>, "
    "audits array<string>"
)
_SOLVED = "conv {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _segmented(kinds: list[pa.DataType], names: list[str], most: int):
    """Segments of a task's rows, of ``most`` rows at most; ``place`` orders them."""

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        found: list[tuple] = []
        current, segment = None, None

        def out() -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "fault", "again", "m"))
            for conv, turn, initial, fault, again, m in zip(*columns, strict=True):
                if segment is None or conv != current:
                    opens = segment is not None  # the first one of a task may have begun in an earlier task
                    if opens:
                        found.append(segment.row(current, place, whole=segment.opens))
                        place += 1
                    current, segment = conv, _Segment(opens)
                for copy in range(m):
                    if len(segment.kinds) == most:
                        found.append(segment.row(current, place, whole=False))
                        place += 1
                        segment = _Segment(opens=False)
                    segment.add(turn, initial, fault if fault == "blank" else "duplicate" if again or copy else fault)
            if len(found) >= 1000:
                yield out()
                found = []
        if segment is not None:
            found.append(segment.row(current, place, whole=False))  # it may go on in the next task
        if found:
            yield out()

    return segments


def _one_conversation(arrow: pa.Schema):
    def merged(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda row: row["place"])
        total = {c: sum(row[c] for row in rows) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
        tables, before, low, high = [], None, None, None
        for row in rows:
            if before is not None and before + row["first"] not in ("su", "ua", "au"):
                total["illegal"] += 1
            before = row["last"]
            if row["low"] is not None:
                total["turns"] -= high == row["low"]  # a turn that goes on in the next segment
                low, high = row["low"] if low is None else low, row["high"]
            table: dict = {}
            for entry, end, cost, audit in zip(row["entries"], row["ends"], row["costs"], row["audits"], strict=True):
                table.setdefault(entry, {})[end] = cost, audit
            tables.append(table)
        cost, audit = joined(tables)
        gaps = 0 if low is None else high - low + 1 - total["turns"]
        values = [rows[0]["conv"], gaps, *(total[c] for c in _COUNTS[1:5]), cost, audit]
        return pa.table([pa.array([v], k) for v, k in zip(values, arrow.types, strict=True)], schema=arrow)

    return merged


def _rows(conversations: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(id_column).alias("conv"),
        F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
    )
    return rows.withColumns({"prefix": F.substring("text", 1, PREFIX), "digest": F.sha2("text", 256)})


def solved(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv, counts, cost, audit of every conversation that has rows (of ``_rows``)."""
    kind = rows.schema["conv"].dataType.simpleString()
    fault = F.when(~F.col("text").rlike(_BLANK), "blank").when(~F.col("text").rlike(_ENDED), "truncated")
    light = rows.select("conv", "turn", "role", "prefix", "digest", fault.alias("fault"))
    light = light.groupBy("conv", "turn", "role", "prefix", "digest").agg(
        F.first("fault").alias("fault"), F.count(F.lit(1)).alias("m")
    )
    light = written(light, "turns")
    order = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    firsts = light.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(order).alias("earliest")
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    marked = light.join(firsts, same).withColumn("again", F.col("earliest") < order)
    by = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("prefix"), F.col("digest")]
    placed = marked.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "again", "m")
    schema = _SEGMENTS.format(id=kind)
    arrow = _arrow_schema(rows.sparkSession, schema)
    found = written(placed.mapInArrow(_segmented(arrow.types, arrow.names, segment), schema), "segments")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    whole = found.where("whole").select("conv", gaps, *_COUNTS[1:5], F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    schema = _SOLVED.format(id=kind)
    merged = _one_conversation(_arrow_schema(rows.sparkSession, schema))
    parts = found.where("not whole").groupBy("conv").applyInArrow(merged, schema)
    return written(whole.unionByName(parts), "audits")


def _arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _placed(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """A conversation's head, then its rows in order."""
    heads = heads.withColumn("head", F.lit(True))
    both = heads.unionByName(rows.withColumn("head", F.lit(False)), allowMissingColumns=True)
    by = [F.col("conv"), F.col("head").desc(), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "prefix", "digest"))]
    placed = both.repartition("conv").sortWithinPartitions(*by)
    return placed.select("conv", "head", "role", "text", *_COUNTS, "audit")


def _edits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(head, None, None, None, None) for each conversation, then (None, edit, own row or not, role, text) of its audit."""
    letters: list[str] = []
    at, last = 0, ""

    def inserts() -> Iterator[tuple]:
        nonlocal at, last
        while at < len(letters) and letters[at] == "I":
            last, at = "a" if last == "u" else "u", at + 1
            yield None, "I", False, "assistant" if last == "a" else "user", ""

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv", "head", "role", "text", *_COUNTS, "audit"))
        for conv, head, role, text, *counts, audit in zip(*columns, strict=True):
            if head:
                yield from inserts()
                letters, at, last = audit, 0, ""
                yield (conv, *counts, audit), None, None, None, None
                continue
            yield from inserts()
            letter, at = letters[at], at + 1
            if letter == "R":
                last = "a" if last == "u" else "u"
                role = "assistant" if last == "a" else "user"
            elif letter == "K":
                last = role[:1]
            yield None, letter, True, role, text
    yield from inserts()


def _heads(conversations: DataFrame, id_column: str, found: DataFrame) -> DataFrame:
    ids = conversations.select(F.col(id_column).alias("c")).distinct()
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    return ids.join(found, F.col("c").eqNullSafe(F.col("conv")), "left").select(F.col("c").alias("conv"), *zeros, audit)


def summaries(
    conversations: DataFrame, ids: DataFrame | None = None, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text", segment: int = SEGMENT,
) -> DataFrame:
    """id, counts, cost, audit and SHA-256 of the repaired ``role:text`` lines of every conversation.

    ``ids`` names conversations that get a row even if they have no rows in ``conversations``.
    """
    rows = _rows(conversations, id_column, turn_column, role_column, text_column)
    placed = _placed(rows, _heads(conversations if ids is None else ids, id_column, solved(rows, segment)))
    schema = _SOLVED.format(id=rows.schema["conv"].dataType.simpleString()) + ", repaired_sha256 string"
    arrow = _arrow_schema(rows.sparkSession, schema)
    kinds, names = arrow.types, arrow.names

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, head, digest, lines = [], None, hashlib.sha256(), 0

        def out() -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for new, edit, _, role, text in _edits(batches):
            if new is not None:
                if head is not None:
                    found.append((*head, digest.hexdigest()))
                    if len(found) >= 1000:
                        yield out()
                        found = []
                head, digest, lines = new, hashlib.sha256(), 0
            elif edit != "D":
                digest.update(("\n" * (lines > 0) + role + ":").encode())
                digest.update(text.encode())
                lines += 1
        if head is not None:
            found.append((*head, digest.hexdigest()))
        if found:
            yield out()

    return placed.mapInArrow(hashed, schema).withColumnRenamed("conv", id_column)


def repaired(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """The repaired conversations: id, turn (from 0), role, text, edit (K, R or I) of every row that stays or is new."""
    rows = _rows(conversations, id_column, turn_column, role_column, text_column)
    placed = _placed(rows, _heads(conversations, id_column, solved(rows)))
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, turn long, role string, text string, edit string"
    arrow = _arrow_schema(rows.sparkSession, schema)

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, conv, turn, waiting = [], None, 0, 0

        def out() -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, arrow.types, strict=True)], arrow.names
            )

        for new, edit, _, role, text in _edits(batches):
            if new is not None:
                conv, turn = new[0], 0
            elif edit != "D":
                found.append((conv, turn, role, text, edit))
                turn, waiting = turn + 1, waiting + len(text)
                if len(found) >= 1000 or waiting > 1 << 22:
                    yield out()
                    found, waiting = [], 0
        if found:
            yield out()

    found = placed.mapInArrow(kept, schema)
    return found.select(
        F.col("conv").alias(id_column), F.col("turn").alias(turn_column), F.col("role").alias(role_column),
        F.col("text").alias(text_column), "edit",
    )


def damaged(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Rows with planted faults, by crc32(``id:turn``) % 20; a null in any of the columns counts as one space."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    place = F.crc32(F.concat(shown(id_column), F.lit(":"), shown(turn_column))) % 20
    text = shown(text_column)
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col("_fault") == 4, "user").otherwise(shown(role_column))
    rows = conversations.select(id_column, turn_column, role_column, text_column, place.alias("_fault")).where("_fault <> 0")
    copies = F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = rows.select(F.col(id_column), F.col(turn_column), role.alias(role_column), text.alias(text_column), copies.alias("_copy"))
    return rows.drop("_copy")
