import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from salesloom.llm import conversation_repair as repair

KIND = {"s": repair.SYSTEM, "u": repair.USER, "a": repair.ASSISTANT, "x": 0}


def coded(initials, marks):
    return bytes(KIND[i] | m for i, m in zip(initials, marks, strict=True))


def every_repair(kinds):
    """All (cost, audit) that end in a legal conversation, with up to two inserted rows at each place."""
    choices = []
    for kind in kinds:
        own = {KIND[i]: i for i in KIND}[kind & 3]
        cut = 3 if kind & repair.CUT else 0
        edits = [(4, "D", "")]
        if not kind & repair.MUST_GO:
            edits += [(cut, "K", own), (3 + cut, "R", "u"), (3 + cut, "R", "a")]
        choices += [[(0, "", ""), (3, "I", "u"), (3, "I", "a"), (6, "II", "ua"), (6, "II", "au")], edits]
    choices.append([(0, "", ""), (3, "I", "u"), (3, "I", "a"), (6, "II", "ua")])
    for edits in itertools.product(*choices):
        if re.fullmatch("(s?(ua)+)?", "".join(e[2] for e in edits)):
            yield sum(e[0] for e in edits), "".join(e[1] for e in edits)


def test_search_against_all_edits():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(0, 3)
        kinds = coded([rng.choice("suax") for _ in range(n)], [rng.choice([0, 0, repair.CUT, repair.MUST_GO]) for _ in range(n)])
        assert repair.search(kinds)[repair.EMPTY] == min(every_repair(kinds))


def plain(kinds):
    """The same by dynamic programming over states, without bounds."""
    states = {0: (0, "")}

    def inserted(found):
        for _ in range(4):
            for state, (cost, audit) in list(found.items()):
                to, label = (3 if state == 2 else 2), (cost + 3, audit + "I")
                if to not in found or label < found[to]:
                    found[to] = label
        return found

    for kind in kinds:
        after = {}
        for state, (cost, audit) in inserted(dict(states)).items():
            follow, cut = (3 if state == 2 else 2), 3 if kind & repair.CUT else 0
            moves = [(4, "D", state)]
            if not kind & repair.MUST_GO:
                moves.append((3 + cut, "R", follow))
                if kind & 3 == follow or kind & 3 == 1 and state == 0:
                    moves.append((cut, "K", kind & 3))
            for more, letter, to in moves:
                label = cost + more, audit + letter
                if to not in after or label < after[to]:
                    after[to] = label
        states = after
    ended = inserted(dict(states))
    return min(ended[s] for s in (0, 3) if s in ended)


def test_search_and_joined_segments_on_longer_rows():
    rng = random.Random(8)
    for case in range(200):
        n = rng.randint(4, 400 if case % 20 == 0 else 30)
        initials = rng.choices("suax", weights=rng.choice([(1, 9, 9, 0), (5, 1, 1, 1), (1, 1, 1, 1), (9, 0, 1, 0)]), k=n)
        marks = rng.choices([0, repair.CUT, repair.MUST_GO], weights=rng.choice([(9, 1, 1), (1, 3, 1), (1, 0, 0)]), k=n)
        kinds = coded(initials, marks)
        expected = plain(kinds)
        assert repair.search(kinds)[repair.EMPTY] == expected
        cuts = sorted({0, n, *(rng.randint(1, n - 1) for _ in range(n // 8 + 1))})
        parts = [kinds[a:b] for a, b in itertools.pairwise(cuts)]
        tables = [{e: repair.search(p, e, close=False) for e in range(4)} for p in parts]
        assert repair.joined(tables) == expected


SCHEMA = "conv_id long, turn long, role string, text string, conv string, head int, digest string, cost int, audit string"


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, "c", 1, "d", 2, "a") for r in rows], SCHEMA)


def by_hand(rows):
    """The result of one conversation's rows (turn, role, text) in order."""
    seen, kinds, faults = set(), [], []
    for _, role, text in rows:
        kind = KIND.get(role[:1], 0)
        if not text.strip(" \t\n\x0b\x0c\r"):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
        kinds.append(kind | {"truncated": repair.CUT, "": 0}.get(faults[-1], repair.MUST_GO))
    cost, audit = plain(bytes(kinds))
    lines, last, rest = [], "", iter(rows)
    for letter in audit:
        turned = "assistant" if last == "u" else "user"
        _, role, text = (None, turned, "") if letter == "I" else next(rest)
        if letter != "D":
            role = turned if letter == "R" else role
            last = role[:1]
            lines.append(f"{role}:{text}")
    turns = {t for t, _, _ in rows if t is not None}
    pairs = itertools.pairwise([r[1][:1] for r in rows])
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in pairs),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def conversations():
    rng = random.Random(2)
    found = {}
    for conv in (*range(40), None):
        rows = []
        for turn in range(rng.choice([1, 2, 5, 9, 60 if conv == 7 else 3])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", " "])
            text = rng.choice([" ", "", "yes.", "no", "Well! \n", "Why?", "a" * 3000 + "."]) if rng.random() < 0.5 else f"{turn}."
            rows.append((turn * rng.choice([1, 2]) if turn else None, role, text))
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        rows += [rows[-1]] * rng.choice([0, 0, 1, 2])
        found[conv] = rows
    return found


@pytest.mark.parametrize("segment", [2, 512])
def test_summaries_of_whole_and_cut_conversations(spark, table, segment):
    expected = conversations()
    rows = [(conv, *row) for conv, own in expected.items() for row in own]
    random.Random(1).shuffle(rows)
    found = repair.summaries(table(rows).repartition(3), segment=segment).collect()
    assert {r.conv_id: tuple(r[1:]) for r in found} == {conv: by_hand(own) for conv, own in expected.items()}
    assert len(found) == len(expected)


def test_hot_conversation_is_spread(spark, table):
    """One conversation holds most rows, and most of these are copies."""
    rows = [(None if i < 2 else i // 2, "user" if i % 2 else "assistant", f"{i}." if i < 400 else "same.") for i in range(3000)]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found = repair.summaries(table([(1, *r) for r in rows] + [(2, 0, "user", "Hi.")]), segment=64).collect()
    assert {r.conv_id: tuple(r[1:]) for r in found} == {1: by_hand(rows), 2: by_hand([(0, "user", "Hi.")])}


def test_nulls_missing_rows_and_empty_tables(spark, table):
    empty = hashlib.sha256(b"").hexdigest()
    rows = table([(1, 0, None, None), (2, None, "user", "A."), (None, 0, "user", None)])
    found = {r.conv_id: tuple(r[1:]) for r in repair.summaries(rows, ids=table([(c, 0, "", "") for c in (1, 2, 3, None)])).collect()}
    assert found == {
        1: (0, 1, 0, 0, 0, 4, "D", empty),
        2: (0, 0, 0, 0, 0, 3, "KI", hashlib.sha256(b"user:A.\nassistant:").hexdigest()),
        3: (0, 0, 0, 0, 0, 0, "", empty),
        None: (0, 1, 0, 0, 0, 4, "D", empty),
    }
    assert repair.summaries(table([])).collect() == []
    assert repair.repaired(table([])).collect() == []
    assert repair.damaged(table([])).collect() == []


def test_repaired_rows_are_legal(spark, table):
    expected = conversations()
    found = repair.repaired(table([(conv, *row) for conv, own in expected.items() for row in own])).collect()
    for conv, own in expected.items():
        rows = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.turn)
        assert [r.turn for r in rows] == list(range(len(rows)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in rows))
        lines = "\n".join(f"{r.role}:{r.text}" for r in rows)
        assert hashlib.sha256(lines.encode()).hexdigest() == by_hand(own)[-1]
        assert "".join(r.edit for r in rows) == by_hand(own)[-2].replace("D", "")


def test_damage(spark, table):
    import zlib

    rows = [(c, t, "assistant", "Yes. No! Why? End") for c in range(30) for t in (0, 1, None)]
    found = repair.damaged(table(rows)).collect()
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        expected = (role if fault != 4 else "user", "" if fault == 1 else text.translate({46: "", 33: "", 63: ""}) if fault == 2 else text)
        own = [(r.role, r.text) for r in found if (r.conv_id, r.turn) == (conv, turn)]
        assert own == [expected] * {0: 0, 3: 2}.get(fault, 1)
    nulls = repair.damaged(table([(None, None, None, None)]).withColumn("conv_id", F.lit(None).cast("long"))).collect()
    assert all(r.role in (" ", "user") and r.text in (" ", "") for r in nulls)
