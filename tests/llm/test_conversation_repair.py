"""Conversation repair against enumeration of all edits and a plain reading of the rules."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm.conversation_repair import damage, repair, search

_LEGAL = re.compile(r"(s?(ua)+)?")
_SPACE = " \t\n\v\f\r"
_SCHEMA = "conv_id long, turn long, role string, text string, plan string"


def _edits(rows: list[tuple[str, str, int]], at: int, inserts: int):
    """All edit sequences of (role, text, fault) rows: (cost, letters, repaired lines, role initials)."""
    if inserts:
        for role in ("user", "assistant"):
            for cost, letters, lines, initials in _edits(rows, at, inserts - 1):
                yield cost + 5, "I" + letters, [f"{role}:", *lines], role[0] + initials
    if at == len(rows):
        yield 0, "", [], ""
        return
    role, text, fault = rows[at]
    options = [(2, "D", None)]
    if fault != 2:
        options += [(5 * fault, "K", role), *((1 + 5 * fault, "R", r) for r in ("user", "assistant"))]
    for (price, letter, name), (cost, letters, lines, initials) in itertools.product(options, list(_edits(rows, at + 1, inserts))):
        if name is None:
            yield price + cost, letter + letters, lines, initials
        else:
            yield price + cost, letter + letters, [f"{name}:{text}", *lines], (name[:1] or "?") + initials


def _brute(turns: list[tuple], inserts: int = 2) -> tuple:
    """Fields of a conversation's report from its rows (turn, role, text) in order."""
    seen, faults, counts = set(), [], [0, 0, 0]
    for _, role, text in turns:
        bare = text.strip(_SPACE)
        kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        faults.append(2 if kind in (0, 1) else 1 if kind == 2 else 0)
        if kind is not None:
            counts[kind] += 1
        seen.add((role, text))
    rows = [(role, text, fault) for (_, role, text), fault in zip(turns, faults)]
    found = [x for k in range(inserts + 1) for x in _edits(rows, 0, k) if _LEGAL.fullmatch(x[3])]
    cost, audit, lines, _ = min(found, key=lambda x: (x[0], x[1].encode()))
    stamps = [t for t, _, _ in turns if t is not None]
    gaps = max(stamps) - min(stamps) + 1 - len(set(stamps)) if stamps else 0
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _broken(conv, turn, role, text):
    role, text = role if role is not None else " ", text if text is not None else " "
    chance = zlib.crc32(f"{conv if conv is not None else ' '}:{turn if turn is not None else ' '}".encode()) % 20
    if chance == 1:
        text = ""
    if chance == 2:
        text = text.translate({ord(c): None for c in ".!?"})
    return [(turn, "user" if chance == 4 else role, text)] * (0 if chance == 0 else 2 if chance == 3 else 1)


def _conversations(seed: int, count: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "open end", "\n tail? \t", " ", "", None, "Ende。", "a" * 40 + ".", "dot.\u0085", "x?　"]
    rows = []
    for conv in range(count):
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(0, 4)):
            turn += rng.choice([1, 1, 1, 2])
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", "system", "tool", None, ""]), rng.choice(texts), "x"))
    return rows


def _key(turn, role, text):
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn if turn is not None else 0, role.encode(), digest)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_enumeration(spark, seed):
    rows = _conversations(seed, 120)
    rows += [(None, 1, "user", "Null id.", "x"), (None, 2, "assistant", "So.", "x")]
    table = spark.createDataFrame(rows, _SCHEMA).repartition(4)
    got = {r[0]: tuple(r)[1:] for r in repair(damage(table), table.select("conv_id")).collect()}
    expected = {}
    for conv in {r[0] for r in rows}:
        turns = [t for c, turn, role, text, _ in rows if c == conv for t in _broken(c, turn, role, text)]
        expected[conv] = _brute(sorted(turns, key=lambda t: _key(*t)))
    assert got == expected


def test_search_equals_enumeration():
    """All shapes of up to three turns, with and without faults."""
    names = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    for size in range(4):
        for roles in itertools.product(range(4), repeat=size):
            for faults in itertools.product(range(3), repeat=size):
                rows = [(names[r], f"{k}", f) for k, (r, f) in enumerate(zip(roles, faults))]
                found = [x for n in range(3) for x in _edits(rows, 0, n) if _LEGAL.fullmatch(x[3])]
                assert search(bytes(roles), bytes(faults)) == min(x[:2] for x in found)


def test_long_conversations_stay_linear():
    rng = random.Random(5)
    roles, faults = bytes(rng.choices(range(4), k=200_000)), bytes(rng.choices(range(3), (8, 1, 1), k=200_000))
    cost, audit = search(roles, faults)
    assert len(audit) - audit.count("I") == 200_000 and cost > 0


def test_conversation_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.", "x") for c in (1, 2) for t in range(9)]
        table = spark.createDataFrame(rows, _SCHEMA)
        got = {r.conv_id: r for r in repair(table, table).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    said = "\n".join(f"{r[2]}:{r[3]}" for r in rows[:8])
    for row in got.values():
        assert (row.cost, row.audit, row.gaps) == (2, "KKKKKKKKD", 0)
        assert row.repaired_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_conversations_without_turns_and_empty_tables(spark):
    none = spark.createDataFrame([], _SCHEMA)
    ids = spark.createDataFrame([(5,), (5,), (None,)], "conv_id long")
    got = sorted(map(tuple, repair(none, ids).collect()), key=str)
    blank = hashlib.sha256(b"").hexdigest()
    assert got == sorted([(c, 0, 0, 0, 0, 0, 0, "", blank) for c in (5, None)], key=str)
    assert repair(none, none).count() == 0
