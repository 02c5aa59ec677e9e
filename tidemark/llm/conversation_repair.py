"""Repair of the turn structure of conversations by depth-first branch-and-bound.

Roles of a repaired conversation alternate: perhaps a system turn, then user and assistant in pairs.  A turn may be kept,
given another role or deleted, and empty turns may be inserted, each at a price.  The search walks the turns with an
explicit stack and tries edits in the order of their letters.  A node is the next turn plus the role before it; a lower
bound on the cost of what follows is known for every node, a table per node holds the best cost and prefix that reached
it, and whatever cannot beat the incumbent (cost, then letters) is cut, until the stack is empty and the incumbent proved.

Two passes keep texts out of memory.  The first sees one small symbol per turn and finds the letters of the edits; the
second streams the turns in order behind those letters and takes the digest, which has to be taken in sequence.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# White space of the contract, marks that end a sentence, costs of the edits.
SPACES = "[\\x20\\x09-\\x0D]"
END_MARKS = ".!?"
DELETE, RENAME, INSERT, CUT = 2, 1, 5, 5
# Roles after which a turn may come: none, system, user, assistant; and where a conversation may end.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_FINAL = (_NONE, _ASSISTANT)
_FAR = 1 << 60

REPAIR_SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_REPAIR = pa.schema(
    [("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
     ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_PLAN = pa.schema(list(_REPAIR)[:-1])
PLAN_SCHEMA = REPAIR_SCHEMA.rsplit(",", 1)[0]


def _keeps(role: int, before: int) -> bool:
    return role == _NEXT[before] or (role == _SYSTEM and before == _NONE)


def suffix_bounds(roles: bytes, faults: bytes) -> array:
    """Least cost from each turn on, per role before it (four numbers a turn); no repair of the rest is cheaper."""
    size = len(roles)
    bounds = array("q", bytes(32 * (size + 1)))
    row = [0 if q in _FINAL else _FAR for q in range(4)]
    for at in range(size, -1, -1):
        if at < size:
            after, fault = row, faults[at]
            row = [x + DELETE for x in after]
            if fault < 2:
                extra = CUT * fault
                for q in range(4):
                    row[q] = min(row[q], after[_NEXT[q]] + RENAME + extra)
                    if _keeps(roles[at], q):
                        row[q] = min(row[q], after[roles[at]] + extra)
        for _ in range(3):  # an inserted turn leads to the next role at the same turn
            row = [min(row[q], row[_NEXT[q]] + INSERT) for q in range(4)]
        bounds[4 * at : 4 * at + 4] = array("q", row)
    return bounds


def search(roles: bytes, faults: bytes) -> tuple[int, str]:
    """(cost, letters) of the cheapest repair, least letters among equals.

    ``roles`` hold the role of each turn (0: none that may stay), ``faults`` 0, 1 for a truncated turn, 2 for one that
    must be deleted.  Edits are tried in the order of their letters (D, I, K, R), so of two prefixes that reach a node
    at the same cost the earlier is the lesser one, and the table needs costs only.  A repair at the bound of the first
    node exists, so what must cost more is cut even before there is an incumbent.
    """
    size = len(roles)
    bounds = suffix_bounds(roles, faults)
    best: tuple[int, str] | None = None
    limit = bounds[_NONE] + 1  # a repair has to cost less
    reached: dict[int, int] = {}
    letters = bytearray()
    # (turn, role before, cost, depth, letter that led here)
    stack: list[tuple[int, int, int, int, int]] = [(0, _NONE, 0, 0, 0)]
    while stack:
        at, before, cost, depth, letter = stack.pop()
        del letters[max(depth - 1, 0):]
        if letter:
            letters.append(letter)
        node = 4 * at + before
        if cost + bounds[node] >= limit:
            continue  # at equal cost the incumbent's letters are less
        known = reached.get(node)
        if known is not None and known <= cost:
            continue  # a lesser prefix of no higher cost has been here
        reached[node] = cost
        if at == size and before in _FINAL:
            best, limit = (cost, letters.decode()), cost
            continue  # inserting more only adds cost
        edits: list[tuple[int, int, int, int, int]] = []
        if at < size:
            edits.append((at + 1, before, cost + DELETE, depth + 1, 68))
        edits.append((at, _NEXT[before], cost + INSERT, depth + 1, 73))
        if at < size and faults[at] < 2:
            extra = CUT * faults[at]
            if _keeps(roles[at], before):
                edits.append((at + 1, roles[at], cost + extra, depth + 1, 75))
            edits.append((at + 1, _NEXT[before], cost + RENAME + extra, depth + 1, 82))
        stack.extend(edit for edit in reversed(edits) if edit[2] + bounds[4 * edit[0] + edit[1]] < limit)
    assert best is not None  # deleting every turn is always allowed
    return best


@lru_cache(maxsize=50_000)
def _search_short(roles: bytes, faults: bytes) -> tuple[int, str]:
    return search(roles, faults)


def plan(roles: bytes, faults: bytes) -> tuple[int, str]:
    """``search``, remembering short conversations, which mostly have few shapes."""
    return _search_short(roles, faults) if len(roles) <= 32 else search(roles, faults)


def _text(name: str) -> Column:
    """A value as text; a missing one is one space."""
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame, modulus: int = 20) -> DataFrame:
    """The given rows with faults that follow from ``crc32("conv_id:turn")``: dropped, emptied, unmarked, repeated, renamed."""
    chance = F.crc32(F.concat_ws(":", _text("conv_id"), _text("turn")).cast("binary")) % modulus
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _text("role").alias("role"),
        _text("text").alias("text"), chance.alias("chance"),
    ).where(F.col("chance") != 0)
    text = F.when(F.col("chance") == 1, "").when(F.col("chance") == 2, F.translate("text", END_MARKS, "")).otherwise(F.col("text"))
    role = F.when(F.col("chance") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("chance") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _coded(rows: DataFrame) -> DataFrame:
    """Turns with a digest of role and text, an order, and what can be told of a turn by itself."""
    bare = F.regexp_replace("text", f"{SPACES}+\\z", "")
    # A digest in place of the text; the length of the role keeps role and text apart.
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", _SYSTEM).when(initial == "u", _USER).when(initial == "a", _ASSISTANT).otherwise(_NONE)
    return rows.withColumns(
        {
            "digest": digest,
            "initial": role.cast("byte"),
            "fault": F.when(bare == "", 2).when(~F.substring(bare, -1, 1).isin(*END_MARKS), 1).otherwise(0).cast("byte"),
            "is_blank": bare == "",
        }
    )


_ORDER = ("turn", "role", "digest")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, *[F.col(c).asc_nulls_first() for c in _ORDER])


@dataclass
class _Shape:
    """Symbols and counts of one conversation."""

    conv: int | None
    roles: bytearray
    faults: bytearray
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    low: int | None = None
    high: int | None = None
    turns: int = 0

    def add(self, turn: int | None, role: int, fault: int, blank: bool, again: bool) -> None:
        if blank:
            self.blank += 1
        elif again:
            self.duplicate, fault = self.duplicate + 1, 2
        elif fault == 1:
            self.truncated += 1
        if turn is not None and turn != self.high:  # turns come in order
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.roles.append(role)
        self.faults.append(fault)

    def row(self) -> dict:
        cost, audit = plan(bytes(self.roles), bytes(self.faults))
        follows = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}
        return {
            "conv_id": self.conv,
            "gaps": 0 if self.low is None or self.high is None else self.high - self.low + 1 - self.turns,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": sum(pair not in follows for pair in zip(self.roles, self.roles[1:])),
            "cost": cost, "audit": audit,
        }


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape: _Shape | None = None
    for batch in batches:
        done = []
        names = ("conv_id", "turn", "initial", "fault", "is_blank", "again")
        for conv, *turn in zip(*(batch.column(n).to_pylist() for n in names)):
            if shape is None or conv != shape.conv:
                if shape is not None:
                    done.append(shape.row())
                shape = _Shape(conv, bytearray(), bytearray())
            shape.add(*turn)
        yield pa.RecordBatch.from_pylist(done, schema=_PLAN)
    if shape is not None:
        yield pa.RecordBatch.from_pylist([shape.row()], schema=_PLAN)


class _Rewrite:
    """The edits of one conversation applied turn by turn to a running digest."""

    def __init__(self, found: dict) -> None:
        self.found, self._audit = found, found["audit"]
        self._at, self._before, self._first, self._sum = 0, _NONE, True, hashlib.sha256()

    def _say(self, role: str, text: str) -> None:
        self._sum.update(f"{'' if self._first else chr(10)}{role}:{text}".encode())
        self._first = False

    def _inserts(self) -> None:
        while self._at < len(self._audit) and self._audit[self._at] == "I":
            self._before, self._at = _NEXT[self._before], self._at + 1
            self._say(_ROLE_NAMES[self._before], "")

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            self._before = _INITIALS[role[0]]
            self._say(role, text)
        elif edit == "R":
            self._before = _NEXT[self._before]
            self._say(_ROLE_NAMES[self._before], text)

    def row(self) -> dict:
        self._inserts()
        return {**self.found, "repaired_sha256": self._sum.hexdigest()}


def _rewrites(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Rewrite | None = None
    for batch in batches:
        done = []
        for found, role, text in zip(*(batch.column(n).to_pylist() for n in ("plan", "role", "text"))):
            if found is None:
                now.add(role, text)
                continue
            if now is not None:
                done.append(now.row())
            now = _Rewrite(found)
        yield pa.RecordBatch.from_pylist(done, schema=_REPAIR)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=_REPAIR)


def plan_repairs(turns: DataFrame) -> DataFrame:
    """Counts of faults, cost and letters of the cheapest repair per conversation.

    Turns count by their first fault: blank, duplicate (role and text as in an earlier turn), truncated.  They come in order
    of turn (nulls first), then role, then a digest of the text.
    """
    coded = _coded(turns).select("conv_id", *_ORDER, "initial", "fault", "is_blank")
    same = Window.partitionBy("conv_id", "digest").orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER[:2]])
    # The window keeps the rows of a conversation together, so both sorts follow one shuffle.
    marked = coded.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    order = [*[F.col(c).asc_nulls_first() for c in _ORDER], F.col("again").asc()]
    return marked.sortWithinPartitions("conv_id", *order).mapInArrow(_shapes, PLAN_SCHEMA)


def repair(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """Per conversation: faults, gaps, illegal neighbours, and the cheapest repair with its digest.

    ``turns`` has ``conv_id, turn, role, text``, ``conv_ids`` every conversation to report; one without turns gets zeros, no
    letters and the digest of nothing.  Null role and text are one space; a null conversation id is one conversation; null
    turns come first and are in no gap; turns that tie are ordered by role and text digest; repeated turns are
    duplicates; a role without one of the initials s, u, a cannot stay as it is; other columns are ignored; an empty table
    gives no row.  A conversation of any length passes in one task, because its digest is one sequence: the first pass
    holds two bytes and four bounds per turn, the second one turn.
    """
    rows = turns.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))
    plans = plan_repairs(rows)
    known = conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("k")
    plans = plans.alias("p")
    fields = [f.name for f in _PLAN if f.name != "conv_id"]
    listed = known.join(plans, F.col("k.conv_id").eqNullSafe(F.col("p.conv_id")), "left").select(
        F.col("k.conv_id").alias("conv_id"),
        *[F.coalesce(F.col(f"p.{c}"), F.lit("" if c == "audit" else 0)).alias(c) for c in fields],
    )
    heads = listed.select("conv_id", F.struct("conv_id", *fields).alias("plan"))
    nothing = F.lit(None)
    rest = _coded(rows).select("conv_id", nothing.cast(heads.schema["plan"].dataType).alias("plan"), *_ORDER, "text")
    empty = [nothing.cast(rest.schema[c].dataType).alias(c) for c in (*_ORDER, "text")]
    stream = heads.select("conv_id", "plan", *empty).unionByName(rest).withColumn("follows", F.col("plan").isNull())
    return _in_order(stream, "follows").select("plan", "role", "text").mapInArrow(_rewrites, REPAIR_SCHEMA)
