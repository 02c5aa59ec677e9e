"""Chat formatting: a declarative template, an automaton over roles, segments with loss flags.

The turns of a conversation pass a finite-state machine in order.  Each turn
becomes a few text segments, each with a loss flag.  Control strings inside
texts are escaped reversibly.  Conversations stream through a task one turn at
a time, so a very long one costs time but no memory; nothing is gathered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Which role may follow which; "" is the start of a conversation.
TRANSITIONS = {
    "": ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user",),
}
FINAL = ("user", "assistant")

TURN_SCHEMA = (
    "conv_id long, position struct<turn: long, role: string, tie: long>, allowed boolean, "
    "segments array<struct<text: string, loss: boolean>>"
)
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "valid boolean"
)
_POSITION = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("tie", pa.int64())])
_TURN = pa.schema(
    [("conv_id", pa.int64()), ("position", _POSITION), ("allowed", pa.bool_()),
     ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))]
)
_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())]
)


@dataclass(frozen=True)
class Template:
    """``open role middle text close`` per turn; texts of ``learned`` roles carry loss.

    All control strings start with ``<|``.  In texts and roles every ``<``, any backslashes, ``|`` gets
    one more backslash, so no control string can occur there; taking one away restores the text.
    """

    open: str = "<|im_start|>"
    middle: str = "<|im_sep|>\n"
    close: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: TRANSITIONS)
    final: tuple[str, ...] = FINAL

    def __post_init__(self) -> None:
        if not all(x.startswith("<|") for x in (self.open, self.middle, self.close)):
            raise ValueError("control strings start with <|")

    @staticmethod
    def escape(text: str) -> str:
        return re.sub(r"<(\\*)\|", r"<\1\\|", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"<(\\*)\\\|", r"<\1|", text)

    def segments(self, role: str, text: str) -> list[dict[str, Any]]:
        return [
            {"text": self.open + self.escape(role) + self.middle, "loss": False},
            {"text": self.escape(text), "loss": role in self.learned},
            {"text": self.close, "loss": False},
        ]

    def parse(self, segments: list[dict[str, Any]]) -> tuple[str, str, bool]:
        """Role, text and loss flag of a turn; the inverse of ``segments``."""
        head, body, tail = segments
        if not (head["text"].startswith(self.open) and head["text"].endswith(self.middle) and tail["text"] == self.close):
            raise ValueError("a turn lacks its control strings")
        role = head["text"][len(self.open) : len(head["text"]) - len(self.middle)]
        return self.unescape(role), self.unescape(body["text"]), body["loss"]

    def may_follow(self, state: str, role: str) -> bool:
        return role in self.transitions.get(state, ())


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "position")


def format_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: ``conv_id, position, allowed, segments``.

    Joining the segments of a conversation in the order of ``position`` (turn number, then role, then a hash of
    the text; so ties and repeated rows have a fixed order) gives its formatted text.  ``allowed`` says whether the
    automaton lets this role follow the one before.  No turn is dropped, allowed or not.  Null role and text are
    empty; a null conversation id is one conversation; a null turn number comes first.  Other columns are ignored.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), F.xxhash64(text).alias("tie")).alias("position"),
        text.alias("text"),
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Any = object()
        state = ""
        for batch in batches:
            convs, positions, texts = (batch.column(n) for n in ("conv_id", "position", "text"))
            allowed, segments = [], []
            for conv, role_, said in zip(convs.to_pylist(), positions.field("role").to_pylist(), texts.to_pylist()):
                if conv != now:
                    now, state = conv, ""
                allowed.append(template.may_follow(state, role_))
                segments.append(template.segments(role_, said))
                state = role_
            yield pa.record_batch(
                [convs, positions.cast(_POSITION), pa.array(allowed, pa.bool_()), pa.array(segments, _TURN.field("segments").type)],
                schema=_TURN,
            )

    return _in_order(rows).mapInArrow(emit, TURN_SCHEMA)


class _Digest:
    """Digests of one conversation, taken turn by turn."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.count, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss, self.valid, self.role = hashlib.sha256(), hashlib.sha256(), True, ""

    def add(self, template: Template, segments: list[dict[str, Any]], allowed: bool) -> None:
        self.role, text, loss = template.parse(segments)
        self.turns.update(f"{self.role}\n{text}\n".encode())
        if loss:
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.count += 1
        self.chars += sum(len(s["text"]) for s in segments)
        self.valid &= allowed

    def row(self, template: Template) -> dict[str, Any]:
        return {
            "conv_id": self.conv, "n_turns": self.count, "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
            "valid": self.valid and self.role in template.final,
        }


def read_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, from its formatted turns: counts, digests and whether the automaton accepts it.

    A digest over a whole conversation must be taken in sequence, so its turns pass one task, in constant memory.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_conversation(batches, template, lambda rows: pa.RecordBatch.from_pylist(rows, schema=_DIGEST))

    return _in_order(formatted).mapInArrow(stream, DIGEST_SCHEMA)


def _by_conversation(
    batches: Iterator[pa.RecordBatch], template: Template, pack: Callable[[list[dict[str, Any]]], pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    digest: _Digest | None = None
    for batch in batches:
        done = []
        for conv, allowed, segments in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "allowed", "segments"))):
            if digest is None or conv != digest.conv:
                if digest is not None:
                    done.append(digest.row(template))
                digest = _Digest(conv)
            digest.add(template, segments, allowed)
        yield pack(done)
    if digest is not None:
        yield pack([digest.row(template)])
