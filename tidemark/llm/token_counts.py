"""Token counts of whole texts by two deterministic transducers compiled from a byte-level vocabulary.

The first transducer reads classes of characters and marks where the vocabulary's splitting rule starts a new piece.  A
batch of texts is cut into chunks of equal length; every chunk gives a map from each state at its start to the state at
its end, the maps are composed by a parallel prefix scan, and with the states so found all chunks mark their pieces at once.

The second one reads the bytes of a piece.  The merges of a vocabulary split every prefix of a piece in exactly one way,
whose last token is the one that may follow the token before it, so a state is the set of unfinished tokens with the
finished token each of them follows.  A transition carries the tokens that it emits, net of those that it joins; their
sum along a piece is the piece's number of tokens.  States and transitions are compiled when a text first needs them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.storage import documents, slices
from tidemark.llm.tokens import _LETTERS, vocabulary_path

COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

# Classes of characters.  The rule has its own words for a few endings after an apostrophe.
_CLASSES = ("letter", "stmd", "r", "v", "l", "e", "digit", "other", "quote", "space", "blank", "end")
_C = {name: k for k, name in enumerate(_CLASSES)}
_LETTER_CLASSES = ("letter", "stmd", "r", "v", "l", "e")
_STATES = ("start", "letters", "digits", "others", "quote", "quote_r", "quote_v", "quote_l", "ending", "space", "spaces", "blank", "blanks")
_HERE, _BEFORE = 1, 2  # a piece starts at this character, at the one before it
_STRIDE = 16
_UNKNOWN = 255
_CHUNK = 256
# Bits of a state's member: tree node, token before it plus one, count plus an offset.
_BITS, _ZERO, _COUNT = 24, 1 << 23, (1 << 24) - 1
_TOKEN, _NODE, _REST = (1 << 20) - 1, 44, (1 << 44) - 1


def _rule(state: str, c: str) -> tuple[str, int]:
    """Next state and marks of the splitting rule ``'s 't 're 've 'm 'll 'd``, `` ?letters``, `` ?digits``, `` ?others``, blanks."""
    fresh = {"digit": "digits", "other": "others", "quote": "quote", "space": "space", "blank": "blank", "end": "start"}.get(c, "letters")
    if state in ("space", "spaces", "blank", "blanks"):
        if c in ("space", "blank"):
            return ("spaces" if c == "space" else "blanks"), 0
        if c == "end":
            return "start", _HERE
        if state in ("blank", "blanks"):
            return fresh, _HERE | (_BEFORE if state == "blanks" else 0)
        return ("others" if c == "quote" else fresh), (_BEFORE if state == "spaces" else 0)
    if state in ("quote_r", "quote_v", "quote_l"):
        if c == ("l" if state == "quote_l" else "e"):
            return "ending", 0
        target, marks = _rule("letters", c)
        return target, marks | _BEFORE
    if state == "quote":
        if c == "stmd":
            return "ending", 0
        if c in ("r", "v", "l"):
            return f"quote_{c}", 0
        return ("others", 0) if c in ("other", "quote") else (fresh, _HERE)
    stays = {"letters": _LETTER_CLASSES, "digits": ("digit",), "others": ("other", "quote")}.get(state, ())
    return (state, 0) if c in stays else (fresh, _HERE)


def _tables() -> tuple[bytes, bytes]:
    """Next state (times the stride) and marks for every state plus class, as translation tables of 256 bytes."""
    following, marks = bytearray(256), bytearray(256)
    for s, state in enumerate(_STATES):
        for c, name in enumerate(_CLASSES):
            target, mark = _rule(state, name)
            following[s * _STRIDE + c], marks[s * _STRIDE + c] = _STATES.index(target) * _STRIDE, mark
    return bytes(following), bytes(marks)


class Splitter:
    """Starts of the pieces that the splitting rule makes of a run of texts."""

    def __init__(self, pre_tokenizer) -> None:
        self._split = pre_tokenizer.pre_tokenize_str
        self._following, self._marks = _tables()
        self._class = np.full(0x110000, _UNKNOWN, np.uint8)
        for letters, name in (("stmd", "stmd"), ("r", "r"), ("v", "v"), ("l", "l"), ("e", "e"), ("'", "quote"), (" ", "space")):
            for letter in letters:
                self._class[ord(letter)] = _C[name]

    def _probe(self, code: int) -> int:
        """The class that the vocabulary's own splitting gives a character: what it joins without a cut."""
        c = chr(code)
        for head, name in (("a", "letter"), ("1", "digit"), ("!", "other")):
            if len(self._split(head + c)) == 1:
                return _C[name]
        return _C["blank"]

    def classes(self, codes: np.ndarray) -> np.ndarray:
        found = self._class[codes]
        if (found == _UNKNOWN).any():
            for code in np.unique(codes[found == _UNKNOWN]).tolist():
                self._class[code] = self._probe(code)
            found = self._class[codes]
        return found

    def _step(self, table: bytes, at: np.ndarray) -> np.ndarray:
        return np.frombuffer(at.tobytes().translate(table), np.uint8).reshape(at.shape)

    def starts(self, classes: np.ndarray) -> np.ndarray:
        """Positions where a piece starts; classes ``end`` are pieces of their own."""
        size = len(classes)
        chunks = max(1, -(-size // _CHUNK))
        padded = np.full(chunks * _CHUNK, _C["end"], np.uint8)
        padded[:size] = classes
        lanes = np.ascontiguousarray(padded.reshape(chunks, _CHUNK).T)
        # Every chunk from every state: the map of the chunk.
        states = np.repeat((np.arange(len(_STATES)) * _STRIDE).astype(np.uint8)[:, None], chunks, axis=1)
        for row in lanes:
            states = self._step(self._following, states + row)
        entry = self._entries((states // _STRIDE).T)
        # Every chunk from the state in which the text before it ends.
        state = (entry * _STRIDE).astype(np.uint8)
        marks = np.empty_like(lanes)
        for k, row in enumerate(lanes):
            at = state + row
            marks[k] = self._step(self._marks, at)
            state = self._step(self._following, at)
        flat = marks.T.reshape(-1)[:size]
        begins = (flat & _HERE) > 0
        begins[:-1] |= (flat[1:] & _BEFORE) > 0
        return np.flatnonzero(begins)

    @staticmethod
    def _entries(maps: np.ndarray) -> np.ndarray:
        """State at the start of every chunk, by an inclusive prefix scan over the composition of maps."""
        composed = maps.astype(np.int64)
        reach = 1
        while reach < len(composed):
            later = np.take_along_axis(composed[reach:], composed[:-reach], axis=1)
            composed = np.concatenate((composed[:reach], later))
            reach *= 2
        return np.concatenate(([0], composed[:-1, 0]))


class PieceTransducer:
    """Number of tokens of a piece; ``limit`` bounds the compiled transitions, which are dropped and built anew beyond it."""

    def __init__(self, model, vocabulary: dict[str, int], limit: int = 600_000) -> None:
        self._tokenize, self._limit = model.tokenize, limit
        byte_of = {ord(letter): byte for byte, letter in _LETTERS.items()}
        self._spelled = {number: spelled for spelled, number in vocabulary.items() if all(ord(x) in byte_of for x in spelled)}
        self._child: dict[int, int] = {}
        self._token: dict[int, int] = {}
        self._open = set()  # nodes of the tree of tokens below which there are more
        nodes = 1
        for number, spelled in self._spelled.items():
            node = 0
            for letter in spelled:
                key = node << 8 | byte_of[ord(letter)]
                self._open.add(node)
                following = self._child.get(key)
                if following is None:
                    self._child[key] = following = nodes
                    nodes += 1
                node = following
            self._token[node] = number
        self._reset()

    def _reset(self) -> None:
        self._pairs: dict[int, bool] = {}
        # Per state its members: tree node, finished token before it and tokens so far less those now, packed into a number.
        self._members: list[tuple[int, ...]] = [(_ZERO,)]
        self._number = {self._members[0]: 0}
        self._edges: dict[int, int] = {}  # next state and emitted tokens, packed

    def _follows(self, before: int, token: int) -> bool:
        """Whether the merges leave two tokens side by side as they are; ``before`` counts from 1, 0 is none."""
        known = self._pairs.get(before << 20 | token)
        if known is None:
            spelled = self._spelled[token] if not before else self._spelled[before - 1] + self._spelled[token]
            found = [t.id for t in self._tokenize(spelled)]
            known = self._pairs[before << 20 | token] = found == ([before - 1, token] if before else [token])
        return known

    def _compile(self, state: int, byte: int) -> int:
        reached, last, emitted = [], None, 0
        for member in self._members[state]:
            child = self._child.get(member >> _NODE << 8 | byte)
            if child is None:
                continue
            if last is None:
                token = self._token.get(child)
                if token is not None and self._follows(member >> _BITS & _TOKEN, token):
                    last, emitted = token, (member & _COUNT) - _ZERO + 1
            if child in self._open:
                reached.append(child << _NODE | member & _REST)
        if last is None:
            raise ValueError(f"the vocabulary cannot spell byte {byte}")
        members = (*(member - emitted for member in reached), (last + 1) << _BITS | _ZERO)
        target = self._number.get(members)
        if target is None:
            target = self._number[members] = len(self._members)
            self._members.append(members)
        edge = self._edges[state << 8 | byte] = target << _BITS | emitted + _ZERO
        return edge

    def count(self, piece: bytes) -> int:
        state = total = 0
        for byte in piece:
            edge = self._edges.get(state << 8 | byte)
            if edge is None:
                if len(self._edges) >= self._limit:
                    members = self._members[state]
                    self._reset()
                    state = self._number.setdefault(members, len(self._members))
                    if state == len(self._members):
                        self._members.append(members)
                edge = self._compile(state, byte)
            state = edge >> _BITS
            total += (edge & _COUNT) - _ZERO
        return total


class _Counts(dict):
    """Whole pieces as single transitions from the first state back to it."""

    def __init__(self, transducer: PieceTransducer) -> None:
        super().__init__()
        self._transducer = transducer

    def __missing__(self, piece: str) -> int:
        self[piece] = found = self._transducer.count(piece.encode())
        return found


class TokenCounter:
    """Token counts as the library gives them for a byte-level vocabulary without adding special tokens.

    Special strings inside a text count as their one token and part it, which is the library's default.  ``window`` is
    the number of characters taken at once; longer texts pass in several windows.  ``limit`` bounds the remembered pieces.
    """

    def __init__(self, path: str, window: int = 2_000_000, limit: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder().values()
        if tokenizer.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("only byte-level vocabularies without normalisation and with plain special tokens can be compiled")
        names = sorted((t.content for t in added), key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, names))) if names else None
        self._splitter = Splitter(tokenizer.pre_tokenizer)
        self._counts = _Counts(PieceTransducer(tokenizer.model, tokenizer.get_vocab(with_added_tokens=False)))
        self._window, self._limit = window, limit

    def _segments(self, text: str) -> list[str]:
        return self._special.split(text) if self._special else [text]

    def _pieces(self, joined: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of pieces and their token counts; characters at ``ends`` only part texts and count nothing."""
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self._splitter.classes(codes)
        classes[ends] = _C["end"]
        starts = self._splitter.starts(classes)
        if len(self._counts) > self._limit:
            self._counts.clear()
        bounds = [*starts.tolist(), len(joined)]
        get = self._counts.__getitem__
        counts = np.fromiter([get(joined[a:b]) for a, b in zip(bounds, bounds[1:])], np.int64, len(starts))
        counts[classes[starts] == _C["end"]] = 0
        return starts, counts

    def _long(self, segment: str) -> int:
        """Tokens of a long segment, window by window; the piece that a window leaves open moves to the next one."""
        total, kept = 0, ""
        for at in range(0, len(segment), self._window):
            part = kept + segment[at : at + self._window]
            starts, counts = self._pieces(part, np.empty(0, np.int64))
            if at + self._window >= len(segment):
                return total + int(counts.sum())
            total += int(counts[:-1].sum())
            kept = part[starts[-1] :]
        return total

    def count(self, texts: Sequence[str]) -> np.ndarray:
        """Tokens of each text."""
        parts: list[str] = []
        totals = np.zeros(len(texts), np.int64)
        first = np.empty(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            segments = self._segments(text)
            totals[i] = len(segments) - 1
            first[i] = len(parts)
            for segment in segments:
                if len(segment) > self._window:
                    totals[i] += self._long(segment)
                else:
                    parts.append(segment)
        first[-1] = len(parts)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(lengths)
        if not len(parts):
            return totals
        starts, counts = self._pieces("\0".join(parts) + "\0", ends - 1)
        reach = np.concatenate(([0], np.cumsum(counts)))
        offsets = np.concatenate(([0], ends))[first]
        return totals + np.diff(reach[np.searchsorted(starts, offsets)])


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The worker's compiled counter for a vocabulary file, kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``documents``.

    Texts are read whole, null ones as empty (no token); repeated rows and ids give a row each; other columns are
    ignored; an empty table gives no row.  ``n_bytes`` is the length in UTF-8, ``over_limit`` says ``n_tokens > limit``.
    A row depends on itself alone, so nothing is shuffled.
    """
    path = path or vocabulary_path()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = part.column("text")
            tokens = counter(path).count(texts.to_pylist())
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.record_batch([part.column("doc_id"), sizes, pa.array(tokens), pa.array(tokens > limit)], schema=_COUNTS)

    return documents(docs).mapInArrow(emit, COUNT_SCHEMA)
