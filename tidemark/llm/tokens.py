"""Token ids of whole texts by a public tokenizer, with a cache of space-delimited pieces.

The vocabulary's splitting rule never joins a space to what stands before it, so
a text may be encoded piece by piece, cutting before a space, wherever the
space is not inside a longer run of white space.  Repeated pieces are encoded
once per worker.  Texts with longer runs of white space or with special strings are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np

END_ID = 2
_WIDE_SPACE = re.compile(r"\s \s|\s \Z")
_MARKS = ".,;:!?"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for a byte: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Index(dict):
    """Numbers keys in the order they first appear and remembers the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class PieceEncoder:
    """Encodes batches of texts to one flat array of ids and the number of ids per text.

    ``limit`` bounds the cached pieces; when it is passed, pieces seen once are forgotten.
    """

    def __init__(self, path: str, limit: int = 750_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Special strings inside a text are their one token, as the library has it; such texts are encoded whole.
        names = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._whole = re.compile("|".join([_WIDE_SPACE.pattern, *names]))
        self._model = self._tokenizer.model
        if self._tokenizer.pre_tokenizer.pre_tokenize_str(" aé")[0][0] != " aé".encode().decode("latin-1").translate(_LETTERS):
            raise ValueError("the vocabulary is not byte-level")
        self._break = self._encode(["\n"])[0]
        self._limit = limit
        self._reset()

    def _reset(self) -> None:
        self._pieces = _Index()
        self._marks: dict[str, list[int]] = {}
        self._ids = np.empty(0, np.int32)
        self._start = np.zeros(1, np.int64)
        self._seen = np.empty(0, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget_rare(self) -> None:
        keep = np.flatnonzero(self._seen > 1)
        if len(keep) > self._limit // 2:
            self._reset()
            return
        lengths = np.diff(self._start)[keep]
        flat = self._ids[ragged(self._start[keep], lengths)]
        names = list(self._pieces)
        self._reset()
        for i in keep:
            self._pieces[names[i]] = len(self._pieces)
        self._ids, self._seen = flat, np.ones(len(keep), np.int64)
        self._start = np.concatenate(([0], np.cumsum(lengths)))

    def _word(self, word: str, lead: str) -> list[int]:
        """Ids of letters, after a space or not: the splitting rule keeps them whole, so the merges apply directly."""
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
        return [t.id for t in self._model.tokenize("\u0120" + spelled if lead else spelled)]

    def _line(self, line: str, lead: str) -> list[int]:
        """Ids of text without a line break; marks after a word are a token run of their own."""
        if line.isalpha():
            return self._word(line, lead)
        word = line.rstrip(_MARKS)
        if not word.isalpha():
            return self._encode([lead + line])[0]
        code = self._pieces.get(word, len(self._start)) if lead else len(self._start)
        if code < len(self._start) - 1:
            ids = self._ids[self._start[code] : self._start[code + 1]].tolist()
        else:
            ids = self._word(word, lead)
        marks = line[len(word) :]
        after = self._marks.get(marks)
        if after is None:
            after = self._marks[marks] = self._encode([marks])[0]
        return ids + after

    def _fill(self) -> None:
        """Encode the pieces that are new; a line break between two words is a token of its own."""
        if not self._pieces.new:
            return
        flat: list[int] = []
        lengths = np.empty(len(self._pieces.new), np.int64)
        for i, piece in enumerate(self._pieces.new):
            before = len(flat)
            line, broken, after = piece.partition("\n")
            if not broken:
                flat += self._line(piece, " ")
            elif line and after and not line[-1].isspace() and not after[0].isspace():
                flat += self._line(line, " ")
                flat += self._break
                flat += self._line(after, "") if "\n" not in after else self._encode([after])[0]
            else:
                flat += self._encode([" " + piece])[0]
            lengths[i] = len(flat) - before
        self._pieces.new.clear()
        self._ids = np.concatenate((self._ids, np.asarray(flat, np.int32)))
        self._start = np.concatenate((self._start, self._start[-1] + np.cumsum(lengths)))
        self._seen = np.concatenate((self._seen, np.zeros(len(lengths), np.int64)))

    def _look_up(self, codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        self._fill()
        code = np.fromiter(codes, np.int64, len(codes))
        if len(code):
            self._seen += np.bincount(code, minlength=len(self._seen))
        lengths = self._start[code + 1] - self._start[code]
        return self._ids[ragged(self._start[code], lengths)], lengths

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each as if a space stood before it, and their number per word."""
        if len(self._pieces) > self._limit:
            self._forget_rare()
        return self._look_up(list(map(self._pieces.__getitem__, words)))

    def encode(self, texts: Sequence[str], end: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order and their number per text; ``end`` is appended to each text."""
        if len(self._pieces) > self._limit:
            self._forget_rare()
        heads: list[str] = []
        rows: list[tuple[int, int]] = []
        codes: list[int] = []
        get = self._pieces.__getitem__
        for text in texts:
            if self._whole.search(text):
                heads.append(text)
                rows.append((len(codes), 0))
                continue
            head, space, tail = text.partition(" ")
            heads.append(head)
            if space:
                before = len(codes)
                codes.extend(map(get, tail.split(" ")))
                rows.append((before, len(codes) - before))
            else:
                rows.append((len(codes), 0))
        body, lengths = self._look_up(codes)
        reach = np.concatenate(([0], np.cumsum(lengths)))
        tail_end = [] if end is None else [end]
        out, sizes = [], []
        for first, (at, n) in zip(self._encode(heads) if heads else [], rows):
            part = body[reach[at] : reach[at + n]]
            out += [np.asarray(first, np.int32), part, np.asarray(tail_end, np.int32)]
            sizes.append(len(first) + len(part) + len(tail_end))
        return (np.concatenate(out) if out else np.empty(0, np.int32)), np.asarray(sizes, np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of every run, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
