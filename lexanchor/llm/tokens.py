"""Token ids by a public tokenizer, for whole texts inside a task.

Both vocabularies in use split a text at a single space or line break between visible
characters before any merge, so such chunks can be encoded alone. Chunks that come again are looked up; of the
rest, letters with ASCII punctuation behind are two pieces, and words known from other chunks are looked up without it. The
result equals that of the whole text, which tests compare. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
from array import array
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Chunks that a worker remembers for good and on trial. A chunk on trial that comes again
#: is remembered for good; either memory is emptied when it is full.
REMEMBERED, ON_TRIAL = 300_000, 200_000
LONGEST_REMEMBERED = 64
_SAFE = r"[\w!-~]"
_BOUNDARY = re.compile(rf"(?<={_SAFE}) (?={_SAFE})")
_SAFE_END = re.compile(_SAFE)
_PLAIN = re.compile(rf"{_SAFE}(?:.*{_SAFE})?", re.DOTALL)

#: Byte-level vocabularies write visible Latin-1 bytes as themselves and the others, in order, from U+0100 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_SPACE_CHAR = chr(_BYTE_CHARS[0x20])


def _in_latin_1(text: str) -> bool:
    """Whether all characters are below U+0100: these are in normal form and each lower-cases by itself."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Ids of texts by the tokenizer of a file; keeps a bounded memory of chunks (ids as little-endian bytes)."""

    def __init__(self, path: str, space_in_front: bool, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self.space = " " if space_in_front else ""
        self.remembered, self.on_trial = remembered, remembered * ON_TRIAL // REMEMBERED
        self.memory: dict[str, bytes] = {}
        self.trial: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.heads: dict[str, bytes] = {"": b""}
        self.line = array("I", self.whole(["\n"])[0]).tobytes()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_merges(self, chunk: str) -> bytes | None:
        """Ids of a word of letters with punctuation behind, straight from the merges; None for other chunks."""
        core = chunk.rstrip(string.punctuation)
        line = core[0] == "\n" if core else False
        if line:
            core = core[1:]
        if not core.isalpha():
            return None
        # both vocabularies set letters and what stands behind them apart; the first ignores case and the space in front
        word = core.lower() if not self.space and core.isascii() else core if line else self.space + core
        ids = self.words.get(word)
        if ids is None:
            ids = self._word(word, core)
            if ids is None:
                return None
            if len(word) <= LONGEST_REMEMBERED:
                if len(self.words) >= self.remembered:
                    self.words.clear()
                self.words[word] = ids
        tail = chunk[len(core) + line:]
        found = self.tails.get(tail)
        if found is None:
            found = array("I", self.whole([tail])[0]).tobytes()
            if len(tail) <= LONGEST_REMEMBERED:
                if len(self.tails) > 1000:
                    self.tails = {"": b""}
                self.tails[tail] = found
        return self.line + ids + found if line else ids + found

    def _word(self, word: str, core: str) -> bytes | None:
        """Ids of letters, with the space in front where the vocabulary has one; None where normalising may change them."""
        if core.isascii():
            piece = word.replace(" ", _SPACE_CHAR)
        else:
            if not self.space:
                word = word.lower()
                if "Σ" in core or not word.isalpha() or not unicodedata.is_normalized("NFC", core):
                    return None
            piece = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.merge(piece)]).tobytes()

    def _missed(self, chunk: str) -> bytes | None:
        """Ids of a chunk that is not remembered for good; None if it can't be encoded alone."""
        ids = self.trial.pop(chunk, None)
        if ids is not None:
            if len(self.memory) >= self.remembered:
                self.memory.clear()
            self.memory[chunk] = ids
            return ids
        ids = self._by_merges(chunk)
        if ids is None:
            line = chunk[:1] == "\n"
            if not _PLAIN.fullmatch(chunk, line):
                return None
            ids = array("I", self.whole([chunk if line else self.space + chunk])[0]).tobytes()
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self.trial) >= self.on_trial:
                self.trial.clear()
            self.trial[chunk] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if not self.space and _in_latin_1(text):
            text = text.lower().replace("\n", " ")  # as the vocabulary's own normaliser does; fewer chunks differ
        # a line break between visible characters stands alone too: it starts a chunk of its own kind
        head, *parts = text.replace("\n", " \n").split(" ")
        if parts and not (head and _SAFE_END.match(head[-1])):
            return self._by_boundary(text)
        found = list(map(self.memory.get, parts))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    ids = self._missed(parts[i])
                    if ids is None:
                        return self._by_boundary(text)
                    found[i] = ids
        ids = self.heads.get(head)
        if ids is None:
            ids = array("I", self.whole([head])[0]).tobytes()
            if len(head) <= LONGEST_REMEMBERED:
                if len(self.heads) >= self.on_trial // 8:
                    self.heads = {"": b""}
                self.heads[head] = ids
        return np.frombuffer(ids + b"".join(found), np.uint32)

    def _by_boundary(self, text: str) -> np.ndarray:
        head, *parts = _BOUNDARY.split(text)
        return np.fromiter(chain.from_iterable(self.whole([head, *(self.space + p for p in parts)])), np.uint32)


_ENCODERS: dict[tuple[str, bool, int], Encoder] = {}


def encoder(path: str, space_in_front: bool, remembered: int = REMEMBERED) -> Encoder:
    """One encoder for each file and worker process."""
    key = (path, space_in_front, remembered)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, space_in_front, remembered)
    return _ENCODERS[key]
