"""Token ids of whole texts by the tokenizers library, with ids of frequent words remembered."""

from __future__ import annotations

import os
import struct
from functools import lru_cache

#: Words whose ids a worker keeps, in each of two generations; longer words aren't kept.
KEPT_WORDS, KEPT_LENGTH = 400_000, 40
_MARKS = ".,!?;:"
#: From here on Python's letters may be newer than the tokenizer's.
_RECENT = "\u0370"
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(64)]


class _Known(dict):
    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, key: str) -> bytes:
        return self.encoder.learn(key)


class Encoder:
    """encode(text): the ids as little-endian unsigned 32-bit numbers.

    A byte-level BPE never merges across the start of a " word" or a line end, nor between letters and marks after
    them, so ids of a text are those of its pieces in a row. Pieces seen before aren't encoded again; words of letters
    go straight to the tokenizer's model, once for all marks after them. Odd texts, and tokenizers for which a probe shows otherwise, are
    encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.new, self.old = _Known(self), {}
        self.marks: dict[str, bytes] = {}
        self.line = self._whole("\n")
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        unprinted = [b for b in range(256) if b not in printed]
        #: the character that stands for each byte in a byte-level vocabulary
        self.shown = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(unprinted)}
        self.space = self.shown[32]
        probe = "One, two's 3rd.\nFour five-six!!\nÄpfel x=1 (é), çela... end"
        self.by_word = self._pieces(probe) == self._whole(probe)

    @property
    def vocabulary(self) -> int:
        return self.tok.get_vocab_size()

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tok.encode(text, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        return _PACKED[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}I", *ids)

    def _pieces(self, text: str) -> bytes | None:
        """None for a text with other white space than single spaces and line ends between words."""
        first, *rest = text.replace("\n", " \n").split(" ")
        # all other white space, by any library's reckoning, is unprintable
        if not first or first[0] == "\n" or "" in rest or "\n" in rest or not text.replace("\n", "").isprintable():
            return None
        if len(self.new) > KEPT_WORDS:
            self.old, self.new = self.new, _Known(self)
        return self._piece("", first) + b"".join(map(self.new.__getitem__, rest))

    def _piece(self, before: str, word: str) -> bytes:
        core = word.rstrip(_MARKS)
        plain = core.isascii()
        if not core.isalpha() or not plain and max(core) >= _RECENT:
            return self._whole(before + word)
        marked = len(core) < len(word)
        # the same word with other marks, or without
        got = (self.new.get(core) or self.old.get(core)) if marked and before else None
        if got is None:
            shown = (self.space + core if before else core) if plain else (before + core).encode().decode("latin-1").translate(self.shown)
            got = self._packed([t.id for t in self.model.tokenize(shown)])
            if marked and before and len(core) <= KEPT_LENGTH:
                self.new[core] = got
        if marked:
            end = word[len(core) :]
            if end not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[end] = self._whole(end)
            got += self.marks[end]
        return got

    def learn(self, key: str) -> bytes:
        """Of a word after a space, or of a line end and the word after it."""
        got = self.old.get(key)
        if got is None:
            got = self.line + self._piece("", key[1:]) if key[0] == "\n" else self._piece(" ", key)
        if len(key) <= KEPT_LENGTH:
            self.new[key] = got
        return got

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        got = self._pieces(text) if self.by_word and "<|" not in text else None
        return self._whole(text) if got is None else got


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    return Encoder(path)
