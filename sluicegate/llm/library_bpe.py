"""Ids by the tokenizers library, remembered per chunk, since corpora repeat their words."""

from __future__ import annotations

import os
from array import array

from tokenizers import Tokenizer

from sluicegate.llm.pretokens import cut, lines, word_and_tail
from sluicegate.llm.rows import ChunkCache, memo

# Spark deals the work to processes; threads of the library would only compete with them.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


# Chunks behind a blank that are remembered: some 250 MB a worker. Fewer cost more time than they save.
SPACED = 1 << 20


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is printable in Latin-1,
    otherwise the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


_LETTERS = _byte_letters()
_BLANK = _LETTERS[32]


def _latin_word(text: str) -> bool:
    """Letters only, all of them from blocks that every version of Unicode tells letters in."""
    return text.isalpha() and max(text) < "ɐ"


class LibraryEncoder:
    """``spaced``: words keep the blank before them as part of their first token.

    A vocabulary without blanks must also have lower case only; Latin-1 text is then lowered before it is
    cut, which is what the library's own normaliser does with it. Single words go to the library's model,
    everything else through its whole chain.

    ``special_tokens``: a special token's string in a text is that token, as the library has it unless told
    otherwise; the texts that hold one go to the library whole. Without, it is plain text.
    """

    def __init__(self, path: str, spaced: bool, special_tokens: bool = False):
        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        added = self.tokenizer.get_added_tokens_decoder().values() if special_tokens else ()
        self.special = [token.content for token in added]
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.first = ChunkCache(self._chunk)
        # Chunks that had a blank before them, without it.
        self.others = ChunkCache(self._spaced_chunk, SPACED) if spaced else self.first
        self.line_end = self._ids("\n") if spaced else b""

    def _ids(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        return self._tokens(word.encode().decode("latin-1").translate(_LETTERS))

    def _tokens(self, letters: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not self.spaced and chunk.isascii() and chunk.isalpha() and chunk.islower():
            return self._tokens(chunk)
        word, tail = word_and_tail(chunk)
        return self.first[word] + self.first[tail] if tail else self._ids(chunk)

    def _spaced_chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self._tokens(_BLANK + chunk)
        if _latin_word(chunk):
            return self._word(" " + chunk)
        word, tail = word_and_tail(chunk)
        return self.others[word] + self.first[tail] if tail else self._ids(" " + chunk)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(name in text for name in self.special):
            # One vocabulary serves both ways; a second one would cost each worker a hundred megabytes.
            self.tokenizer.encode_special_tokens = False
            try:
                return self._ids(text)
            finally:
                self.tokenizer.encode_special_tokens = True
        if self.spaced:
            return self.line_end.join(map(self._line, lines(text)))
        # White space of any kind becomes a blank there, and no token.
        return b"".join(map(self.first.__getitem__, self._lowered(text).replace("\n", " ").split(" ")))

    def _lowered(self, text: str) -> str:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def _line(self, text: str) -> bytes:
        first, *others = cut(text)
        return self.first[first] + b"".join(map(self.others.__getitem__, others))


def library_encoder(path: str, spaced: bool, special_tokens: bool = False) -> LibraryEncoder:
    """One encoder per worker process, so that tasks share what it remembers."""
    key = (LibraryEncoder, path, spaced, special_tokens)
    return memo(key, lambda: LibraryEncoder(path, spaced, special_tokens))
