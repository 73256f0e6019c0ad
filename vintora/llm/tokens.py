"""Token ids of whole texts with the public lower-case word BPE, as little-endian uint32 bytes.

That tokenizer drops white space and never joins text across it, so a text's ids are the ids of its
white-space-separated words in order. Words repeat, so most of the work is to look up pieces of words
in a cache of their ids as bytes. The cache is bounded in bytes and ends with the task; only the
tokenizer itself stays with the worker.
"""

from __future__ import annotations

import re
import struct

# The characters with Unicode's White_Space property.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# How the tokenizer splits lower-case text of ASCII and Latin-1 letters.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+"
CACHE_BYTES = 48 << 20
_ENTRY = 200            # about what an entry takes besides its text and ids
_PLAIN = bytes([*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xC0, 0x100)])


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def plain(text: str) -> bool:
    """ASCII and Latin-1 letters only: already in normal form, and lower case is letter by letter."""
    try:
        return not text.encode("latin-1").translate(None, _PLAIN) and "<|" not in text
    except UnicodeEncodeError:
        return False


class Ids(dict):
    """The ids, as bytes, of each lower-case piece of plain text, filled on demand."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.words: dict[str, bytes] = {}
        self.held = 0
        self.letters = byte_letters()
        self.split = re.compile(PIECES).findall
        self.spaces = re.compile(f"[{SPACES}]+").split

    def __missing__(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else \
            "".join([self.letters[b] for b in piece.encode()])
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        out = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        self.held += _ENTRY + len(piece) + len(out)
        return out

    def _word(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        out = self.words[word] = struct.pack(f"<{len(ids)}I", *ids)
        self.held += _ENTRY + len(word) + len(out)
        return out

    def text(self, text: str) -> bytes:
        if plain(text):
            return b"".join(map(self.__getitem__, self.split(text.lower())))
        return b"".join([self.words.get(w) or self._word(w) for w in self.spaces(text) if w])

    def trim(self) -> None:
        if self.held > CACHE_BYTES:
            self.clear()
            self.words.clear()
            self.held = 0


def tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)
