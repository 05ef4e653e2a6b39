"""Token ids exactly as the tokenizers library gives them, with its work done once per distinct word.

Both vocabularies cut a text into words by a pattern and merge inside words only. So a text's ids are its words' ids in
a row, and each worker keeps the ids of the words it has met. The cutting is done here for texts of plain characters;
any other text, and any text that may hold a special token, goes to the library whole.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Words of a generation that a worker remembers, and the longest word that is remembered.
REMEMBERED_WORDS, LONGEST_WORD = 150_000, 40

#: The last code point of the plain characters.
PLAIN_END = 0x17F
SPACES = "\t\n\x0b\x0c\r "


def _characters(kind: str) -> str:
    """A character class: the plain characters of one kind, L or N."""
    return "".join(re.escape(chr(c)) for c in range(PLAIN_END + 1) if unicodedata.category(chr(c))[0] == kind)


L, N, S = _characters("L"), _characters("N"), re.escape(SPACES)
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The word patterns of the two vocabularies, over plain characters.
WORD_PATTERN = rf"{CONTRACTIONS}|[{L}]+|[{N}]|[^{S}{L}{N}]+"
BYTE_PATTERN = rf"{CONTRACTIONS}| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Not plain: what engines may class differently, and a capital whose small letter is two characters.
UNPLAIN = re.compile("[^\t\n\x0b\x0c\r\x20-\x7e\xa1-įı-ſ]")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, without truncation and padding."""
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Word to ids; asks the library for words not met lately.

    Words are kept in two generations. When the young one is full it becomes the old one, whose words come back if they
    are met again; so frequent words stay and the memory is bounded.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= LONGEST_WORD:
            if len(self) >= REMEMBERED_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Encodes texts by one vocabulary file; no special tokens are added."""

    def __init__(self, path: str):
        library = tokenizer(path)
        self.whole = lambda text: as_bytes(library.encode(text, add_special_tokens=False).ids)
        self.lower = library.normalizer is not None
        self.find = re.compile(WORD_PATTERN if self.lower else BYTE_PATTERN).findall
        #: Merges a word as the vocabulary has it, a character for each byte.
        self.merge = library.model.tokenize
        self.characters = {byte: char for char, byte in byte_characters().items()}
        self.words = Words(self.word)

    def word(self, word: str) -> bytes:
        """The ids of one word of the pattern."""
        return as_bytes([token.id for token in self.merge(word.encode().decode("latin-1").translate(self.characters))])

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if "<|" in text or UNPLAIN.search(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, self.find(text.lower() if self.lower else text)))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return Encoder(path)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, as a rule gives it."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(rest)}


@lru_cache(maxsize=4)
def id_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; ids without a token have none."""
    vocabulary, bytes_of = tokenizer(path).get_vocab(with_added_tokens=True), byte_characters()
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        table[number] = bytes(bytes_of[c] for c in token)
    return table


def decode(ids: bytes, path: str) -> str:
    """The text of ids of a byte-level vocabulary, special tokens kept; bytes that are no UTF-8 become U+FFFD."""
    table = id_bytes(path)
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
