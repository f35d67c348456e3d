"""Token ids of texts from a public tokenizer file, with a word cache.

The tokenizer of the ``word_bpe`` family lower-cases, treats any white space
as a boundary that makes no token, and never joins across it. So a text's ids
are those of its blank-separated words in turn, and a word that a Python
worker has met before costs one dictionary look-up. The cache holds at most
``CACHE_WORDS`` words and is emptied when full; results do not depend on it.

In Latin-1 text words are lower-cased, and full stops and commas taken apart,
before they are looked up. A new word of Latin letters, with at most one mark of punctuation after them,
is one pre-token (and the mark's), so it goes straight to the tokenizer's
model; any other new word goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array

from mentions.llm.common import worker_cache

CACHE_WORDS = 400_000
#: Longer words are encoded each time, so that the cache's bytes are bounded too.
CACHED_LENGTH = 64

#: Letters that lower-case one by one to letters and are in normal form already (the dotted capital I is not).
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?]?)")
#: Latin-1 characters as a full stop or comma (``.``), letter, digit or white space (``a``), or another mark (``!``).
KINDS = bytes(ord("." if c in ".," else "a" if c.isalnum() or c in " \t\n\r\x0b\x0c" else "!") for c in map(chr, range(256)))


def default_tokenizer() -> str:
    """Path of the public tokenizer file (each executor has the package)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: bytes that print stand for themselves, the others for the letters from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: b for b in prints} | {b: 256 + i for i, b in enumerate(others)}


def plain_words(text: str) -> list[str]:
    """Words whose ids, in turn, are those of the text; few different ones, so that most have been met before.

    In Latin-1 text, lower-casing beforehand changes no id. A full stop or
    comma with no other punctuation beside it is a pre-token of its own, so
    it may stand alone.
    """
    try:
        kinds = text.encode("latin-1").translate(KINDS)
    except UnicodeEncodeError:
        pass
    else:
        text = text.lower()
        if b".." not in kinds and b".!" not in kinds and b"!." not in kinds:
            text = text.replace(".", " . ").replace(",", " , ")
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


class WordEncoder(dict):
    """Ids of words, as little-endian unsigned 32-bit integers; a word not held yet is encoded on look-up."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.marks = {m: self.whole(m) for m in ".,;:!?"} | {"": b""}
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
            self[""] = b""
        ids = self.word(word)
        if len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return array("I", [t.id for t in self.model.tokenize(word.lower())]).tobytes()
        simple = SIMPLE.fullmatch(word)
        if simple is None:
            return self.whole(word)
        letters = simple[1].lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes() + self.marks[simple[2]]

    def text(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, plain_words(text or "")))


def token_bytes(texts: list[str | None], path: str | None) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers, special tokens not added."""
    path = path or default_tokenizer()
    encoder = worker_cache(f"tokenizer {path}", lambda: WordEncoder(path))
    return [encoder.text(t) for t in texts]
