"""Ids of a word-level BPE vocabulary (one with word ends) for many texts, word by word.

The vocabulary never joins across white space, so a text is cut at ASCII white space and each
distinct word is encoded once and kept. Plain Latin words go through a rank encoder built from
the same vocabulary; every other word goes through the tokenizer itself, so ids always equal the
tokenizer's. The kept words are bounded and dropped all at once when the bound is reached.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import tiktoken
from tokenizers import Tokenizer

KEPT_WORDS = 300_000
LONGEST_KEPT = 64

#: Words whose lower case and pieces are the same in every library: ASCII and Latin letters without special case rules.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-įı-ķĹ-ňŊ-ž]+\Z")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|[^\w\s]+(?:_[^\w\s]*)*|_+(?:[^\w\s]+_*)*")
_END = b"\xff"  # never part of UTF-8


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_of() -> dict[str, int]:
    """Printable stand-ins of bytes in byte-level vocabularies, inverted."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in plain]
    table.update({chr(256 + i): b for i, b in enumerate(rest)})
    return table


class WordEncoder(dict):
    """Kept words and their ids as unsigned 16-bit little-endian bytes."""

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        super().__init__()
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        byte_of, ranks = _byte_of(), {}
        for token, i in vocabulary.items():
            if token.startswith("<|"):
                continue
            bare = token.removesuffix("</w>")
            ranks[bytes(byte_of[c] for c in bare) + (_END if bare != token else b"")] = i
        self.ranked = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self.piece = self.ranked._core_bpe.encode_single_piece
        self.kept = kept

    def raw(self, word: str) -> bytes:
        """Ids of a word as bytes."""
        return array("H", self.encode(word)).tobytes()

    def encode(self, word: str) -> list[int]:
        if not word:
            return []
        if len(word) <= LONGEST_KEPT and word.isascii() and word.isalpha():
            return self.piece(word.lower().encode() + _END)
        if _PLAIN.match(word) and len(word) <= LONGEST_KEPT:
            lower = unicodedata.normalize("NFC", word).lower()
            return [i for piece in _PIECES.findall(lower) for i in self.piece(piece.encode() + _END)]
        return self.exact.encode(word, add_special_tokens=False).ids

    def miss(self, word: str) -> bytes:
        ids = self.raw(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= self.kept:
                self.clear()
            self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        """Ids of a whole text."""
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        found = list(map(self.get, words))
        if None in found:
            found = [self.miss(w) if x is None else x for w, x in zip(words, found)]
        return b"".join(found)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per process and vocabulary; a Python worker keeps it from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
