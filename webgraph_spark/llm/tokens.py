"""Token ids of a public byte-level BPE file, with what repeats kept per worker.

Ids are those of the ``tokenizers`` library for the same file. Its pre-tokenizer never
joins text over a space between two other characters, so such a text is a list of
words that are encoded one by one, and nearly all of them have been seen before. Texts with
other white space around spaces, control characters, characters beyond Latin-1 or special tokens
go to ``tokenizers`` whole.
"""

from __future__ import annotations

import json
import sys
from array import array
from types import ModuleType

# Fixed value: the pre-tokenizer's pattern of byte-level BPE files of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words a worker remembers; beyond them words are encoded each time.
WORDS = 400_000
MARKS = ".,;:!?"


def _bytes_of_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable Latin-1 bytes for
    themselves, the others for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class _Words(dict):
    """Ids of " " + word as little-endian 32-bit bytes."""

    def __init__(self, encode, encode_piece):
        self.encode, self.encode_piece = encode, encode_piece
        self.marks = {mark: array("I", encode(mark)).tobytes() for mark in MARKS}

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = array("I", self.encode_piece(f" {word}".encode())).tobytes()
        elif word[-1] in self.marks and word[:-1].isalpha():
            ids = self[word[:-1]] + self.marks[word[-1]]
        else:
            ids = array("I", self.encode(f" {word}")).tobytes()
        if len(self) < WORDS:
            self[word] = ids
        return ids


class Encoder:
    """``encode(text)`` gives the ids of one text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.special = [token["content"] for token in content["added_tokens"]]
        letters = _bytes_of_letters()
        vocabulary = content["model"]["vocab"]
        ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items() if word not in self.special}
        coding = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ordinary = coding._core_bpe.encode_ordinary
        self.words = _Words(self.ordinary, coding._core_bpe.encode_single_piece)

    def plain(self, text: str) -> bool:
        """Whether the text may be cut at every space."""
        if "  " in text or text[:1].isspace() or text[-1:].isspace():
            return False
        if "\n" in text and (" \n" in text or "\n " in text):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return text.replace("\n", "").isprintable() and not any(token in text for token in self.special)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.plain(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.ordinary(first)).tobytes() + b"".join(map(self.words.__getitem__, rest))


def encoder(path: str) -> Encoder:
    """The encoder of a file, made once per worker process.

    Functions sent by value begin each task with fresh globals, so what a worker keeps lies in
    a module that only exists there.
    """
    kept = vars(sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")))
    key = f"encoder:{path}"
    if key not in kept:
        kept[key] = Encoder(path)
    return kept[key]
