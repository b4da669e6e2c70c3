"""Hashes of the words of many texts at once, for operators that run on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash

# Texts are handled in slices of about this many bytes, which bounds what a task holds besides its batch.
SLICE_BYTES = 4_000_000

_MIX = [np.uint64(c) for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_SHIFT = np.uint64(33)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over all output bits."""
    out = values ^ (values >> _SHIFT)
    out *= _MIX[0]
    out ^= out >> _SHIFT
    out *= _MIX[1]
    return out ^ (out >> _SHIFT)


def multipliers(count: int, seed: int, kind=np.uint64) -> np.ndarray:
    """Fixed odd numbers, the same in every process."""
    bits = np.iinfo(kind).bits
    return (np.random.default_rng(seed).integers(0, 2**bits - 1, count, dtype=kind, endpoint=True) | kind(1)).astype(kind)


def lower_words(text: str | None) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space; bytes.lower and bytes.split do exactly that."""
    return text.encode().lower().split() if text else []


def slices(batch: pa.RecordBatch, column: str, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each text) for consecutive slices of a batch."""
    first, words, size = 0, [], 0
    for row, text in enumerate(batch.column(column)):
        value = text.as_py()
        words.append(lower_words(value))
        size += len(value) if value else 0
        if size >= slice_bytes:
            yield first, words
            first, words, size = row + 1, [], 0
    if words:
        yield first, words


def numbered_words(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash of every distinct word, its number for every word of all texts in order, where each text
    begins and the last ends)."""
    ends = np.cumsum([0, *map(len, texts)])
    flat = pa.array([word for words in texts for word in words], pa.binary()).dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in flat.dictionary.to_pylist()), np.uint64, len(flat.dictionary))
    return known, flat.indices.to_numpy(), ends


def word_hashes(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of all texts in order, where each text begins and the last ends)."""
    known, numbers, ends = numbered_words(texts)
    return known[numbers], ends
