"""Content hashes and word shingles as Column expressions (HSH-1..3, AGG-7, SET-4)."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions.binding import bind
from webgraph_spark.schemas import LIMITS

# Fixed value: word separators, Unicode white space and the four ASCII separators.
WORD_BREAK = r"(?U)[\s\x1c-\x1f]+"
# Words that a window is dealt by (``shingle_counts``), and bytes of text for each part they are dealt to.
DEALT_WORDS = 3
DEALT_BYTES = 2**24
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
HALF_PAIR = re.compile(rb"\xed[\xa0-\xbf][\x80-\xbf]")


def content_hash(html: Column) -> Column:
    return F.sha2(html, 256)


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def _normal(text: Column) -> Column:
    """The words as bytes, one blank between two; words hold no blanks."""
    return F.array_join(words(text), " ").cast("binary")


def _bounds(normal: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words begin and where they end."""
    if not normal:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blanks = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
    return np.append(0, blanks + 1), np.append(blanks, len(normal))


def _cut(normal: bytes, starts: np.ndarray, ends: np.ndarray, k: int) -> list[bytes]:
    """Every window of ``k`` words."""
    return [normal[a:b] for a, b in zip(starts.tolist(), ends[k - 1 :].tolist())]


def _windows(text: Column, k: int, finish) -> Column:
    def windows(tokens: Column) -> Column:
        count = F.size(tokens) - (k - 1)
        # sequence(1, 0) would count down, so short texts get no start at all.
        starts = F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: finish(F.array_join(F.slice(tokens, i, F.lit(k)), " ")))

    return bind(words(text), windows)


def word_shingles(text: Column, k: int = LIMITS.shingle_words) -> Column:
    """Every window of ``k`` words joined by one blank; empty for shorter texts."""
    return _windows(text, k, lambda shingle: shingle)


def shingle_set(text: Column, k: int = LIMITS.shingle_words) -> Column:
    """Distinct CRC32 values (unsigned, so bigint) of the word shingles."""
    return F.array_distinct(_windows(text, k, lambda shingle: F.crc32(shingle.cast("binary"))))


def _runs(normal: bytes, k: int) -> list[tuple[int, bytes]]:
    """(key, words) of runs of windows that a text holds, each window in one run and once.

    The key is the smallest hash of ``DEALT_WORDS`` words in a window: equal windows have equal keys, and neighbours mostly too.
    """
    starts, ends = _bounds(normal)
    count = len(starts) - k + 1
    if count < 1:
        return []
    part = min(DEALT_WORDS, k)
    hashes = np.fromiter(map(zlib.crc32, _cut(normal, starts, ends, part)), np.uint64) * _SPREAD
    keys = np.lib.stride_tricks.sliding_window_view(hashes, k - part + 1).min(axis=1)
    breaks = np.append(True, keys[1:] != keys[:-1])
    windows = _cut(normal, starts, ends, k)
    first = np.ones(count, bool)
    seen = set(windows)
    if len(seen) < count:
        first[:] = False
        first[list({w: i for i, w in reversed(list(enumerate(windows)))}.values())] = True
    breaks[1:] |= ~first[:-1]
    breaks &= first
    # A run ends before the next one begins or before a window that came earlier.
    stops = np.flatnonzero(np.append(breaks[1:] | ~first[1:], True) & first)
    begins = np.flatnonzero(breaks)
    own = keys[begins].view(np.int64).tolist()
    return [(key, normal[a:b]) for key, a, b in zip(own, starts[begins].tolist(), ends[stops + k - 1].tolist())]


def shingle_counts(texts: DataFrame, column: str, parts: int, k: int = LIMITS.shingle_words) -> DataFrame:
    """(shingle, pages): on how many rows of ``texts`` each window of ``k`` words occurs.

    Neighbouring windows are moved together, as the words they span, to the part of their key; only there are they cut out
    and counted. What is moved is about three times the text and not ``k`` times. Equal runs of a batch are moved once.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = Counter(run for normal in batch.column(0) for run in _runs(normal.as_py() or b"", k))
            columns = [pa.array([key for key, _ in met], pa.int64()), pa.array([run for _, run in met], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(met.values()), pa.int64())], ["key", "run", "n"])

    runs = texts.select(_normal(F.col(column))).mapInArrow(deal, "key long, run binary, n long").repartition(parts, "key")
    cut = runs.select("key", "n", F.explode(word_shingles(F.col("run").cast("string"), k)).alias("shingle"))
    # Parts by key hold all of a shingle, so the rows stay where they are.
    return cut.groupBy("key", "shingle").agg(F.sum("n").alias("pages")).select("shingle", "pages")


def columns_of(rows: DataFrame, names: Sequence[str], other: Mapping[str, str] | None = None) -> str:
    """The columns of ``rows`` with their types, or with ``other`` ones, as Spark reads a schema."""
    types = {name: rows.schema[name].dataType.simpleString() for name in names} | dict(other or {})
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


def packed(values: np.ndarray) -> bytes:
    """Numbers as bytes: four each where all are CRC32 values, else eight each and one byte more."""
    if not len(values) or (values.min() >= 0 and values.max() < 2**32):
        return values.astype("<u4").tobytes()
    return values.astype("<i8").tobytes() + b"8"


def unpacked(blob: bytes) -> np.ndarray:
    if len(blob) % 4 == 0:
        return np.frombuffer(blob, "<u4").astype(np.int64)
    return np.frombuffer(blob, "<i8", count=len(blob) // 8)


def _normal_bytes(text: bytes) -> bytes:
    """``_normal`` of a text; Python splits at what ``WORD_BREAK`` names."""
    try:
        known = text.decode()
    except UnicodeDecodeError:
        # As Java reads it: half of a surrogate pair is one fault, not three.
        known = HALF_PAIR.sub("\ufffd".encode(), text).decode("utf-8", "replace")
    return " ".join(known.split()).encode()


def _set_of(normal: bytes, k: int) -> np.ndarray:
    """The distinct CRC32 values of the windows, in the order they come."""
    starts, ends = _bounds(normal)
    found = dict.fromkeys(map(zlib.crc32, _cut(normal, starts, ends, k)))
    return np.fromiter(found, np.int64, len(found))


def with_sets(rows: DataFrame, column: str, k: int = LIMITS.shingle_words, as_bytes: bool = False) -> DataFrame:
    """``rows`` with hash (``shingle_set``, or the same ``packed``) and hash_length in the place of the text ``column``.

    Windows are cut and hashed in Arrow batches. A row without a text has the empty set.
    """
    kept = [name for name in rows.columns if name != column]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_set_of(_normal_bytes(text.as_py() or b""), k) for text in batch.column("_text")]
            hashed = pa.array([packed(s) for s in sets], pa.binary()) if as_bytes else lists(sets)
            sizes = pa.array([len(s) for s in sets], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), hashed, sizes], [*kept, "hash", "hash_length"])

    made = rows.select(*kept, F.col(column).cast("binary").alias("_text"))
    return made.mapInArrow(sign, f"{columns_of(rows, kept)}, hash {'binary' if as_bytes else 'array<bigint>'}, hash_length int")


def with_packed(rows: DataFrame) -> DataFrame:
    """``rows`` with the array column hash as ``packed`` bytes."""
    names = rows.columns
    at = names.index("hash")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (s.values for s in batch.column("hash"))
            blobs = [s if s is None else packed(s.drop_null().to_numpy()) for s in sets]
            yield batch.set_column(at, "hash", pa.array(blobs, pa.binary()))

    return rows.mapInArrow(pack, columns_of(rows, names, {"hash": "binary"}))


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """Numbers as Arrow lists."""
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def signature_length(signature: Column) -> Column:
    return F.size(F.array_distinct(signature))


def jaccard_from_counts(common: Column, size_a: Column, size_b: Column) -> Column:
    return F.when(common > 0, common / (size_a + size_b - common)).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets held as arrays of distinct values."""
    return jaccard_from_counts(F.size(F.array_intersect(a, b)), F.size(a), F.size(b))
