"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and of word pairs are summed over the whole training text in segments of their hashes, whose number
grows with the text. A count becomes a level, 1 + floor(log2(count)), and an n-gram is put into the Bloom filter of its
segment once for every level up to its own, with ``BITS`` bits per entry at every size. A count is read back by probing
level after level until one is missing, and the pair model is smoothed with the word model of the same filter.

The filter is broadcast in ranges of segments, with the exact counts of their words, of at most ``RANGE_BYTES`` each. The
first range is asked while the documents are read; where it is the only one, they are scored in that pass. Otherwise the
distinct n-grams of each slice of documents are written by range, the other ranges are broadcast one after the other
and probed for their part in place, and the answers, a byte for each n-gram and a count for each word, come back to the
slices. Scores do not depend on the number of ranges, and no more than one range is held anywhere.

Texts of any length are scored whole; NULL texts are empty; columns other than doc_id and text are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.llm import hashing
from webgraph_spark.llm.common import held_part
from webgraph_spark.session import cut_lineage, drop_path, new_path

END = b" "  # no word holds a space
ADD = 0.1
SEGMENT_BITS = 12  # at least; a segment has the n-grams of about SEGMENT_TEXT bytes of text
SEGMENT_TEXT = 2**24
KEY_BITS = 60  # of a word whose count is exact
LOW_BITS = 48
SHORT = np.uint64(12)  # lowest bits that keys in the filter go without
LOW = np.uint64(2**LOW_BITS - 1)

BITS = 12  # per entry
PROBES = 4
LEVELS = 40
RANGE_BYTES = 2**25  # of filter and counts that are broadcast at once
# Words added to each context in proportion to the word model. Chosen on training rows of sf0.01 (remainders 2 to 9 teach,
# 1 checks): mean log10 probability of a token -3.70, -3.68, -3.67, -3.68, -3.70 with 10, 20, 50, 100, 200.
PRIOR = 50.0
SLICE_TEXT = 4_000_000  # bytes of text whose n-grams are asked together
COUNT_TEXT = 1_000_000  # bytes of text that are counted together
FLUSH = 2_000_000  # n-grams a task holds before it puts equal ones together, and passes them on if half are left

_GOLDEN = 0x9E3779B97F4A7C15
_PAIR = hashing.multipliers(2, 31)

COUNTS = "segment long, pair boolean, keys binary, counts binary"
SEGMENT = "segment long, words binary, word_counts binary, filter binary, tokens long, kinds long"


def keys_of(hashes: np.ndarray) -> np.ndarray:
    """Keys of KEY_BITS; the highest bits are the segment."""
    return hashing.mixed(hashes) >> np.uint64(64 - KEY_BITS)


def segment_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(KEY_BITS - bits)).astype(np.int64)


def short(keys: np.ndarray) -> np.ndarray:
    """Keys as the filter knows them."""
    return (keys >> SHORT) << SHORT


def pair_keys(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    return short(keys_of(before * _PAIR[0] + hashes * _PAIR[1]))


def _pack_low(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray((keys & LOW).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack_low(data: bytes, segment: int, bits: int) -> np.ndarray:
    """Keys of a segment from their LOW_BITS lowest bits; there are SEGMENT_BITS above these."""
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel() | (np.uint64(segment >> (bits - SEGMENT_BITS)) << np.uint64(LOW_BITS))


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Keys of the filter in order: four bytes each, and once what is above these."""
    highs, counts = np.unique(keys >> np.uint64(44), return_counts=True)
    lows = ((keys >> SHORT) & np.uint64(2**32 - 1)).astype(np.uint32)
    return b"".join(a.tobytes() for a in (np.array([len(highs)], np.int64), highs.astype(np.uint32), counts.astype(np.uint32), lows))


def _unpack_sorted(data: bytes) -> np.ndarray:
    groups = int(np.frombuffer(data, np.int64, 1)[0])
    highs, counts = (np.frombuffer(data, np.uint32, groups, 8 + 4 * groups * k) for k in (0, 1))
    lows = np.frombuffer(data, np.uint32, -1, 8 + 8 * groups).astype(np.uint64)
    return ((np.repeat(highs.astype(np.uint64), counts) << np.uint64(32)) | lows) << SHORT


def _squeezed(values: np.ndarray) -> bytes:
    """Bytes of numbers, all lowest ones first: the upper ones are mostly zero and shrink to nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zlib.compress(planes.tobytes(), 1)


def _expanded(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(zlib.decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, len(flat) // size).T).reshape(-1).view(kind)


def _framed(*parts: bytes) -> bytes:
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def _unframed(data: bytes) -> list[bytes]:
    count = int(np.frombuffer(data, np.int64, 1)[0])
    ends = np.cumsum([8 + 8 * count, *np.frombuffer(data, np.int64, count, 8)])
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct keys in order, the place of each key among them); sorting is much faster than hashing here."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    places = np.empty(len(keys), np.int64)
    places[order] = np.cumsum(new) - 1
    return ordered[new], places


def _tokens(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every distinct token, number of every token, bounds of texts); every text ends with END."""
    return hashing.numbered_words([[*words, END] for words in texts])


def _before(numbers: np.ndarray, ends: np.ndarray, end: int) -> np.ndarray:
    """The number of the token in front of each; END stands in front of a text."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[ends[:-1]] = end
    return before


def _end_number(known: np.ndarray) -> int:
    return int(np.flatnonzero(known == np.uint64(xxhash.xxh3_64_intdigest(END)))[0])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(all_keys)
    all_keys, all_counts = all_keys[order], all_counts[order]
    del order
    starts = np.flatnonzero(np.append(True, all_keys[1:] != all_keys[:-1])) if len(all_keys) else np.zeros(0, np.int64)
    return all_keys[starts], np.add.reduceat(all_counts, starts) if len(starts) else np.zeros(0, np.int64)


def _counted(bits: int):
    """(segment, pair, keys, counts) of blocks of tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, tuple[list, list]] = {pair: ([], []) for pair in (False, True)}
        size = 0

        def merge() -> int:
            """Puts equal n-grams together and gives the number of those left."""
            left = 0
            for keys, counts in held.values():
                merged, sums = _summed(keys, counts)
                keys[:], counts[:] = [merged], [sums]
                left += len(merged)
            return left

        def flush() -> Iterator[pa.RecordBatch]:
            for pair, (own_keys, own_counts) in held.items():
                keys, counts = _summed(own_keys, own_counts)
                segments, starts = np.unique(segment_of(keys, bits), return_index=True)
                bounds = list(zip(starts, [*starts[1:], len(keys)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segments, pa.int64()),
                        pa.array([pair] * len(bounds), pa.bool_()),
                        pa.array([(_pack_sorted if pair else _pack_low)(keys[a:b]) for a, b in bounds], pa.binary()),
                        pa.array([counts[a:b].astype("<u4").tobytes() for a, b in bounds], pa.binary()),
                    ],
                    ["segment", "pair", "keys", "counts"],
                )

        for batch in batches:
            for _, texts in hashing.slices(batch, "text", COUNT_TEXT):
                known, numbers, ends = _tokens(texts)
                held[False][0].append(keys_of(known))
                held[False][1].append(np.bincount(numbers, minlength=len(known)))
                hashes = known[numbers]
                before = known[_before(numbers, ends, _end_number(known))]
                pairs, places = _distinct(pair_keys(hashes, before))
                held[True][0].append(pairs)
                held[True][1].append(np.bincount(places))
                size += len(pairs) + len(known)
                if size >= FLUSH:
                    size = merge()
                    if size >= FLUSH // 2:
                        yield from flush()
                        size = 0
        yield from flush()

    return count


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)  # 1 + floor(log2(count))


def _entries(words: np.ndarray, pairs: np.ndarray) -> int:
    return int(_levels(words).sum() + _levels(pairs).sum())


def _segments(bits: int):
    """Sums what tasks have counted, one segment after the other; rows come in order of segment."""

    def build(segment: int, rows: list[tuple]) -> pa.RecordBatch:
        row: list = []
        for pair in (False, True):
            own = [(data, counts) for is_pair, data, counts in rows if is_pair == pair]
            keys = [_unpack_sorted(data) if pair else _unpack_low(data, segment, bits) for data, _ in own]
            row += _summed(keys, [np.frombuffer(c, "<u4").astype(np.int64) for _, c in own])
        words, word_counts, pairs, pair_counts = row
        own = _filter_bytes(words, word_counts, pairs, pair_counts, BITS, _entries(word_counts, pair_counts))
        values = [segment, words.tobytes(), word_counts.tobytes(), own.tobytes(), int(word_counts.sum()), len(words)]
        kinds = [pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.int64()]
        names = ["segment", "words", "word_counts", "filter", "tokens", "kinds"]
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
        for segment, members in groupby(rows, key=lambda row: row[0]):
            yield build(segment, [row[1:] for row in members])

    return work


def _places(keys: np.ndarray, level: int, bits: np.ndarray, probe: int) -> np.ndarray:
    spread = hashing.mixed(keys + np.uint64(level * _GOLDEN % 2**64))
    first, step = spread >> np.uint64(32), (spread & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((first + np.uint64(probe) * step) % bits).astype(np.int64)


def _filter_bytes(words, word_counts, pairs, pair_counts, bits_each: float, entries: int) -> np.ndarray:
    size = max(8, int(np.ceil(entries * bits_each / 8)))
    marks = np.zeros(size * 8, bool)
    total = np.full(1, size * 8, np.uint64)
    for keys, counts in ((short(words), word_counts), (pairs, pair_counts)):
        levels = _levels(counts)
        for level in range(1, int(levels.max(initial=0)) + 1):
            own = keys[levels >= level]
            for probe in range(PROBES):
                marks[_places(own, level, total, probe)] = True
    return np.packbits(marks, bitorder="little")


class LogFrequencyFilter(NamedTuple):
    """The Bloom filters of consecutive segments, one after the other, and the exact counts of their words."""

    segment_bits: int
    first: int  # segment
    data: np.ndarray
    starts: np.ndarray  # bytes
    bits: np.ndarray
    words: np.ndarray  # in order
    counts: np.ndarray

    def exact(self, words: np.ndarray) -> np.ndarray:
        """The counts of ``words``, which are in order."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at], 0)

    def levels(self, keys: np.ndarray, first: int) -> np.ndarray:
        """The highest level of each key that is there with all levels from ``first``; ``first`` - 1 without any."""
        segment = segment_of(keys, self.segment_bits) - self.first
        starts, bits = self.starts[segment], self.bits[segment]
        found = np.full(len(keys), first - 1, np.int64)
        open_ = np.arange(len(keys))
        for level in range(first, LEVELS):
            for probe in range(PROBES):
                if not len(open_):
                    return found
                at = _places(keys[open_], level, bits[open_], probe)
                there = (self.data[starts[open_] + (at >> 3)] >> (at & 7)) & 1
                open_ = open_[there.astype(bool)]
            found[open_] = level
        return found


def read_back(levels: np.ndarray, first: int) -> np.ndarray:
    """The count a level stands for, the middle of its range; 0 below ``first``."""
    middle = (2.0 ** (levels - 1) + 2.0**levels - 1) / 2
    return np.where(levels >= first, middle, 0.0)


def _assembled(rows: list, bits: int, first: int, last: int) -> LogFrequencyFilter:
    """The filter of the segments from ``first`` to before ``last``; one without n-grams is empty."""
    by_segment = {row["segment"]: row for row in rows}
    empty = np.zeros(8, np.uint8)
    ordered = [np.frombuffer(by_segment[s]["filter"], np.uint8) if s in by_segment else empty for s in range(first, last)]
    sizes = np.array([len(p) for p in ordered], np.int64)
    # Words of a segment are in order, and so are segments.
    words = b"".join(by_segment[s]["words"] for s in sorted(by_segment))
    counts = b"".join(by_segment[s]["word_counts"] for s in sorted(by_segment))
    return LogFrequencyFilter(
        bits,
        first,
        np.concatenate(ordered),
        np.cumsum(sizes) - sizes,
        (sizes * 8).astype(np.uint64),
        np.frombuffer(words, np.uint64),
        np.frombuffer(counts, np.int64),
    )


class Model(NamedTuple):
    """What scoring needs of the training text."""

    segments: DataFrame
    bits: int  # of a segment's number
    bounds: list[int]  # first segments of the ranges, and the number of segments
    tokens: int
    kinds: int

    def filter_of(self, part: int) -> LogFrequencyFilter:
        """The filter and counts of a range, at most RANGE_BYTES."""
        first, last = self.bounds[part : part + 2]
        own = self.segments.where((F.col("segment") >= first) & (F.col("segment") < last))
        return _assembled(own.select("segment", "filter", "words", "word_counts").collect(), self.bits, first, last)


def _range_bounds(segments: DataFrame, bits: int) -> list[int]:
    """Ranges of equally many segments, as many as it takes for the largest to fit."""
    size = F.octet_length("filter") + F.octet_length("words") + F.octet_length("word_counts")
    total = segments.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    ranges = min(2**bits, total // RANGE_BYTES + 1)
    while ranges < 2**bits:
        part = F.floor(F.col("segment") * ranges / 2**bits)
        largest = segments.groupBy(part).agg(F.sum(size).alias("size")).agg(F.max("size")).first()[0]
        if largest is None or largest <= RANGE_BYTES:
            break
        ranges += ranges // 8 + 1
    return [-(-part * 2**bits // ranges) for part in range(ranges + 1)]


def fit(docs: DataFrame) -> Model:
    """Counts all tokens and pairs of ``docs`` (text) and builds the filters. Without rows the model is empty."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(SEGMENT_BITS, (size // SEGMENT_TEXT).bit_length())
    counted = docs.select("text").mapInArrow(_counted(bits), COUNTS)
    dealt = counted.repartition("segment").sortWithinPartitions("segment")
    segments = cut_lineage(dealt.mapInArrow(_segments(bits), SEGMENT), "lm-segments")
    totals = segments.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("tokens", "kinds")]).first()
    return Model(segments, bits, _range_bounds(segments, bits), totals["tokens"], totals["kinds"])


# Three kinds of rows: a document, the tokens of a slice, and the n-grams that a slice asks of a later range (part from 1).
DOCUMENT, SLICE = -2, -1
PREPARED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("uid", pa.int64()),
        ("n_tokens", pa.int64()),
        ("known", pa.int64()),
        ("base", pa.float64()),
        ("score", pa.float64()),
        ("slice", pa.int64()),
        ("data", pa.binary()),
        ("part", pa.int32()),
    ]
)
PREPARED_DDL = (
    "doc_id long, held_out boolean, uid long, n_tokens long, known long, base double, score double, "
    "slice long, data binary, part int"
)
def _rows(length: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch of PREPARED; columns that are not given are NULL."""
    arrays = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(length, f.type) for f in PREPARED]
    return pa.RecordBatch.from_arrays(arrays, schema=PREPARED)


def _pack_slice(uids: np.ndarray, ends: np.ndarray, known: np.ndarray, numbers: np.ndarray) -> bytes:
    """A slice with its distinct tokens in order, so that their differences are short."""
    order = np.argsort(known)
    rank = np.empty(len(known), np.uint32)
    rank[order] = np.arange(len(known))
    parts = [column.astype(np.int64).tobytes() for column in (uids, ends)]
    return _framed(*parts, _squeezed(np.diff(known[order], prepend=np.uint64(0))), _squeezed(rank[numbers]))


def _unpack_slice(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(uids, ends, known, numbers), numbers being places among ``known`` in order."""
    uids, ends, known, numbers = _unframed(data)
    columns = [np.frombuffer(part, np.int64) for part in (uids, ends)]
    return *columns, np.cumsum(_expanded(known, np.uint64), dtype=np.uint64), _expanded(numbers, np.uint32).astype(np.int64)


def _grams(known: np.ndarray, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key of each distinct word, number of the token in front of each, key of each pair)."""
    before = _before(numbers, ends, _end_number(known))
    return keys_of(known), before, pair_keys(known[numbers], known[before])


class Totals(NamedTuple):
    tokens: int
    kinds: int
    prior: float
    bits: int
    bounds: list[int]

    def ends(self, keys: np.ndarray) -> np.ndarray:
        """Where the keys of each range begin and end; ``keys`` are in order."""
        return np.searchsorted(segment_of(keys, self.bits), np.array(self.bounds))


class Asked(NamedTuple):
    """The distinct words and n-grams of a slice, in order of key."""

    words: np.ndarray
    word_places: np.ndarray  # of every distinct token among ``words``
    grams: np.ndarray
    gram_places: np.ndarray  # of every distinct token, then of every pair, among ``grams``
    before: np.ndarray

    @classmethod
    def of(cls, known: np.ndarray, numbers: np.ndarray, ends: np.ndarray) -> Asked:
        keys, before, pairs = _grams(known, numbers, ends)
        return cls(*_distinct(keys), *_distinct(np.concatenate([short(keys), pairs])), before)


def _told(own: LogFrequencyFilter, words: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return own.exact(words), own.levels(grams, 1).astype(np.uint8)


def _text_scores(model: Totals, asked: Asked, counts, levels, numbers: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """(known tokens, base score, score) of every text of a slice, from the counts of its words and levels of its n-grams."""
    exact = counts[asked.word_places]
    base = np.log10((exact + ADD) / (model.tokens + ADD * (model.kinds + 1)))[numbers]
    known = (exact > 0).astype(np.int64)[numbers]
    # No count is more than all tokens, whatever its level stands for.
    read = np.minimum(read_back(levels.astype(np.int64), 1), model.tokens)[asked.gram_places]
    alone, pair = read[: len(exact)], read[len(exact) :]
    share = (alone + ADD) / (model.tokens + ADD * (model.kinds + 1))
    context = alone[asked.before]
    chance = (np.minimum(pair, context) + model.prior * share[numbers]) / (context + model.prior)
    return [np.add.reduceat(column, ends[:-1]) for column in (known, base, np.log10(chance))]


def _pack_told(counts: np.ndarray, levels: np.ndarray) -> bytes:
    return _framed(_squeezed(counts.astype(np.int64)), _squeezed(levels))


def _unpack_told(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    counts, levels = _unframed(data)
    return _expanded(counts, np.int64), _expanded(levels, np.uint8)


def _pack_asked(words: np.ndarray, grams: np.ndarray) -> bytes:
    return _framed(_squeezed(np.diff(words, prepend=np.uint64(0))), _pack_sorted(grams))


def _unpack_asked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    words, grams = _unframed(data)
    return np.cumsum(_expanded(words, np.uint64), dtype=np.uint64), _unpack_sorted(grams)


def _prepared(first_range, model: Totals):
    """Documents, with scores where there is one range; slices, and what later ranges have to be asked, where there are more."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LogFrequencyFilter(*first_range.value)
        whole = len(model.bounds) == 2
        for batch in batches:
            for first, texts in hashing.slices(batch, "text", SLICE_TEXT):
                tokens, numbers, ends = _tokens(texts)
                asked = Asked.of(tokens, numbers, ends)
                word_ends, gram_ends = model.ends(asked.words), model.ends(asked.grams)
                told = _told(own, asked.words[: word_ends[1]], asked.grams[: gram_ends[1]])
                scores = {}
                if whole:
                    found = _text_scores(model, asked, *told, numbers, ends)
                    scores = {name: pa.array(column) for name, column in zip(("known", "base", "score"), found)}
                part = batch.slice(first, len(texts))
                columns = {name: part.column(name) for name in ("doc_id", "held_out", "uid")}
                size = pa.array(np.diff(ends))
                yield _rows(len(texts), **columns, n_tokens=size, part=pa.array(np.full(len(texts), DOCUMENT)), **scores)
                if whole:
                    continue
                uids = part.column("uid").to_numpy()
                bounds = list(zip(word_ends[1:], word_ends[2:], gram_ends[1:], gram_ends[2:]))
                data = [_pack_slice(uids, ends, tokens, numbers), _pack_told(*told)]
                data += [_pack_asked(asked.words[a:b], asked.grams[c:d]) for a, b, c, d in bounds]
                kinds = [SLICE, *range(len(model.bounds) - 1)]
                name = pa.array(np.full(len(kinds), uids[0]))
                yield _rows(len(kinds), slice=name, data=pa.array(data, pa.binary()), part=pa.array(kinds))

    return prepare


def _probed(shared):
    """(slice, data, part): the answers to what data asks."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LogFrequencyFilter(*shared.value)
        for batch in batches:
            told = [_pack_told(*_told(own, *_unpack_asked(data.as_py()))) for data in batch.column("data")]
            columns = [batch.column("slice"), pa.array(told, pa.binary()), batch.column("part")]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "data", "part"])

    return probe


def _scored(model: Totals):
    """(uid, known, base, score) of the documents of each slice; its tokens come first, then the answers by range."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
        for _, members in groupby(rows, key=lambda row: row[0]):
            (_, tokens, _), *answers = members
            uids, ends, known, numbers = _unpack_slice(tokens)
            asked = Asked.of(known, numbers, ends)
            counts, levels = (np.concatenate(parts) for parts in zip(*(_unpack_told(data) for _, data, _ in answers)))
            if (len(counts), len(levels)) != (len(asked.words), len(asked.grams)):
                raise ValueError(f"{len(levels)} levels for {len(asked.grams)} n-grams")
            found = _text_scores(model, asked, counts, levels, numbers, ends)
            columns = [pa.array(column) for column in (uids, *found)]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "known", "base", "score"])

    return score


def _slice_scores(prepared: DataFrame, source: str, model: Model, totals: Totals) -> DataFrame:
    """(uid, known, base, score) where there are several ranges: each is broadcast in turn and told what is asked of it.

    ``prepared`` was read from ``source``; what has been answered there is dropped.
    """
    spark = prepared.sparkSession
    path = new_path(spark, "lm-answers")
    slices = prepared.select("slice", "data", "part")
    for part in range(1, len(model.bounds) - 1):
        shared = spark.sparkContext.broadcast(tuple(model.filter_of(part)))
        asked = slices.where(F.col("part") == part)
        asked.mapInArrow(_probed(shared), "slice long, data binary, part int").write.parquet(f"{path}/range={part}")
        shared.destroy()
        drop_path(spark, f"{source}/part={part}")
    answers = spark.read.schema("slice long, data binary, part int").parquet(path).select("slice", "data", "part")
    # Listed anew, without the partitions that are gone.
    rest = spark.read.schema(PREPARED_DDL).parquet(source).select("slice", "data", "part")
    whole = rest.where(F.col("part").isin(SLICE, 0)).unionByName(answers)
    ordered = whole.repartition("slice").sortWithinPartitions("slice", "part")
    return ordered.mapInArrow(_scored(totals), "uid long, known long, base double, score double")


def score(docs: DataFrame, held_parts: int = 10, prior: float = PRIOR) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text).

    One in ``held_parts`` documents, by the checksum of its id, is held out; the others are the training text.
    NULL texts are empty: one END token. NULL ids count as an empty id. Every row is scored by itself, equal rows alike. A table
    without training rows gives every token the same share. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (held_part("doc_id", held_parts) == 0).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")))
    totals = Totals(model.tokens, model.kinds, prior, model.bits, model.bounds)
    first = spark.sparkContext.broadcast(tuple(model.filter_of(0)))
    numbered = rows.withColumn("uid", F.monotonically_increasing_id())
    path = new_path(spark, "lm-prepared")
    numbered.mapInArrow(_prepared(first, totals), PREPARED_DDL).write.partitionBy("part").parquet(path)
    prepared = spark.read.schema(PREPARED_DDL).parquet(path)
    found = prepared.where(F.col("part") == DOCUMENT)
    if len(model.bounds) > 2:
        scores = _slice_scores(prepared, path, model, totals)
        found = spark.read.schema(PREPARED_DDL).parquet(path).where(F.col("part") == DOCUMENT)
        found = found.select("doc_id", "held_out", "uid", "n_tokens").join(scores, "uid")
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
