"""Best-fit packing with exact-complement hashing.

Lengths are bounded by the size of a sequence, so the whole corpus is described by one
count per length. The plan is made on these counts: for the largest length still available the
gap it leaves is looked up among single lengths, sums of two and sums of three that are
available, and a combination that fills it exactly is used as often as the counts allow.
What has no exact complement is placed by best fit, largest first, into the smallest gap that
holds it. Every step of the plan handles a whole run of equal sequences, so the number of
steps depends on the size of a sequence, not on the number of documents.

Spark numbers the pieces of each length; a piece finds its sequence from its length and number.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.llm.tokens import encoder
from webgraph_spark.session import cut_lineage

CAPACITY = 2048
END = 0
# Parts in which the pieces of one length are numbered, so that a frequent length is not one group.
PARTS = 1024

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, capacity: int, end: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        last = int(end).to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + last
                total = len(ids) // 4
                # Only the first piece may be shorter, so what is left over comes first.
                stop = total % capacity or min(capacity, total)
                start = piece = 0
                while start < total:
                    part = ids[4 * start : 4 * stop]
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(part), part if keep_ids else None))
                    start, stop, piece = stop, stop + capacity, piece + 1
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            stop = len(names) if keep_ids else -1
            yield pa.RecordBatch.from_arrays(arrays[:stop], names[:stop])

    return cut


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the tokens of each text and ``end``, cut to ``capacity``.

    With ``keep_ids`` also ids, little-endian 32-bit. A NULL or empty text is ``end`` alone.
    """
    schema = PIECES + (", ids binary" if keep_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer, capacity, end, keep_ids), schema)


def _complement(counts: np.ndarray, first: int, gap: int) -> tuple[int, ...] | None:
    """Up to three available lengths that fill ``gap`` beside one of length ``first``; large ones first."""

    def available(*lengths: int) -> bool:
        wanted = [first, *lengths]
        return all(counts[x] >= wanted.count(x) for x in lengths)

    if counts[gap] and available(gap):
        return (gap,)
    there = counts[: gap + 1] > 0
    there[0] = False
    # Sums of two: length a and gap - a, both there.
    for a in np.flatnonzero(there & there[::-1])[::-1]:
        if 2 * a < gap:
            break
        if available(int(a), gap - int(a)):
            return int(a), gap - int(a)
    single = np.flatnonzero(there)
    for a in single[::-1]:
        a = int(a)
        if 3 * a < gap:
            break
        rest = gap - a
        part = counts[: rest + 1] > 0
        part[0] = False
        for b in np.flatnonzero(part & part[::-1])[::-1]:
            b = int(b)
            if b > a:
                continue
            if 2 * b < rest:
                break
            if available(a, b, rest - b):
                return a, b, rest - b
    return None


def pack_lengths(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """The plan: (((length, how many), ...), number of sequences), from the count of each length.

    Its size is bounded by ``capacity``: every step uses up a length or an open run of sequences.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in lengths.items():
        counts[length] = n
    plan: list[tuple[tuple[tuple[int, int], ...], int]] = []
    if counts[capacity]:
        plan.append((((capacity, 1),), int(counts[capacity])))
        counts[capacity] = 0
    left: list[tuple[int, int]] = []
    for length in range(capacity - 1, 0, -1):
        while counts[length]:
            others = _complement(counts, length, capacity - length)
            if others is None:
                left.append((length, int(counts[length])))
                counts[length] = 0
                break
            used = [length, *others]
            times = min(int(counts[x]) // used.count(x) for x in used)
            for x in used:
                counts[x] -= times
            plan.append((tuple((x, 1) for x in used), times))
    # Best fit of what is left: open runs of equal sequences, by their gap.
    runs: dict[int, list] = {}
    gaps: list[int] = []

    def put(gap: int, content: tuple, n: int) -> None:
        if gap not in runs:
            runs[gap] = []
            insort(gaps, gap)
        runs[gap].append((content, n))

    for length, n in left:
        while n:
            at = int(np.searchsorted(gaps, length))
            if at == len(gaps):
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    put(capacity - each * length, ((length, each),), full)
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                break
            gap = gaps[at]
            content, there = runs[gap].pop()
            if not runs[gap]:
                del runs[gap]
                gaps.pop(at)
            # A sequence takes as many as fit before the next one is opened.
            each = min(gap // length, n)
            times = min(there, n // each)
            if times < there:
                put(gap, content, there - times)
            put(gap - each * length, (*content, (length, each)), times)
            n -= times * each
    plan.extend(run for gap in list(gaps) for run in runs[gap])
    return plan


def _places(plan) -> dict[str, np.ndarray]:
    """The plan by (length, number of the piece within its length)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for content, times in plan:
        offset = 0
        for length, each in content:
            first = used.get(length, 0)
            rows.append((length, first, each, sequence, offset))
            used[length] = first + each * times
            offset += length * each
        sequence += times
    rows.sort()
    names = ["length", "first", "each", "sequence", "offset"]
    return {name: np.array(column, dtype=np.int64) for name, column in zip(names, zip(*rows))} if rows else {n: np.zeros(0, np.int64) for n in names}


def _locate(places: dict[str, np.ndarray]):
    # Lengths are small, numbers in a length below 2**47: one sorted key for both.
    keys = (places["length"] << 47) + places["first"]

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            number = batch.pop("_number").to_numpy(np.int64)
            at = np.searchsorted(keys, (length << 47) + number, side="right") - 1
            inside = number - places["first"][at]
            each = places["each"][at]
            batch["sequence_id"] = places["sequence"][at] + inside // each
            batch["offset"] = places["offset"][at] + inside % each * length
            yield batch

    return locate


def number_in_length(pieces: DataFrame) -> DataFrame:
    """Adds _number: from 0, without gaps, among the pieces of one length.

    Pieces of a length are numbered in PARTS parts; the counts of the parts, at most
    PARTS rows per length, say where each part begins.
    """
    part = F.pmod(F.xxhash64("uid"), F.lit(PARTS)).cast("int")
    parted = pieces.withColumn("_part", part)
    counts = parted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_part").orderBy("uid")
    numbered = parted.withColumn("_in", F.row_number().over(inside)).join(counts, ["length", "_part"])
    return numbered.withColumn("_number", F.col("_before") + F.col("_in") - 1).drop("_before", "_in", "_part", "uid")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, ...) with sequence_id and offset.

    The driver sees one count per length and makes the plan from it; both are bounded by
    ``capacity`` whatever the number of pieces. Rows with equal ids are different pieces.
    No pieces give no rows.
    """
    kept = cut_lineage(pieces.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    counts = kept.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    plan = pack_lengths({row["length"]: row["n"] for row in counts}, capacity)
    numbered = number_in_length(kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "_number")
    return numbered.mapInPandas(_locate(_places(plan)), f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """All ``docs`` (doc_id, text) as pieces with a place in sequences of at most ``capacity`` tokens."""
    return pack(token_pieces(docs, tokenizer, capacity, keep_ids=keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from ``pack_documents(..., keep_ids=True)``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda so_far, piece: F.concat(so_far, piece["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
