"""Conversations as ordered streams: what the operators on their turns share.

A partition holds whole conversations, sorted by Spark (which spills), and is read row by row.
So a conversation of any length is never collected: a task holds one Arrow batch and what its
reader keeps. Its rows do pass through one task, since a digest of a whole conversation can only be
taken in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows and characters that a task gathers before it passes them on.
OUT_ROWS = 4096
OUT_CHARS = 4_000_000


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """Whole conversations per partition, each in ``order`` (nulls first)."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) one after the other; the first column is conv_id, the rest makes the rows."""
    rows = chain.from_iterable(zip(*(column.to_pylist() for column in batch.columns), strict=True) for batch in batches)
    for conv_id, members in groupby(rows, key=lambda row: row[0]):
        yield conv_id, (row[1:] for row in members)


def arrow_schema(columns: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(columns))


def write(rows: Iterable[tuple], schema: pa.Schema, size=lambda row: 0) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``OUT_ROWS`` rows, and of few more than ``OUT_CHARS`` by ``size``."""

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += size(row)
        if len(held) >= OUT_ROWS or chars >= OUT_CHARS:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()
