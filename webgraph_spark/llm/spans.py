"""Places of regular expressions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,hit:string,before:string>>"


def spans(text: Column, pattern: Column, measure: Callable[[Column], Column] = F.char_length) -> Column:
    """All leftmost non-overlapping matches: start, end (exclusive), the match, and what stands before it
    since the last match. Lengths are counted by ``measure``. The pattern must not match empty text.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.arrays_zip(gaps.alias("before"), hits.alias("hit"))
    whole = F.filter(pairs, lambda p: p["hit"].isNotNull())

    def step(done: Column, pair: Column) -> Column:
        start = (done["at"] + measure(pair["before"])).cast("int")
        end = (start + measure(pair["hit"])).cast("int")
        found = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"), pair["before"].alias("before"))
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(found)).alias("found"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))
    return F.aggregate(whole, nothing, step)["found"]


def no_spans() -> Column:
    return F.array().cast(SPANS)


def join_sorted(values: Column) -> Column:
    """Distinct values in order, joined by commas; nothing gives an empty string."""
    return F.array_join(F.array_sort(F.array_distinct(values)), ",")
