"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, and a word as a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Only A-Z become lower case."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "left") -> DataFrame:
    """Joins on ``names``, NULL equal to NULL; the names come once, from ``left``."""
    theirs = {name: f"_{name}_of_right" for name in names}
    right = right.withColumnsRenamed(theirs)
    match = reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[t]) for n, t in theirs.items()])
    return left.join(right, match, how).drop(*theirs.values())


def held_part(doc_id: str | Column, parts: int) -> Column:
    """CRC32 of the id as text, modulo ``parts``; NULL ids count as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(parts)).cast("int")
