"""Checks that replace enforced keys and column widths (INT-1..4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.schemas import COLUMN_WIDTHS


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; a key with a NULL part never collides."""
    known = df.where(" and ".join(f"`{name}` is not null" for name in key))
    return known.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def check_fk(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-null child values without a parent, with the number of rows that hold them.

    Values are counted before the join, so a value with very many rows is one row in it.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    counted = values.agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parent.select(F.col(key).alias("value")), "value", "left_anti")


def check_codes(df: DataFrame, column: str, codes: Sequence[str]) -> DataFrame:
    """Codes outside a code table, with their number of rows."""
    unknown = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(codes)))
    return unknown.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def too_long(df: DataFrame, column: str, width: int) -> Column:
    return F.char_length(F.col(column)) > width


def check_lengths(df: DataFrame, widths: dict[str, int], id_column: str = "id") -> DataFrame:
    """(id, column, length) of every value wider than its column, in one pass over the table."""
    checks = F.array(
        *[
            F.when(too_long(df, name, width), F.struct(F.lit(name).alias("column"), F.char_length(name).alias("length")))
            for name, width in widths.items()
        ]
    )
    found = df.select(F.col(id_column).alias("id"), F.explode(checks).alias("_found")).where("_found is not null")
    return found.select("id", "_found.column", "_found.length")


def widths_of(table: str) -> dict[str, int]:
    return {column: width for (name, column), width in COLUMN_WIDTHS.items() if name == table}
