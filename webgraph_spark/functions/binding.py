"""Local names inside Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    Without it an expression used inside a lambda runs again for every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)
