"""Claims of workers on frontier pages: who holds which page (TOP-1, CLS-4, CLS-5).

Workers write to a log that only grows: page, taker, time and how long the claim lasts. Who holds a page follows from the
log alone, so no row is ever locked or changed: a claim wins if the page is free at its time, and it frees the page
again when it expires. Which claims win depends on those that won before, so the claims of a page are read in order;
a task keeps one time per page, however many claims there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = ["at", "claim_id"]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    page, free = None, None
    for batch in batches:
        won = []
        for own, at, until in zip(*(batch.column(c).to_pylist() for c in ("page_id", "_at", "_until")), strict=True):
            if own != page:
                page, free = own, None
            won.append(free is None or at >= free)
            if won[-1]:
                free = until
        yield batch.select(["claim_id", "page_id", "taker"]).append_column("won", pa.array(won, pa.bool_()))


def fold_claims(claims: DataFrame) -> DataFrame:
    """(claim_id, page_id, taker, won) of claims (claim_id, page_id, taker, at, lease), lease in seconds.

    The first claim of a page wins; while it lasts all others are refused, those of its own taker too. Claims of one
    moment go by claim_id. Claims without a page or time are left out; one without a lease never expires.
    """
    kinds = dict(claims.dtypes)
    micros = F.unix_micros(F.col("at").cast("timestamp"))
    forever = F.lit(2**63 - 1)
    until = F.coalesce(micros + F.col("lease").cast("long") * 1_000_000, forever)
    known = claims.where("page_id is not null and at is not null")
    rows = known.select("claim_id", "page_id", "taker", micros.alias("_at"), until.alias("_until"))
    dealt = rows.repartition("page_id").sortWithinPartitions("page_id", "_at", "claim_id")
    schema = f"claim_id {kinds['claim_id']}, page_id {kinds['page_id']}, taker {kinds['taker']}, won boolean"
    return dealt.mapInArrow(_fold, schema)


def held_pages(claims: DataFrame, now) -> DataFrame:
    """(page_id, taker) of the pages that a claim holds at ``now``, a timestamp column or literal."""
    winners = fold_claims(claims.where(F.col("at") <= now)).where("won").select("claim_id", "page_id", "taker")
    lasting = claims.select("claim_id", "page_id", "at", "lease").join(winners, ["claim_id", "page_id"])
    end = F.unix_micros(F.col("at").cast("timestamp")) + F.col("lease").cast("long") * 1_000_000
    return lasting.where(F.coalesce(end > F.unix_micros(now.cast("timestamp")), F.lit(True))).select("page_id", "taker")


def with_claims(pages: DataFrame, claims: DataFrame, now) -> DataFrame:
    """``pages`` with active_in_crawler as the log has it at ``now``: true while held, else NULL."""
    held = held_pages(claims, now).select(F.col("page_id").alias("id"), F.lit(True).alias("_held"))
    return pages.drop("active_in_crawler").join(held, "id", "left").withColumnRenamed("_held", "active_in_crawler")
