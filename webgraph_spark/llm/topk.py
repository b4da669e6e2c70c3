"""Exact top-k inner products with MaxScore.

A vector is a document whose terms are its components, kept in shards of
``SHARD_ROWS`` vectors with one posting column per term. Components may be negative, so every
term is counted from the end of its range that is worst for the query: what a vector
gains above that is at least 0 and at most |q| times the range. For each query the terms are
ordered by that bound. Those whose bounds together cannot lift a vector from the base to the k-th
best score so far are non-essential. The essential postings are traversed; the others are
probed, largest bound first, only for vectors that can still reach the k-th score.
Shards give at most k rows per query, which are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.session import cut_lineage

# Bounds of one block: a task holds one block of queries and one shard of vectors at a time.
SHARD_ROWS = 4096
QUERY_ROWS = 1024
# The grid of tasks: every query block goes to each lane of shards and the other way round.
SHARD_LANES = 32
QUERY_LANES = 8
# Terms probed together before vectors that cannot reach the k-th score are dropped.
PROBE = 8

BLOCK_SCHEMA = "block long, uids binary, ids binary, nulls binary, width int, parts binary"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; NULL for vectors that take no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.when(whole, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _pack(rows: int):
    """Blocks of at most ``rows`` rows; a batch of input becomes one or more of them."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at : at + rows]
                width = max((len(v) for v in part["parts"]), default=0)
                matrix = np.zeros((len(part), width), dtype=np.int64)
                for row, v in enumerate(part["parts"]):
                    matrix[row, : len(v)] = v
                uids = part["uid"].to_numpy(np.int64)
                yield pd.DataFrame(
                    {
                        "block": [int(uids[0])],
                        "uids": [uids.tobytes()],
                        "ids": [part["id"].fillna(0).to_numpy(np.int64).tobytes()],
                        "nulls": [part["id"].isna().to_numpy().tobytes()],
                        "width": [width],
                        "parts": [matrix.tobytes()],
                    }
                )

    return pack


def _unpack(uids: bytes, ids: bytes, nulls: bytes, width: int, parts: bytes, wanted: int):
    """The arrays of a block; vectors are padded to ``wanted`` terms."""
    own = np.frombuffer(uids, np.int64)
    matrix = np.frombuffer(parts, np.int64).reshape(len(own), width)
    return own, np.frombuffer(ids, np.int64), np.frombuffer(nulls, bool), np.pad(matrix, ((0, 0), (0, wanted - width)))


def _best(scores, ids, nulls, uids, k):
    """Places of the k best: highest score, then smallest id, NULL ids last."""
    return np.lexsort((uids, ids, nulls, -scores))[:k]


def max_score(query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, floor: int | None):
    """(places, scores) of all vectors that reach ``floor``; exact scores.

    ``postings`` has one row per term and one column per vector, ``low`` and ``high`` the range
    of each term in the shard.
    """
    worst = np.where(query >= 0, low, high)
    bounds = np.abs(query) * (high - low)
    base = int(query @ worst)
    order = np.argsort(-bounds, kind="stable")
    rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
    if floor is None:
        essential = len(order)
    else:
        essential = int(np.argmax(base + rest < floor)) if base < floor else len(order)
    if floor is not None and base + rest[0] < floor:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    terms = order[:essential]
    scores = base + query[terms] @ (postings[terms] - worst[terms, None])
    at = np.arange(postings.shape[1])
    for start in range(essential, len(order), PROBE):
        keep = scores + rest[start] >= floor
        at, scores = at[keep], scores[keep]
        if not len(at):
            break
        terms = order[start : start + PROBE]
        scores = scores + query[terms] @ (postings[np.ix_(terms, at)] - worst[terms, None])
    if floor is not None:
        keep = scores >= floor
        at, scores = at[keep], scores[keep]
    return at, scores


def _search(k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                width = max(row.s_width, row.q_width)
                uids, ids, nulls, matrix = _unpack(row.s_uids, row.s_ids, row.s_nulls, row.s_width, row.s_parts, width)
                q_uids, q_ids, _, queries = _unpack(row.q_uids, row.q_ids, row.q_nulls, row.q_width, row.q_parts, width)
                postings = np.ascontiguousarray(matrix.T)
                low, high = postings.min(axis=1, initial=0), postings.max(axis=1, initial=0)
                for n, q_uid in enumerate(q_uids):
                    known = found.get(int(q_uid))
                    floor = int(known[1][-1]) if known is not None and len(known[1]) >= k else None
                    at, scores = max_score(queries[n], postings, low, high, floor)
                    own = uids[at] != q_uid
                    at, scores = at[own], scores[own]
                    new = (scores, ids[at], nulls[at], uids[at])
                    if known is not None:
                        new = tuple(np.concatenate(pair) for pair in zip(known[1:], new))
                    keep = _best(*new, k)
                    found[int(q_uid)] = (int(q_ids[n]), *(column[keep] for column in new))
        for q_uid, (q_id, scores, ids, nulls, uids) in found.items():
            yield pd.DataFrame(
                {
                    "query_uid": q_uid,
                    "query_id": q_id,
                    "uid": uids,
                    "vec_id": pd.array(ids, dtype="Int64").take(np.where(nulls, -1, np.arange(len(ids))), allow_fill=True),
                    "score": scores,
                }
            )

    return search


def top_k(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row where ``queries`` holds.

    Candidates are all rows but the query's own row; a repeated row is a candidate for its copy. Ties
    go to the smaller id, NULL ids last. Vectors that are NULL or hold NULL or non-finite components
    take no part; shorter vectors count as padded with zeros. A query with fewer than ``k``
    candidates gets all of them. Scores must fit a 64-bit integer.

    Query blocks and shards are laid out on a fixed grid of lanes and meet by an equality join on the
    cell, each pair once; a task keeps k rows per query of its cells.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(vec_id).cast("long").alias("id"),
        quantised(F.col(vector)).alias("parts"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).where(F.col("parts").isNotNull())
    rows = cut_lineage(rows, "topk-vectors")
    shards = cut_lineage(rows.select("uid", "id", "parts").mapInPandas(_pack(SHARD_ROWS), BLOCK_SCHEMA), "topk-shards")
    asked = rows.where("asks").select("uid", "id", "parts")
    blocks = cut_lineage(asked.mapInPandas(_pack(QUERY_ROWS), BLOCK_SCHEMA), "topk-queries")
    names = blocks.columns
    lane = lambda lanes: F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")
    every = lambda lanes: F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    left = shards.select(*[F.col(n).alias(f"s_{n}") for n in names], lane(SHARD_LANES).alias("s_lane"), every(QUERY_LANES).alias("q_lane"))
    right = blocks.select(*[F.col(n).alias(f"q_{n}") for n in names], every(SHARD_LANES).alias("s_lane"), lane(QUERY_LANES).alias("q_lane"))
    pairs = left.join(right, ["s_lane", "q_lane"])
    schema = "query_uid long, query_id long, uid long, vec_id long, score long"
    found = pairs.mapInPandas(_search(k), schema)
    order = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
