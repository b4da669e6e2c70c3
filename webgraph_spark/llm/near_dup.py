"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

Documents with the same shingle set are one class and go on as one row. Signatures of ``BANDS`` bands of ``ROWS``
values propose candidates; a pair at the threshold is missed with probability (1 - 0.75**6)**64, about 4e-6.
Candidates are compared by their signatures in batches of ``BATCH`` values: after each batch the pair is dropped if the
posterior probability of a similarity of at least the threshold is below ``MISS``. Survivors are verified on full sets.

A bucket never pairs with itself. First all members meet the bucket's smallest one, which settles most groups of copies in
linear size. Then members meet a few leaders of their bucket that lie in other components, and components grow. What is
still apart is paired through differences. Classes that buckets hold together, directly or over others, share a reference
for each range of sizes, and each class is described by what it has and the reference has not, or the other way round. Two
sets are similar when these descriptions differ in at most a seventh of their sizes together. So a pair either has
rare parts of its descriptions in common, at places that still allow enough common parts after them, and is met there; or
both lie so near the reference that comparing each class with the reference links them. Edited copies of one text that
have their edits in different places therefore never meet.

Texts of any length are read whole. Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.llm import hashing
from webgraph_spark.llm.common import same
from webgraph_spark.llm.components import components
from webgraph_spark.session import cut_lineage, drop_tables

SHINGLE = 5
PERCENT = 75
BANDS = 64
ROWS = 6
SKETCH = 128  # signature values that are compared, 16 bits of each
BATCH = 16
MISS = 1e-6
LEADERS = 4  # of a bucket
BITS = 2**23  # of the filter in front of the second reading; its size is fixed
COLUMNS = 1024  # shingles hashed at once, so that the block stays in cache

PRINT = "uid long, doc_id long, text_a long, text_b long, n_shingles long, high long, low long, bands array<long>, sketch binary"


def shingle_sets(texts: list[list[bytes]]) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of the distinct shingles of each text.

    A text of fewer than SHINGLE words has its whole sequence as one; a text without words has none.
    """
    words, ends = hashing.word_hashes(texts)
    factors = hashing.multipliers(SHINGLE, 11)
    windows = max(len(words) - SHINGLE + 1, 0)
    joined = np.zeros(windows, np.uint64)
    for k in range(SHINGLE):
        joined += words[k : k + windows] * factors[k]
    joined = hashing.mixed(joined)
    for first, last in zip(ends[:-1], ends[1:]):
        n = int(last - first)
        if n >= SHINGLE:
            yield np.unique(joined[first : last - SHINGLE + 1])
        elif n:
            whole = (words[first:last] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
            yield hashing.mixed(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


class Signer:
    """MinHash values of a shingle set under fixed affine functions of 32-bit hashes."""

    def __init__(self):
        count = BANDS * ROWS
        self.a = hashing.multipliers(count, 21, np.uint32)[:, None]
        self.b = hashing.multipliers(count, 22, np.uint32)[:, None]
        self.factors = hashing.multipliers(ROWS, 23)
        self.salts = hashing.multipliers(BANDS, 24)
        self.block = np.empty((count, COLUMNS), np.uint32)

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        short = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
        least = None
        for at in range(0, short.shape[1], COLUMNS):
            part = short[:, at : at + COLUMNS]
            block = self.block[:, : part.shape[1]]
            np.multiply(self.a, part, out=block)
            block += self.b
            found = block.min(axis=1)
            least = found if least is None else np.minimum(least, found)
        return least

    def bands(self, signature: np.ndarray) -> np.ndarray:
        rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
        return hashing.mixed((rows * self.factors).sum(axis=1, dtype=np.uint64) + self.salts).view(np.int64)


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    signer = Signer()
    for batch in batches:
        for first, texts in hashing.slices(batch, "text"):
            sizes, highs, lows, bands, sketches = [], [], [], [], []
            for shingles in shingle_sets(texts):
                sizes.append(len(shingles))
                high, low = _set_key(shingles)
                highs.append(high)
                lows.append(low)
                if len(shingles):
                    signature = signer.sign(shingles)
                    bands.append(signer.bands(signature))
                    sketches.append(signature[:SKETCH].astype(np.uint16).tobytes())
                else:
                    bands.append(None)
                    sketches.append(None)
            part = batch.slice(first, len(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(name) for name in ("uid", "doc_id", "text_a", "text_b")],
                    pa.array(sizes, pa.int64()),
                    pa.array(highs, pa.int64()),
                    pa.array(lows, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["uid", "doc_id", "text_a", "text_b", "n_shingles", "high", "low", "bands", "sketch"],
            )


@lru_cache(maxsize=1)
def least_matches() -> list[int]:
    """Matches needed after each batch: fewer leave a posterior below MISS (uniform prior)."""
    needed = []
    for seen in range(BATCH, SKETCH + 1, BATCH):
        n, below, m = seen + 1, 0.0, -1
        # The chance of a similarity of at least t after m matches of `seen` is that of at most m successes in seen + 1.
        while True:
            more = below + comb(n, m + 1) * (PERCENT / 100) ** (m + 1) * (1 - PERCENT / 100) ** (n - m - 1)
            if more >= MISS:
                break
            below, m = more, m + 1
        needed.append(m + 1)
    return needed


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), SKETCH)


def _plausible(needed: list[int]):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = _sketches(batch.column("sketch_a")), _sketches(batch.column("sketch_b"))
            open_, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for step, least in enumerate(needed):
                span = slice(step * BATCH, (step + 1) * BATCH)
                matches = matches + (left[open_, span] == right[open_, span]).sum(axis=1)
                open_, matches = open_[matches >= least], matches[matches >= least]
            yield batch.select(["a", "b"]).take(pa.array(open_))

    return keep


def _sets(bitmap: bytes):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            bits = batch.column("bit").to_numpy()
            batch = batch.filter(pa.array((wanted[bits >> 3] >> (bits & 7)) & 1).cast(pa.bool_()))
            for _, texts in hashing.slices(batch, "text"):
                found = [(*_set_key(s), s.tobytes()) for s in shingle_sets(texts) if len(s)]
                highs, lows, sets = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(highs, pa.int64()), pa.array(lows, pa.int64()), pa.array(sets, pa.binary())],
                    ["high", "low", "shingles"],
                )

    return collect


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("set_a"), batch.column("set_b")):
            a, b = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def fitting(n: Column, m: Column) -> Column:
    """Sets of these sizes can be similar at all."""
    return (n * 100 >= m * PERCENT) & (m * 100 >= n * PERCENT)


def _filter_bit(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(BITS)).cast("long")


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, shingles) of the classes ``wanted`` (rep, doc_id, high, low), from a second reading of the texts.

    A filter of fixed size keeps most other texts out; the join on the set keys is what decides.
    """
    bit = _filter_bit(F.col("doc_id"))
    # One bitmap of 4 KB per bucket: BITS / 8 bytes in all, whatever the number of documents.
    parts = (
        wanted.select(F.bitmap_bucket_number(bit + 1).alias("bucket"), F.bitmap_bit_position(bit + 1).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    width = 4096
    bitmap = bytearray(BITS // 8)
    for part in parts:
        at = (part["bucket"] - 1) * width
        bitmap[at : at + width] = part["bits"]
    rows = docs.select("text", bit.alias("bit"))
    found = rows.mapInArrow(_sets(bytes(bitmap)), "high long, low long, shingles binary")
    keyed = found.join(wanted.select("rep", "high", "low"), ["high", "low"])
    return keyed.groupBy("rep").agg(F.first("shingles").alias("shingles"))


def _survivors(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of classes that the signatures do not rule out."""
    sketch = reps.select("rep", "sketch")
    with_a = pairs.join(sketch.withColumnsRenamed({"rep": "a", "sketch": "sketch_a"}), "a")
    both = with_a.join(sketch.withColumnsRenamed({"rep": "b", "sketch": "sketch_b"}), "b").select("a", "b", "sketch_a", "sketch_b")
    return cut_lineage(both.mapInArrow(_plausible(least_matches()), "a long, b long"), "neardup-survivors")


def _links(survivors: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``survivors`` (a, b) whose full sets reach the threshold."""
    with_a = survivors.join(sets.withColumnsRenamed({"rep": "a", "shingles": "set_a"}), "a")
    with_both = with_a.join(sets.withColumnsRenamed({"rep": "b", "shingles": "set_b"}), "b")
    return cut_lineage(with_both.select("a", "b", "set_a", "set_b").mapInArrow(_similar, "a long, b long"), "neardup-links")


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """``members`` with the component of each class; one without links is its own."""
    known = found.withColumnRenamed("id", "rep")
    return members.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _open(placed: DataFrame) -> DataFrame:
    """The rows of buckets that still hold several components."""
    apart = placed.groupBy("band").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b")
    return placed.join(apart.select("band"), "band", "left_semi")


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (id, component) after ``links`` (a, b) of classes: only components are linked anew."""
    ends = [found.withColumnsRenamed({"id": end, "component": f"c{end}"}) for end in ("a", "b")]
    between = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    between = between.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    joined = cut_lineage(components(between), "neardup-joined")
    renamed = joined.select(F.col("id").alias("component"), F.col("component").alias("_new"))
    old = found.join(renamed, "component", "left")
    old = old.select("id", F.coalesce("_new", "component").alias("component"))
    new = joined.join(found.select("id"), "id", "left_anti").select("id", "component")
    merged = cut_lineage(old.union(new), "neardup-components")
    drop_tables(found, joined)
    return merged


def _leader_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of every member with LEADERS members of its bucket, where these lie in another component."""
    names = ["rep", "n", "component"]
    one = F.struct(*[F.col(c).alias("lead" if c == "rep" else f"lead_{c}") for c in names])
    chosen = [F.min_by(one, F.xxhash64("rep", F.lit(i))).alias(f"_{i}") for i in range(LEADERS)]
    leads = rows.groupBy("band").agg(*chosen)
    leads = leads.select("band", F.explode(F.array_distinct(F.array(*[f"_{i}" for i in range(LEADERS)]))).alias("l")).select("band", "l.*")
    apart = (F.col("component") != F.col("lead_component")) & fitting(F.col("n"), F.col("lead_n"))
    met = rows.join(leads, "band").where(apart)
    return met.select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct()


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(crowd, rep, size, part): a row for each shingle that only one of class and reference has."""
    for batch in batches:
        for row in range(batch.num_rows):
            own, other = (np.frombuffer(batch.column(c)[row].as_py(), np.int64) for c in ("shingles", "reference"))
            parts = np.setxor1d(own, other, assume_unique=True)
            same_row = pa.array(np.full(len(parts), row))
            columns = [batch.column(name).take(same_row) for name in ("crowd", "rep")]
            columns += [pa.array(np.full(len(parts), len(parts), np.int32)), pa.array(parts)]
            yield pa.RecordBatch.from_arrays(columns, ["crowd", "rep", "size", "part"])


def _clustered(rows: DataFrame) -> DataFrame:
    """(rep, n, component, cluster, step) of the open classes; cluster: those that buckets hold together.

    A class has the step of its size and the one below, so classes of fitting sizes share one.
    """
    ties = rows.join(rows.groupBy("band").agg(F.min("rep").alias("_least")), "band").select(F.col("rep").alias("a"), F.col("_least").alias("b"))
    clusters = cut_lineage(components(ties), "neardup-clusters").withColumnsRenamed({"id": "rep", "component": "cluster"})
    classes = rows.select("rep", "n", "component").distinct().join(clusters, "rep")
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / PERCENT)) + 1e-9)
    return classes.withColumn("step", F.explode(F.array(step, step - 1)))


def _difference_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of open classes in different components that can be similar, and those of each class with its references."""
    crowd = F.xxhash64("cluster", "step").alias("crowd")
    classes = cut_lineage(_clustered(rows).select(crowd, "rep", "n", "component"), "neardup-crowds")
    references = classes.groupBy("crowd").agg(F.min(F.struct("rep", "n", "component")).alias("r"), F.count(F.lit(1)).alias("_members"))
    references = cut_lineage(references.where("_members > 1").select("crowd", "r.*"), "neardup-references")
    reference_sets = references.select("crowd", "rep").join(sets, "rep").select("crowd", F.col("shingles").alias("reference"))
    described = classes.select("crowd", "rep").join(sets, "rep").join(reference_sets, "crowd")
    parts = cut_lineage(described.mapInArrow(_differences, "crowd long, rep long, size int, part long"), "neardup-differences")
    # What only one class has joins nothing; it only counts among the rarest parts, which come first.
    held = parts.groupBy("crowd", "part").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    whole = Window.partitionBy("crowd", "rep")
    single = F.col("size") - F.count(F.lit(1)).over(whole)
    placed = parts.join(held, ["crowd", "part"]).withColumn("place", single + F.row_number().over(whole.orderBy("holders", "part")) - 1)
    # A similar pair differs in at most n / 3 parts, so the first common one is not farther.
    placed = placed.drop("holders").join(classes, ["crowd", "rep"]).where(F.col("place") * 3 <= F.col("n"))
    placed = cut_lineage(placed, "neardup-places")
    drop_tables(parts)
    other = placed.select("crowd", "part", *[F.col(c).alias(f"x_{c}") for c in ("rep", "n", "component", "size", "place")])
    left = F.least(F.col("size") - F.col("place"), F.col("x_size") - F.col("x_place"))
    enough = left * 14 >= (F.col("size") + F.col("x_size")) * 7 - F.col("n") - F.col("x_n")
    met = placed.join(other, ["crowd", "part"]).where(
        (F.col("rep") < F.col("x_rep")) & (F.col("component") != F.col("x_component")) & fitting(F.col("n"), F.col("x_n")) & enough
    )
    near = classes.join(references.withColumnsRenamed({c: f"x_{c}" for c in ("rep", "n", "component")}), "crowd").where(
        (F.col("component") != F.col("x_component")) & fitting(F.col("n"), F.col("x_n"))
    )
    near = near.select("rep", "x_rep").union(met.select("rep", "x_rep"))
    return near.select(F.least("rep", "x_rep").alias("a"), F.greatest("rep", "x_rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, uid: str | None = None) -> DataFrame:
    """(uid, doc_id, n_shingles, component_id, kept, first) for every row of ``docs`` (doc_id, text, ...).

    ``component_id`` is the smallest doc_id reachable over links, NULL ids last; ``kept`` says that it is the row's
    own. Where rows share an id several are kept; ``first`` is true for one row of each component. Rows with a NULL text, or without
    words, have an empty set and are linked with nothing. An empty table gives an empty table.

    ``uid`` names a column that tells rows apart, with values that do not change when ``docs`` is read again; without it
    rows are numbered here.
    """
    number = F.monotonically_increasing_id() if uid is None else F.col(uid)
    marks = _marked(docs.select(number.alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text", *_text_keys()))
    return marks.select("uid", "doc_id", "n_shingles", "component_id", "kept", "first")


def _text_keys() -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit("b"), "text").alias("text_b")]


def _marked(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` of docs (uid, doc_id, text, text_a, text_b), and the keys of the texts."""
    wide = cut_lineage(docs.mapInArrow(_prints, PRINT), "neardup-prints")
    # A set has one signature, so any row of the class has the right one.
    reps = wide.where("n_shingles > 0").groupBy("high", "low").agg(
        F.min("uid").alias("rep"),
        F.min("doc_id").alias("doc_id"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    reps = cut_lineage(reps, "neardup-classes")
    prints = cut_lineage(wide.drop("bands", "sketch"), "neardup-rows")
    drop_tables(wide)
    banded = reps.select("rep", "n", F.explode("bands").alias("band"))
    leads = (
        banded.groupBy("band")
        .agg(F.count(F.lit(1)).alias("_members"), F.min(F.struct("rep", "n")).alias("lead"))
        .where("_members > 1")
        .select("band", F.col("lead.rep").alias("lead"), F.col("lead.n").alias("lead_n"))
    )
    members = cut_lineage(banded.join(leads, "band"), "neardup-members")
    stars = members.where((F.col("rep") != F.col("lead")) & fitting(F.col("n"), F.col("lead_n")))
    stars = stars.select(F.least("lead", "rep").alias("a"), F.greatest("lead", "rep").alias("b")).distinct()
    stars = cut_lineage(stars, "neardup-stars")
    survivors = _survivors(reps, stars)
    ids = survivors.select(F.col("a").alias("rep")).union(survivors.select(F.col("b").alias("rep"))).distinct()
    classes = reps.select("rep", "doc_id", "high", "low")
    wanted = cut_lineage(classes.join(ids, "rep", "left_semi"), "neardup-wanted")
    first_sets = cut_lineage(_sets_of(docs, wanted), "neardup-sets")
    links = _links(survivors, first_sets)
    found = cut_lineage(components(links), "neardup-components")
    drop_tables(survivors, links)

    rows = cut_lineage(_open(_placed(members.select("band", "rep", "n"), found)), "neardup-open")
    drop_tables(members)
    more = rows.select("rep").distinct().join(wanted.select("rep"), "rep", "left_anti")
    more = cut_lineage(classes.join(more, "rep", "left_semi"), "neardup-wanted")
    more_sets = cut_lineage(_sets_of(docs, more), "neardup-sets")
    sets = first_sets.union(more_sets)
    if not rows.isEmpty():
        led = cut_lineage(_leader_pairs(rows).join(stars, ["a", "b"], "left_anti"), "neardup-pairs")
        found = _merged(found, _links(_survivors(reps, led), sets))
        still = cut_lineage(_open(_placed(rows.drop("component"), found)), "neardup-open")
        drop_tables(rows)
        pairs = _difference_pairs(still, sets).join(stars.union(led), ["a", "b"], "left_anti")  # none is compared twice
        found = _merged(found, _links(_survivors(reps, cut_lineage(pairs, "neardup-pairs")), sets))

    labelled = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    labelled = cut_lineage(labelled.withColumn("component", F.coalesce("component", "rep")), "neardup-labels")
    drop_tables(reps, stars, wanted, more, first_sets, more_sets, found)
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named_classes = cut_lineage(labelled.join(least, "component").select("high", "low", "component", "component_id"), "neardup-named")
    drop_tables(labelled)
    own = F.col("n_shingles") == 0
    named = prints.join(named_classes, ["high", "low"], "left")
    named = named.withColumn("component_id", F.when(own, F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    firsts = named.where(kept & ~own).groupBy("component").agg(F.min("uid").alias("uid")).select("uid", F.lit(True).alias("_first"))
    marked = named.join(firsts, "uid", "left")
    first = own | F.coalesce("_first", F.lit(False))
    return marked.select("uid", "doc_id", "text_a", "text_b", "n_shingles", "component_id", kept.alias("kept"), first.alias("first"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of each component, one of the smallest id; same columns.

    Rows are told apart by id and text, so no numbered copy of them is needed. Of rows that have both in common with the one
    that stays, the one with the least checksum of all columns does.
    """
    marks = _marked(docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text", *_text_keys()))
    key = ["doc_id", "text_a", "text_b"]
    kinds = marks.where("n_shingles > 0").groupBy(*key).agg(F.max("first").alias("stays"), F.count(F.lit(1)).alias("copies"))
    # Most rows stay and are alone; only the others are looked up.
    kinds = cut_lineage(kinds.where("not stays or copies > 1").select(*key, "stays"), "neardup-dropped")
    row = F.struct(*[docs[c] for c in docs.columns])
    keyed = docs.select(row.alias("_row"), docs["doc_id"].cast("long").alias("doc_id"), *_text_keys())
    told = same(keyed, kinds, key)
    alone = told.where(F.col("stays").isNull()).select("_row.*")
    repeated = told.where("stays").groupBy(*key).agg(F.min_by("_row", F.xxhash64(*[F.col(f"_row.{c}") for c in docs.columns])).alias("_row"))
    return alone.unionByName(repeated.select("_row.*"))
