"""Phrase collocations from sorted count streams, without hash tables of phrases.

The layout is that of external language-model estimation:

1. Every word of a piece begins one window of up to ``longest`` words. A task sorts the windows of a block
   of text and writes each distinct one with its count. So what is moved is one row per word place at most,
   not one per place and length, and frequent windows are put together first.
2. The windows are dealt into ranges of their order and sorted (prefix order). The bounds come from a sample of
   documents and only balance the ranges; nothing is written between. All windows that begin with
   the same words lie next to each other, so the counts of the beginnings of every length are run lengths, taken
   in one pass. Runs that reach an end of a batch or a range are put together afterwards; there are at most
   ``longest`` at either end. So a word that begins a third of all windows splits over batches and ranges.
3. Of the phrases counted ``least`` times or more (every part of one is another, so nothing else is needed) two
   streams are kept: in prefix order the beginnings of a phrase come right before it, in suffix order
   (words reversed) its endings do. One pass over each, with a stack, gives the counts of all beginnings and of
   the extensions to the right, or of all endings and the extensions to the left.
4. The two streams meet phrase by phrase, in a sort-merge join.

Scores are quotients of 38-digit decimals, so they are exact up to texts of 1e17 words.

Defined results: a null text is empty, a null lang is ``und``; empty texts add nothing; words are case
folded for A-Z only; repeated rows count each time; ties go as stated in ``mine``; an empty table gives no
rows; texts of any length are read whole; other columns are left out, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.llm.common import whole_text
from webgraph_spark.session import cut_lineage

UNKNOWN = "und"
# Bytes of text whose windows a task sorts at once.
BLOCK = 6_000_000
# Documents, and windows of each, from which the bounds of the ranges are taken.
SAMPLED = 2_000
SAMPLED_WINDOWS = 32

# Upper case becomes lower, marks that end a piece become line breaks, tabs blanks.
_BREAK = b"\n"
_ENDS = b".,;:!?\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + _BREAK * len(_ENDS) + b" ")

COUNTED = "lang string, words string, count long"


# --- windows of a block -----------------------------------------------------


def _windows_of(text: bytes, longest: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct windows of a folded text, every word followed by a blank, in order, and their counts."""
    tokens = _tokens(text)
    known = tokens.dictionary.to_pylist()
    order = sorted((word, i) for i, word in enumerate(known) if word not in (b"", _BREAK))
    ranks = np.zeros(len(known), np.int64)
    ranks[[i for _, i in order]] = np.arange(1, len(order) + 1)
    ids = tokens.indices.to_numpy()
    if b"" in known:
        ids = ids[ids != known.index(b"")]
    line = ranks[ids]  # 0 where a piece ends
    columns = [line]
    for step in range(1, longest):
        later = np.append(line[step:], np.zeros(min(step, len(line)), np.int64))
        columns.append(np.where(columns[-1] > 0, later, 0))
    columns = [column[line > 0] for column in columns]
    packed = _packed(columns, len(order))
    sort = np.lexsort(packed[::-1])
    columns = [column[sort] for column in columns]
    new = np.ones(len(sort), bool)
    new[1:] = np.logical_or.reduce([key[sort[1:]] != key[sort[:-1]] for key in packed])
    first = np.flatnonzero(new)
    words = pa.array([b"", *(word + b" " for word, _ in order)], pa.binary()).cast(pa.string())
    parts = [words.take(pa.array(column[first])) for column in columns]
    return pc.binary_join_element_wise(*parts, ""), np.diff(np.append(first, len(sort)))


def _packed(columns: list[np.ndarray], most: int) -> list[np.ndarray]:
    """The columns in fewer ones of the same order; ``most`` is the largest value."""
    bits = max(1, most.bit_length())
    each = max(1, 63 // bits)
    keys = []
    for first in range(0, len(columns), each):
        key = np.zeros(len(columns[0]), np.int64)
        for column in columns[first : first + each]:
            key = (key << bits) | column
        keys.append(key)
    return keys


def _tokens(text: bytes) -> pa.DictionaryArray:
    """Words and line breaks; there may be empty ones."""
    return pa.array(text.replace(_BREAK, b" \n ").split(b" "), pa.binary()).dictionary_encode()


def _blocks(text: bytes) -> Iterator[bytes]:
    """A folded text in blocks that end with a piece."""
    at = 0
    while len(text) - at > BLOCK:
        end = text.find(_BREAK, at + BLOCK)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


def _keys(lang: str, words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(lang), words, "\n")


def _windows(longest: int, bounds: list[bytes]):
    """(part, key, count): the windows of blocks and the range each belongs to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            sizes.pop(lang)
            words, counts = _windows_of(_BREAK.join(held.pop(lang)), longest)
            keys = _keys(lang, words)
            ends = [bisect_left(range(len(keys)), bound, key=lambda at: keys[at].as_py().encode()) for bound in bounds]
            part = np.repeat(np.arange(len(bounds) + 1, dtype=np.int32), np.diff([0, *ends, len(keys)]))
            return pa.record_batch([pa.array(part), keys, pa.array(counts, pa.int64())], names=["part", "key", "count"])

        for batch in batches:
            for lang, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for block in _blocks(text.encode().translate(_FOLD)):
                    held.setdefault(lang, []).append(block)
                    sizes[lang] = sizes.get(lang, 0) + len(block)
                    if sum(sizes.values()) >= BLOCK:
                        yield flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield flush(lang)

    return work


def _sampled(longest: int):
    """(key, weight): evenly spaced windows of each text, standing for all of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                words, counts = _windows_of(text.encode().translate(_FOLD), longest)
                if len(words):
                    places = np.unique(np.linspace(0, len(words) - 1, SAMPLED_WINDOWS).astype(np.int64))
                    weight = np.full(len(places), counts.sum() / len(places))
                    yield pa.record_batch([_keys(lang, words.take(pa.array(places))), pa.array(weight)], names=["key", "weight"])

    return work


def _bounds(texts: DataFrame, longest: int, ranges: int) -> list[bytes]:
    """Keys that cut the windows into about equal ranges, from ``SAMPLED`` documents or all of a few."""
    share = min(1.0, SAMPLED / max(1, texts.count()))
    some = texts.sample(share, seed=11).mapInArrow(_sampled(longest), "key string, weight double").collect()
    found = sorted((row["key"].encode(), row["weight"]) for row in some)
    upto = np.cumsum([weight for _, weight in found])
    cuts = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges) if found else []
    return sorted({found[cut][0] for cut in cuts})


# --- run lengths ------------------------------------------------------------


def _numbered(keys: pa.Array, longest: int) -> tuple[np.ndarray, list[str], pa.Array]:
    """Numbers of language and words per row (0: no word there), the languages, and the words."""
    halves = pc.split_pattern(keys, "\n", max_splits=1, reverse=True).flatten()
    langs = halves.take(pa.array(np.arange(0, len(halves), 2)))
    words = halves.take(pa.array(np.arange(1, len(halves), 2)))
    split = pc.split_pattern(words, " ")
    lengths = pc.list_value_length(split).to_numpy()  # a blank follows the last word, so one too many
    flat = split.flatten().dictionary_encode().indices.to_numpy()
    tongues = langs.dictionary_encode()
    numbers = np.zeros((len(keys), longest + 1), np.int64)
    numbers[:, 0] = tongues.indices.to_numpy() + 1
    starts = np.cumsum(lengths) - lengths
    for depth in range(1, longest + 1):
        has = np.flatnonzero(lengths > depth)
        numbers[has, depth] = flat[starts[has] + depth - 1] + 1
    return numbers, langs, words


def _run_lengths(longest: int, least: int):
    """Counts of the beginnings of sorted windows; the one without words counts all words of a language.

    A run inside a batch is complete and passes with ``least``; those at the ends of a batch always pass.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, langs, words = _numbered(batch.column(0), longest)
            upto = np.append(0, np.cumsum(batch.column(1).to_numpy()))
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            out = []
            for depth in range(longest + 1):
                new[1:] |= numbers[1:, depth] != numbers[:-1, depth]
                begins = np.flatnonzero(new)
                counts = upto[np.append(begins[1:], batch.num_rows)] - upto[begins]
                passes = counts >= (least if depth else 0)
                passes[[0, -1]] = True
                for at in np.flatnonzero(passes & (numbers[begins, depth] > 0)):
                    row = int(begins[at])
                    out.append((langs[row].as_py(), " ".join(words[row].as_py().split(" ")[:depth]), int(counts[at])))
            columns = zip(*out, strict=True)
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "words", "count"])

    return work


def phrase_counts(docs: DataFrame, least: int, longest: int = 5) -> DataFrame:
    """(lang, words, count) of all phrases of up to ``longest`` words that occur ``least`` times or more in ``docs``
    (text, lang), and per language one row without words: the count of all its words."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), whole_text("text").alias("text"))
    bounds = _bounds(texts, longest, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    windows = texts.mapInArrow(_windows(longest, bounds), "part int, key string, count long")
    dealt = windows.repartitionById(len(bounds) + 1, "part").drop("part").sortWithinPartitions("key")
    runs = dealt.mapInArrow(_run_lengths(longest, least), COUNTED)
    whole = runs.groupBy("lang", "words").agg(F.sum("count").alias("count"))
    return whole.where((F.col("count") >= least) | (F.col("words") == ""))


# --- streams ----------------------------------------------------------------


def _with_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to every phrase the counts of its beginnings and its most frequent extension.

    In this order every beginning comes before what it begins, with nothing else between.
    """
    stack: list[list] = []  # words, count, most frequent extension
    path: list[str] = []
    tongue = None

    def emit(depth: int, out: list[tuple]) -> None:
        while len(stack) > depth:
            phrase, count, most = stack.pop()
            out.append((tongue, phrase, count, [above[1] for above in stack], most))
            if stack:
                stack[-1][2] = max(stack[-1][2] or 0, count)
        del path[depth:]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.record_batch(columns, names=["lang", "words", "count", "parts", "more"])

    for batch in batches:
        out: list[tuple] = []
        for lang, phrase, key, count in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            steps = key.split(" ")[:-1]
            same = 0
            while lang == tongue and same < min(len(path), len(steps)) and path[same] == steps[same]:
                same += 1
            emit(same, out)
            tongue = lang
            if len(steps) != len(stack) + 1:
                raise ValueError(f"a beginning of {phrase!r} was not counted")
            path[:] = steps
            stack.append([phrase, count, None])
        if out:
            yield batch_of(out)
    if stack:
        out = []
        emit(0, out)
        yield batch_of(out)


def _stream(counted: DataFrame, words: Column, parts: str, more: str) -> DataFrame:
    """(lang, words, count, parts, more) from one pass in the order of ``words``, an array."""
    keyed = counted.withColumn("key", F.concat(F.array_join(words, " "), F.lit(" "))).withColumn("head", words[0])
    # All phrases with the same first word lie in one range: phrases counted often, not their places.
    dealt = keyed.repartitionByRange("lang", "head").sortWithinPartitions("lang", "key")
    schema = f"lang string, words string, count long, {parts} array<long>, {more} long"
    return dealt.select("lang", "words", "key", "count").mapInArrow(_with_parts, schema)


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def mine(docs: DataFrame, least: int = 100, longest: int = 5, first: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` collocations of every language.

    Candidates are phrases of 2 to ``longest`` words counted a >= ``least`` times. n is the count of all words. A
    cut into a first part counted l and a rest counted r times scores floor(1000 a n / (l r)); the lowest cut
    counts, the earliest of equal ones. A candidate goes where a longer candidate around it is as frequent; an
    extension by one word tells, since all phrases between the two are as frequent too. Order: score and a
    descending, then the phrase by its bytes.
    """
    counted = cut_lineage(phrase_counts(docs, least, longest), "phrases")
    totals = counted.where("words = ''").select("lang", F.col("count").alias("n"))
    phrases = counted.where("words <> ''")
    words = F.split("words", " ", -1)
    left = _stream(phrases, words, "begins", "to_right")
    right = _stream(phrases, F.reverse(words), "ends", "to_left")
    left = left.where(F.size("begins") > 0).withColumnRenamed("count", "a")
    both = left.hint("merge").join(right.where(F.size("ends") > 0).drop("count"), ["lang", "words"])
    extended = F.greatest("to_right", "to_left")  # of those that are there
    kept = both.where(extended.isNull() | (100 * extended < 100 * F.col("a"))).join(totals, "lang")

    def cut(k: Column) -> Column:
        l, r = F.col("begins")[k - 1], F.col("ends")[F.size("ends") - k]
        over = F.lit(1000).cast("decimal(38,0)") * _exact(F.col("a")) * _exact(F.col("n"))
        score = F.call_function("div", over, _exact(l) * _exact(r))
        return F.struct(score.alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), F.size("begins")), cut))
    scored = kept.select("lang", F.col("words").alias("phrase"), "a", "n", best.alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")
