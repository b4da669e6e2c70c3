"""Secret scans: patterns, and sliding-window entropy of candidate strings.

Candidates are runs of characters that tokens are made of. Each belongs to the narrowest character class that
holds it. A window slides over the candidate; the counts of its characters, and with them the sum of c * log2(c),
change by the character that enters and the one that leaves, so each step costs the same whatever the window.
A candidate is reported where the entropy of some window reaches the threshold of its class, unless
the allow list knows it. All of it is built-in expressions on one row; nothing is shuffled.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.llm.common import whole_text
from webgraph_spark.llm.spans import no_spans, spans

# The patterns of the base kinds. The shorter forms of access and hex find the same spans as a
# match of any length with a minimum checked afterwards, since a shorter match never holds a valid one.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ASSIGN_GATE = r"(?i)password|passwd|secret|token|api_?key"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

WINDOW = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}"


class CharClass(NamedTuple):
    """Characters of a class and the bits per character at which a window counts as random."""

    kind: str
    pattern: str
    bits: float


# The narrowest class comes first. Random windows of 20 characters have about 3.3, 4.0 and 4.1 bits.
CLASSES = [
    CharClass("entropy_hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.9),
    CharClass("entropy_upper", r"^[0-9A-Z]+$", 3.5),
    CharClass("entropy_mixed", r"^[A-Za-z0-9+/_=-]+$", 3.7),
]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

# What looks random and is not a secret: words, in one case or as humps, numbers, versions and dates, UUIDs, integrity sums, and
# words joined by marks. Letters in mixed case that are no humps are judged like any other run.
ALLOWED = [
    r"^[-_/+=]*+(?:(?:[A-Z]?+[a-z]{2,}+|[A-Z][a-z](?=[A-Z][a-z]{2})|[A-Z]{2,}+|[A-Za-z](?![A-Za-z]))[-_/+=]*+)*$",
    r"^[0-9_+/=-]+$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^sha(?:1|224|256|384|512)-",
    r"^(?:[A-Za-z]+[0-9]{0,4}[-_/+=]+)+[A-Za-z]*[0-9]{0,4}[-_/+=]*$",
]
# Placeholders, sequences and runs of one character: a candidate is cut there and what is left of it is judged.
CUT = r"(?i:example|sample|placeholder|changeme|dummy|redacted|abcdefgh|01234567|12345678|deadbeef)|(.)\1{7,}"
# What in front of a candidate says that it is a checksum or a revision.
ALLOWED_BEFORE = r"(?i)(?:commit|revision|sha-?1|sha-?256|sha-?512|md5|checksum|digest|etag)[\"']?\x20*[:=]?\x20*[\"']?$"

KINDS = ["assign", "access", "hex", *[c.kind for c in CLASSES]]
SPAN = "struct<start:int,place:int,end:int,kind:string>"


def _as(kind: str, found: Column) -> Column:
    place = KINDS.index(kind)
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _where(gate: Column, found: Column) -> Column:
    return F.when(gate, found).otherwise(no_spans())


def _assigned(text: Column) -> Column:
    found = spans(text, F.lit(ASSIGN))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    pairs = F.arrays_zip(found.alias("span"), values.alias("value"))
    return F.transform(F.filter(pairs, lambda p: F.char_length(p["value"]) >= ASSIGN_LEAST), lambda p: p["span"])


def base_spans(text: Column) -> Column:
    """Spans (start, place, end, kind) of the three base kinds, in order of kind."""
    return F.concat(
        _as("assign", _where(text.rlike(ASSIGN_GATE), _assigned(text))),
        _as("access", _where(F.contains(text, F.lit("AKIA")), spans(text, F.lit(ACCESS)))),
        _as("hex", _where(text.rlike(HEX), spans(text, F.lit(HEX)))),
    )


def window_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits per character, of any window of the candidate; 0 if it is shorter.

    The state holds the count of each character of the alphabet in the window and the sum of c * log2(c).
    """
    places = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def weight(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(0.0)

    def step(state: Column, at: Column) -> Column:
        enters = F.get(state["places"], at)
        leaves = F.when(at >= window, F.get(state["places"], at - window)).otherwise(-1)
        same = enters == leaves
        gained = weight(F.get(state["counts"], enters) + 1) - weight(F.get(state["counts"], enters))
        lost = weight(F.get(state["counts"], leaves)) - weight(F.get(state["counts"], leaves) - 1)
        total = state["total"] + F.when(same, 0.0).otherwise(gained - F.when(leaves >= 0, lost).otherwise(0.0))
        counts = F.when(same, state["counts"]).otherwise(
            F.transform(state["counts"], lambda n, i: n + (i == enters).cast("int") - (i == leaves).cast("int"))
        )
        bits = F.when(at >= window - 1, math.log2(window) - total / window).otherwise(0.0)
        return F.struct(
            state["places"].alias("places"),
            counts.alias("counts"),
            total.alias("total"),
            F.greatest(state["most"], bits).alias("most"),
        )

    start = F.struct(
        places.alias("places"),
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("most"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.char_length(candidate) - 1), start, step)["most"]


def _allowed(run: Column) -> Column:
    return reduce(lambda known, pattern: known | run.rlike(pattern), ALLOWED, F.lit(False))


def entropy_spans(text: Column) -> Column:
    """Spans of candidates of which a part reaches the entropy of its class and is not allowed.

    A part is what ``CUT`` leaves of a candidate, and has at least WINDOW characters.
    """
    found = _where(text.rlike(CANDIDATE), spans(text, F.lit(CANDIDATE)))
    candidates = F.filter(found, lambda s: ~(_allowed(s["hit"]) | s["before"].rlike(ALLOWED_BEFORE)))

    def random_class(part: Column) -> Column:
        place, bits = F.lit(len(KINDS) - 1), F.lit(CLASSES[-1].bits)
        for c in reversed(CLASSES[:-1]):
            place = F.when(part.rlike(c.pattern), KINDS.index(c.kind)).otherwise(place)
            bits = F.when(part.rlike(c.pattern), c.bits).otherwise(bits)
        return F.when(window_entropy(part) >= bits, place)

    def judged(span: Column) -> Column:
        parts = F.filter(F.split(span["hit"], CUT), lambda p: (F.char_length(p) >= WINDOW) & ~_allowed(p))
        place = F.array_min(F.transform(parts, random_class))
        names = F.array(*[F.lit(kind) for kind in KINDS])
        return F.struct(
            span["start"].alias("start"), place.alias("place"), span["end"].alias("end"), F.get(names, place).alias("kind")
        )

    return F.filter(F.transform(candidates, judged), lambda s: s["place"].isNotNull())


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (text, ...) with base and spans: arrays of (start, place, end, kind), in order of start and kind.

    Places are code points from 0, ends exclusive. ``base`` holds the spans of the patterns; ``spans`` these
    and the random strings that no base span covers. A NULL or empty text has none. Equal rows give equal results;
    columns of these names in ``docs`` are replaced, all others stay.
    """
    text = whole_text()
    found = docs.withColumns({"base": F.array_sort(base_spans(text)), "_more": entropy_spans(text)})
    outside = F.filter(
        F.col("_more"),
        lambda s: ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"])),
    )
    return found.withColumn("spans", F.array_sort(F.concat(F.col("base"), outside))).drop("_more")


def _joined(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a checksum of their spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark``; overlapping spans become one mark.

    All rows stay and columns are the same; n_chars, where there is such a column, follows the text. A text
    without secrets, a NULL one too, is not changed.
    """
    scanned = scan(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "text"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), done["at"] + 1, s["start"] - done["at"])
        more = F.when(s["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), more.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "spans", start, step, lambda done: F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.char_length("text")))
    )
    text = F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))
    named = {c: F.col("_row")[c].alias(c) for c in docs.columns}
    changed = scanned.withColumn("_text", text)
    named["text"] = F.col("_text").alias("text")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.size("spans") > 0, F.char_length("_text")).otherwise(F.col("_row")["n_chars"])
        named["n_chars"] = length.cast(kind).alias("n_chars")
    return changed.select(*[named[c] for c in docs.columns])
