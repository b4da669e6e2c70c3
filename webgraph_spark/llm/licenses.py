"""License scans with ordered signature rules.

A text becomes its lower-case words, each between two spaces, so one pattern finds a phrase whatever stands
between its words. Two prefilters come before any rule: one expression over the keywords of all rules drops the
texts that hold none, and each rule runs only where its own keyword occurs. What rules find are intervals of words. An
interval inside another one of higher priority, or of the same priority and longer or earlier in the list, is
suppressed. All of it is built-in expressions on one row; nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgraph_spark.functions.binding import bind
from webgraph_spark.llm.common import UPPER, whole_text
from webgraph_spark.llm.license_rules import BASE, FORMS, Rule, rules
from webgraph_spark.llm.spans import join_sorted, spans

# Fixed value: what is not part of a word, before letters are lowered.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_CHARS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

FOUND = "struct<start:int,end:int,label:string,form:string,priority:int,confidence:double,rule:int>"
TOP = max(priority for priority, _ in FORMS.values())


def wrapped(pattern: str) -> str:
    """A pattern over single-spaced words for words between two spaces each; an optional space is two or none."""
    return f" {pattern.replace(' ?', '(?: )?').replace(' ', '  ')} "


def word_line(text: Column) -> Column:
    """" w1  w2 ": the lower-case words of a text; an empty string without words."""
    spaced = F.trim(F.regexp_replace(F.translate(text, UPPER, UPPER.lower()), BREAK, "  "))
    return F.when(spaced == "", "").otherwise(F.concat(F.lit(" "), spaced, F.lit(" ")))


def words_in(line: Column) -> Column:
    return ((F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit("")))) / 2).cast("int")


def keyword_of(rule: Rule) -> str:
    """What every match of a rule begins a word with: ``licen`` where no match can do without a word that begins so."""
    outside = rule.pattern
    while outside != (outside := re.sub(r"\([^()]*\)", "", outside)):
        pass
    return "licen" if re.search("(?:^| )licen", outside) else rule.keyword


def keyword_gate(signatures: list[Rule]) -> str:
    """One pattern that holds in every text in which a rule or a base phrase can match."""
    first = {keyword_of(rule) for rule in signatures} | {phrase.split(" ")[0] for _, phrase in BASE[:1]} | {"licen", "reserved"}
    return f"(?i)(?<![a-z0-9[^\\x00-\\x7F]])(?:{'|'.join(sorted(first))})"


def _constants(values: list[str]) -> Column:
    """An array of strings as one constant, split while the query is planned."""
    return F.split(F.lit("\n".join(values)), "\n")


def _phrase(line: Column, label: str, phrase: str) -> Column:
    """(start, end, label) of every place of one base phrase."""
    pattern = F.lit(wrapped(phrase))
    places = F.when(F.contains(line, pattern), spans(line, pattern, words_in))
    return F.transform(F.coalesce(places, F.array()), lambda s: F.struct(s["start"], s["end"], F.lit(label).alias("label")))


def _base(line: Column) -> Column:
    return F.concat(*[_phrase(line, label, phrase) for label, phrase in BASE])


def _detections(line: Column, signatures: list[Rule]) -> Column:
    """Everything that rules find whose keyword occurs, as FOUND."""
    keywords = [keyword_of(rule) for rule in signatures]
    present = F.filter(_constants(sorted(set(keywords))), lambda k: F.contains(line, F.concat(F.lit(" "), k)))
    forms = list(FORMS)

    def active(here: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.lit(len(signatures) - 1))
        gated = F.filter(numbers, lambda i: F.array_contains(here, F.get(_constants(keywords), i)))
        named = _constants([f" {rule.keyword}" for rule in signatures])
        gated = F.filter(gated, lambda i: F.contains(line, F.get(named, i)))
        return F.filter(gated, lambda i: F.rlike(line, F.get(_constants([wrapped(r.pattern) for r in signatures]), i)))

    def found(i: Column) -> Column:
        form = F.array_position(_constants(forms), F.get(_constants([r.form for r in signatures]), i)).cast("int") - 1
        return F.transform(
            spans(line, F.get(_constants([wrapped(r.pattern) for r in signatures]), i), words_in),
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.get(_constants([r.label for r in signatures]), i).alias("label"),
                F.get(_constants(forms), form).alias("form"),
                F.get(F.array(*[F.lit(FORMS[f][0]) for f in forms]), form).alias("priority"),
                F.get(F.array(*[F.lit(FORMS[f][1]) for f in forms]), form).alias("confidence"),
                i.alias("rule"),
            ),
        )

    return F.flatten(F.transform(bind(present, active), found))


def suppress(detections: Column) -> Column:
    """What is left of ``detections`` after containment.

    In the order of start, then longest, then highest priority, then rule, all that can contain an interval
    come before it; so the largest end seen per priority decides.
    """
    keyed = F.transform(detections, lambda d: F.struct(d["start"].alias("a"), (-d["end"]).alias("b"), (-d["priority"]).alias("c"), d["rule"].alias("e"), d.alias("d")))
    ordered = F.transform(F.array_sort(keyed), lambda k: k["d"])

    def step(done: Column, d: Column) -> Column:
        ends = F.slice(done["ends"], d["priority"], F.lit(TOP) - d["priority"] + 1)
        inside = F.exists(ends, lambda end: end >= d["end"])
        kept = F.when(inside, done["kept"]).otherwise(F.concat(done["kept"], F.array(d.cast(FOUND))))
        seen = F.transform(
            done["ends"], lambda end, i: F.when(i + 1 == d["priority"], F.greatest(end, d["end"])).otherwise(end)
        )
        return F.struct(seen.alias("ends"), kept.alias("kept"))

    nothing = F.struct(F.array(*[F.lit(-1)] * TOP).alias("ends"), F.array().cast(f"array<{FOUND}>").alias("kept"))
    return F.aggregate(ordered, nothing, step)["kept"]


def scan(docs: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """``docs`` (text, ...) with n_words, base (start, end, label) and detections (what the rules keep).

    Places are word numbers from 0, ends exclusive. A NULL or empty text has no words and finds nothing.
    Equal rows give equal results; columns of these names in ``docs`` are replaced, all others stay.
    """
    signatures = rules() if signatures is None else signatures
    text = whole_text()
    gated = F.when(text.rlike(keyword_gate(signatures)), word_line(text))
    lines = docs.withColumns({"n_words": F.regexp_count(text, F.lit(WORD_CHARS)).cast("long"), "_line": gated})
    base = F.coalesce(F.when(F.col("_line").isNotNull(), _base(F.col("_line"))), F.array())
    raw = F.when(F.col("_line").isNotNull(), _detections(F.col("_line"), signatures))
    found = lines.withColumns({"base": base, "_raw": raw}).drop("_line")
    kept = F.when(F.size("_raw") > 0, suppress(F.col("_raw")))
    return found.withColumn("detections", F.coalesce(kept, F.array())).drop("_raw")


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document: counts, places and labels of what ``scan`` found, and a score.

    The score is the confidence of the surest detection, a base phrase alone counting 0.5; 0 without any.
    """
    base, kept = F.col("base"), F.col("detections")
    starts = F.transform(base, lambda b: b["start"])
    base_names = F.transform(base, lambda b: b["label"])
    sure = F.array_max(F.transform(kept, lambda d: d["confidence"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        join_sorted(base_names).alias("base_labels"),
        join_sorted(F.concat(base_names, F.transform(kept, lambda d: d["label"]))).alias("labels"),
        F.greatest(F.coalesce(sure, F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"),
        F.size(kept).cast("long").alias("n_detections"),
    )
