"""Chat formatting: spans of turns found by rendering, without knowing the template.

A template is a black box from a list of turns to a string. The prefixes of a conversation are rendered one
after the other. Where each output begins with the one before, its new end is the span of the new turn.
The place of the text inside comes from two more renderings in which the text is a single letter: what these
have in common on both sides belongs to the template.

An output that does not begin with the one before shows a template that rewrites history (drops earlier
reasoning, moves a system turn). The part so far is then closed and the rewritten output begins a new one;
``rewrites`` of the part names the turn that made it and ``rewritten`` the first turn that changed. Texts of
earlier turns have been learnt in the part before and are not under the loss mask again.

A conversation of more than ``BLOCK`` turns goes on from its last ``CONTEXT`` turns: both the long and the
short history are rendered with the next turn, and only if they add the same is the long one let go.
So rendering takes time in proportion to the turns, and a template that looks further back still gets its
whole history.

Defined results: a null conv_id is a conversation of its own; null turns come first; rows of one turn are
ordered by role and text; a null text or role is empty; repeated rows are turns of their own; an empty table
gives no rows; texts of any length are rendered whole; other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgraph_spark.llm import turns
from webgraph_spark.llm.common import whole_text

BLOCK = 32
CONTEXT = 4

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

START = "<|im_start|>"
END = "<|im_end|>"
LEARNT = "assistant"

SPANS = "array<struct<role: string, start: long, end: long, text_start: long, text_end: long, loss: boolean>>"


# --- a template -------------------------------------------------------------


def escape(text: str) -> str:
    """No control string is left: ``<``, any backslashes and ``|`` get one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role(role: str) -> str:
    # A role ends at the line break, so it may hold none.
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def chatml(history: list[Turn]) -> str:
    """Every turn between marks; control strings inside texts and roles are escaped."""
    return "".join(f"{START}{_role(role)}\n{escape(text)}{END}\n" for role, text in history)


def parse_chatml(text: str) -> Iterator[Turn]:
    """The turns of ``chatml``, or ValueError."""
    at = 0
    while at < len(text):
        line, end = text.find("\n", at), text.find(END, at)
        if not text.startswith(START, at) or not 0 <= line < end or not text.startswith("\n", end + len(END)):
            raise ValueError(f"no turn at {at}")
        yield _unrole(text[at + len(START) : line]), unescape(text[line + 1 : end])
        at = end + len(END) + 1


# --- spans ------------------------------------------------------------------


class Span(NamedTuple):
    role: str
    start: int
    end: int
    text_start: int
    text_end: int
    loss: bool


class Part(NamedTuple):
    text: str
    spans: list[Span]
    rewrites: int | None
    rewritten: int | None


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _ends(render: Template, history: list[Turn], output: str) -> list[float]:
    """Where the prefixes of ``history`` end in ``output``; never, if it does not begin with them."""
    prefixes = (render(history[: k + 1]) for k in range(len(history)))
    return [len(prefix) if output.startswith(prefix) else math.inf for prefix in prefixes]


def _text_at(render: Template, history: list[Turn], output: str) -> tuple[int, int]:
    """Where the text of the last turn lies in ``output``; nowhere (the end, twice) if the template hides it."""
    role = history[-1][0]
    one, two = (render([*history[:-1], (role, letter)]) for letter in "xy")
    if one == two:
        return len(output), len(output)
    head, tail = _common(one, two), _common(one[::-1], two[::-1])
    begin, end = head, len(output) - tail
    if end < begin or output[:begin] != one[:head] or output[end:] != one[len(one) - tail :]:
        return len(output), len(output)
    return begin, end


def parts(history: Iterable[Turn], render: Template, learnt: str = LEARNT, block: int = BLOCK, context: int = CONTEXT) -> Iterator[Part]:
    """The output of one conversation in parts, each with the spans of the turns that are new in it.

    Parts that go on where the one before ended have no ``rewrites``; together they are the whole output.
    """
    window: list[Turn] = []
    before = ""  # output of the window
    skipped = done = 0  # characters of that output before this part; turns in all
    text, spans = [], []
    rewrites = rewritten = None
    ends: list[float] = []  # of the window's turns in its output
    for turn in history:
        if len(window) >= block:
            recent = window[-context:]
            short = render(recent)
            longer, shorter = render([*window, turn]), render([*recent, turn])
            if longer.startswith(before) and shorter.startswith(short) and longer[len(before) :] == shorter[len(short) :]:
                yield Part("".join(text), spans, rewrites, rewritten)
                window, before, ends = recent, short, _ends(render, recent, short)
                skipped, text, spans, rewrites, rewritten = len(short), [], [], None, None
        window.append(turn)
        output = render(window)
        begin, end = _text_at(render, window, output)
        if output.startswith(before):
            start = len(before)
            text.append(output[start:])
        else:
            if spans:
                yield Part("".join(text), spans, rewrites, rewritten)
            kept = _common(before, output)
            rewrites, rewritten = done, done - len(window) + 1 + sum(place <= kept for place in ends)
            skipped, text, spans, start = 0, [output], [], begin
            ends = _ends(render, window[:-1], output)
        places = [place - skipped for place in (start, len(output), begin, end)]
        spans.append(Span(turn[0], *places, turn[0] == learnt))
        ends.append(len(output))
        before = output
        done += 1
    if spans:
        yield Part("".join(text), spans, rewrites, rewritten)


def format_chats(
    conversations: DataFrame, render: Template = chatml, learnt: str = LEARNT, block: int = BLOCK, context: int = CONTEXT
) -> DataFrame:
    """(conv_id, part, text, spans, rewrites, rewritten): the formatted conversations, in parts from 0.

    spans: of each new turn its place in ``text``, the place of its own text, and whether that is under the
    loss mask (role ``learnt``); a turn that rewrites history begins at its text. Parts of a conversation follow each other in one partition.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), whole_text("text").alias("text")
    )
    rows = turns.in_order(rows, "turn", "role", "text")
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, part int, text string, spans {SPANS}, rewrites long, rewritten long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            (conv_id, number, part.text, [span._asdict() for span in part.spans], part.rewrites, part.rewritten)
            for conv_id, members in turns.read(batches)
            for number, part in enumerate(parts((row[1:] for row in members), render, learnt, block, context))
        )
        return turns.write(found, arrow, lambda row: len(row[2]))

    arrow = turns.arrow_schema(schema)
    return rows.mapInArrow(work, schema)


def read_back(formatted: DataFrame, parse=parse_chatml, plain=unescape) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted conversations.

    All of it is read from the output: turns by the template's marks, learnt texts by the loss spans. For
    templates that do not rewrite history. ``formatted`` must hold the parts of a conversation one after the
    other, as ``format_chats`` gives them; a stored table goes through ``turns.in_order(stored, "part")`` first.
    """
    kind = dict(formatted.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def summary(conv_id: object, members: Iterable[tuple]) -> tuple:
        said, learnt = hashlib.sha256(), hashlib.sha256()
        count = chars = size = 0
        for text, spans in members:
            for role, turn in parse(text):
                said.update(f"{role}\n{turn}\n".encode())
                count += 1
            for span in spans:
                if span["loss"]:
                    shown = plain(text[span["text_start"] : span["text_end"]])
                    learnt.update(shown.encode())
                    chars += len(shown)
            size += len(text)
        return conv_id, count, said.hexdigest(), chars, learnt.hexdigest(), size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return turns.write((summary(conv_id, members) for conv_id, members in turns.read(batches)), arrow)

    arrow = turns.arrow_schema(schema)
    return formatted.select("conv_id", "text", "spans").mapInArrow(work, schema)
