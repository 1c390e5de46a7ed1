"""Formatting of conversations by a template that is only called, never looked into.

The template renders one turn, then two, then three; each rendering must begin with the one before, and what
it adds is the new turn's span.  A template that changes what it wrote before is detected so.  Where a turn's
text lies in its span is found by rendering it with two other texts that share neither their first
nor their last character: what these have in common is what the template puts around a text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Render = Callable[[Sequence[Turn]], str]

#: Fixed marks of the template here.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
PROBES = ("a", "b")
#: The conversation that the query adds, whose texts hold control strings of many templates.
PLANTED = "\\### Assistant: </turn> ok"

SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("text_begin", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())])
FORMATTED = "formatted string, spans array<struct<begin: bigint, end: bigint, text_begin: bigint, text_end: bigint, loss: boolean>>, rewrites array<int>"


def escape(text: str) -> str:
    """``text`` without any control string of the template: backslashes are doubled, and one goes before each
    number sign and into each closing mark."""
    if "\\" in text or "#" in text or "</turn>" in text:
        return text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn>", "<\\/turn>")
    return text


def unescape(text: str) -> str:
    """What was escaped: a backslash goes, what follows it stays."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def marked_turns(turns: Sequence[Turn]) -> str:
    """The template: each turn between marks, with role and text escaped."""
    return "".join(f"{OPEN}{escape_role(r)}{BETWEEN}{escape(t)}{CLOSE}" for r, t in turns)


def role_of(span: str) -> str:
    """The role of a turn, read back from its span."""
    return unescape(re.match(r"### ((?:[^\\:]|\\.)*): ", span, re.DOTALL)[1])


def around(render: Render, before: Sequence[Turn], role: str, held: str) -> tuple[str, str] | None:
    """What the template puts before and after the text of a turn of ``role``; None if that can't be told,
    as its renderings don't begin with ``held``."""
    a, b = (render([*before, (role, x)]) for x in PROBES)
    if not (a.startswith(held) and b.startswith(held)):
        return None
    a, b = a[len(held) :], b[len(held) :]
    head = os.path.commonprefix([a, b])
    tail = os.path.commonprefix([a[len(head) :][::-1], b[len(head) :][::-1]])[::-1]
    return head, tail


def located(render: Render, turns: Sequence[Turn], loss_roles: Sequence[str]) -> tuple[str, list[tuple[int, int, int, int, bool]], list[int]]:
    """The rendering of all turns, the spans of its turns and their texts, and the turns (from 0) at which
    the template changed what it had written.  If there are any, no span is given, since offsets of
    earlier turns no longer hold; nor if a text can't be told from what is around it."""
    held, spans, rewrites, plain = render([]), [], [], True
    for k, (role, text) in enumerate(turns):
        out = render(turns[: k + 1])
        if not out.startswith(held):
            rewrites.append(k)
        elif plain and not rewrites:
            ends = around(render, turns[:k], role, held)
            begin, end = len(held), len(out)
            if ends and end - begin >= len(ends[0]) + len(ends[1]) and out.startswith(ends[0], begin) and out.endswith(ends[1]):
                spans.append((begin, end, begin + len(ends[0]), end - len(ends[1]), role in loss_roles))
            else:
                plain = False
        held = out
    return held, spans if plain and not rewrites else [], rewrites


def format_chats(conversations: DataFrame, render: Render = marked_turns, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``(conv_id, n_turns, formatted, spans, rewrites)``.

    ``spans`` holds for each turn its begin and end in ``formatted``, in code points, those of its text, and whether the
    text counts for the loss (turns of ``loss_roles``).  ``rewrites`` lists the turns, from 0, at which
    the template changed what it had written before; such a conversation has no spans and should
    not be trained on.  Turns go by ``turn`` (null first), then role and text; null roles and texts
    are empty; rows without a ``conv_id`` are one conversation without an id.  Repeated rows are
    turns of their own.  A conversation and its rendering are one row, so it has to fit into one.
    Further columns make no difference.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), text("role"), text("text"))
    held = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):  # one conversation at a time is held
                row = batch.slice(i, 1)
                turns = [(x["role"], x["text"]) for x in row.column(1)[0].as_py()]
                out, spans, rewrites = located(render, turns, loss_roles)
                yield pa.RecordBatch.from_arrays([row.column(0), pa.array([len(turns)], pa.int64()), pa.array([out]), pa.array([spans and [dict(zip(("begin", "end", "text_begin", "text_end", "loss"), s)) for s in spans]], pa.list_(SPAN)), pa.array([rewrites], pa.list_(pa.int32()))], ["conv_id", "n_turns", "formatted", "spans", "rewrites"])

    return held.select("conv_id", "turns").mapInArrow(run, "conv_id bigint, n_turns bigint, " + FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rows of :func:`format_chats`, made with :func:`marked_turns`, say when they are read:
    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``.  Roles, texts and what is
    under the loss mask are cut out of ``formatted`` by its spans and unescaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                out, spans = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for s in spans:
                    text = unescape(out[s["text_begin"] : s["text_end"]])
                    turns.update(f"{role_of(out[s['begin'] : s['text_begin']])}\n{text}\n".encode())
                    if s["loss"]:
                        loss.update(text.encode())
                        chars += len(text)
                rows.append((batch.column(0)[i].as_py(), len(spans), turns.hexdigest(), chars, loss.hexdigest(), len(out)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names)

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(run, schema)


def with_planted(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -7, whose texts are made of control strings.  If there is a conversation
    -7 already, the two turns come after its own."""
    kind = "conv_id bigint, turn bigint, role string, text string"
    last = (1 << 62) + 1
    planted = conversations.sparkSession.createDataFrame([(-7, last, "user", PLANTED), (-7, last + 1, "assistant", PLANTED)], kind)
    return conversations.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in kind.split(", ")]).unionByName(planted)
