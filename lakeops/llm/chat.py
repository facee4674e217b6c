"""Chat formatting with any template, by rendering successive prefixes of a conversation.

A template is a function from a list of (role, text) turns to a string; nothing else is known of it. For each prefix the
output is compared with that of the prefix before: what they share is settled, the rest is the span of the new turn. A probe
rendering, with a private-use character for the new turn's text, shows where inside the span the text lies. A template that
changes settled text rewrites history: the conversation is marked and gets no mask, because spans found earlier no longer hold.

Rows of a conversation meet in one task in turn order; a task holds one conversation at a time. Rendering every prefix takes
time with the square of a conversation's turns, as the template may look at all of them.

Defined cases: null texts and roles count as empty; a null conversation id is a conversation of its own; turns that tie are
ordered by role, then text, nulls first; repeated rows are repeated turns; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

PROBE = "\ue000"
TURN, END = "<|im_start|>", "<|im_end|>"
# Control strings of common templates, escaped wherever a text contains them.
CONTROLS = (TURN, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_TURNS = re.compile(rf"{re.escape(TURN)}([^\n]*)\n(.*?){re.escape(END)}\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Backslashes are doubled and each control string gets one after its first character, so none is left whole."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\-{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """The inverse of :func:`escape` for texts and role names."""
    return _ESCAPED.sub(lambda m: {"-": "", "n": "\n"}.get(m[1], m[1]), text)


def marked_turns(turns: list[Turn]) -> str:
    """The default template: each turn between markers, its role on the first line."""
    return "".join(f"{TURN}{escape(role).replace('\n', '\\n')}\n{escape(text)}{END}\n" for role, text in turns)


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a text made by :func:`marked_turns`."""
    return [(unescape(role), unescape(text)) for role, text in _TURNS.findall(formatted)]


def locate(turns: list[Turn], render: Template) -> tuple[str, list[tuple[int, int, int, int]], bool]:
    """The rendering, per turn (start, end, text start, text end) in it, and whether the template rewrote history."""
    spans: list[tuple[int, int, int, int]] = []
    before, settled, rewritten = render([]), 0, False
    for k, (role, _) in enumerate(turns):
        now = render(turns[: k + 1])
        shared = len(before) if now.startswith(before) else len(os.path.commonprefix([before, now]))
        rewritten |= shared < settled
        probe = render([*turns[:k], (role, PROBE)])
        at = probe.rfind(PROBE)
        tail = len(probe) - at - 1
        if at < 0 or at < shared - tail or len(now) - tail < at or probe[:at] != now[:at] or probe[at + 1 :] != now[len(now) - tail :]:
            text = (shared, shared)  # the template does not show the text of this turn as one piece
        else:
            text = (at, len(now) - tail)
        settled = text[1]
        spans.append((min(shared, text[0]), len(now), *text))
        before = now
    return before, spans, rewritten


_OUT = pa.schema([
    ("conv_id", pa.int64()), ("formatted", pa.large_string()), ("rewritten", pa.bool_()), ("roles", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "text_start", "text_end")]))),
    ("loss", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end")]))),
])
FORMATTED = (
    "conv_id bigint, formatted string, rewritten boolean, roles array<string>,"
    " spans array<struct<start: bigint, end: bigint, text_start: bigint, text_end: bigint>>, loss array<struct<start: bigint, end: bigint>>"
)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """Conversations of rows sorted by conversation and turn."""
    conv, turns = None, []
    for batch in batches:
        for now, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if turns and now != conv:
                yield conv, turns
                turns = []
            conv = now
            turns.append((role, text))
    if turns:
        yield conv, turns


def format_chats(rows: DataFrame, render: Template = marked_turns, learn_roles: tuple[str, ...] = ("assistant",), conv_id: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: formatted text, the spans of its turns, and the spans under the loss mask (code points)."""
    named = rows.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    learned = tuple(learn_roles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = [], 0

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), _OUT, strict=True)], schema=_OUT)

        for conv, turns in _conversations(batches):
            formatted, found, rewritten = locate(turns, render)
            spans = [dict(zip(("start", "end", "text_start", "text_end"), s, strict=True)) for s in found]
            loss = [{"start": s[2], "end": s[3]} for s, (r, _) in zip(found, turns, strict=True) if r in learned and not rewritten]
            made.append((conv, formatted, rewritten, [r for r, _ in turns], spans, loss))
            held += len(formatted)
            if held > 4_000_000:
                yield flush()
                made, held = [], 0
        if made:
            yield flush()

    return named.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, FORMATTED)


_DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewritten boolean"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, formatted, loss, rewritten in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss", "rewritten")), strict=True):
            turns = read_turns(formatted)
            learned = "".join(unescape(formatted[s["start"] : s["end"]]) for s in loss)
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted), rewritten))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What can be read back from rows formatted with :func:`marked_turns`: turns from the text, learned text from the mask."""
    return formatted.select("conv_id", "formatted", "loss", "rewritten").mapInArrow(_digests, _DIGEST)
