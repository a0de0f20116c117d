"""Chat formatting with any template, and the spans of turns found by rendering alone.

A template is a function from a list of turns to a text; nothing is known of how it works. Successive
prefixes of a conversation are rendered. If every output goes on from the one before, a turn's span
is what its prefix adds. Else the template rewrites history (it drops, moves or changes what it wrote
before): the first turn that does so is reported, and spans are looked for in the rendering of the whole
conversation instead. The text inside a span is found by rendering once more with one sentinel
character in place of the turn's text: what stands around the sentinel is marking. A turn whose text is not
in the output as it was put in has no content span, and a turn that the output drops has no span.

``MarkedTemplate`` marks turns by control strings. Inside roles and texts such strings are escaped, by one
more backslash after their first character, which ``unescape`` takes away again; so the output can be read
back whatever the texts say. No control string has the first character of one inside it, so marks and texts
never form one across their border.

Turns of a conversation ascend, null first; of equal turns the role and then the text decides, and rows that
repeat stay turns of their own. Null texts and roles are empty. Rows without conversation id are one conversation.
A conversation is held by one task, with two of its renderings; the work grows with the square of its number of turns,
as the method renders every prefix. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a task returns at a time, at most, and the characters that make it return fewer.
BATCH_ROWS, BATCH_CHARS = 2_000, 4_000_000

#: Control strings of the usual chat formats; none is left standing inside a text.
CONTROLS = (
    "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "<|im_start|>", "<|im_end|>",
    "<|user|>", "<|assistant|>", "<|system|>", "<|end|>", "<|endoftext|>")


class Turn(NamedTuple):
    role: str
    text: str


Render = Callable[[list[Turn]], str]


class Span(NamedTuple):
    """Places in the output: the turn, and the text in it; -1 where it is not found."""

    start: int
    end: int
    text_start: int
    text_end: int


class Formatted(NamedTuple):
    text: str
    spans: list[Span]
    rewritten_at: int  # the first turn that changes what was written before it, -1 if none does


def locate(turns: list[Turn], render: Render) -> Formatted:
    """Render a conversation and find its turns in the output."""
    before, spans, rewritten = render([]), [], -1
    for i in range(len(turns)):
        now = render(turns[:i + 1])
        if not now.startswith(before):
            rewritten = i
            break
        spans.append(_inside(turns, i, i + 1, render, now, len(before)))
        before = now
    if rewritten < 0:
        return Formatted(before, spans, rewritten)
    whole = render(turns)
    return Formatted(whole, [_inside(turns, i, len(turns), render, whole, None) for i in range(len(turns))], rewritten)


def _inside(turns: list[Turn], i: int, end: int, render: Render, output: str, start: int | None) -> Span:
    """The span of turn i in ``output``, the rendering of the first ``end`` turns."""
    text = turns[i].text
    sentinel = _absent(output)
    probed = render([*turns[:i], Turn(turns[i].role, sentinel), *turns[i + 1:end]])
    at = probed.find(sentinel)
    tail = len(probed) - at - 1
    found = (
        at >= 0 and probed.find(sentinel, at + 1) < 0 and output[:at] == probed[:at]
        and output[at:len(output) - tail] == text and output.endswith(probed[at + 1:]))
    if start is not None:
        return Span(start, len(output), *((at, at + len(text)) if found else (-1, -1)))
    return Span(at, at + len(text), at, at + len(text)) if found else Span(-1, -1, -1, -1)


def _absent(text: str) -> str:
    """A private-use character that the text does not hold."""
    code = 0xE000
    while chr(code) in text:
        code += 1
    return chr(code)


@dataclass(frozen=True)
class MarkedTemplate:
    """Marks per role, a form for other roles, and what opens a conversation."""

    opening: str = "<s>"
    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<|assistant|>", "</s>")})
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "<|end|>")
    controls: tuple[str, ...] = CONTROLS

    def __post_init__(self):
        firsts = {c[0] for c in self.controls}
        marks = [self.opening, *(m for pair in self.roles.values() for m in pair), *self.other]
        if any(f in c[1:] or f == "\\" for f in firsts for c in self.controls):
            raise ValueError("the first character of a control string may not stand inside one, nor be a backslash")
        if any(m.strip() not in self.controls for m in marks):
            raise ValueError("every mark must be a control string")
        if len({first.strip() for first, _ in self.roles.values()} | {self.other[0].strip()}) != len(self.roles) + 1:
            raise ValueError("every role needs a first mark of its own")

    def _pattern(self, slashes: str) -> re.Pattern:
        rest = "|".join(f"{re.escape(c[0])}(?={slashes}{re.escape(c[1:])})" for c in self.controls)
        return re.compile(rest)

    def escape(self, text: str) -> str:
        return _cached(self, r"\\*").sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        pieces, last = [], 0
        for m in _cached(self, r"\\+").finditer(text):
            pieces.append(text[last:m.end()])
            last = m.end() + 1
        return "".join([*pieces, text[last:]])

    def escaped(self, turn: Turn) -> Turn:
        return Turn(turn.role if turn.role in self.roles else self.escape(turn.role), self.escape(turn.text))

    def render(self, turns: list[Turn]) -> str:
        """The conversation of escaped turns."""
        out = [self.opening]
        for role, text in turns:
            if role in self.roles:
                first, last = self.roles[role]
                out += (first, text, last)
            else:
                out += (self.other[0], role, self.other[1], text, self.other[2])
        return "".join(out)

    def read(self, output: str) -> list[Turn]:
        """The turns of an output, unescaped."""
        if not output.startswith(self.opening):
            raise ValueError("not an output of this template")
        turns, at = [], len(self.opening)
        while at < len(output):
            for role, (first, last) in self.roles.items():
                if output.startswith(first, at):
                    break
            else:
                middle = output.index(self.other[1], at)
                role = self.unescape(output[at + len(self.other[0]):middle])
                first, last = output[at:middle] + self.other[1], self.other[2]
            start = at + len(first)
            # The last mark's control string, not what pads it: the text may end like the padding.
            end = output.index(last.strip(), start) - (len(last) - len(last.lstrip()))
            turns.append(Turn(role, self.unescape(output[start:end])))
            at = end + len(last)
        return turns


_patterns: dict[tuple, re.Pattern] = {}


def _cached(template: MarkedTemplate, slashes: str) -> re.Pattern:
    key = (template.controls, slashes)
    if key not in _patterns:
        _patterns[key] = template._pattern(slashes)
    return _patterns[key]


#: The template of the registered query.
INSTRUCT = MarkedTemplate()

_SPAN = "struct<turn: int, role: string, start: bigint, end: bigint, text_start: bigint, text_end: bigint, loss: boolean>"
_ARROW_SPAN = pa.list_(pa.struct([
    ("turn", pa.int32()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text_start", pa.int64()),
    ("text_end", pa.int64()), ("loss", pa.bool_())]))


def format_conversations(
    rows: DataFrame, render: Render, prepare: Callable[[Turn], Turn] = lambda t: t, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``spans`` (places are code points) and ``rewritten_at``.

    ``prepare`` is applied to every turn once, before anything is rendered. ``loss`` marks the turns of ``loss_roles``
    whose text was found in the output; the loss mask is the union of their text places.
    """
    columns = [
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]]
    dealt = rows.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv_id, turns in _conversations(batches):
            made = locate([prepare(t) for t in turns], render)
            spans = [
                {"turn": i, "role": t.role, **s._asdict(), "loss": t.role in loss_roles and s.text_start >= 0}
                for i, (t, s) in enumerate(zip(turns, made.spans, strict=True))]
            out.append((conv_id, made.text, spans, made.rewritten_at))
            if len(out) >= BATCH_ROWS or sum(len(r[1]) for r in out[-64:]) >= BATCH_CHARS:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return dealt.mapInArrow(run, f"conv_id bigint, formatted string, spans array<{_SPAN}>, rewritten_at int")


def _batch(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), _ARROW_SPAN, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["conv_id", "formatted", "spans", "rewritten_at"])


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """The conversations of sorted rows."""
    key, turns = None, []
    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if turns and conv_id != key:
                yield key, turns
                turns = []
            key = conv_id
            turns.append(Turn(role, text))
    if turns:
        yield key, turns


def read_back(formatted: DataFrame, template: MarkedTemplate) -> DataFrame:
    """What the outputs of a template say: digests of their turns and of the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            rows = []
            for conv_id, text, spans in zip(*(batch.column(c).to_pylist() for c in names[:1] + ["formatted", "spans"]), strict=True):
                turns = template.read(text)
                said = "".join(f"{t.role}\n{t.text}\n" for t in turns)
                learned = "".join(template.unescape(text[s["text_start"]:s["text_end"]]) for s in spans if s["loss"])
                rows.append((conv_id, len(turns), _sha(said), len(learned), _sha(learned), len(text)))
            if rows:
                columns = zip(zip(*rows, strict=True), types, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    return formatted.select("conv_id", "formatted", "spans").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
