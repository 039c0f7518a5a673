"""Chat formatting: a finite-state machine over roles and a declarative template.

Turns stream through the machine in order. Each becomes three segments of output: the
template's opening, the text with control strings escaped, the closing; a segment carries a
loss flag, set only on the texts of the roles the template trains on. Escaping is reversible:
one backslash goes between ``<`` and ``|`` (behind backslashes already there), so an escaped
text never holds a control string and taking one backslash away restores it.

A conversation is hashed and checked in order by one task, but streamed: a task holds the state
of one conversation, never its turns, and rows of other conversations run beside it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

START = ""


@dataclass(frozen=True)
class Template:
    """Marks around a turn, roles whose texts carry loss, and which role may follow which."""

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {
        START: frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}),
        "assistant": frozenset({"user", "tool"}), "tool": frozenset({"assistant", "tool"}),
    })
    final: frozenset[str] = frozenset({"assistant"})


CHATML = Template()
_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Machine:
    """The state of one conversation: the role of its last turn, and whether every turn was allowed."""

    def __init__(self, template: Template):
        self.template, self.state, self.in_order = template, START, True

    def step(self, role: str) -> bool:
        if role not in self.template.follows.get(self.state, ()):
            self.in_order = False
        self.state = role if role in self.template.follows else self.state
        return self.in_order

    def accepts(self) -> bool:
        return self.in_order and self.state in self.template.final


def _in_order(rows: DataFrame, *within: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *within)


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per turn: conv_id, place (from 0), segments (text, loss) and in_order.

    ``turns`` has conv_id, turn, role, text. Turns are taken by turn, then role, then text (nulls
    first); a null role or text is empty, rows with a null conv_id form one conversation, and
    repeated rows are turns of their own. ``in_order`` turns false at the first turn whose role may
    not follow the one before. Joining all segment texts gives the formatted conversation.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current: object = run  # no conversation yet
        machine, place = Machine(template), 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: dict[str, list] = {"conv_id": ids, "place": [], "segments": [], "in_order": []}
            for conv, role, text in zip(ids, batch.column(1), batch.column(2), strict=True):
                if current is run or conv != current:
                    current, machine, place = conv, Machine(template), 0
                role = role.as_py() or ""
                out["place"].append(place)
                out["in_order"].append(machine.step(role))
                out["segments"].append([
                    {"text": template.opening + _escape_role(role) + template.after_role, "loss": False},
                    {"text": escape(text.as_py() or ""), "loss": role in template.loss_roles},
                    {"text": template.closing, "loss": False},
                ])
                place += 1
            yield out

    ordered = _in_order(turns.select("conv_id", "turn", "role", "text"), "turn", "role", "text").select("conv_id", "role", "text")
    return map_arrow(ordered, run, "conv_id bigint, place bigint, segments array<struct<text: string, loss: boolean>>, in_order boolean")


class _Digest:
    def __init__(self, conv: int | None, template: Template):
        self.conv, self.template, self.machine = conv, template, Machine(template)
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segments: list[dict]) -> None:
        """Read one turn back from its output alone."""
        whole = "".join(s["text"] for s in segments)
        t = self.template
        role, text = whole[len(t.opening):-len(t.closing)].split(t.after_role, 1)
        role, text = _unescape_role(role), unescape(text)
        self.machine.step(role)
        self.turns += 1
        self.chars += len(whole)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for segment in segments:
            if segment["loss"]:
                shown = unescape(segment["text"])
                self.loss_chars += len(shown)
                self.loss.update(shown.encode("utf-8", "surrogatepass"))


def digest_conversations(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation, read back from ``format_conversations`` output by parsing it.

    Columns: conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars,
    loss_sha256 (text under the loss mask), formatted_chars, valid (the machine accepts).
    """
    def row(done: list[_Digest]) -> dict:
        return {
            "conv_id": [d.conv for d in done], "n_turns": [d.turns for d in done], "turns_sha256": [d.all.hexdigest() for d in done],
            "loss_chars": [d.loss_chars for d in done], "loss_sha256": [d.loss.hexdigest() for d in done],
            "formatted_chars": [d.chars for d in done], "valid": [d.machine.accepts() for d in done],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current: _Digest | None = None
        for batch in batches:
            done = []
            for conv, segments in zip(batch.column(0), batch.column(1), strict=True):
                conv = conv.as_py()
                if current is None or conv != current.conv:
                    if current is not None:
                        done.append(current)
                    current = _Digest(conv, template)
                current.add(segments.as_py())
            yield row(done)
        if current is not None:
            yield row([current])

    ordered = _in_order(formatted.select("conv_id", "place", "segments"), "place").select("conv_id", "segments")
    return map_arrow(
        ordered, run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean",
    )


def formatted_text(formatted: DataFrame) -> DataFrame:
    """conv_id, place and the turn's formatted text, for writing out."""
    return formatted.select("conv_id", "place", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"))
