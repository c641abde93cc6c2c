"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names, for each role, the header that opens a turn and whether its text is under
the loss. ``format_conversations`` walks the turns of each conversation in order, validates
them with the machine and emits one row per text segment (header, body, close) with its own
loss flag, so the formatted text is the segments of a conversation put together, and the mask
is the flags. Control strings inside a text are escaped with a backslash, and backslashes
are doubled, so the text can be read back and no text can open or close a turn.

Turns are placed by conversation and sorted inside each part; a task streams over them and
keeps one state, never a conversation. A conversation's hash is sequential by nature, so one
conversation is one task's stream, however long; its memory does not grow.

Defined cases: null texts are empty. Roles not in the template, the empty and the null one
among them, get the header of ``OTHER`` with the escaped role in it; a null role reads back
as empty. Turns with equal numbers are ordered by role, then text; null turns come first;
null conversation ids form one conversation. Faulty turn orders are formatted all the same
and flagged. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    headers: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: tuple[str, str] = ("### Other ", ": ")
    close: str = " </turn>\n"
    # Strings that may not stand unescaped inside a text. None is part of, or overlaps, another.
    controls: tuple[str, ...] = ("### ", "</turn>")
    loss_roles: tuple[str, ...] = ("assistant",)
    # state -> role -> next state; a missing entry is a fault.
    machine: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    final: tuple[str, ...] = ("answered", "asked")

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for control in self.controls:
            text = text.replace(control, "\\" + control)
        return text

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def header(self, role: str) -> str:
        known = self.headers.get(role)
        # The colon ends such a role, so it is escaped too.
        return known or self.other[0] + self.escape(role).replace(":", "\\:") + self.other[1]

    def role(self, header: str) -> str:
        for name, known in self.headers.items():
            if header == known:
                return name
        return self.unescape(header[len(self.other[0]) : -len(self.other[1])])

    def step(self, state: str, role: str) -> str | None:
        return self.machine.get(state, {}).get(role)

    def resume(self, role: str) -> str:
        """The state after a faulty turn: the one its role leads to from anywhere."""
        return next((row[role] for row in self.machine.values() if role in row), "start")


def ordered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Rows of a conversation side by side and in order, without moving them through one task."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


SEGMENT = "conv_id long, turn_no long, segment_no int, kind string, text string, loss boolean, fault boolean"


def _formatter(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, number = object(), "start", 0
        for batch in batches:
            out: dict[str, list] = {name.split()[0]: [] for name in SEGMENT.split(", ")}
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if conv != last:
                    last, state, number = conv, "start", 0
                following = template.step(state, role)
                state = following or template.resume(role)
                parts = (("header", template.header(role)), ("body", template.escape(text)), ("close", template.close))
                for i, (kind, piece) in enumerate(parts):
                    for name, value in zip(out, (conv, number, i, kind, piece, kind == "body" and role in template.loss_roles, following is None)):
                        out[name].append(value)
                number += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return run


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turn_no, segment_no, kind, text, loss, fault): three segments for each turn."""
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = ordered(turns, "turn", "role", "text").select("conv_id", "role", "text")
    return placed.mapInArrow(_formatter(template), SEGMENT)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_faults long")


def _reader(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        last, own = object(), None

        def close():
            if own is not None:
                done.append((last, own["n"], own["turns"].hexdigest(), own["loss"], own["masked"].hexdigest(), own["chars"], own["faults"]))

        def flush():
            fields = [pa.field(x.split()[0], pa.string() if "string" in x else pa.int64()) for x in DIGEST.split(", ")]
            columns = list(zip(*done)) or [[]] * len(fields)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))
            done.clear()
            return batch

        for batch in batches:
            for conv, kind, text, loss, fault in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if conv != last or own is None:
                    close()
                    last = conv
                    own = {"n": 0, "turns": hashlib.sha256(), "loss": 0, "masked": hashlib.sha256(), "chars": 0, "faults": 0}
                own["chars"] += len(text)
                plain = template.unescape(text)
                if kind == "header":
                    own["n"] += 1
                    own["faults"] += fault
                    own["turns"].update(f"{template.role(text)}\n".encode("utf-8", "surrogatepass"))
                elif kind == "body":
                    own["turns"].update(f"{plain}\n".encode("utf-8", "surrogatepass"))
                if loss:
                    own["loss"] += len(plain)
                    own["masked"].update(plain.encode("utf-8", "surrogatepass"))
            if len(done) >= 5000:
                yield flush()
        close()
        yield flush()

    return run


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation from its segments alone, unescaped."""
    placed = ordered(segments, "turn_no", "segment_no").select("conv_id", "kind", "text", "loss", "fault")
    return placed.mapInArrow(_reader(template), DIGEST)


def formatted_texts(segments: DataFrame) -> DataFrame:
    """One string per conversation, for those who want it: a conversation must fit one row."""
    each = F.array_sort(F.collect_list(F.struct("turn_no", "segment_no", "text")))
    return segments.groupBy("conv_id").agg(F.array_join(F.transform(each, lambda s: s.text), "").alias("formatted"))
