"""Chat formatting: a finite-state machine over roles, a declarative template, per-segment loss flags.

A template names the strings around a turn, the roles whose text counts for the loss and the role
that may follow each role. Every turn yields three segments: head, body, tail. Only the body of a
loss role carries the flag. Control strings inside texts are escaped by one more backslash between
'<' and '|', which reading back takes away again; '%' and line feeds in roles are escaped too.

The machine judges turn order and marks offending turns (turn_ok); it formats them all the same, so
no row is lost.

Defined results: null text and null role count as empty; rows go by turn (nulls first), then role and
text, so ties and repeated rows have one order; rows with a null conv_id form one conversation; an
empty table gives no segments; further columns are not read. A conversation of any length passes
through its task as a stream: no more than one batch and one turn are held.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """start, role, middle, text, end of a turn; follows: the roles that may come after each ('' at the start)."""

    start: str = "<|im_start|>"
    middle: str = "\n"
    end: str = "<|im_end|>\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )

    def __post_init__(self):
        if not (self.start.startswith("<|") and self.end.startswith("<|")):
            raise ValueError("control strings start with <|, which is what texts have escaped")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


#: Turns whose segments go out together.
TURNS_AT_ONCE = 2000


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Segments of all conversations: conv_id, turn_no (from 0), part, text, loss, turn_ok; in order within a partition."""
    ordered = (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches):
        current, state, number = object(), "", 0
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            for lo in range(0, len(rows), TURNS_AT_ONCE):
                out = []
                for conv, role, text in rows[lo : lo + TURNS_AT_ONCE]:
                    if conv != current:
                        current, state, number = conv, "", 0
                    ok = role in template.follows.get(state, ())
                    out.append((conv, number, "head", template.start + escape_role(role) + template.middle, False, ok))
                    out.append((conv, number, "body", escape(text), role in template.loss_roles, ok))
                    out.append((conv, number, "tail", template.end, False, ok))
                    state, number = role, number + 1
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["conv_id", "turn_no", "part", "text", "loss", "turn_ok"])

    return ordered.mapInArrow(run, "conv_id bigint, turn_no bigint, part string, text string, loss boolean, turn_ok boolean")


def read_back(segments: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation from the segments' texts and flags alone: the turns are parsed out of the text.

    Takes the segments as format_chats leaves them, a conversation's in order within one partition.
    """
    turn = re.compile(re.escape(template.start) + r"((?:(?!<\|)[^\n])*)" + re.escape(template.middle) + r"((?:(?!<\|).)*)" + re.escape(template.end), re.S)

    class Fold:
        def __init__(self, conv):
            self.conv, self.buffer, self.turns, self.loss_chars, self.chars, self.bad = conv, "", 0, 0, 0, 0
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()

        def take(self, text, loss, last, ok):
            self.chars += len(text)
            self.buffer += text
            if loss:
                plain = unescape(text)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode("utf-8", "surrogatepass"))
            while text.endswith(template.end) and (found := turn.match(self.buffer)):
                self.all.update(f"{unescape_role(found[1])}\n{unescape(found[2])}\n".encode("utf-8", "surrogatepass"))
                self.buffer = self.buffer[found.end() :]
                self.turns += 1
            self.bad += last and not ok

        def row(self):
            if self.buffer:
                raise ValueError(f"conversation {self.conv} does not end with a whole turn")
            return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.bad

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_violations"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        fold = None
        for batch in batches:
            out = []
            for conv, part, text, loss, ok in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))):
                if fold is None or conv != fold.conv:
                    if fold is not None:
                        out.append(fold.row())
                    fold = Fold(conv)
                fold.take(text, loss, part == "tail", ok)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if fold is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(fold.row()), kinds)], names)

    return segments.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_violations bigint")
