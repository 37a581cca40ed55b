"""Chat formatting: a state machine over roles and a declarative template.

The template says which marks open and close a turn of each role, whether its
text bears loss, and which role may follow which. Formatting gives one row per
text segment with its loss flag; `read_back` parses such segments again.

A control string inside a text gets an escape character after its first
character, and one more for each that is there already, so no mark of the
template can be spelled by a text, and the change can be undone exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, ERROR = "start", "error"
ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks per role, a form for roles it does not name, and the allowed successions."""

    turns: dict[str, Turn]
    other: Turn
    follows: dict[str, tuple[str, ...]]
    last: tuple[str, ...]
    controls: tuple[str, ...] = field(default=())

    def pattern(self, escaped: bool) -> re.Pattern:
        firsts: dict[str, list[str]] = {}
        for word in self.controls:
            firsts.setdefault(word[0], []).append(re.escape(word[1:]))
        one = "+" if escaped else "*"
        parts = [
            f"{re.escape(first)}{re.escape(ESCAPE)}{one}(?:{'|'.join(sorted(rest, key=len, reverse=True))})"
            for first, rest in firsts.items()
        ]
        return re.compile("|".join(parts))


#: The marks of a widely used instruction format.
INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s> ", " </s>", loss=True),
    },
    other=Turn("[ROLE] ", " [/ROLE]"),
    follows={
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    last=("assistant",),
    controls=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]"),
)

SEGMENTS = "conv_id long, segment long, text string, loss boolean, state string"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "valid boolean"
)


def escape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: m[0][0] + m[0][2:], text)


def step(state: str, role: str, template: Template) -> str:
    """The state after a turn; `error` is never left."""
    return role if role in template.follows.get(state, ()) else ERROR


def conversations(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in rows:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of at most 2,000 rows and about `most` characters."""
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= 2000 or chars >= most:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


SEGMENT_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("segment", pa.int64()), ("text", pa.string()), ("loss", pa.bool_()), ("state", pa.string())]
)
DIGEST_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()),
    ]
)


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Segments `(conv_id, segment, text, loss, state)`; their texts in order make up the training text.

    A turn gives its opening mark, its escaped text and its closing mark. Turns
    go by turn number; ties by role and text, so repeated rows are repeated
    turns; NULL numbers come first. NULL role and text count as empty. A turn out
    of order is formatted like any other, and `state` is `error` from there on.
    Rows with a NULL conv_id form one conversation. Other columns are ignored; an
    empty table gives no rows. Rows stream through sorted partitions: a
    conversation of any length needs the memory of one turn.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = template.pattern(escaped=False)

        def segments() -> Iterator[tuple]:
            conv: object = object()
            state, number = START, 0
            for conv_id, _, role, text in conversations(source):
                if conv_id != conv:
                    conv, state, number = conv_id, START, 0
                state = step(state, role, template)
                turn = template.turns.get(role, template.other)
                opening = turn.opening
                if role not in template.turns:
                    opening += escape(role, plain) + "\n"
                parts = (opening, False), (escape(text, plain), turn.loss), (turn.closing, False)
                for part, loss in parts:
                    yield conv_id, number, part, loss, state
                    number += 1

        return batched(segments(), SEGMENT_ARROW)

    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.mapInArrow(run, SEGMENTS)


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digests of conversations, parsed from their formatted segments.

    Roles are told from the marks and texts are unescaped. `valid` says that the
    state machine met no turn out of order and ended where it may.
    """
    by_opening = {t.opening: role for role, t in template.turns.items()}

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = template.pattern(escaped=True)

        def turn(segment: str) -> str:
            if segment in by_opening:
                return by_opening[segment]
            return unescape(segment[len(template.other.opening) : -1], marked)

        def digests() -> Iterator[tuple]:
            conv: object = object()
            began, role, place = False, "", 0
            for conv_id, _, text, loss, state in conversations(source):
                if not began or conv_id != conv:
                    if began:
                        yield conv, n, whole.hexdigest(), chars, masked.hexdigest(), size, last in template.last
                    conv, began, place = conv_id, True, 0
                    n, chars, size, last = 0, 0, 0, START
                    whole, masked = hashlib.sha256(), hashlib.sha256()
                size += len(text)
                if place == 0:
                    role = turn(text)
                    n, last = n + 1, state
                    whole.update(f"{role}\n".encode("utf-8", "surrogatepass"))
                elif place == 1:
                    said = unescape(text, marked)
                    whole.update(f"{said}\n".encode("utf-8", "surrogatepass"))
                    if loss:
                        chars += len(said)
                        masked.update(said.encode("utf-8", "surrogatepass"))
                place = (place + 1) % 3
            if began:
                yield conv, n, whole.hexdigest(), chars, masked.hexdigest(), size, last in template.last

        return batched(digests(), DIGEST_ARROW)

    placed = segments.select("conv_id", "segment", "text", "loss", "state")
    placed = placed.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return placed.mapInArrow(run, DIGESTS)
