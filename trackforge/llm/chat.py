"""Chat formatting by grammar round trip.

A conversation is rendered into a template whose grammar is

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" body "<|im_end|>" "\\n"

Each turn is rendered plainly first, parsed back by ``parse`` and compared with
its source; as long as they differ, the text is escaped and the turn rendered
again.  Escaping puts one backslash into every control string (or already
escaped control string) of the text, so it can be undone exactly and a rendered
conversation never holds a control string that is not the template's own.

Defined results: a null text or role is an empty string; turns are ordered by
``turn`` (nulls first, ties by their rendered text); repeated rows are turns of
their own; a null ``conv_id`` is one conversation; an empty table gives an empty
result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackforge.llm.common import in_batches

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")


class GrammarError(ValueError):
    """The text is not in the template's language."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def _role_out(role: str) -> str:
    """Roles stand on one line of the template, so line breaks are written as \\n."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns as (role, text, start and length of the rendered text), or GrammarError."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise GrammarError(f"no turn begins at {at}")
        line = rendered.find("\n", at)
        end = rendered.find(END, at)
        if line < 0 or end < line or not rendered.startswith("\n", end + len(END)):
            raise GrammarError(f"the turn at {at} does not end")
        body = rendered[line + 1 : end]
        if START in body:
            raise GrammarError(f"a turn begins inside the turn at {at}")
        turns.append((_role_in(rendered[at + len(START) : line]), unescape(body), line + 1, len(body)))
        at = end + len(END) + 1
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, with the start and length of its text; it parses back to exactly (role, text)."""
    body = text
    for _ in range(2):
        rendered = f"{START}{_role_out(role)}\n{body}{END}\n"
        try:
            turns = parse(rendered)
        except GrammarError:
            turns = []
        if [t[:2] for t in turns] == [(role, text)]:
            return rendered, *turns[0][2:]
        body = escape(body)
    raise GrammarError(f"no rendering of {text[:80]!r} parses back")


FORMATTED = "conv_id long, turn long, formatted string, loss_start int, loss_length int"


def format_turns(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Rendered turns; joined in order they are the conversation's text.

    ``loss_start`` and ``loss_length`` mark the text under the loss mask inside
    ``formatted`` (length 0 for roles that are not trained on).  Turns are
    rendered where they lie: no shuffle.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles, texts = b.column("role").to_pylist(), b.column("text").to_pylist()
            made = [render(r or "", t or "") for r, t in zip(roles, texts)]
            trained = [r == loss_role for r in roles]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("conv_id"),
                    b.column("turn"),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.int32()),
                    pa.array([m[2] if t else 0 for m, t in zip(made, trained)], pa.int32()),
                ],
                names=["conv_id", "turn", "formatted", "loss_start", "loss_length"],
            )

    columns = F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    return in_batches(conversations.select(*columns)).mapInArrow(work, FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Digest:
    """What is read back of one conversation; holds no texts."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, loss_start: int, loss_length: int) -> None:
        for role, text, _, _ in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        masked = unescape(formatted[loss_start : loss_start + loss_length])
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.chars += len(formatted)

    def row(self) -> list:
        return [self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars]


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted turns and digest each conversation.

    A digest runs over a conversation from its first turn to its last, so a
    conversation is read by one task, but as a stream in turn order: only the
    running digests are held, however long it is.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        current, digest = None, None
        for b in batches:
            rows = []
            for conv, text, start, length in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_length"))):
                if digest is None or conv != current:
                    if digest is not None:
                        rows.append([current, *digest.row()])
                    current, digest = conv, _Digest()
                digest.add(text, start, length)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip([current, *digest.row()], schema.types)], schema=schema)

    return in_batches(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted").mapInArrow(work, DIGEST)
