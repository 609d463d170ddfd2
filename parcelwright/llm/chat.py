"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a declarative template.

Turns of a conversation arrive sorted inside a partition and are streamed, so a conversation is never held as a whole,
however long. The machine checks the order of turns; the template says what text stands around a turn and which part
counts for the loss. Control strings inside texts are escaped, so the formatted text can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

_SCHEMA = "conv_id long, segment long, text string, loss boolean, valid boolean, problem string"
BATCH_CHARS = 4_000_000


@dataclass(frozen=True)
class Template:
    """``turns[role]`` is a list of (literal or ``{text}``, loss flag); ``other`` serves roles that it doesn't name."""

    turns: dict[str, tuple[tuple[str, bool], ...]]
    other: tuple[tuple[str, bool], ...]
    control: tuple[str, ...]
    #: state -> role -> next state; a role that is missing breaks the order.
    order: dict[str, dict[str, str]] = field(default_factory=dict)
    accept: frozenset[str] = frozenset()

    def escaper(self) -> re.Pattern[str]:
        return re.compile("|".join(re.escape(c) for c in sorted(self.control, key=len, reverse=True)))


INSTRUCT = Template(
    turns={
        "system": (("<<SYS>>\n", False), ("{text}", False), ("\n<</SYS>>\n\n", False)),
        "user": (("<s>[INST] ", False), ("{text}", False), (" [/INST]", False)),
        "assistant": ((" [ANS] ", False), ("{text}", True), ("</s>", False)),
    },
    other=(("[ROLE] {role}\n", False), ("{text}", False), (" [/ROLE]", False)),
    control=("<s>", "</s>", "[INST]", "[/INST]", "[ANS]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"),
    order={"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user"}},
    accept=frozenset({"user", "assistant"}),
)


def escape(text: str, pattern: re.Pattern[str]) -> str:
    """Backslashes are doubled and one is put after the first character of every control string."""
    return pattern.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.string())
    names = ("conv_id", "segment", "text", "loss", "valid", "problem")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = template.escaper()
        current, state, problem, n = object(), "start", None, 0
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))
            for conv, turn, role, text in zip(*columns, strict=True):
                role, text = role or "", text or ""
                if conv != current:
                    current, state, problem, n = conv, "start", None, 0
                following = template.order.get(state, {}).get(role)
                if following is None and problem is None:
                    problem = f"{role or 'no role'} after {state} at turn {turn}"
                state = following or role
                for part, loss in template.turns.get(role, template.other):
                    if part == "{text}":
                        part = escape(text, pattern)
                    elif "{role}" in part:
                        part = part.replace("{role}", escape(role, pattern).replace("\n", "\\n"))
                    rows.append((conv, n, part, loss, problem is None, problem))
                    held += len(part)
                    n += 1
                if held > BATCH_CHARS or len(rows) > 50_000:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    return run


def by_conversation(rows: DataFrame) -> DataFrame:
    """Turns dealt by conversation and sorted; ties of a turn number go by role, then text."""
    return rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Segments ``conv_id, segment, text, loss, valid, problem``, in order within each partition.

    Joined in order, a conversation's segments are its formatted text. ``valid`` turns false at the turn that breaks the
    order (``problem`` says how); the conversation is still formatted whole. Null text and role count as empty, null
    conv_id is a conversation of its own, repeated rows are turns of their own, an empty table has no segments.
    """
    return by_conversation(rows).mapInArrow(_format(template), _SCHEMA)


class Reader:
    """Reads turns from formatted text as it comes: what opens a turn names its role, the first unescaped closing string
    after it ends the turn. Only the formatted text is looked at."""

    def __init__(self, template: Template):
        self.forms = [(role, parts[0][0].split("{role}")[0], "{role}" in parts[0][0], parts[-1][0]) for role, parts in (*template.turns.items(), ("", template.other))]
        self.longest = max(len(opening) for _, opening, _, _ in self.forms)
        self.text, self.form, self.searched = "", None, 0

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """Role and text of the turns that ``text`` completes."""
        self.text += text
        while self.text:
            if self.form is None:
                self.form = next((f for f in self.forms if self.text.startswith(f[1])), None)
                if self.form is None:
                    if len(self.text) < self.longest and any(f[1].startswith(self.text) for f in self.forms):
                        return
                    raise ValueError(f"no turn of this template: {self.text[:40]!r}")
                self.searched = len(self.form[1])
            role, opening, named, closing = self.form
            end = self.text.find(closing, self.searched)
            if end < 0:
                self.searched = max(len(opening), len(self.text) - len(closing) + 1)
                return
            body = self.text[len(opening) : end]
            if named:
                role, _, body = body.partition("\n")
                role = re.sub(r"\\(\\|n)?", lambda m: {"n": "\n", "\\": "\\", None: ""}[m[1]], role)
            self.text, self.form = self.text[end + len(closing) :], None
            yield role, unescape(body)

    def close(self) -> None:
        if self.text:
            raise ValueError(f"a turn that never ends: {self.text[:40]!r}")


def _read_back(template: Template):
    schema = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "problem"]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        reader, last = None, ""
        turns = loss = hashlib.sha256()
        n = loss_chars = chars = 0
        problem = None
        out: list[tuple] = []

        def finish() -> tuple:
            reader.close()
            why = problem or (f"ends after {last or 'no role'}" if template.accept and last not in template.accept else None)
            return current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, why is None, why

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "text", "loss", "problem"))
            for conv, segment, text, counts, why in zip(*columns, strict=True):
                if segment == 0:
                    if reader:
                        out.append(finish())
                    current, reader, problem = conv, Reader(template), None
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n = loss_chars = chars = 0
                chars += len(text)
                problem = why
                if counts:
                    plain = unescape(text)
                    loss.update(plain.encode())
                    loss_chars += len(plain)
                for last, said in reader.feed(text):
                    turns.update(f"{last}\n{said}\n".encode())
                    n += 1
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=schema)
                out = []
        if reader:
            out.append(finish())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=schema)

    return run


def digest(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, read back from the segments of ``format_conversations`` in the order they come.

    Turns are read from the formatted text by its control strings, the loss from the segments' flags; ``valid`` and
    ``problem`` are the verdict of the state machine on the order of turns and on the state in which they end.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, problem string"
    return segments.mapInArrow(_read_back(template), schema)
