"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, its text
alone under the loss mask. Turns that no reply follows are kept by one last example without a
target, so that every conversation can be read back whole. Conversations are dealt out by id,
sorted by turn, and streamed; a task holds one conversation's formatted text and one batch.
By the method the output of a conversation grows with the square of its turns.

The template marks turns with control strings. Inside texts a backslash stands in each control
string behind its first character, and backslashes are doubled; dropping each backslash and
keeping what follows it gives the text back.

Defined cases: a null text or role is empty; rows without conv_id make up one conversation;
turns are ordered by (turn, role, text), null turns first, so ties and repeated rows are turns
of their own in a fixed order; an empty table gives no examples; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_CHARS = 1 << 22
EXAMPLES = "conv_id long, example int, n_turns long, text string, mask_start long, mask_end long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"

CONTROL = re.compile(r"\\|<s>|</s>|\[/?INST\]|<</?SYS>>|<</?ROLE")
TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n\n|<s>(?P<assistant>.*?)</s>"
    r"|<<ROLE (?P<role>(?:\\.|[^\\>])*)>>(?P<other>.*?)<</ROLE>>",
    re.DOTALL,
)
FRAMES = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "assistant": ("<s>", "</s>")}


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what stands behind it."""
    before, behind = FRAMES.get(role) or ("<<ROLE " + escape(role).replace(">", "\\>") + ">>", "<</ROLE>>")
    return before, escape(text), behind


def parse_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    while at < len(text):
        m = TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        turns.append((unescape(m["role"]) if kind == "other" else kind, unescape(m[kind])))
        at = m.end()
    return turns


def _rows(batches: Iterator[pa.RecordBatch], *names: str):
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


class _Batches:
    """Arrow batches of bounded text size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.chars = schema, [], 0

    def add(self, row: tuple, chars: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if self.chars >= BATCH_CHARS or len(self.rows) >= 10_000:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.chars = [], 0


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(_schema(EXAMPLES))
    conv, parts, chars, turns, examples, open_turns = object(), [], 0, 0, 0, False

    def tail():
        if open_turns:
            text = "".join(parts)
            yield from out.add((conv, examples, turns, text, len(text), len(text)), len(text))

    for conv_id, role, content in _rows(batches, "conv_id", "role", "text"):
        if conv_id != conv:
            yield from tail()
            conv, parts, chars, turns, examples, open_turns = conv_id, [], 0, 0, 0, False
        before, escaped, behind = format_turn(role or "", content or "")
        start = chars + len(before)
        parts.append(before + escaped + behind)
        chars += len(parts[-1])
        turns += 1
        open_turns = role != "assistant"
        if not open_turns:
            text = "".join(parts)
            parts = [text]
            yield from out.add((conv, examples, turns, text, start, start + len(escaped)), len(text))
            examples += 1
    yield from tail()
    yield from out.flush()


def prefix_targets(conversations: DataFrame) -> DataFrame:
    """One example per assistant turn: formatted text, and the code points of it that are under the loss mask."""
    turns = conversations.selectExpr("CAST(conv_id AS BIGINT) AS conv_id", "turn", "role", "text")
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_expand, EXAMPLES)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(_schema("conv_id long, example int, n_turns long, turns_sha256 string, chars long, loss string"))
    for conv_id, example, text, start, end in _rows(batches, "conv_id", "example", "text", "mask_start", "mask_end"):
        digest, turns = hashlib.sha256(), parse_turns(text)
        for role, content in turns:
            digest.update(f"{role}\n{content}\n".encode())
        loss = unescape(text[start:end]) if end > start else None
        yield from out.add((conv_id, example, len(turns), digest.hexdigest(), len(text), loss), end - start)
    yield from out.flush()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(_schema(DIGESTS))
    state = None

    def done():
        if state:
            conv, turns, sha, chars, loss, formatted, examples = state
            yield from out.add((conv, turns, sha, chars, loss.hexdigest(), formatted, examples), 200)

    for conv_id, turns, sha, chars, loss in _rows(batches, "conv_id", "n_turns", "turns_sha256", "chars", "loss"):
        if state is None or state[0] != conv_id:
            yield from done()
            state = [conv_id, 0, "", 0, hashlib.sha256(), 0, 0]
        state[1], state[2] = turns, sha  # the last example has all turns
        state[3] += len(loss or "")
        state[4].update((loss or "").encode())
        state[5] += chars
        state[6] += 1
    yield from done()
    yield from out.flush()


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples' texts and masks: turns and their digest, loss text and its digest, formatted size."""
    read = examples.mapInArrow(_read, "conv_id long, example int, n_turns long, turns_sha256 string, chars long, loss string")
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "example").mapInArrow(_digest, DIGESTS)


def with_probe(conversations: DataFrame) -> DataFrame:
    """The turns, and conversation -7, whose texts hold control strings."""
    probe = conversations.sparkSession.sql(
        "SELECT -7L AS conv_id, t AS turn, r AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)"
    )
    return conversations.select(*(F.col(c) for c in ("conv_id", "turn", "role", "text"))).unionByName(probe)
