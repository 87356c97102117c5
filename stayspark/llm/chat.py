"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example has all turns before it as context and only its own reply under the loss mask. The template marks turns as

    ### Role: text </turn>

one after the other, each ended by a line feed. Inside a text a backslash stands before every backslash and before every
control string (`###` and `</turn>`), so what was formatted can be read back. Roles are escaped alike, and in them colons too.
Turns after the last reply, and conversations without a reply, give one more example with no trainable text, so nothing is lost.

Defined results: null text is empty, null role is the empty role; turns go by number (null first), ties by role and text;
repeated rows are turns of their own; a null conv_id is a conversation; an empty table gives no example; other columns are
ignored. A conversation is streamed: memory holds one conversation's formatted text, not its table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.llm.common import arrow_rows, table

OPEN, CLOSE = "### ", " </turn>\n"
CONTROL = re.compile(r"\\|###|</turn>")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|:|\n")
HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)
UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
REPLY = "assistant"
EXAMPLES = "conv_id long, example int, turns int, text string, loss_start long, loss_end long, last boolean"
_EXAMPLES = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("turns", pa.int32()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("last", pa.bool_())])
BATCH_CHARS = 4 << 20


def escape(text: str, control: re.Pattern = CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def expand(turns: Iterator[tuple[int | None, str, str]]) -> Iterator[tuple]:
    """Examples of turns that come conversation by conversation, in order."""
    conv, parts, size, example, pending, begun = None, [], 0, 0, None, False

    def closing() -> Iterator[tuple]:
        if pending is not None:
            yield (*pending, True)
        elif begun:
            yield conv, example, len(parts), "".join(parts), size, size, True

    for now, role, text in turns:
        if not begun or now != conv:
            yield from closing()
            conv, parts, size, example, pending, begun = now, [], 0, 0, None, True
        if pending is not None:
            yield (*pending, False)
            pending = None
        head = f"{OPEN}{escape(role, ROLE_CONTROL)}: "
        body = escape(text)
        parts.append(head + body + CLOSE)
        if role == REPLY:
            start = size + len(head)
            pending = (conv, example, len(parts), "".join(parts), start, start + len(body))
            example += 1
        size += len(parts[-1])
    yield from closing()


def examples(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, example, turns, text, loss_start, loss_end, last); offsets are in code points of `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(k).to_pylist() for k in ("conv_id", "role", "text")], strict=True)

        rows, chars = [], 0
        for row in expand(turns()):
            rows.append(row)
            chars += len(row[3])
            if chars > BATCH_CHARS:
                yield arrow_rows(_EXAMPLES, **dict(zip(_EXAMPLES.names, zip(*rows, strict=True), strict=True)))
                rows, chars = [], 0
        if rows:
            yield arrow_rows(_EXAMPLES, **dict(zip(_EXAMPLES.names, zip(*rows, strict=True), strict=True)))

    by = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return by.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, EXAMPLES)


def read_back(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted text."""
    out, at = [], 0
    while at < len(text):
        head = HEAD.match(text, at)
        # Inside a body every close mark has a backslash before it, so the first one after a blank ends the turn.
        end = text.find(CLOSE, head.end()) if head else -1
        if end < 0:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(head[1]), unescape(text[head.end() : end])))
        at = end + len(CLOSE)
    return out


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"


def digests(made: DataFrame) -> DataFrame:
    """One row a conversation from its examples, which follow each other in a task: turns from the last example's text,
    trained text from every example's loss span; formatted_chars sums over the examples."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0
        for batch in batches:
            rows = []
            for conv, text, start, end, last in zip(*[batch.column(k).to_pylist() for k in ("conv_id", "text", "loss_start", "loss_end", "last")], strict=True):
                reply = unescape(text[start:end])
                loss.update(reply.encode())
                loss_chars, chars, count = loss_chars + len(reply), chars + len(text), count + 1
                if last:
                    turns = read_back(text)
                    digest = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                    rows.append((conv, len(turns), digest.hexdigest(), loss_chars, loss.hexdigest(), chars, count))
                    loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0
            if rows:
                yield arrow_rows(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))

    return made.select("conv_id", "text", "loss_start", "loss_end", "last").mapInArrow(run, DIGEST)


def op2_prefix_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    return digests(examples(rows.unionByName(more)))
