"""Conversations as training text with a loss mask, through a compiled template.

Turns are gathered by conversation in turn order and rendered one message at a time.  The text leaves in parts of about
PART_CHARS characters, cut between template pieces; nearly every conversation is one part, and one of any length needs no
more memory than a part and a message.  A part lists the spans under generation markers.

Control strings inside texts get a backslash after their first character, and backslashes are doubled.  So none of them
survives in an escaped text, and `unescape` restores it.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise, records
from demandspark.llm.templates import compile_template

CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for message in messages %}<|im_start|>{{ message.role | escape_line }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
PART_CHARS = 1 << 20

_SPECIAL = re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)]))
_ESCAPED = re.compile(r"\\(.?)", re.S)
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_line(text: str) -> str:
    """Escaped, and on one line."""
    return escape(text).replace("\n", "\\n")


def unescape_line(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int32()),
        ("formatted", pa.large_string()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ]
)
DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, formatted, spans: the rendered text of every conversation, with its spans under the loss.

    Turns go in the order of turn, role and text, NULL first.  A NULL role or text is empty; a NULL conv_id is a
    conversation of its own; repeated rows are turns of their own; other columns are ignored.  Without rows the result
    is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape, "escape_line": escape_line})
        out: dict[str, list] = {name: [] for name in FORMATTED.names}
        held = 0
        for conversation, rows in groupby(_rows(batches), key=lambda row: row[0]):
            messages = ({"role": role, "text": text} for _, role, text in rows)
            part, pieces, spans, size = 0, [], [], 0

            def close() -> None:
                for name, value in zip(FORMATTED.names, (conversation, part, "".join(pieces), spans)):
                    out[name].append(value)

            for text, marked in render({"messages": messages}):
                if marked and text:
                    spans.append({"begin": size, "end": size + len(text)})
                pieces.append(text)
                size += len(text)
                if size >= PART_CHARS:
                    close()
                    yield records(out, FORMATTED)
                    out, held = {name: [] for name in FORMATTED.names}, 0
                    part, pieces, spans, size = part + 1, [], [], 0
            if size or not part:
                close()
                held += size
            if held >= PART_CHARS:
                yield records(out, FORMATTED)
                out, held = {name: [] for name in FORMATTED.names}, 0
        yield records(out, FORMATTED)

    plain = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("turn"),
    )
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(
        run, "conv_id bigint, part int, formatted string, spans array<struct<begin: bigint, end: bigint>>"
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted text and spans alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {name: [] for name in DIGESTS.names}
        for conversation, rows in groupby(_rows(batches), key=lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            rest: list[str] = []  # text after the last whole turn
            for _, text, spans in rows:
                chars += len(text)
                for span in spans:
                    said = unescape(text[span["begin"] : span["end"]])
                    loss_chars += len(said)
                    loss.update(said.encode())
                rest.append(text)
                if "<|im_end|>\n" in text or len(rest) > 1:
                    whole, end = "".join(rest), 0
                    for turn in _TURN.finditer(whole):
                        turns.update(f"{unescape_line(turn[1])}\n{unescape(turn[2])}\n".encode())
                        n_turns, end = n_turns + 1, turn.end()
                    rest = [whole[end:]]
            if any(rest):
                raise ValueError(f"conversation {conversation} does not end with a turn")
            values = (conversation, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)
            for name, value in zip(DIGESTS.names, values):
                out[name].append(value)
            if len(out["conv_id"]) >= 4096:
                yield records(out, DIGESTS)
                out = {name: [] for name in DIGESTS.names}
        yield records(out, DIGESTS)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.select("conv_id", "formatted", "spans").mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


def round_trip(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Format, write, read the output and describe it."""
    return read_back(materialise(format_conversations(turns, template), "formatted"))
